"""Codes of vectors: product quantisation with exact integer codebooks and adaptive bounds."""

from __future__ import annotations

import math
from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxlake.llm.common import discard, pin, small_side
from wxlake.schemas import ddl
from wxlake.session import fresh_folder

#: Fixed values of the codes: parts of a vector, entries of a codebook, rounds, steps of one unit.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Share of the decisions that the listed entries of the next round should cover.
COVERED = 0.99
#: Entry number of an unused place in a list.
NONE = 255
#: Kinds of rows that a round writes.
ROWS, SUMS = "rows", "sums"
#: Names of sums that are not components: members of an entry, decisions by the entries they needed.
MEMBERS, NEEDED = -1, -2
LIMB = 32

Codebook = list[list[list[int]]]


def state_type(listed: int) -> np.dtype:
    """What a round keeps of a part: its entry and an upper bound of the distance to it, the ``listed`` next entries
    with ascending lower bounds, and a lower bound for all entries that are neither."""
    return np.dtype([("entry", "u1"), ("upper", "<f4"), ("outer", "<f4"), ("ids", "u1", (listed,)), ("lower", "<f4", (listed,))])


def _up(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype("<f4"), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    most = np.finfo("<f4").max
    return np.where(np.isinf(x), np.float32(np.inf), np.nextafter(np.minimum(x, most).astype("<f4"), np.float32(-np.inf)))


def _root(square: int) -> float:
    try:
        return math.sqrt(square)
    except OverflowError:
        return math.inf


class Round:
    """One round's entries, how far they have moved, and the lengths of the lists that come in and go out."""

    def __init__(self, codebook: Codebook, before: Codebook | None, listed: int, next_listed: int):
        self.exact = codebook
        self.size = len(codebook[0])
        self.width = len(codebook[0][0])
        #: Components below this in magnitude have distances within 64 bits.
        self.limit = math.isqrt(2**62 // max(1, self.width)) // 2
        self.plain = all(abs(x) < self.limit for part in codebook for entry in part for x in entry)
        self.entries = np.array(codebook, dtype=np.int64) if self.plain else None
        self.listed, self.next_listed = listed, next_listed
        self.moves = np.zeros((len(codebook), 256))
        if before is not None:
            for p, (new, old) in enumerate(zip(codebook, before)):
                for i, (a, b) in enumerate(zip(new, old)):
                    self.moves[p, i] = _root(sum((x - y) ** 2 for x, y in zip(a, b))) * (1 + 1e-9)

    def squares(self, part: int, v: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows to their entries ``ids``, as 64-bit or Python integers."""
        small = self.plain and (v.dtype != np.float64 or bool((np.abs(v) < self.limit).all()))
        if small:
            gap = v.astype(np.int64)[:, None, :] - self.entries[part][ids]
            return np.einsum("nkd,nkd->nk", gap, gap)
        out = np.empty(ids.shape, dtype=object)
        for i, (row, own) in enumerate(zip(v.tolist(), ids.tolist())):
            row = [int(x) for x in row]
            out[i] = [sum((x - y) ** 2 for x, y in zip(row, self.exact[part][e])) for e in own]
        return out

    def nearest_first(self, part: int, v: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries in order of (distance, entry), decided in integers, and their squared distances."""
        squares = self.squares(part, v, ids)
        if squares.dtype == object:
            order = np.array([sorted(range(len(s)), key=lambda j: (s[j], i[j])) for s, i in zip(squares, ids)]).reshape(ids.shape)
        else:
            order = np.lexsort((ids, squares), axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(squares, order, 1)

    @staticmethod
    def distances(squares: np.ndarray) -> np.ndarray:
        if squares.dtype == object:
            return np.array([[_root(x) for x in row] for row in squares.tolist()]).reshape(squares.shape)
        return np.sqrt(squares.astype(np.float64))

    def decide(self, part: int, v: np.ndarray, state: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The new state of the rows' part, and how many listed entries each decision needed; one more than there are for all entries."""
        n = len(v)
        new = np.zeros(n, dtype=state_type(self.listed))
        needed = np.full(n, self.listed + 1, dtype=np.int64)
        if state is None:
            self._search(part, v, np.arange(n), new)
            return new, needed
        move = self.moves[part]
        entry, ids = state["entry"], state["ids"]
        upper = state["upper"].astype(np.float64) + move[entry]
        outer = state["outer"].astype(np.float64) - move[: self.size].max()
        # Lists are ordered from their end: no entry has a bound above that of what follows it.
        own = state["lower"].astype(np.float64) - move[ids]
        lower = np.minimum.accumulate(np.concatenate([own, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :-1]
        open_ = np.flatnonzero(upper >= lower[:, 0])
        if len(open_):
            upper[open_] = self.distances(self.squares(part, v[open_], entry[open_][:, None]))[:, 0] * (1 + 1e-9)
        needed = (lower <= upper[:, None]).sum(axis=1)
        everything = (needed == self.listed) & (outer <= upper)
        new["entry"], new["upper"], new["outer"], new["ids"], new["lower"] = entry, _up(upper), _down(outer), ids, _down(lower)
        for count in np.unique(needed[(needed > 0) & ~everything]):
            at = np.flatnonzero((needed == count) & ~everything)
            among = np.concatenate([entry[at][:, None], ids[at, :count]], axis=1)
            order, squares = self.nearest_first(part, v[at], among)
            far = self.distances(squares)
            new["entry"][at], new["upper"][at] = order[:, 0], _up(far[:, 0] * (1 + 1e-9))
            new["ids"][at, :count] = order[:, 1:]
            new["lower"][at, :count] = _down(far[:, 1:] * (1 - 1e-9))
        self._search(part, v, np.flatnonzero(everything), new)
        needed[everything] = self.listed + 1
        return new, needed

    def _search(self, part: int, v: np.ndarray, at: np.ndarray, new: np.ndarray) -> None:
        """Rows whose bounds decide nothing are compared with all entries."""
        if not len(at):
            return
        everything = np.broadcast_to(np.arange(self.size, dtype=np.uint8), (len(at), self.size))
        order, squares = self.nearest_first(part, v[at], everything)
        far = self.distances(squares)
        new["entry"][at], new["upper"][at] = order[:, 0], _up(far[:, 0] * (1 + 1e-9))
        ids = np.full((len(at), self.listed), NONE, dtype=np.uint8)
        lower = np.full((len(at), self.listed), np.inf)
        rest = min(self.listed, self.size - 1)
        ids[:, :rest], lower[:, :rest] = order[:, 1 : rest + 1], far[:, 1 : rest + 1] * (1 - 1e-9)
        new["ids"][at], new["lower"][at] = ids, _down(lower)
        new["outer"][at] = _down(far[:, rest + 1] * (1 - 1e-9)) if rest + 1 < self.size else np.inf

    def resized(self, state: np.ndarray) -> np.ndarray:
        """The state with lists of the next length: dropped entries come under the outer bound, new places are open."""
        if self.next_listed == self.listed:
            return state
        kept = min(self.listed, self.next_listed)
        out = np.zeros(state.shape, dtype=state_type(self.next_listed))
        for name in ("entry", "upper", "outer"):
            out[name] = state[name]
        out["ids"][..., :kept], out["lower"][..., :kept] = state["ids"][..., :kept], state["lower"][..., :kept]
        out["ids"][..., kept:], out["lower"][..., kept:] = NONE, state["outer"][..., None]
        if kept < self.listed:
            out["outer"] = np.minimum(state["outer"], state["lower"][..., kept:].min(axis=-1))
        return out


class Totals:
    """Exact sums of a task: members and components by part and entry, and the entries that decisions needed."""

    def __init__(self, parts: int, size: int, width: int, listed: int):
        self.members = np.zeros((parts, size), dtype=np.int64)
        self.sums = np.zeros((parts, size, width), dtype=np.int64)
        self.large: dict[tuple[int, int, int], int] = {}
        self.needed = np.zeros(listed + 2, dtype=np.int64)

    def add(self, part: int, v: np.ndarray, entry: np.ndarray, needed: np.ndarray) -> None:
        self.needed += np.bincount(needed, minlength=len(self.needed))
        self.members[part] += np.bincount(entry, minlength=self.members.shape[1])
        if v.dtype == np.float64:
            wide = (np.abs(v) >= 2**31).any(axis=1)
            for row, e in zip(v[wide].tolist(), entry[wide].tolist()):
                for d, x in enumerate(row):
                    self.large[part, e, d] = self.large.get((part, e, d), 0) + int(x)
            v, entry = v[~wide], entry[~wide]
        chosen = (entry[:, None] == np.arange(self.members.shape[1])).astype(np.float64)
        self.sums[part] += (chosen.T @ v.astype(np.float64)).astype(np.int64)

    def rows(self):
        """(part, entry, place, limb, value): limbs of 32 bits, so that sums of any size add up in 64 bits."""
        for at, n in enumerate(self.needed.tolist()):
            yield (-1, at, NEEDED, 0, n)
        for (p, e), n in np.ndenumerate(self.members):
            if n:
                yield (p, e, MEMBERS, 0, int(n))
                for d, x in enumerate(self.sums[p, e].tolist()):
                    total = x + self.large.get((p, e, d), 0)
                    sign, total, limb = (-1 if total < 0 else 1), abs(total), 0
                    while total:
                        yield (p, e, d, limb, sign * (total & (2**LIMB - 1)))
                        total, limb = total >> LIMB, limb + 1


def _matrix(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """Binaries of equal width as the rows of a matrix."""
    if not len(column):
        return np.zeros((0, 0), kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return raw.reshape(len(column), -1).copy().view(kind)


def _binaries(rows: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(rows).reshape(len(rows), -1).view(np.uint8)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * raw.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _assigning(work: Round, kind: str, parts: int, first: bool):
    """A round over batches of rows: new states, and at the end of the task its sums."""
    number = np.dtype(kind)
    names = ["kind", "vec_id", "label", "v", "state", "part", "entry", "place", "limb", "value"]
    types = [pa.string(), pa.int64(), None, pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def batch_of(columns: dict, n: int, label: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(n, t or label) for c, t in zip(names, types)], names=names)

    def assign(batches):
        label = None
        totals = Totals(parts, work.size, work.width, work.listed)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            label = batch.column(1).type
            v = _matrix(batch.column(2), number)
            split = v.reshape(n, parts, work.width)
            state = None if first else _matrix(batch.column(3), state_type(work.listed)).reshape(n, parts)
            new = np.zeros((n, parts), dtype=state_type(work.listed))
            for p in range(parts):
                new[:, p], needed = work.decide(p, split[:, p], None if state is None else state[:, p])
                totals.add(p, split[:, p], new["entry"][:, p].astype(np.int64), needed)
            yield batch_of({
                "kind": pa.array([ROWS] * n), "vec_id": batch.column(0), "label": batch.column(1), "v": batch.column(2),
                "state": _binaries(work.resized(new))}, n, label)
        if label is None:
            return
        sums = list(zip(*totals.rows()))
        columns = dict(zip(names[5:], (pa.array(c, t) for c, t in zip(sums, types[5:]))))
        yield batch_of(columns | {"kind": pa.array([SUMS] * len(sums[0]))}, len(sums[0]), label)

    return assign


def _scaling(scale: int, kind: str):
    """Vectors as binaries of floor(scale * x)."""

    def scaled(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(flat * scale).astype(kind).reshape(batch.num_rows, -1)
            columns = [batch.column(0), batch.column(1), _binaries(whole)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "v"])

    return scaled


def kept_vectors(vectors: DataFrame, scale: int, column: str, key: str, label: str) -> DataFrame:
    """``vec_id``, ``label`` and ``x`` in doubles, without vectors that are null or hold null, NaN or infinity."""
    x = F.col(column).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) * F.lit(float(scale)) < float("inf")))
    return vectors.where(x.isNotNull() & finite).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), x.alias("x"))


def _codebook(first: Sequence[Sequence[float]], parts: int, scale: int) -> Codebook:
    whole = [[math.floor(x * scale) for x in vector] for vector in first]
    width = len(whole[0]) // parts
    return [[vector[p * width : (p + 1) * width] for vector in whole] for p in range(parts)]


def _moved(codebook: Codebook, sums: DataFrame) -> tuple[Codebook, list[int]]:
    """The next codebook, and how many decisions needed 0, 1, 2 ... listed entries.

    The sums are one row for a component of an entry and limb, whatever the number of vectors.
    """
    total, members, needed = {}, {}, {}
    for part, entry, place, limb, value in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value")).collect():
        if place == NEEDED:
            needed[entry] = value
        elif place == MEMBERS:
            members[part, entry] = value
        else:
            total[part, entry, place] = total.get((part, entry, place), 0) + (value << (LIMB * limb))
    moved = [[[total.get((p, e, d), 0) // members[p, e] for d in range(len(old))] if (p, e) in members else old
              for e, old in enumerate(part)] for p, part in enumerate(codebook)]
    return moved, [needed.get(i, 0) for i in range(max(needed, default=0) + 1)]


def next_length(needed: Sequence[int], listed: int, most: int, covered: float = COVERED) -> int:
    """The shortest list, of one entry at least, that was enough for the share ``covered`` of the decisions.

    If the present list was not, one of twice its length, up to ``most``.
    """
    seen, total = 0, sum(needed)
    for length, n in enumerate(needed[: listed + 1]):
        seen += n
        if length >= 1 and seen >= covered * total:
            return length
    return max(listed, min(2 * listed, most))


class Codes:
    """Result of ``fit``: rows with their states, and the final codebook."""

    def __init__(self, spark: SparkSession, rows: DataFrame | None, codebook: Codebook, lengths: list[int]):
        self.spark, self.rows, self.codebook, self.lengths = spark, rows, codebook, lengths

    def digest(self) -> str:
        """SHA-256 of all final entries' components by part, entry and position."""
        return sha256(",".join(str(x) for part in self.codebook for entry in part for x in entry).encode()).hexdigest()


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
        covered: float = COVERED) -> Codes | None:
    """Codebooks by k-means in integers, exactly as full comparisons would give them. None without vectors.

    Each round is one pass over rows that hold a vector and, for each part, its entry, the nearest other entries with lower
    bounds, and a bound for the rest (Drake and Hamerly). Entries' moves widen the bounds; where they still tell the nearest
    entry, nothing is computed. Else the listed entries in question, or at last all of them, are compared in
    integers, ties going to the lower entry. The list's length follows what 99% of the decisions of the round before
    needed, up to half of the entries.
    A round writes the rows and its sums; the driver takes sums by entry only.
    """
    spark = pin(kept.sparkSession)
    first = [r.x for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()]
    if not first:
        return None
    width, left = divmod(len(first[0]), parts)
    if left or not width:
        return Codes(spark, None, [], [])
    first = [x for x in first if len(x) == parts * width]
    codebook = _codebook(first, parts, scale)
    rows = kept.where(F.size("x") == parts * width)
    largest = rows.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0] * scale
    kind = "<i2" if largest < 2**15 - 1 else "<i4" if largest < 2**31 - 1 else "<f8"
    label = dict(kept.dtypes)["label"]
    columns = {"kind": "string", "vec_id": "bigint", "label": label, "v": "binary", "state": "binary", "part": "int", "entry": "int",
               "place": "int", "limb": "int", "value": "bigint"}
    listed = min(max(1, len(first) // 4), 254)
    lengths, before, path = [], None, None
    current = rows.mapInArrow(_scaling(scale, kind), ddl({k: columns[k] for k in ("vec_id", "label", "v")}))
    for number in range(rounds + 1):
        lengths.append(listed)
        last = number == rounds
        following = listed if before is None else next_length(needed, listed, max(1, (len(first) - 1) // 2), covered)
        work = Round(codebook, before, listed, following)
        written = fresh_folder(spark, "vector-codes")
        current.mapInArrow(_assigning(work, kind, parts, before is None), ddl(columns)).write.partitionBy("kind").parquet(written)
        stored = ddl({k: v for k, v in columns.items() if k != "kind"})
        sums = spark.read.schema(stored).parquet(f"{written}/kind={SUMS}")
        if path:
            discard(spark, path)
        path, before, listed = written, codebook, following
        current = spark.read.schema(stored).parquet(f"{path}/kind={ROWS}").select("vec_id", "label", "v", "state")
        if not last:
            codebook, needed = _moved(codebook, sums)
    answers = current.mapInArrow(
        _answers(codebook, kind, parts, width, listed), ddl({"vec_id": "bigint", "label": label, "code": "string", "error": "bigint"}))
    return Codes(spark, answers, codebook, lengths)


def _answers(codebook: Codebook, kind: str, parts: int, width: int, listed: int):
    """``code`` and ``error`` from the last states."""
    work = Round(codebook, None, listed, listed)

    def answers(batches):
        for batch in batches:
            n = batch.num_rows
            v = _matrix(batch.column(2), np.dtype(kind)).reshape(n, parts, width) if n else np.zeros((0, parts, width))
            entry = _matrix(batch.column(3), state_type(listed)).reshape(n, parts)["entry"] if n else np.zeros((0, parts), np.uint8)
            errors = np.zeros(n, dtype=object)
            for p in range(parts):
                if n:
                    errors += work.squares(p, v[:, p], entry[:, p][:, None])[:, 0].astype(object)
            columns = [
                batch.column(0), batch.column(1), pa.array([row.tobytes().hex() for row in np.ascontiguousarray(entry)], pa.string()),
                pa.array([int(e) if e < 2**63 else None for e in errors], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return answers


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             column: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of each usable vector.

    Vectors that are null or hold null, NaN or infinity (or a component that ``scale`` makes infinite) are left out. The
    codebooks start from the vectors with the smallest keys, null keys last, equal keys in order of their vectors; fewer
    vectors make fewer entries. The length is that of the first of them: vectors of another length, or all if ``parts``
    does not divide it, keep their row with null ``code`` and ``error``. Repeated rows count each. An error beyond 64 bits
    is null, and counts for nothing in ``label_error``; equal labels share a sum, null labels too. No vectors: no rows.
    """
    spark = pin(vectors.sparkSession)
    kept = kept_vectors(vectors, scale, column, key, label)
    kind = dict(kept.dtypes)["label"]
    names = ddl({"vec_id": "bigint", "label": kind, "code": "string", "error": "bigint"})
    codes = fit(kept, parts, entries, rounds, scale)
    out = spark.createDataFrame([], names)
    digest = sha256(b"").hexdigest()
    if codes is not None:
        digest = codes.digest()
        others = kept.where(F.size("x") != parts * len(codes.codebook[0][0])) if codes.rows else kept
        out = others.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        out = codes.rows.unionByName(out) if codes.rows else out
    sums = out.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    sums = small_side(sums.select("of", F.col("total").try_cast("long").alias("label_error")), "label-errors")
    return out.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
