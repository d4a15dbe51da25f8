"""Similarity join of shingle sets: token combinations in extended prefixes, then exact counts."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxlake.llm.chunks import (
    BUCKET_BYTES, NAMES, Chunk, Named, Sizes, chunked, common_names, ranges,
)
from wxlake.llm.common import materialise, text_bytes
from wxlake.llm.fingerprints import mix, run_hashes, word_hashes, word_spans
from wxlake.llm.graphs import components

SHINGLE, PERCENT = 3, 90
#: A token in as many sets is frequent, a power of two; frequent tokens are indexed in pairs within CELLS groups.
FREQUENT, CELLS = 32, 256
#: Sets and tokens of one side of a tile.
SIDE_SETS, SIDE_TOKENS = 512, 2_000_000
#: Columns of a tile's matrices.
SLICE = 4096
#: Bytes of prefix names per byte of text, to size the buckets.
PREFIX_BYTES = 0.35

DIGESTS = "chunk int, doc_id long, n long, node binary"
SETS = "doc_id long, digest binary, n long, node binary, tokens binary"
COUNTS = "bucket int, chunk int, names binary, counts binary"
ANSWERS = "chunk int, names binary, counts binary"
SIGNATURES = "node binary, signature long"
VERIFIED = "a binary, b binary, links long"


# ---- sets -----------------------------------------------------------------------------------


def shingle_sets(chunk: Chunk, size: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; fewer words than ``size``: the whole sequence; none: empty."""
    starts, ends = word_spans(chunk.data, chunk.offsets)
    words = word_hashes(chunk.data, starts, ends, lower=True)
    firsts = np.searchsorted(starts, chunk.offsets).tolist()
    runs = {m: run_hashes(words, m, salt=m) for m in range(1, size + 1)}
    out = []
    for a, b in zip(firsts, firsts[1:]):
        length = min(size, b - a)
        out.append(np.unique(runs[length][a : b - length + 1]) if length else np.zeros(0, dtype=np.uint64))
    return out


def node_of(tokens: np.ndarray) -> bytes:
    """128-bit digest of a set."""
    return b"".join(int(mix(tokens, salt).sum(dtype=np.uint64) + np.uint64(len(tokens))).to_bytes(8, "big") for salt in (21, 22))


def least_common(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that any linked set holds at least."""
    return -(-percent * n // 100)


def extra(n: int) -> int:
    """Tokens by which the hash-ordered prefix is longer than what a linked set may miss."""
    return 1 + n // 10


def prefix(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The tokens with the smallest hashes: at least ``extra`` of them are in any linked set."""
    n = len(tokens)
    return tokens[: n - least_common(n, percent) + extra(n)]


def _digests(size: int):
    def digests(table: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        sets = shingle_sets(chunk, size)
        return pa.table({
            "chunk": pa.array([chunk.number] * len(chunk), pa.int32()),
            "doc_id": pa.array(chunk.doc_ids, pa.int64()), "n": pa.array([len(s) for s in sets], pa.int64()),
            "node": pa.array([node_of(s) if len(s) and d is not None else None for s, d in zip(sets, chunk.doc_ids)], pa.binary())})

    return digests


def _representatives(chunk: Chunk, sets: list[np.ndarray], wanted: list[tuple[int, bytes]]) -> list[int]:
    """For each wanted document and set, its first row."""
    places: dict[tuple[int, bytes], int] = {}
    for i, (doc, tokens) in enumerate(zip(chunk.doc_ids, sets)):
        if doc is not None and len(tokens):
            places.setdefault((doc, node_of(tokens)), i)
    return [places[w] for w in wanted]


def _wanted(table: pa.Table) -> list[tuple[int, bytes]]:
    return [(d, n) for d, n in zip(table.column("rep").to_pylist(), table.column("node").to_pylist()) if n is not None]


def _named(sets: list[np.ndarray], percent: int) -> Named:
    """Names of the prefixes' tokens, set after set."""
    return Named(mix(np.concatenate([prefix(s, percent) for s in sets]), 31))


def _prefix_names(size: int, percent: int, buckets: int):
    def names(table: pa.Table, reps: pa.Table) -> pa.Table:
        if not table.num_rows or not reps.num_rows:
            return Named(np.zeros(0, np.uint64)).table(0, buckets)
        chunk = Chunk(table)
        sets = shingle_sets(chunk, size)
        return _named([sets[i] for i in _representatives(chunk, sets, _wanted(reps))], percent).table(chunk.number, buckets)

    return names


def _surviving_sets(size: int, percent: int, buckets: int):
    def surviving(table: pa.Table, told: pa.Table) -> pa.Table:
        """All documents; the tokens of those sets whose prefix shares enough tokens with other sets."""
        empty = {"doc_id": pa.array([], pa.int64()), "digest": pa.array([], pa.binary()), "n": pa.array([], pa.int64()), "node": pa.array([], pa.binary()), "tokens": pa.array([], pa.binary())}
        if not table.num_rows:
            return pa.table(empty)
        chunk = Chunk(table)
        sets = shingle_sets(chunk, size)
        tokens: list[bytes | None] = [None] * len(sets)
        places = _representatives(chunk, sets, _wanted(told)) if told.num_rows else []
        if places:
            common = _named([sets[i] for i in places], percent).common(told.filter(pc.is_valid(told.column("found"))), buckets)
            ends = np.cumsum([len(prefix(sets[i], percent)) for i in places])
            for i, shared in zip(places, np.add.reduceat(common.astype(np.int64), np.r_[0, ends[:-1]]).tolist()):
                if shared >= extra(least_common(len(sets[i]), percent)):
                    tokens[i] = sets[i].tobytes()
        return pa.table({
            "doc_id": pa.array(chunk.doc_ids, pa.int64()), "digest": pa.array([md5(t.as_buffer()).digest() for t in chunk.texts], pa.binary()),
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "node": pa.array([node_of(s) if len(s) and d is not None else None for s, d in zip(sets, chunk.doc_ids)], pa.binary()),
            "tokens": pa.array(tokens, pa.binary())})

    return surviving


# ---- signatures -----------------------------------------------------------------------------


def _token_arrays(table: pa.Table) -> tuple[list[bytes], list[np.ndarray]]:
    nodes, tokens = table.column("node").to_pylist(), table.column("tokens").to_pylist()
    order = sorted(range(len(nodes)), key=nodes.__getitem__)
    return [nodes[i] for i in order], [np.frombuffer(tokens[i], dtype="<u8") for i in order]


def _token_counts(buckets: int):
    def counts(table: pa.Table) -> pa.Table:
        names, found = np.unique(mix(np.concatenate(_token_arrays(table)[1]), 31), return_counts=True)
        held, bounds = ranges(names, buckets)
        number = table.column("chunk")[0].as_py()
        rows = [(k, number, names[a:b].tobytes(), found[a:b].astype("<u4").tobytes())
                for k, a, b in zip(held.tolist(), bounds.tolist(), bounds[1:].tolist())]
        bucket, chunk, blobs, numbers = zip(*rows)
        return pa.table({"bucket": pa.array(bucket, pa.int32()), "chunk": pa.array(chunk, pa.int32()),
                         "names": pa.array(blobs, pa.binary()), "counts": pa.array(numbers, pa.binary())})

    return counts


def _blobs(table: pa.Table, column: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=kind) for x in table.column(column).to_pylist()]


def _summed(table: pa.Table) -> pa.Table:
    """To each chunk, how many sets hold its tokens, for those that more than one holds."""
    parts, found = _blobs(table, "names", "<u8"), _blobs(table, "counts", "<u4")
    names, place = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.bincount(place, np.concatenate(found)).astype(np.int64)[place]
    rows, start = [], 0
    for chunk, own in zip(table.column("chunk").to_pylist(), parts):
        total = totals[start : start + len(own)]
        start += len(own)
        if (total > 1).any():
            rows.append((chunk, own[total > 1].tobytes(), np.minimum(total[total > 1], 2**32 - 1).astype("<u4").tobytes()))
    chunk, blobs, numbers = zip(*rows) if rows else ((), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int32()), "names": pa.array(blobs, pa.binary()), "counts": pa.array(numbers, pa.binary())})


def signatures(tokens: np.ndarray, counts: np.ndarray, percent: int, frequent: int = FREQUENT, cells: int = CELLS) -> np.ndarray:
    """Signatures of a set, of which any two linked sets share one.

    ``tokens`` are hashes, ``counts`` the number of sets that hold each. Tokens are ordered by class, the binary
    magnitude of their count, then by hash; from ``frequent`` on they are frequent, else rare or single. A linked set misses at most m tokens of this one. Rare tokens are signatures themselves;
    frequent ones fall into cells by their hash, and each pair of one cell is a signature: to spoil all pairs
    of a cell, all its tokens but one must be missing. The prefix grows until more than m tokens must
    be missing to spoil all its signatures. If the whole set is not enough, its
    first m + 1 frequent tokens are signatures too. Empty where the single tokens alone are more than m.
    """
    missing = len(tokens) - least_common(len(tokens), percent)
    single = int((counts < 2).sum())
    if single > missing:
        return np.zeros(0, dtype=np.uint64)
    order = np.lexsort((tokens, np.floor(np.log2(counts))))
    tokens, counts = tokens[order], counts[order]
    rare, common = tokens[(counts >= 2) & (counts < frequent)], tokens[counts >= frequent]
    needed = missing + 1 - single
    alone = rare[:needed]
    needed -= len(alone)
    if not needed:
        return mix(alone, 41)
    cell = mix(common, 42) % np.uint64(cells)
    # Whether a token is not the first of its cell: from then on it adds one.
    order = np.argsort(cell, kind="stable")
    adds = np.ones(len(common), dtype=bool)
    adds[order[np.r_[True, cell[order][1:] != cell[order][:-1]]] if len(common) else order] = False
    gained = np.cumsum(adds)
    enough = len(common) and gained[-1] >= needed
    length = int(np.searchsorted(gained, needed)) + 1 if enough else len(common)
    parts = [mix(alone, 41)]
    cell, common = cell[:length], common[:length]
    order = np.argsort(cell, kind="stable")
    for own in np.split(common[order], np.flatnonzero(np.diff(cell[order])) + 1):
        a, b = np.triu_indices(len(own), 1)
        parts.append(mix(mix(own[a], 43) + own[b], 44))
    if not enough:
        first = max(0, missing + 1 - single - len(rare))
        parts.append(mix(common[:first], 45))
    return np.unique(np.concatenate(parts))


def _signed(percent: int):
    def signed(table: pa.Table, told: pa.Table) -> pa.Table:
        nodes, sets = _token_arrays(table)
        names, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if told.num_rows:
            names, counts = np.concatenate(_blobs(told, "names", "<u8")), np.concatenate(_blobs(told, "counts", "<u4"))
            order = np.argsort(names)
            names, counts = names[order], counts[order]
        own_nodes, own = [], []
        for node, tokens in zip(nodes, sets):
            found = np.ones(len(tokens), dtype=np.int64)
            if len(names):
                mixed = mix(tokens, 31)
                at = np.minimum(np.searchsorted(names, mixed), len(names) - 1)
                found = np.where(names[at] == mixed, counts[at], 1)
            marks = signatures(tokens, found, percent)
            own_nodes += [node] * len(marks)
            own.append(marks)
        flat = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
        return pa.table({"node": pa.array(own_nodes, pa.binary()), "signature": pa.array(flat, pa.int64())})

    return signed


# ---- verification ---------------------------------------------------------------------------


def _common(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all sets of two sides (or of one with itself), by products of slices of their incidence matrices."""
    sides = [left] if right is None else [left, right]
    sizes = [sum(map(len, s)) for s in sides]
    names, place, counts = np.unique(np.concatenate([t for s in sides for t in s]), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    useful = counts[place] > 1
    parts = []
    for side, start, size in zip(sides, (0, sizes[0]), sizes):
        own = slice(start, start + size)
        rows = np.repeat(np.arange(len(side)), [len(t) for t in side])[useful[own]]
        columns = column[place[own]][useful[own]]
        order = np.argsort(columns, kind="stable")
        parts.append((len(side), rows[order], columns[order]))
    total = np.zeros((len(left), len(sides[-1])), dtype=np.float32)
    for first in range(0, int((counts > 1).sum()), SLICE):
        made = []
        for n, rows, columns in parts:
            a, b = np.searchsorted(columns, [first, first + SLICE])
            matrix = np.zeros((n, SLICE), dtype=np.float32)
            matrix[rows[a:b], columns[a:b] - first] = 1
            made.append(matrix)
        total += made[0] @ made[-1].T
    return total.astype(np.int64)


def _stars(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the link matrix of rows and columns (numbered after the rows) connects, one per member."""
    n, m = linked.shape
    roots, edges = np.full(n + m, -1), []
    for start in range(n):
        if roots[start] >= 0 or not linked[start].any():
            continue
        rows = np.array([start])
        roots[start] = start
        while len(rows):
            columns = np.flatnonzero(linked[rows].any(0) & (roots[n:] < 0))
            roots[n + columns] = start
            rows = np.flatnonzero(linked[:, columns].any(1) & (roots[:n] < 0))
            roots[rows] = start
    return [(int(r), i) for i, r in enumerate(roots.tolist()) if r >= 0 and r != i]


def verify(nodes: list[bytes], sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, whole: bool, percent: int):
    """Edges and numbers of links of one tile: all pairs within it if it is a ``whole`` block, else those between sides 0 and 1."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    other = left if whole else right
    if not len(left) or not len(other):
        return [], []
    shared = _common([sets[i] for i in left], None if whole else [sets[i] for i in right])
    size = np.array([len(s) for s in sets])
    union = size[left][:, None] + size[other][None, :] - shared
    linked = 100 * shared >= percent * union
    if whole:
        np.fill_diagonal(linked, False)
    names = [*left.tolist(), *other.tolist()]
    edges = [(nodes[names[a]], nodes[names[b]]) for a, b in _stars(linked)]
    links = [(nodes[i], n) for i, n in zip(left.tolist(), (linked @ copies[other]).tolist()) if n]
    if not whole:
        links += [(nodes[i], n) for i, n in zip(right.tolist(), (linked.T @ copies[left]).tolist()) if n]
    return [e for e in edges if e[0] != e[1]], links


def _verified(percent: int):
    def verified(table: pa.Table) -> pa.Table:
        nodes, clusters = table.column("node").to_pylist(), table.column("cluster").to_pylist()
        sets = _blobs(table, "tokens", "<u8")
        copies, side = table.column("copies").to_numpy().astype(np.int64), table.column("side").to_numpy()
        whole = table.column("whole").to_pylist()
        groups: dict[bytes, list[int]] = {}
        for i, c in enumerate(clusters):
            groups.setdefault(c, []).append(i)
        rows: list[tuple] = []
        for own in groups.values():
            edges, links = verify([nodes[i] for i in own], [sets[i] for i in own], copies[own], side[own], whole[own[0]], percent)
            rows += [(a, b, None) for a, b in edges] + [(a, None, n) for a, n in links]
        a, b, n = zip(*rows) if rows else ((), (), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "links": pa.array(n, pa.int64())})

    return verified


def _tiles(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """``tile`` and ``side`` of members of candidate clusters.

    A cluster that is too large for one tile is dealt into blocks, and a tile is a pair of blocks, so each
    block goes to as many tiles as there are blocks. Small clusters share tiles, which they
    fill to about the same size.
    """
    sizes = clusters.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(SIDE_SETS)), F.ceil(F.sum("n") / F.lit(SIDE_TOKENS))).cast("int").alias("blocks"),
        F.sum("n").alias("cluster_tokens"))
    sizes = materialise(sizes, "clusters")
    small = sizes.where("blocks = 1").agg(F.sum("cluster_tokens")).first()[0] or 0
    bins = max(1, -(-small // SIDE_TOKENS))
    rows = members.join(sizes.select(F.col("cluster").alias("c"), "blocks"), F.col("cluster") == F.col("c")).drop("c")
    alone = rows.where("blocks = 1").withColumn("tile", F.concat(
        F.lit("bin "), F.pmod(F.xxhash64("cluster"), F.lit(bins)).cast("string"))).withColumn("side", F.lit(0)).withColumn("whole", F.lit(True))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = rows.where("blocks > 1").withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("tile", F.concat_ws(
        " ", F.hex("cluster"), F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string")))
    spread = spread.withColumn("side", (F.col("block") > F.col("other")).cast("int"))
    spread = spread.withColumn("whole", F.col("block") == F.col("other"))
    columns = ["tile", "side", "whole", "cluster", "node", "copies", "tokens"]
    return alone.select(*columns).unionByName(spread.select(*columns))


def linked_sets(docs: DataFrame, shingle: int, percent: int, chunk_bytes: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows of documents with ``doc_id``, ``digest`` of the text, ``n`` and ``node``, their set; and of each node ``of`` its
    ``component``, the smallest ``component_id`` and ``n_links``. See ``join``."""
    sizes = Sizes(docs, chunk_bytes)
    parts = chunked(docs, sizes.chunks)
    digests = parts.groupBy("chunk").applyInArrow(_digests(shingle), DIGESTS)
    reps = digests.where("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "chunk")).alias("first"))
    reps = reps.select("first.chunk", F.col("first.doc_id").alias("rep"), "node")
    buckets = sizes.buckets(PREFIX_BYTES)
    prefixes = parts.groupBy("chunk").cogroup(reps.groupBy("chunk")).applyInArrow(_prefix_names(shingle, percent, buckets), NAMES)
    told = reps.withColumn("found", F.lit(None).cast("binary")).unionByName(common_names(prefixes, buckets), allowMissingColumns=True)
    found = materialise(parts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        _surviving_sets(shingle, percent, buckets), SETS), "sets")

    classes = found.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    sets = found.where("tokens is not null").select("node", "n", "tokens")
    total = 8 * (sets.agg(F.sum("n")).first()[0] or 0)
    chunks, buckets = max(1, total // BUCKET_BYTES), max(1, 2 * total // BUCKET_BYTES)
    rows = sets.select(F.pmod(F.xxhash64("node"), F.lit(chunks)).cast("int").alias("chunk"), "node", "tokens")
    counts = rows.groupBy("chunk").applyInArrow(_token_counts(buckets), COUNTS).groupBy("bucket").applyInArrow(_summed, ANSWERS)
    signed = materialise(rows.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_signed(percent), SIGNATURES), "signatures")

    pivots = signed.groupBy(F.col("signature").alias("s")).agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("held")).where("held > 1")
    candidates = signed.join(pivots, F.col("signature") == F.col("s")).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    clusters = components(candidates).withColumnRenamed("root", "cluster")
    members = clusters.join(sets, "node").join(classes.select("node", "copies"), "node")
    tiles = _tiles(members, members.select("cluster", "n"))
    verified = materialise(tiles.groupBy("tile").applyInArrow(_verified(percent), VERIFIED), "links")

    joined = components(verified.where("b is not null").select("a", "b"))
    links = verified.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    answer = classes.join(joined, "node", "left").join(links, "node", "left")
    least = answer.where("root is not null").groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("least"))
    answer = answer.join(least, F.col("root") == F.col("r"), "left").select(
        F.col("node").alias("of"), F.coalesce("root", "node").alias("component"), F.coalesce("least", "rep").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return found.drop("tokens"), answer


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, chunk_bytes: int | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``n_links`` of every row.

    A document's set holds the distinct runs of ``shingle`` words, A-Z lower-cased. Two documents link if
    100 * intersection >= percent * union. ``component_id`` is the smallest ``doc_id`` that links reach, ``n_links``
    counts the linked documents. Documents without words, or null texts, link with nothing. Rows
    without ``doc_id`` link with nothing and have a null component. Repeated rows are documents each.

    1. Equal sets form a class; from here on a class is one set, a node.
    2. Each set sends its tokens with the smallest hashes, twice as many as a linked set may miss; a set of which
       too few of them occur elsewhere has no partner.
    3. Of the others, all tokens are counted, and signatures made of rare tokens and of pairs of frequent ones.
    4. Sets that share signatures form candidate clusters. Each pair of a cluster is verified in exactly
       one tile; a tile returns the links' numbers and edges that connect what they connect, not the pairs.
    """
    found, answer = linked_sets(docs, shingle, percent, chunk_bytes)
    return found.join(answer, F.col("node") == F.col("of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, chunk_bytes: int | None = None) -> DataFrame:
    """One row of each group of linked documents: that with the smallest ``doc_id``, of equal ids that with the smallest digest of its text.

    Rows with equal ``doc_id`` and text are one document. Rows with equal ``doc_id`` and other texts are documents of their own, and
    go only if they are linked with another one. Rows without ``doc_id``, and without words, link with nothing and stay.
    """
    found, answer = linked_sets(docs, shingle, percent, chunk_bytes)
    known = found.where("doc_id is not null").select(F.struct("doc_id", "digest").alias("own"), "node")
    best = known.where("node is not null").join(answer, F.col("node") == F.col("of")).groupBy("component").agg(F.min("own").alias("own"))
    keep = best.select("own.*").unionByName(known.where("node is null").select("own.*").distinct())
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("id"), F.unhex(F.md5(text_bytes())).alias("of_text"))
    same = (F.col("id") == F.col("doc_id")) & (F.col("of_text") == F.col("digest"))
    first = Window.partitionBy("id", "of_text").orderBy(F.xxhash64("row.text"))
    kept = rows.where("id is not null").join(keep, same, "left_semi").withColumn("place", F.row_number().over(first))
    return kept.where("place = 1").select("row.*").unionByName(docs.where(docs["doc_id"].isNull()))
