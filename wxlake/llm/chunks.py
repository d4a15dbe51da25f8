"""Documents in chunks, and counting of hashed names over all chunks.

A chunk is some hundred documents that one task handles as arrays. Names that chunks have in common are
found by an exchange in which a row holds a chunk's names of one range of hashes, a bucket, rather than
one name. Chunks and buckets grow in number, not in size, with the documents; a name
counts once for a chunk, so however often it occurs, a bucket has it once per chunk at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.common import pin, text_bytes

#: Bytes of text in a chunk: at least, and at most for large tables.
CHUNK_BYTES, LARGE_CHUNK_BYTES, FEW_CHUNKS = 1 << 20, 16 << 20, 10_000
#: Bytes of names in a bucket, about.
BUCKET_BYTES = 4 << 20

#: Buckets that a chunk deals its names to, at most, and chunks that are gathered where there are more buckets.
FIRST_BUCKETS, GATHERED_CHUNKS = 4096, 4096

NAMES = "bucket int, chunk int, names binary, checks binary, twice binary"
COMMON = "chunk int, bucket int, found binary"


class Sizes:
    """Numbers of chunks and buckets for a table of texts."""

    def __init__(self, docs: DataFrame, chunk_bytes: int | None = None):
        self.bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        size = chunk_bytes or min(max(CHUNK_BYTES, self.bytes // FEW_CHUNKS), LARGE_CHUNK_BYTES)
        self.chunks = max(1, -(-self.bytes // size))

    def buckets(self, bytes_per_text_byte: float) -> int:
        return max(1, int(self.bytes * bytes_per_text_byte / BUCKET_BYTES))


def chunked(docs: DataFrame, chunks: int) -> DataFrame:
    """``chunk``, ``doc_id`` and ``text`` in UTF-8.

    Rows are dealt by ``doc_id`` and text, so an id on many texts, or a text under many ids, falls to all
    chunks. Only rows equal in both stay together.
    """
    pin(docs.sparkSession)
    doc_id, text = F.col("doc_id").cast("long"), text_bytes()
    chunk = F.pmod(F.xxhash64(doc_id, text), F.lit(chunks)).cast("int")
    return docs.select(chunk.alias("chunk"), doc_id.alias("doc_id"), text.alias("text"))


class Chunk:
    """The documents of a chunk in an order that does not depend on the shuffle, and their texts side by side."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id")
        keys = [("doc_id", "ascending")]
        if pc.count_distinct(ids, mode="all").as_py() < len(ids):
            keys.append(("text", "ascending"))
        table = table.take(pc.sort_indices(table, sort_keys=keys))
        texts = table.column("text").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        self.number = table.column("chunk")[0].as_py()
        self.doc_ids = table.column("doc_id").to_pylist()
        self.texts = texts
        raw = texts.buffers()
        offsets = np.frombuffer(raw[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(raw[2] or b"", dtype=np.uint8)
        self.data, self.offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]

    def __len__(self) -> int:
        return len(self.doc_ids)


def _column(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype="<u8") for chunk in table.column(name).chunks for x in chunk]


def ranges(names: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted names, the buckets that hold any, and where each begins, with the end. Work is linear in the names, not in the buckets."""
    if buckets == 1 or not len(names):
        return np.zeros(min(len(names), 1), np.int64), np.unique([0, len(names)])
    bucket = (names // np.uint64(-(-(2**64) // buckets))).astype(np.int64)
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    return bucket[at], np.r_[at, len(names)]


def _rows(number: int, buckets: int, names: np.ndarray, checks: np.ndarray | None, twice: np.ndarray) -> pa.Table:
    held, bounds = ranges(names, buckets)
    rows = [(bucket, number, names[a:b].tobytes(), b"" if checks is None else checks[a:b].tobytes(), np.packbits(twice[a:b]).tobytes())
            for bucket, a, b in zip(held.tolist(), bounds.tolist(), bounds[1:].tolist())]
    columns = list(zip(*rows)) or [()] * 5
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["bucket", "chunk", "names", "checks", "twice"])


def _bits(raw, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=count).astype(bool)


def _told(told: pa.Table, names: np.ndarray, buckets: int) -> np.ndarray:
    """From rows of COMMON, which of the distinct sorted names, dealt to so many buckets, are common."""
    out = np.zeros(len(names), dtype=bool)
    if not told.num_rows:
        return out
    held, bounds = ranges(names, buckets)
    for bucket, raw in zip(told.column("bucket").to_pylist(), told.column("found").to_pylist()):
        i = int(np.searchsorted(held, bucket))
        out[bounds[i] : bounds[i + 1]] = _bits(raw, int(bounds[i + 1] - bounds[i]))
    return out


class Named:
    """Names of a chunk's things, distinct and sorted.

    ``checks`` are second hashes of the same things; names count as equal only if these are, too.
    A chunk that makes its names anew has them in the same order, so an answer is one bit a name.
    """

    def __init__(self, names: np.ndarray, checks: np.ndarray | None = None):
        order = np.lexsort((names,) if checks is None else (checks, names))
        names = names[order]
        new = np.r_[True, names[1:] != names[:-1]] if len(names) else np.zeros(0, bool)
        if checks is not None and len(names):
            checks = checks[order]
            new[1:] |= checks[1:] != checks[:-1]
        at = np.flatnonzero(new)
        self.place = np.empty(len(names), dtype=np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.twice = np.diff(np.r_[at, len(names)]) > 1
        self.names, self.checks = names[at], None if checks is None else checks[at]

    def table(self, chunk: int, buckets: int, first: int = FIRST_BUCKETS) -> pa.Table:
        """Rows of NAMES: the distinct names by range, and which of them occur twice in the chunk."""
        return _rows(chunk, min(buckets, first), self.names, self.checks, self.twice)

    def common(self, told: pa.Table, buckets: int, first: int = FIRST_BUCKETS) -> np.ndarray:
        """From the chunk's rows of COMMON, which of the things' names are common, in the order given."""
        return _told(told, self.names, min(buckets, first))[self.place]


class _Joined:
    """The names of several rows of NAMES as distinct ones, and which occur at least twice, in one row or in several."""

    def __init__(self, table: pa.Table):
        parts, second = _column(table, "names"), np.concatenate(_column(table, "checks"))
        self.sizes = [len(p) for p in parts]
        twice = np.concatenate([_bits(t.as_buffer(), n) for t, n in zip((x for c in table.column("twice").chunks for x in c), self.sizes)])
        joined = Named(np.concatenate(parts), second if len(second) else None)
        self.names, self.checks, self.place = joined.names, joined.checks, joined.place
        self.twice = joined.twice
        self.twice[self.place[twice]] = True

    def answers(self, table: pa.Table, common: np.ndarray) -> pa.Table:
        """Rows of COMMON to the rows of NAMES, given which distinct names are common."""
        pieces = np.split(common[self.place], np.cumsum(self.sizes)[:-1])
        rows = [(c, b, np.packbits(f).tobytes())
                for c, b, f in zip(table.column("chunk").to_pylist(), table.column("bucket").to_pylist(), pieces) if f.any()]
        columns = list(zip(*rows)) or [()] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()))], names=["chunk", "bucket", "found"])


def _tell(table: pa.Table) -> pa.Table:
    joined = _Joined(table)
    return joined.answers(table, joined.twice)


def common_names(rows: DataFrame, buckets: int, first: int = FIRST_BUCKETS, gathered: int = GATHERED_CHUNKS) -> DataFrame:
    """Rows of COMMON: of each chunk's names those that occur at least twice, in this chunk or in several.

    With more than ``first`` buckets, a chunk's names would be too few for a row each. Then rows of
    ``gathered`` chunks and one first bucket are joined, dealt on as one chunk, and their answers handed back.
    """
    if buckets <= first:
        return rows.groupBy("bucket").applyInArrow(_tell, COMMON)

    def gather(table: pa.Table) -> pa.Table:
        joined = _Joined(table)
        return _rows(table.column("relay")[0].as_py(), buckets, joined.names, joined.checks, joined.twice)

    def hand_back(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"chunk": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()), "found": pa.array([], pa.binary())})
        joined = _Joined(table)
        return joined.answers(table, _told(told, joined.names, buckets))

    relay = F.floor(F.col("chunk") / F.lit(gathered)) * F.lit(first) + F.col("bucket")
    relayed = rows.withColumn("relay", relay.cast("int"))
    told = relayed.groupBy("relay").applyInArrow(gather, NAMES).groupBy("bucket").applyInArrow(_tell, COMMON)
    return relayed.groupBy("relay").cogroup(told.groupBy("chunk")).applyInArrow(hand_back, COMMON)
