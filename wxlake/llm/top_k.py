"""Exact top-k by tiled matrix products."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxlake.llm.common import materialise, pin

#: Vectors of a shard and queries of a block; a tile is one of each.
SHARD, BLOCK = 8192, 1024
#: Partial lists merged by one task at each level of the tree.
FAN_IN = 16

PACKED = "dims int, pack long, ids binary, width int, vectors binary"
LISTS = "block long, shard long, q_ids binary, ids binary, scores binary"
ANSWERS = "query_id long, rank int, vec_id long, score long"


def usable(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``, the array of floor(scale * x), without vectors that are null or hold null, NaN or infinity."""
    x = F.col(column)
    whole = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(scale).cast("double")))
    return vectors.where(whole & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), scaled.alias("v"))


def _gathered(batches, size: int):
    """Batches of ``size`` rows or a little more, whatever the size of those that come; the last may be smaller."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Up to ``size`` vectors of equal length in a row, by ascending id, as raw integers."""

    def pack(batches):
        for batch in _gathered(batches, size):
            ids = batch.column(0).to_numpy()
            lists = batch.column(1)
            dims = np.diff(lists.offsets.to_numpy())
            flat, starts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(dims)[:-1]]).astype(int)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                own = own[np.argsort(ids[own], kind="stable")]
                for i in range(0, len(own), size):
                    part = own[i : i + size]
                    values = flat[starts[part][:, None] + np.arange(d)] if d else np.empty((len(part), 0), np.int64)
                    small = ((values < 2**15) & (values >= -(2**15))).all()
                    yield pa.RecordBatch.from_pydict({
                        "dims": pa.array([d], pa.int32()), "pack": pa.array([0], pa.int64()),
                        "ids": [ids[part].astype("<i8").tobytes()], "width": pa.array([2 if small else 8], pa.int32()),
                        "vectors": [values.astype("<i2" if small else "<i8").tobytes()]})

    return rows.mapInArrow(pack, PACKED).withColumn("pack", F.monotonically_increasing_id())


def _size(rows: np.ndarray) -> np.ndarray:
    """At least the largest magnitude in each row, without overflow."""
    return np.maximum(rows.max(axis=1, initial=0), ~rows.min(axis=1, initial=0))


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point where no sum can leave its exact range.

    Rows so large that 64 bits might not do are multiplied as Python integers; a score beyond 64 bits is held at their end.
    """
    dims, sizes = max(1, q.shape[1]), (_size(q), _size(v))
    largest = dims * (int(sizes[0].max(initial=0)) + 1) * (int(sizes[1].max(initial=0)) + 1)
    if largest < 2**24:
        return (q.astype(np.float32) @ v.astype(np.float32).T).astype(np.int64)
    if largest < 2**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    if largest < 2**63:
        return q @ v.T
    low, high = (s < isqrt(2**62 // dims) for s in sizes)
    out = np.empty((len(q), len(v)), dtype=np.int64)
    out[np.ix_(low, high)] = q[low] @ v[high].T

    def exact(a, b):
        products = a.astype(object) @ b.astype(object).T
        return np.clip(products, EMPTY + 1, 2**63 - 1).astype(np.int64)

    out[~low] = exact(q[~low], v)
    out[np.ix_(low, ~high)] = exact(q[low], v[~high])
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row: higher score, then smaller id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


#: Score of a place without candidate.
EMPTY = np.iinfo(np.int64).min + 1


def _tile(q_ids, q, ids, v, k):
    """Top list of each query in one shard, without the query's own id."""
    scores = _scores(q, v)
    scores[q_ids[:, None] == ids[None, :]] = EMPTY
    if scores.shape[1] > k:
        # Everything above the k-th best score, and ties of it by smaller id: ids ascend in a shard.
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        above = scores > kth
        ties = scores == kth
        room = k - above.sum(1, keepdims=True)
        chosen = above | (ties & (np.cumsum(ties, axis=1) <= room))
        columns = np.nonzero(chosen)[1].reshape(len(q), k)
        found_ids, found = ids[columns], np.take_along_axis(scores, columns, 1)
    else:
        found_ids, found = np.broadcast_to(ids, scores.shape).copy(), scores
    short = k - found.shape[1]
    if short > 0:
        found_ids = np.pad(found_ids, ((0, 0), (0, short)))
        found = np.pad(found, ((0, 0), (0, short)), constant_values=EMPTY)
    return _best(found_ids, found, k)


def _numbers(raw: bytes, width: int, dims: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").astype(np.int64).reshape(rows, dims)


def _tiles(k: int):
    def tiles(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                q_ids, ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                q = _numbers(row["q"], row["q_width"], row["dims"], len(q_ids))
                v = _numbers(row["vectors"], row["width"], row["dims"], len(ids))
                best_ids, best = _tile(q_ids, q, ids, v, k)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([row["block"]], pa.int64()), "shard": pa.array([row["pack"]], pa.int64()),
                    "q_ids": [row["q_ids"]], "ids": [best_ids.astype("<i8").tobytes()], "scores": [best.astype("<i8").tobytes()]})

    return tiles


def _merge(k: int):
    def merge(key, lists):
        """One list of several lists of a block."""
        rows = lists.to_pylist()
        shape = (len(rows[0]["q_ids"]) // 8, -1)
        ids = np.hstack([np.frombuffer(r["ids"], "<i8").reshape(shape) for r in rows])
        scores = np.hstack([np.frombuffer(r["scores"], "<i8").reshape(shape) for r in rows])
        best_ids, best = _best(ids, scores, k)
        return pa.Table.from_pydict({
            "block": [rows[0]["block"]], "shard": [min(r["shard"] for r in rows)], "q_ids": [rows[0]["q_ids"]],
            "ids": [best_ids.astype("<i8").tobytes()], "scores": [best.astype("<i8").tobytes()]})

    return merge


def _opened(k: int):
    def opened(batches):
        for batch in batches:
            for row in batch.to_pylist():
                queries = np.repeat(np.frombuffer(row["q_ids"], "<i8"), k)
                ids, scores = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["scores"], "<i8")
                ranks = np.tile(np.arange(1, k + 1, dtype=np.int32), len(queries) // k)
                real = scores != EMPTY
                yield pa.RecordBatch.from_pydict({
                    "query_id": queries[real], "rank": ranks[real], "vec_id": ids[real], "score": scores[real]})

    return opened


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, column: str = "embedding",
          key: str = "vec_id", shard: int = SHARD, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` of the k best rows of each query row.

    ``is_query`` is a condition on ``vec_id``. Score: inner product of floor(scale * x). Candidates are
    all rows with another id and as many components; fewer than k: all of them. Ties go to
    the smaller id. Unusable vectors take no part. Repeated rows are candidates each; a repeated
    query row is answered each time. No rows or no queries: no rows. Scores beyond 64 bits are held at their end.

    Blocks of queries meet shards of vectors by an equi-join on groups of shards: each
    block is sent to each group once. A tile's lists are merged in a tree, about ``fan_in`` lists to a task.
    """
    pin(vectors.sparkSession)
    rows = usable(vectors, column, key, scale)
    shards = materialise(_packed(rows, shard), "shards")
    picked = rows.where(is_query)
    # Queries are dealt to full blocks, as a task may hold few of them.
    blocks = materialise(_packed(picked.repartition(max(1, -(-picked.count() // block))), block), "blocks")
    # From here on a row is a block, a shard or a list; Spark cuts batches by their bytes (arrow.maxBytesPerBatch).
    n_shards = max(1, shards.count())
    groups = -(-n_shards // 4)
    group = F.pmod(F.xxhash64("pack"), F.lit(groups))
    left = shards.withColumn("group", group)
    right = blocks.select(
        F.col("dims").alias("q_dims"), F.col("pack").alias("block"), F.col("ids").alias("q_ids"),
        F.col("width").alias("q_width"), F.col("vectors").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("q_group"))
    on = (F.col("group") == F.col("q_group")) & (F.col("dims") == F.col("q_dims"))
    lists = left.join(right, on).mapInArrow(_tiles(k), LISTS)
    while n_shards > 1:
        n_shards = -(-n_shards // fan_in)
        lists = lists.groupBy("block", F.pmod(F.xxhash64("shard"), F.lit(n_shards))).applyInArrow(_merge(k), LISTS)
    return lists.mapInArrow(_opened(k), ANSWERS)
