"""A log of changes: folders of batches, folded into snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wxlake.operators.dedup import latest_per_key
from wxlake.schemas import Schema, ddl
from wxlake.sources.layers import empty_table
from wxlake.streaming.live import MARKER, TRIGGER, _file_system, _start
from wxlake.streaming.state import GONE

#: Batches that are folded into one snapshot.
COMPACT_EVERY = 20
#: Column with the number of the batch that a row came with.
BATCH = "_batch"


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete folders of a kind. A log has few folders, as old ones go."""
    hadoop_path, files = _file_system(spark, path)
    found = files.globStatus(hadoop_path(f"{path}/{kind}=*/{MARKER}")) or []
    return sorted(int(entry.getPath().getParent().getName().split("=")[1]) for entry in found)


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the completely written batches that are still there."""
    return _numbers(spark, path, "batch")


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete snapshots: each stands for all batches up to its number."""
    return _numbers(spark, path, "snapshot")


def open_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders that a reader opens: the newest snapshot and the batches after it."""
    newest = max(snapshots(spark, path), default=None)
    tail = [b for b in batches(spark, path) if newest is None or b > newest]
    return ([] if newest is None else [f"{path}/snapshot={newest}"]) + [f"{path}/batch={b}" for b in tail]


def _read(spark: SparkSession, folders: Sequence[str], schema: Schema) -> DataFrame:
    stored = ddl({**schema, BATCH: "bigint"})
    parts = [spark.read.schema(stored).parquet(f) for f in folders]
    return reduce(DataFrame.unionByName, parts) if parts else empty_table(spark, {**schema, BATCH: "bigint"})


def _folded(rows: DataFrame, keys: Sequence[str], newest: Sequence[str], by_batch: bool) -> DataFrame:
    # Ties go by the rows' own columns, so they do not depend on how rows fell into batches.
    own = sorted(set(rows.columns) - {*keys, *newest, BATCH})
    return latest_per_key(rows, keys, [BATCH], own) if by_batch else latest_per_key(rows, keys, newest, [*own, BATCH])


def current_rows(
    spark: SparkSession, path: str, schema: Schema, keys: Sequence[str], newest: Sequence[str] = (),
    by_batch: bool = False,
) -> DataFrame:
    """The newest row per key of a log; equal before, during and after a compaction.

    ``by_batch`` takes the row of the last batch, for changes whose order a stream has decided; keys
    whose last row is marked as gone are left out.
    """
    rows = _folded(_read(spark, open_folders(spark, path), schema), keys, newest, by_batch).drop(BATCH)
    if GONE in schema:
        rows = rows.filter(~F.coalesce(GONE, F.lit(False))).drop(GONE)
    return rows


def compact(
    spark: SparkSession, path: str, schema: Schema, keys: Sequence[str], newest: Sequence[str] = (),
    by_batch: bool = False, up_to: int | None = None,
) -> int | None:
    """Fold the newest snapshot and the batches after it, up to ``up_to``, into one snapshot. Returns its number.

    It counts from when its completion marker is there; a stop before leaves the log as it was, a stop after leaves
    folders that nobody opens, and the next compaction removes them. What the snapshot before it needs
    stays, for readers that have begun; older folders go. Gone keys stay until the second compaction, so
    that no older row of theirs comes back.
    """
    before = max(snapshots(spark, path), default=None)
    tail = [b for b in batches(spark, path) if (before is None or b > before) and (up_to is None or b <= up_to)]
    if not tail:
        return before
    number = tail[-1]
    folders = ([] if before is None else [f"{path}/snapshot={before}"]) + [f"{path}/batch={b}" for b in tail]
    rows = _folded(_read(spark, folders, schema), keys, newest, by_batch)
    if GONE in schema and before is not None:
        rows = rows.filter(~F.coalesce(GONE, F.lit(False)) | (F.col(BATCH) > before))
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}/snapshot={number}")
    if before is not None:
        hadoop_path, files = _file_system(spark, path)
        for kind, limit in (("batch", before + 1), ("snapshot", before)):
            for entry in files.globStatus(hadoop_path(f"{path}/{kind}=*")) or []:
                folder = entry.getPath()
                if int(folder.getName().split("=")[1]) < limit:
                    files.delete(folder, True)
    return number


def write_log(
    rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = (), newest: Sequence[str] = (),
    by_batch: bool = False, mode: str = "append", compact_every: int | None = COMPACT_EVERY,
    after: Callable[[int], None] | None = None, available_now: bool = False, trigger: str = TRIGGER,
) -> StreamingQuery:
    """Write each batch of a stream to a folder of its own, and fold the folders now and then.

    With ``newest``, the newest row per key of the batch. A batch that is repeated after a failure replaces its
    folder, so nothing is lost or doubled, whether it failed before its write, after it or in a compaction.
    ``after`` is called when a batch is written and not yet committed. At most ``compact_every`` batches and
    one snapshot are open to readers, twice that on disk.
    """
    schema = dict(rows.dtypes)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kept = latest_per_key(batch, keys, newest) if newest else batch
        kept.withColumn(BATCH, F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{path}/batch={number}")
        if after:
            after(number)
        if compact_every and len(open_folders(spark, path)) > compact_every:
            # The batch itself may be repeated, so only those before it are folded.
            compact(spark, path, schema, keys, newest, by_batch, up_to=number - 1)

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _start(writer, available_now, trigger)
