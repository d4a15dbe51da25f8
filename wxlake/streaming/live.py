"""Streams of live messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wxlake import schemas
from wxlake.functions.dates import parse_quarter
from wxlake.operators.clean import live_measures
from wxlake.operators.dedup import latest_per_key
from wxlake.operators.rollup import live_index
from wxlake.sources.layers import empty_table

# Fixed value: seconds per micro-batch, to limit the number of small files.
TRIGGER = "300 seconds"
# Complete versions of a table that are kept.
KEPT_VERSIONS = 3
MARKER = "_SUCCESS"
# Log lines that report an error.
ERROR_LINE = "ERROR|Exception|Traceback"


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Topic from its earliest offset. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest").load()
    )


def file_source(
    spark: SparkSession, path: str, schema: str | StructType, kind: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _start(writer, available_now: bool, trigger: str) -> StreamingQuery:
    if not available_now:
        return writer.trigger(processingTime=trigger).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def keyed_json(records: DataFrame, key: str = "city") -> DataFrame:
    """Records as key and JSON value, ready for a topic."""
    return records.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish(records: DataFrame, servers: str, topic: str, key: str = "city") -> None:
    """Send a table of records to a topic. Needs the Kafka connector."""
    (
        keyed_json(records, key).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )


def assemble_records(cities: DataFrame, blocks: DataFrame, ingested_at: Column) -> DataFrame:
    """City reference and measures joined on the city, with the ingest time."""
    joined = cities.join(blocks, "city", "inner")
    return joined.select(ingested_at.alias("ingested_at"), "*")


def land_raw(
    messages: DataFrame, path: str, checkpoint: str, available_now: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Untouched message text, in one folder per ingest day.

    ``messages`` has ``value`` and ``timestamp``. The checkpoint makes a restart
    continue where the last committed batch ended.
    """
    lines = messages.select(
        F.col("value").cast("string").alias("value"),
        F.to_date("timestamp").alias("ingest_date"),
    )
    writer = (
        lines.writeStream.format("text").option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy("ingest_date")
    )
    return _start(writer, available_now, trigger)


def live_rows(messages: DataFrame) -> DataFrame:
    """Message text to scored live rows with their ingest time. No state."""
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), schemas.ddl(schemas.LIVE_MESSAGE)).alias("m")
    ).select("m.*")
    timed = parsed.withColumn("obs_time", parse_quarter(F.col("time")))
    timed = timed.filter(F.col("obs_time").isNotNull())
    return live_index(live_measures(timed, keep=("ingested_at",)))


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path, hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the completely written versions of a table, from their completion markers."""
    hadoop_path, files = _file_system(spark, path)
    found = files.globStatus(hadoop_path(f"{path}/version=*/{MARKER}")) or []
    return sorted(int(entry.getPath().getParent().getName().split("=")[1]) for entry in found)


def _version(spark: SparkSession, path: str, number: int | None, columns: dict[str, str]) -> DataFrame:
    if number is None:
        return empty_table(spark, columns)
    return spark.read.schema(schemas.ddl(columns)).parquet(f"{path}/version={number}")


def upsert_latest(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], newest: list[str],
    available_now: bool = False, trigger: str = TRIGGER, keep: int = KEPT_VERSIONS,
) -> StreamingQuery:
    """Keep a table with the newest row per key up to date.

    Batch n writes version n: the newest rows of the version before it and of the
    batch. A repeated batch rewrites the same version from the same input, so a
    restart neither loses nor doubles rows, and a late older row never replaces a
    newer one. The last ``keep`` versions stay for readers that have begun. Each
    batch rewrites the table, so use it for one row per city; see ``log_latest``
    for keys that grow with time.
    """
    columns = {name: kind for name, kind in rows.dtypes}

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [v for v in versions(spark, path) if v < batch_id]
        before = _version(spark, path, max(earlier, default=None), columns)
        both = before.unionByName(latest_per_key(batch, keys, newest))
        newest_rows = latest_per_key(both, keys, newest)
        newest_rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        hadoop_path, files = _file_system(spark, path)
        for old in earlier[: max(0, len(earlier) + 1 - keep)]:
            files.delete(hadoop_path(f"{path}/version={old}"), True)

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _start(writer, available_now, trigger)


def current_version(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Rows of the newest complete version written by ``upsert_latest``; no other one is opened."""
    return _version(spark, path, max(versions(spark, path), default=None), columns)


def message_rate(
    messages: DataFrame, ts: str = "timestamp", width: str = "5 minutes", late: str = "1 hour"
) -> DataFrame:
    """Messages per second in each window; also valid on a batch table.

    A stream drops messages of windows that ended more than ``late`` before the
    newest message; ``rows_dropped`` counts them.
    """
    span = F.window(ts, width)
    counted = messages.withWatermark(ts, late).groupBy(span).agg(F.count("*").alias("n"))
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    return counted.select(
        F.col("window.start").alias("window_start"), "n", (F.col("n") / seconds).alias("per_second")
    )


def rows_dropped(query: StreamingQuery) -> int:
    """Late rows that the watermark has dropped, over the batches that the query still reports."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress for operator in progress.stateOperators
    )


def _log(
    writer, path: str, change, available_now: bool, trigger: str, day: str | None = None
) -> StreamingQuery:
    """Write what ``change`` makes of each batch to a folder of its own.

    The work of a batch depends on the batch alone, and a repeated batch replaces
    its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = change(batch).write.mode("overwrite")
        if day:
            writer = writer.partitionBy(day)
        writer.parquet(f"{path}/batch={batch_id}")

    return _start(writer.foreachBatch(write), available_now, trigger)


def log_latest(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], newest: list[str],
    available_now: bool = False, trigger: str = TRIGGER, day: str | None = None,
) -> StreamingQuery:
    """Log the newest row per key of each batch.

    For keys that grow with time, such as city and quarter hour. Readers take the
    newest row per key over the log, so late rows are never lost. ``day``, a date
    column that the keys determine, becomes a folder of each batch, so a reader of
    some days opens only their part of the log.
    """
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    return _log(writer, path, lambda b: latest_per_key(b, keys, newest), available_now, trigger, day)


def log_updates(
    counted: DataFrame, path: str, checkpoint: str, available_now: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Log the aggregates that changed in each batch."""
    writer = counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return _log(writer, path, lambda b: b, available_now, trigger)


def error_lines(lines: DataFrame, column: str = "value", pattern: str = ERROR_LINE) -> DataFrame:
    """Lines that match the error pattern; works on a stream and on a table."""
    return lines.filter(F.col(column).rlike(pattern))
