"""Layer tables: reading, writing, listing."""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wxlake.schemas import Schema, conform, ddl


def read_layer(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """A Parquet layer table. With a schema, folder values keep its types."""
    reader = spark.read if schema is None else spark.read.schema(ddl(schema))
    return reader.parquet(path)


def optional_table(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame | None:
    """The table, or None where its path does not exist. Other errors are raised."""
    try:
        return read_layer(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def empty_table(spark: SparkSession, schema: Schema) -> DataFrame:
    return spark.createDataFrame([], ddl(schema))


def first_present(spark: SparkSession, paths: Sequence[str], schema: Schema) -> DataFrame:
    """The first table that exists and has rows, in the given schema; else an empty one.

    Absent columns are typed NULLs. Whether a table has a row is a scalar
    subquery of the result, which reads one row at most.
    """
    out, before = empty_table(spark, schema), F.lit(0).cast("bigint")
    for path in paths:
        found = optional_table(spark, path)
        if found is not None:
            out = out.unionByName(conform(found, schema).filter(before == 0))
            before = before + found.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return out


def write_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the folders that the rows fall in; writing twice changes nothing.

    The rebalance hint gathers each folder's rows in few files, joins small
    folders in one task and splits a big one over several.
    """
    (
        df.hint("rebalance", *columns).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    )


def write_small_table(df: DataFrame, path: str) -> None:
    """Replace a whole table: one file while it is small, more when it grows."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def write_counted(df: DataFrame, write, label: str) -> int:
    """Write and return the number of rows written, without a second scan."""
    seen = Observation(label)
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def whole_months(start: date | None, end: date | None) -> tuple[date | None, date | None]:
    """Widen a range to whole months.

    A month folder is replaced as a whole, so a range that begins or ends within
    a month would cut that month's rows.
    """
    first = start.replace(day=1) if start else None
    last = end.replace(day=calendar.monthrange(end.year, end.month)[1]) if end else None
    return first, last


def date_range(df: DataFrame, day: str, start: date | None, end: date | None) -> DataFrame:
    """Rows from ``start`` to ``end``, each optional and inclusive."""
    if start:
        df = df.filter(F.col(day) >= F.lit(start))
    if end:
        df = df.filter(F.col(day) <= F.lit(end))
    return df


def month_range(df: DataFrame, day: str, start: date | None, end: date | None) -> DataFrame:
    """Range safe for replacing month folders."""
    return date_range(df, day, *whole_months(start, end))


def partition_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a folder column; no data column is read."""
    return df.select(column).distinct().orderBy(column)


def folder_values(spark: SparkSession, path: str, columns: Sequence[str], files: str = "*.parquet") -> DataFrame:
    """Sorted distinct values of folder columns, from the names of folders; no data file is opened.

    Spark lists the folders, in tasks when there are many of them, and asks for the names of their files only.
    """
    named = spark.read.format("binaryFile").option("pathGlobFilter", files).load(path)
    return named.select(*columns).distinct().orderBy(*columns)


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"))


def newest_write(spark: SparkSession, path: str) -> DataFrame:
    """Time of the last write of a file-based table: one row per file is read, no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("modificationTime").agg(F.max("modificationTime").alias("updated_at"))
