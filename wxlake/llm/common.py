"""Helpers of the operators: tables, settings, written intermediates."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxlake.session import fresh_folder, pin_session

#: Folder of the package, for the Python workers of a session that was started elsewhere.
ROOT = str(Path(__file__).resolve().parents[2])
#: Measured bytes up to which a side of a join is broadcast.
BROADCAST_BYTES = 16 << 20


def pin(spark: SparkSession) -> SparkSession:
    """Settings of the operators: short Arrow batches, as single texts may be long."""
    pin_session(spark)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of earlier steps,
    and what was decided once (ranks, batch numbers) stays decided.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written step whose readers are done; later steps have been written from it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_side(df: DataFrame, label: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """A side of a join, written, and broadcast if it is measured to be at most ``most`` bytes as text."""
    df = materialise(df, label)
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")
