"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every operator here relies on.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key in an equi-join is split at run time, even when that costs one
    # more exchange further up the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Where a local session without spark.checkpoint.dir keeps its work folder.
LOCAL_KEY = "wxlake.local.work.dir"


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "wxlake", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return pin_session(builder.getOrCreate())


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, one
    process on this machine, may fall back to a folder of it, which goes with the process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_KEY, None)
    if shared:
        return shared.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    local = tempfile.mkdtemp(prefix="wxlake-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set(LOCAL_KEY, local)
    return local


def fresh_folder(spark: SparkSession, label: str) -> str:
    """Path of a not yet existing folder below the shared work folder."""
    return f"{work_folder(spark)}/wxlake-{label}-{uuid.uuid4().hex}"
