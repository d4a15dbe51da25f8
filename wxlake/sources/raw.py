"""Readers of the raw layer, each with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.operators.lots import ALERT_FILE, FAMILIES, periods_between

# Path fields and file names.
SNAPSHOT_FIELD = r"snapshot=(\d{4}-\d{2}-\d{2})"
DATE_FIELD = r"date=(\d{4}-\d{2}-\d{2})"
LOT_GLOB = "*.csv.gz"
MARKER = "_SUCCESS"


def with_path_field(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Text field of the file path; NULL where the path does not have it."""
    found = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return df.withColumn(name, F.nullif(found, F.lit("")))


def complete_lots(spark: SparkSession, pattern: str) -> DataFrame:
    """``folder`` of each lot that matches the pattern and holds a completion marker.

    Markers are hidden files for the readers, so the file system resolves the
    pattern down to them; data files are not listed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/{MARKER}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    folders = sorted(entry.getPath().getParent().toUri().getPath() for entry in found)
    return spark.createDataFrame([(f,) for f in folders], "folder string")


def folder_of(path: Column) -> Column:
    """Folder of a file path, without scheme and host; the reader's escapes undone."""
    bare = F.regexp_replace(path, "^[a-zA-Z0-9+.-]+:(//[^/]*)?", "")
    return F.url_decode(F.replace(F.regexp_replace(bare, "/[^/]*$", ""), F.lit("+"), F.lit("%2B")))


def read_csv_lots(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], glob: str = LOT_GLOB
) -> DataFrame:
    """Semicolon-separated lots below the paths, with their snapshot.

    All columns are text. The schema is by position, so the header line is
    checked against it and the columns must be those of the file. The parser
    splits whole lines, which takes it less time than to skip columns; those
    that are not used get no further.
    """
    reader = (
        spark.read.schema(schemas.ddl(schemas.strings(*columns)))
        .option("header", True).option("sep", ";").option("enforceSchema", False).option("columnPruning", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    )
    return with_path_field(reader.csv(paths), "snapshot", SNAPSHOT_FIELD)


def header_columns(spark: SparkSession, paths: str | Sequence[str], glob: str = LOT_GLOB) -> list[str]:
    """Column names of the files, for lots with more columns than are used."""
    reader = spark.read.option("header", True).option("sep", ";").option("inferSchema", False)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.csv(paths).columns


def _read_lots(
    spark: SparkSession, path: str, columns: Sequence[str] | None, known: Sequence[str],
    lots: str | None = None,
) -> DataFrame:
    """Lots with the given columns; else the header line is read and the known ones are kept.

    With the pattern of the lots' folders, only rows of complete lots. A path
    without any lot is an empty table.
    """
    wanted = list(columns or known)
    try:
        rows = read_csv_lots(spark, path, columns or header_columns(spark, path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.ddl(schemas.strings(*wanted, "snapshot")))
    kept = [F.col(f"`{c}`") for c in (*wanted, "snapshot")]
    if lots is None:
        return rows.select(*kept)
    placed = rows.select(*kept, folder_of(F.col("_metadata.file_path")).alias("_folder"))
    marked = complete_lots(spark, lots)
    return placed.join(marked, F.col("_folder") == F.col("folder"), "left_semi").drop("_folder")


def read_daily_family(
    spark: SparkSession, root: str, family: str, columns: Sequence[str] | None = None,
    complete_only: bool = False, start: date | None = None, end: date | None = None,
) -> DataFrame:
    """One family of the daily files of all areas; of a range, the periods that overlap it."""
    periods = "*"
    if start or end:
        periods = "{" + ",".join([*periods_between(start, end), "latest"]) + "}"
    path = f"{root}/dept=*/period={periods}/family={family}"
    first = family == FAMILIES[0]
    known = schemas.DAILY_MAIN_COLUMNS if first else schemas.DAILY_OTHER_COLUMNS
    return _read_lots(spark, path, columns, known, f"{path}/snapshot=*" if complete_only else None)


def read_hourly(
    spark: SparkSession, root: str, columns: Sequence[str] | None = None, complete_only: bool = False
) -> DataFrame:
    path = f"{root}/dept=*/period=*"
    return _read_lots(spark, path, columns, schemas.HOURLY_COLUMNS, f"{path}/snapshot=*" if complete_only else None)


def read_grid_values(
    spark: SparkSession, root: str, kind: str, columns: Sequence[str] | None = None,
    complete_only: bool = False,
) -> DataFrame:
    """Mesh values of ``kind`` ``mens`` (monthly) or ``quot_latest`` (daily)."""
    path, monthly = f"{root}/kind={kind}", kind == "mens"
    lots = f"{path}/year=*/snapshot=*" if monthly else f"{path}/snapshot=*"
    known = schemas.GRID_MONTHLY_COLUMNS if monthly else schemas.GRID_DAILY_COLUMNS
    return _read_lots(spark, path, columns, known, lots if complete_only else None)


def read_grid_reference(spark: SparkSession, path: str) -> DataFrame:
    """Plain CSV whose column names contain blanks and parentheses."""
    schema = schemas.ddl(schemas.strings(*schemas.GRID_REF_COLUMNS))
    return spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)


def read_live_messages(spark: SparkSession, folder: str, start: date | None = None) -> DataFrame:
    """JSON lines landed by the stream; from a day on, the folders that can hold its messages.

    Reads the folder itself: its commit log hides files of unfinished batches,
    which a file pattern would pick up. A message is not landed before its day,
    and one day is left for clocks that differ.
    """
    lines = spark.read.schema(schemas.ddl(schemas.LIVE_MESSAGE)).json(folder)
    if start and "ingest_date" in lines.columns:
        lines = lines.filter(F.col("ingest_date") >= F.lit(start - timedelta(days=1)))
    return lines


def read_alert_documents(spark: SparkSession, folder: str, glob: str = ALERT_FILE) -> DataFrame:
    """One JSON document per day, dated by its folder."""
    documents = (
        spark.read.schema(schemas.ddl(schemas.ALERT_DOCUMENT))
        .option("multiLine", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).json(folder)
    )
    dated = with_path_field(documents, "vig_date", DATE_FIELD)
    return dated.withColumn("vig_date", F.col("vig_date").try_cast("date"))


def strip_bom(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines without byte-order marks and surrounding blanks; empty lines dropped."""
    bare = F.trim(F.regexp_replace(F.trim(column), "^﻿+", ""))
    return lines.withColumn(column, bare).filter(F.length(column) > 0)


def parse_nested_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Captured messages: the nested ``current`` block moves to the top level."""
    parsed = strip_bom(lines, column).select(
        F.from_json(column, schemas.ddl(schemas.NESTED_MESSAGE)).alias("message")
    )
    top = parsed.select("message.*")
    return top.select(*[c for c in top.columns if c != "current"], "current.*")


def json_field(text: Column | str, name: str, kind: str) -> Column:
    """One top-level field of a JSON text; NULL where absent or unreadable."""
    return F.from_json(text, f"`{name}` {kind}")[name]


def area_of_file(path: Column) -> Column:
    """Area code from a file name like ``Q_75_latest_family.csv.gz``."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.split_part(name, F.lit("_"), F.lit(2))
