import datetime as dt
import gzip
import json
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wxlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("wxlake-tests", os.environ.get("TEST_MASTER", "local[8]"), {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def day(text):
    return dt.date.fromisoformat(text)


def moment(text):
    return dt.datetime.fromisoformat(text)


def write_lot(root, path, columns, rows, marker=True):
    """One gzip CSV lot with its completion marker."""
    folder = Path(root) / path
    folder.mkdir(parents=True, exist_ok=True)
    lines = [";".join(columns)]
    for row in rows:
        lines.append(";".join("" if row.get(c) is None else str(row[c]) for c in columns))
    with gzip.open(folder / "lot.csv.gz", "wt", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    if marker:
        (folder / "_SUCCESS").touch()
    return str(folder)


def write_json_lines(path, records):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records), encoding="utf-8")
