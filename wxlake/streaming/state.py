"""Streams that keep state: repeats, closed quarter hours, newest row per city."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wxlake.schemas import ddl
from wxlake.streaming.live import TRIGGER, _start

#: Column that tells a row that has gone from a new or changed one.
GONE = "gone"


def drop_repeats(rows: DataFrame, keys: Sequence[str], ts: str, late: str) -> DataFrame:
    """A stream without repeated deliveries: the first row of each key is kept.

    The state holds a key until the newest ``ts`` is more than ``late`` after it, so it has the keys of that
    span, however long the stream runs. Rows later than that are dropped and counted by ``rows_dropped``.
    """
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def closed_newest(
    rows: DataFrame, keys: Sequence[str], newest: Sequence[str], ts: str, late: str
) -> DataFrame:
    """The newest row of each key, once, when the key's time is over.

    ``ts`` is one of the keys, such as the quarter hour of a city's reading. Two states
    in one stream: repeated deliveries go, then the highest row by ``newest`` is kept, ties by the other
    columns in the order of their names. When no row of the key can come any more, it is sent
    and forgotten, so the table that follows needs no newest-row choice. Keys are open, and not
    sent, until a row more than ``late`` after them has come.
    """
    if ts not in keys:
        raise ValueError(f"{ts} must be one of the keys")
    rest = sorted(set(rows.columns) - set(keys) - set(newest))
    once = drop_repeats(rows, rows.columns, ts, late)
    best = once.groupBy(*keys).agg(F.max(F.struct(*newest, *rest)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in (*newest, *rest)])


def append_closed(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False, trigger: str = TRIGGER,
    day: str | None = None,
) -> StreamingQuery:
    """Write closed rows to a table, each once, also after a restart."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if day:
        writer = writer.partitionBy(day)
    return _start(writer, available_now, trigger)


def _plain(value):
    """A value of a pandas row as a state can hold it."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def _order(row: Sequence) -> tuple:
    """Sort key of a row in which null is lowest."""
    return tuple((value is not None, value) if value is not None else (False,) for value in row)


def _highest(frame: pd.DataFrame, newest: Sequence[str]) -> list[tuple]:
    """Rows of a frame that share the highest ``newest`` values; null is lowest."""
    for column in newest:
        known = frame[frame[column].notna()]
        if len(known):
            frame = known[known[column] == known[column].max()]
    return [tuple(_plain(v) for v in row) for row in frame.drop_duplicates().itertuples(index=False)]


def newest_per_key(
    rows: DataFrame, key: str, newest: Sequence[str], ts: str, late: str, silent: str
) -> DataFrame:
    """Changes of a table with the newest row per key: rows that have become the newest, and keys that went silent.

    The state of a key is its newest row, so a batch reads and writes the keys that it holds and
    nothing else. An older row never replaces a newer one, however late it comes; ties go by the other columns in
    the order of their names. A key without rows for ``silent`` after its last ``ts`` is sent once more with ``gone``
    true and other columns null, and forgotten. A key that speaks again starts anew.
    """
    rest = sorted(set(rows.columns) - {key} - set(newest))
    columns = [key, *newest, *rest]
    types = dict(rows.dtypes)
    wait = int(rows.sparkSession.range(1).select(
        (F.expr(f"timestamp'1970-01-01 00:00:00' + interval {silent}").cast("double") * 1000).cast("long")).first()[0])
    place = columns.index(ts)

    def change(keys, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            gone = {c: [None] for c in columns} | {key: [keys[0]], GONE: [True]}
            yield pd.DataFrame(gone)
            return
        held = tuple(state.get) if state.exists else None
        best = held
        for frame in frames:
            found = _highest(frame[columns], newest)
            if best is not None:
                found.append(best)
            best = max(found, key=_order) if found else best
        if best is not None and best[place] is not None:
            if state.getCurrentWatermarkMs() < best[place].timestamp() * 1000 + wait:
                state.setTimeoutTimestamp(int(best[place].timestamp() * 1000) + wait)
        if best is not None and best != held:
            state.update(best)
            yield pd.DataFrame({**{c: pd.Series([v], dtype=object) for c, v in zip(columns, best)}, GONE: [False]})

    fields = ddl({c: types[c] for c in columns})
    watched = rows.select(*columns).withWatermark(ts, late)
    return watched.groupBy(key).applyInPandasWithState(
        change, f"{fields}, {GONE} boolean", fields, "update", GroupStateTimeout.EventTimeTimeout)
