"""URL rules and exact list membership by a cascade of Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from wxlake.llm.common import materialise, pin, small_side

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Share of other keys that pass one level.
FALSE_SHARE = 0.05
#: Distinct keys of one shard, about.
SHARD_KEYS = 200_000
#: Bytes of all filters up to which they are broadcast; beyond, rows go to their shard's filters, about so many to a task.
BROADCAST_BYTES, PART_ROWS = 32 << 20, 100_000

LEVELS = "shard int, bits array<int>, hashes array<int>, filters array<binary>"


class Rule(NamedTuple):
    """``text`` is a host, and from its first slash on a path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path. Null or without ``://``: both empty."""
    pattern = "://([^/?#]*)([^?#]*)"
    part = [F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2)]
    return F.translate(part[0], CAPITALS, SMALL), part[1]


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as its text; else null. Rules are a few parameters."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def _spread(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int):
    """Bit positions of keys in a level; each level mixes the two hashes anew."""
    with np.errstate(over="ignore"):
        a = h1.view(np.uint64) ^ (np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15))
        a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(27)
        b = (h2.view(np.uint64) + np.uint64(level)) * np.uint64(0x94D049BB133111EB) | np.uint64(1)
        for i in range(hashes):
            yield ((a + np.uint64(i) * b) >> np.uint64(11)) % np.uint64(bits)


def _filter(h1, h2, level, share=FALSE_SHARE):
    """Bits, number of hashes and the filter itself, of the keys of a level."""
    hashes = max(1, round(-np.log2(share)))
    bits = max(64, int(np.ceil(len(h1) * hashes / np.log(2))))
    marks = np.zeros(bits, dtype=bool)
    for at in _spread(h1, h2, level, hashes, bits):
        marks[at] = True
    return bits, hashes, np.packbits(marks).tobytes()


def _passes(h1, h2, level, bits, hashes, raw) -> np.ndarray:
    marks = np.frombuffer(raw, dtype=np.uint8)
    found = np.ones(len(h1), dtype=bool)
    for at in _spread(h1, h2, level, hashes, bits):
        found &= (marks[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return found


def _build(table: pa.Table) -> pa.Table:
    """Cascade of one shard: level by level, the keys that the level before lets through wrongly.

    Levels start with the listed keys. A level holds one side, and what passes it of the other
    side is the next level, until nothing passes.
    """
    h1, h2 = (np.ascontiguousarray(table.column(c).to_numpy()) for c in ("h1", "h2"))
    listed = np.asarray(table.column("listed").to_numpy())
    sides = [(h1[listed], h2[listed]), (h1[~listed], h2[~listed])]
    levels = []
    while len(sides[0][0]):
        if len(levels) == 60:
            raise ValueError("a listed and another key have equal hashes")
        level = len(levels)
        made = _filter(*sides[0], level)
        passed = _passes(*sides[1], level, *made)
        levels.append(made)
        sides = [tuple(h[passed] for h in sides[1]), sides[0]]
    columns = list(zip(*levels)) if levels else [(), (), ()]
    return pa.Table.from_pydict({
        "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
        "bits": pa.array([columns[0]], pa.list_(pa.int32())), "hashes": pa.array([columns[1]], pa.list_(pa.int32())),
        "filters": pa.array([columns[2]], pa.list_(pa.binary()))})


def _listed(levels, h1, h2) -> np.ndarray:
    """Exact for every key of the universe: the first level that a key fails tells its side."""
    answer, open_ = np.zeros(len(h1), dtype=bool), np.arange(len(h1))
    for level, (bits, hashes, raw) in enumerate(levels):
        passed = _passes(h1[open_], h2[open_], level, bits, hashes, raw)
        answer[open_[~passed]] = level % 2 == 1
        open_ = open_[passed]
    answer[open_] = len(levels) % 2 == 1
    return answer


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


class Cascade:
    """Filters by shard, in a written table."""

    def __init__(self, table: DataFrame, shards: int, size: int):
        self.table, self.shards, self.size = table, shards, size


def fit(universe: DataFrame, listed: Column, key: str = "key", shard_keys: int = SHARD_KEYS) -> Cascade:
    """Cascade over all keys of ``universe``; a key is listed if ``listed`` holds in any of its rows.

    Null keys take no part. Repeated keys are combined before the shuffle. A shard has about
    ``shard_keys`` distinct keys, whatever the number of rows, and is built in one task.
    """
    pin(universe.sparkSession)
    rows = universe.where(F.col(key).isNotNull()).select(*_hashed(F.col(key)), F.coalesce(listed, F.lit(False)).alias("listed"))
    keys = materialise(rows.groupBy("h1", "h2").agg(F.bool_or("listed").alias("listed")), "url-keys")
    shards = max(1, -(-keys.count() // shard_keys))
    shard = F.pmod("h2", F.lit(shards)).cast("int").alias("shard")
    table = keys.select(shard, "h1", "h2", "listed").groupBy("shard").applyInArrow(_build, LEVELS)
    table = materialise(table, "cascade")
    size = table.agg(F.sum(F.aggregate("filters", F.lit(0).cast("long"), lambda n, x: n + F.length(x)))).first()[0] or 0
    return Cascade(table, shards, size)


def contains(rows: DataFrame, cascade: Cascade, key: str = "key", broadcast_bytes: int = BROADCAST_BYTES,
             part_rows: int = PART_ROWS) -> DataFrame:
    """All rows with one more column ``listed``; false for null keys. Keys must be of the fitted universe.

    Up to ``broadcast_bytes`` the filters go to all tasks. Beyond, the rows themselves are dealt by shard, and a shard
    with more than ``part_rows`` rows in parts, as one key may hold many; its filters go to each part, where the cascade answers.
    No keys are joined. A null key's rows are dealt like those of any other hash.
    """
    spark, shards = rows.sparkSession, cascade.shards
    if cascade.size <= broadcast_bytes:
        levels = {r.shard: list(zip(r.bits, r.hashes, r.filters)) for r in cascade.table.collect()}
        shared = spark.sparkContext.broadcast(levels)

        @F.arrow_udf("boolean")
        def member(h1: pa.Array, h2: pa.Array) -> pa.Array:
            a, b = h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)
            shard, out = b % shards, np.zeros(len(a), dtype=bool)
            for s in np.unique(shard):
                own = shard == s
                out[own] = _listed(shared.value.get(int(s), []), a[own], b[own])
            return pa.array(out)

        return rows.withColumn("listed", F.col(key).isNotNull() & member(*_hashed(F.col(key))))

    shard = F.pmod("h2", F.lit(shards)).cast("int")
    hashed = rows.select(F.struct(*[rows[c] for c in rows.columns]).alias("row"), F.col(key).isNotNull().alias("keyed"), *_hashed(F.col(key)))
    hashed = hashed.withColumn("shard", shard)
    parts = hashed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(part_rows)).cast("int").alias("parts"))
    parts = small_side(parts.withColumnRenamed("shard", "of"), "url-parts")
    dealt = hashed.join(parts, F.col("shard") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    filters = cascade.table.join(parts, F.col("shard") == F.col("of")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def answer(filters: pa.Table, told: pa.Table) -> pa.Table:
        levels = [list(zip(r["bits"], r["hashes"], r["filters"])) for r in filters.to_pylist()] or [[]]
        a, b = (np.ascontiguousarray(told.column(c).to_numpy()) for c in ("h1", "h2"))
        found = _listed(levels[0], a, b) & np.asarray(told.column("keyed").to_numpy())
        return pa.table({"row": told.column("row"), "listed": pa.array(found)})

    schema = StructType([StructField("row", rows.schema), StructField("listed", BooleanType())])
    told = filters.select("shard", "part", "bits", "hashes", "filters").groupBy("shard", "part").cogroup(
        dealt.select("shard", "part", "h1", "h2", "keyed", "row").groupBy("shard", "part")).applyInArrow(answer, schema)
    return told.select("row.*", "listed")


def judge(pages: DataFrame, rules: Sequence[Rule], listed: Column, carry: Sequence[str] = ("page_id",),
          url: str = "url", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The carried columns, ``host``, ``path``, ``rule``, ``listed`` and ``verdict`` of every page.

    The longest fitting rule decides. Without a rule, a page is blocked if its key, host and path, is
    listed: if ``listed``, a condition on ``pages``, holds for any page with this key. Urls without host have no key and are allowed.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(*carry, host.alias("host"), path.alias("path"), F.coalesce(listed, F.lit(False)).alias("on_list"))
    rows = rows.withColumn("key", F.when(F.col("host") != "", F.concat("host", "path")))
    cascade = fit(rows.select("key", "on_list"), F.col("on_list"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    told = contains(rows, cascade, "key", broadcast_bytes).withColumn("rule", rule)
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    for r in rules:
        verdict = F.when(F.col("rule") == r.text, r.verdict).otherwise(verdict)
    return told.select(*carry, "host", "path", "rule", "listed", verdict.alias("verdict"))
