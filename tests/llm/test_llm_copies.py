"""Substring dedup, Jaccard join, components and line dedup against brute force."""

import random
from hashlib import md5

import pytest

import corpus_pipeline
from brute import SCHEMA, linked, odd_rows, random_rows, without_repeats
from wxlake.llm import chunks, graphs, jaccard, line_dedup, queries, substrings

SF = "/root/testdata/sf0.001"


def table(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("window", [35, 4])
def test_repeated_windows(spark, window):
    rows = random_rows(window) + odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = substrings.without_repeats(docs, window, chunk_bytes=4000).collect()
    assert sorted(map(tuple, found), key=repr) == without_repeats(rows, window)


@pytest.mark.parametrize("checked", [False, True])
@pytest.mark.parametrize("buckets, first", [(1, 4), (4, 4), (9, 9), (300, 7)])
def test_names_in_common(spark, buckets, first, checked):
    """Against counts of all names; with more buckets than ``first``, over relays of two chunks. Checks split equal names."""
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    pick = np.random.default_rng(buckets)
    pool = pick.integers(0, 2**64, 400, dtype=np.uint64)
    held = [(pool[pick.integers(0, 400, n)], pick.integers(0, 2, n).astype(np.uint64)) for n in (150, 1, 0, 80, 60)]
    named = [chunks.Named(n, c if checked else None) for n, c in held]
    counts = Counter((a, b * checked) for n, c in held for a, b in zip(n.tolist(), c.tolist()))
    rows = pa.concat_tables([own.table(i, buckets, first) for i, own in enumerate(named)])
    told = chunks.common_names(spark.createDataFrame(rows.to_pylist(), chunks.NAMES), buckets, first, 2).toArrow()
    for i, (own, (n, c)) in enumerate(zip(named, held)):
        mine = told.filter(pa.compute.equal(told.column("chunk"), i))
        assert own.common(mine, buckets, first).tolist() == [counts[a, b * checked] > 1 for a, b in zip(n.tolist(), c.tolist())]


def test_buckets_cost_nothing_where_no_name_falls():
    import numpy as np

    names = np.sort(np.random.default_rng(3).integers(0, 2**64, 1000, dtype=np.uint64))
    for buckets in (1, 2, 10, 25_000_000):
        held, bounds = chunks.ranges(names, buckets)
        width = -(-(2**64) // buckets)
        assert [int(x) // width for x in names] == [b for b, n in zip(held.tolist(), np.diff(bounds).tolist()) for _ in range(n)]
    assert chunks.Named(names).table(0, 25_000_000).num_rows <= 1000
    assert [len(x) for x in chunks.ranges(names[:0], 5)] == [0, 1]


def test_an_id_on_many_texts_and_a_text_under_many_ids_fall_to_all_chunks(spark):
    from pyspark.sql import functions as F

    ids = spark.range(4000)
    one = ids.select(F.lit(7).alias("doc_id"), F.col("id").cast("string").alias("text"))
    for docs in (one, one.withColumn("doc_id", F.lit(None).cast("long")), ids.select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))):
        sizes = [r["count"] for r in chunks.chunked(docs, 20).groupBy("chunk").count().collect()]
        assert len(sizes) == 20 and max(sizes) < 300


def test_repeats_within_one_text_and_none_at_all(spark):
    words = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(words * 2), None, None, None), (2, " ".join(words[:34]), None, None, None)]
    found = {r.doc_id: r.n_removed for r in substrings.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: 100, 2: 0}
    assert substrings.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_symbols_outside_reach_of_edges_are_equal_everywhere():
    """Every symbol whose deciding words lie in a copied passage occurs in all copies."""
    import numpy as np

    pick = np.random.default_rng(5)
    passage = pick.integers(0, 40, 60, dtype=np.uint64)
    texts = [np.concatenate([pick.integers(0, 40, n, dtype=np.uint64), passage, pick.integers(0, 40, m, dtype=np.uint64)])
             for n, m in ((0, 9), (13, 0), (30, 30))]
    seen = []
    for text, before in zip(texts, (0, 13, 30)):
        own = substrings.Symbols.compressed(text, np.zeros(len(text), dtype=int))
        inside = (own.low >= before) & (own.high <= before + len(passage))
        seen.append({(n, l - before, h - before) for n, l, h in zip(own.names[inside].tolist(), own.low[inside].tolist(), own.high[inside].tolist())})
    assert seen[0] == seen[1] == seen[2] and seen[0]


def test_repeats_over_relays(spark, monkeypatch):
    """More buckets than a chunk deals its names to: the answers come back through relays."""
    monkeypatch.setattr(chunks.common_names, "__defaults__", (4, 3))
    monkeypatch.setattr(chunks.Named.table, "__defaults__", (4,))
    monkeypatch.setattr(chunks.Named.common, "__defaults__", (4,))
    monkeypatch.setattr(chunks, "BUCKET_BYTES", 300)
    rows = random_rows(8) + odd_rows()
    found = substrings.without_repeats(spark.createDataFrame(rows, SCHEMA), 35, chunk_bytes=9000).collect()
    assert sorted(map(tuple, found), key=repr) == without_repeats(rows, 35)


def test_substring_query(spark):
    import hashlib

    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in without_repeats(table(spark))]
    assert sorted(map(tuple, queries.QUERIES["op6_substring_dedup"](spark, SF).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("percent, frequent, cells, side", [(90, 32, 256, 512), (90, 2, 8, 7), (75, 4, 4, 5)])
def test_similarity_join(spark, monkeypatch, percent, frequent, cells, side):
    monkeypatch.setattr(jaccard.signatures, "__defaults__", (frequent, cells))
    monkeypatch.setattr(jaccard, "SIDE_SETS", side)
    rows = random_rows(percent + side) + odd_rows()
    found = jaccard.join(spark.createDataFrame(rows, SCHEMA), percent=percent, chunk_bytes=4000).collect()
    assert sorted(map(tuple, found), key=repr) == linked(rows, percent=percent)


def test_signatures_of_linked_sets_meet():
    import numpy as np

    pick = np.random.default_rng(6)
    universe = np.unique(pick.integers(0, 2**63, 3000, dtype=np.uint64))
    counts = pick.choice([1, 2, 9, 20, 40], len(universe))
    met = 0
    for _ in range(400):
        n = int(pick.integers(1, 200))
        own = np.sort(pick.choice(universe[counts > 1], n, replace=False))
        other = np.unique(np.r_[own[pick.random(n) < 0.97], pick.choice(universe, int(pick.integers(0, 1 + n // 20)))])
        shared = len(np.intersect1d(own, other))
        if 100 * shared >= 90 * (len(own) + len(other) - shared):
            at = dict(zip(universe.tolist(), counts.tolist()))
            signed = [jaccard.signatures(s, np.array([at[t] for t in s.tolist()]), 90, frequent=4, cells=8) for s in (own, other)]
            assert len(np.intersect1d(*signed))
            met += 1
    assert met > 50


def test_join_without_rows_or_links(spark):
    assert jaccard.join(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b c d", None, None, None), (2, "e f g h", None, None, None)]
    assert sorted(map(tuple, jaccard.join(spark.createDataFrame(rows, SCHEMA)).collect())) == [(1, 2, 1, 0), (2, 2, 2, 0)]


def one_of_each(rows):
    """doc_id and text of the rows that stay, by linking rows under ids of their own."""
    own = sorted({r[:2] for r in rows if r[0] is not None}, key=lambda r: (r[0], md5((r[1] or "").encode()).digest()))
    parts = linked([(i, text) for i, (_, text) in enumerate(own)])
    return sorted([own[i] for i, _, component, _ in parts if i == component] + [r[:2] for r in rows if r[0] is None], key=repr)


def test_one_document_of_each_group(spark):
    rows = random_rows(11, groups=10) + odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as component_id", "'x' as row", "2 as digest", "3 as node")
    kept = jaccard.one_of_each(docs, chunk_bytes=4000)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == one_of_each(rows)


def test_other_texts_of_an_id_stay(spark):
    rows = [(1, "alpha beta gamma delta"), (1, "wholly other words stand here"), (1, "alpha beta gamma delta"), (2, "wholly other words stand here"),
            (2, "a third text of its own"), (3, ""), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.text or "") for r in jaccard.one_of_each(docs).collect()), key=repr)
    assert found == [(1, "alpha beta gamma delta"), (1, "wholly other words stand here"), (2, "a third text of its own"), (3, "")]


def test_join_query(spark):
    assert sorted(map(tuple, queries.QUERIES["op9_ngram_jaccard_join"](spark, SF).collect()), key=repr) == linked(table(spark))


def test_components(spark):
    pick = random.Random(8)
    edges = [(pick.randint(0, 150), pick.randint(0, 150)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)] + [(5, 5)]
    root = list(range(300))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {i: find(i) for a, b in edges for i in (a, b) if a != b}
    found = graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == want and len(found) == len(want)
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_boilerplate_of_a_tenth_of_the_pages_goes_from_all_hosts(spark):
    """Shares of 8 to 13% by the chance of the host go, those under 5% stay."""
    rows = [(1000 * h + i, "\n".join([f"own {h} {i}", *["licence"] * (i < share), *["motto"] * (i < 9)]), "en", f"h{h}", 0)
            for h, share in enumerate((16, 18, 20, 26)) for i in range(200)]
    kept = line_dedup.drop_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(kept) == len(rows) and not any("licence" in r.text for r in kept)
    assert sum("motto" in r.text for r in kept) == 4 * 9


def test_boilerplate_lines(spark):
    rows = [(300 + i, f"top\nline {i}\n\n{'common' if i % 2 else 'rare ' + str(i)}\ncommon", "en", "a", 0) for i in range(20)]
    rows += [(100 + i, "top\nelse", None, None, None) for i in range(4)] + odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n_lines", "2 as of", "3 as common")
    found = {r.row.doc_id: r for r in line_dedup.mark_lines(docs, ratio=0.1, least_pages=5).collect() if (r.row.doc_id or 0) >= 0}
    hosts = {}
    for _, text, _, source, _ in rows:
        hosts.setdefault(source, []).append((text or "").split("\n") if text is not None else [])
    for r in line_dedup.mark_lines(docs, ratio=0.1, least_pages=5).collect():
        pages = hosts[r.row.source]
        held = {line for page in pages for line in page if line and sum(line in p for p in pages) > 0.1 * len(pages) and sum(line in p for p in pages) >= 5}
        if r.row.text is None:
            assert (r.n_lines, r.n_dropped, r.kept) == (0, 0, None)
            continue
        own = r.row.text.split("\n")
        kept = [x for x in own if x not in held]
        assert (r.n_lines, r.n_dropped, r.kept) == (len(own), len(own) - len(kept), "\n".join(kept))
    assert found[303].kept == "line 3\n"
    out = line_dedup.drop_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert line_dedup.mark_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pipeline_drops_boilerplate_around_a_tenth_on_all_hosts(spark):
    rows = []
    for host, percent in (("a", 8), ("b", 10), ("c", 11), ("d", 13)):
        for i in range(100):
            text = [f"{host} line {i}"] + ["licence"] * (i < percent) + ["phrase"] * (i >= 96)
            rows.append((len(rows), "\n".join(text), "en", host, 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    out = corpus_pipeline.boilerplate_lines(spark, docs, SF).collect()
    assert len(out) == 400 and not any("licence" in r.text for r in out)
    assert sum("phrase" in r.text for r in out) == 16
    assert sum("line" in r.text for r in out) == 400


def test_copies_of_a_whole_text_are_no_boilerplate_of_the_pipeline(spark):
    clean = "a clean text\nof two lines"
    rows = [(i, clean if i < 40 else None if i < 44 else f"page {i}\nmenu", "en", "a", 0) for i in range(100)]
    rows += [(200 + i, clean, None, None, 0) for i in range(10)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r.text for r in corpus_pipeline.boilerplate_lines(spark, docs, SF).collect()}
    assert len(out) == 110
    assert all(out[i] == clean for i in [*range(40), *range(200, 210)])
    assert all(out[i] is None for i in range(40, 44)) and all(out[i] == f"page {i}" for i in range(44, 100))
    counted = {r.row.doc_id: r.kept for r in line_dedup.mark_lines(docs).collect()}
    assert counted[0] == counted[200] == "" and counted[50] == "page 50"


def test_a_tile_of_two_blocks_with_one_empty_counts_nothing():
    import numpy as np

    sets = [np.arange(20, dtype=np.uint64), np.arange(20, dtype=np.uint64)]
    alone = (np.ones(2, np.int64), np.zeros(2, np.int64))
    assert jaccard.verify([b"a", b"b"], sets, *alone, False, 90) == ([], [])
    edges, links = jaccard.verify([b"a", b"b"], sets, *alone, True, 90)
    assert {frozenset(e) for e in edges} == {frozenset((b"a", b"b"))} and links == [(b"a", 1), (b"b", 1)]
