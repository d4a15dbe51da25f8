"""Merkle manifest against trees built in plain Python."""

import random
import zlib
from hashlib import sha256

import pytest

from brute import SCHEMA, odd_rows
from wxlake.llm import manifest, queries


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = (row[0], row[3], row[2], row[4], text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """Root, and for each node its siblings before and after it, level by level."""
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([h("".join(rows[-1][i : i + 8])) for i in range(0, len(rows[-1]), 8)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for row in rows[:-1]:
            start = i // 8 * 8
            path.append((row[start:i], row[i + 1 : start + 8]))
            i //= 8
        paths.append(path)
    return rows[-1][0], paths


def proven(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for x in langs]
    trees = [tree([leaf(r, r[1]) for r in own]) for own in groups]
    root, tops = tree([t[0] for t in trees])
    out = []
    for own, (subroot, paths), top in zip(groups, trees, tops):
        for row, path in zip(own, paths):
            text = row[1]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest = leaf(row, text)
            for before, after in path + top:
                digest = h("".join([*before, digest, *after]))
            proof = h("".join("".join(b + a) for b, a in path + top))
            out.append((row[0], leaf(row, row[1]), subroot, root, proof, digest, digest == root))
    return sorted(out, key=repr)


def many_rows(n, langs):
    pick = random.Random(n)
    return [(i * 7 % 1009 if i % 50 else None, pick.choice(["A b", "", "c D"]) + str(i) if i % 9 else None, pick.choice(langs), None, i)
            for i in range(n)]


@pytest.mark.parametrize("rows, depth", [
    (odd_rows(), 4), (odd_rows(), 1), (many_rows(1500, ["en", "en", "en", None, "é", "de"]), 2), ([(5, "A", None, None, None)], 4),
    (many_rows(300, [None, *map(str, range(90))]), 1),
])
def test_proofs_equal_plain_trees(spark, rows, depth):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tree", "2 as rank", "3 as size", "4 as root", "5 as key")
    found = manifest.prove(docs, manifest.lower_case_tampering(), depth=depth)
    assert sorted(map(tuple, found.collect()), key=repr) == proven(rows)


def test_an_untouched_table_is_verified(spark):
    found = manifest.prove(spark.createDataFrame(odd_rows(), SCHEMA)).collect()
    assert len(found) == len(odd_rows()) and all(r.verified for r in found)


def test_no_rows(spark):
    assert manifest.prove(spark.createDataFrame([], SCHEMA), manifest.lower_case_tampering()).collect() == []


def test_a_last_single_node_is_hashed_at_each_level():
    rows = manifest.reduced([h(str(i)) for i in range(9)], size=9)
    assert [len(r) for r in rows] == [9, 2, 1] and rows[1][1] == h(rows[0][8])
    assert [len(r) for r in manifest.reduced([h("x")], size=9, depth=1)] == [1, 1]
    assert len(manifest.reduced([h("x")], size=1)) == 1


def test_query_covers_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op12_merkle_manifest"](spark, sf).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, found), key=repr) == proven(rows)
