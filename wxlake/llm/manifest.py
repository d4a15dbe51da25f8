"""Merkle manifest of a table: subtrees, proofs of all rows and their verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxlake.llm.common import materialise, pin, small_side

#: Nodes of a run, and the columns of a leaf in order.
WIDTH = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one group reduces: a superblock has WIDTH ** DEPTH nodes of a tree.
DEPTH = 4

NODES = "tree string, rank long, size long, digest binary"
OUTER = "tree string, rank long, digest binary, root binary, path array<string>"
PROVEN = "tree string, key long, leaf string, proof_sha256 string, folded_root string, root binary, subroot binary"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of values side by side, each its length in bytes, a colon and itself, or ``-`` where it is null."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tree_key(column: Column) -> Column:
    """Text that sorts as the column does, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def ranked(nodes: DataFrame, order: Sequence[str], label: str) -> tuple[DataFrame, int]:
    """Nodes with ``rank`` in their tree from 0 and ``size``, the nodes of the tree; and the largest size.

    Ranges of (tree, order) are sorted by a task each and numbered there; the counts of the ranges, one row for a
    range and tree, give each range its first rank. So a tree of any share of the rows is spread over tasks.
    """
    placed = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = materialise(placed.withColumn("place", F.monotonically_increasing_id()), label)
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy("tree", part).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("tree")
    before = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        F.col("tree").alias("of"), F.col("part").alias("of_part"),
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(own).alias("size"))
    counts = small_side(counts, f"{label}-ranges")
    largest = counts.agg(F.max("size")).first()[0] or 0
    same = (F.col("tree") == F.col("of")) & (F.shiftright("place", 33) == F.col("of_part"))
    ranks = placed.join(counts, same).withColumn("rank", F.col("place") + F.col("shift"))
    return ranks.drop("place", "shift", "of", "of_part"), largest


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def reduced(digests: list[str], size: int, width: int = WIDTH, depth: int = DEPTH) -> list[list[str]]:
    """Levels above a superblock's nodes: to a single node if the tree of ``size`` nodes ends here, else ``depth`` of them."""
    rows = [digests]
    whole = size <= width**depth
    while len(rows[-1]) > 1 if whole else len(rows) <= depth:
        last = rows[-1]
        rows.append([_hash("".join(last[i : i + width])) for i in range(0, len(last), width)])
    return rows


def local_paths(rows: list[list[str]], outer: list[str], width: int = WIDTH) -> list[list[str]]:
    """For each node the texts of its siblings before and after it, level by level to the root."""
    paths = [outer]
    for row in reversed(rows[:-1]):
        found = []
        for i in range(len(row)):
            start = i // width * width
            found.append(["".join(row[start:i]), "".join(row[i + 1 : start + width]), *paths[i // width]])
        paths = found
    return paths


def folded(digest: str, path: Sequence[str]) -> str:
    """Root that follows from a node and its siblings."""
    for before, after in zip(path[::2], path[1::2]):
        digest = _hash(f"{before}{digest}{after}")
    return digest


def _block(depth: int) -> Column:
    return F.floor(F.col("rank") / F.lit(WIDTH**depth)).cast("long")


def levels_up(nodes: DataFrame, largest: int, label: str, depth: int = DEPTH) -> list[DataFrame]:
    """The nodes, the roots of their superblocks, and so on to one root for each tree; upper levels are written."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        size = int(block["size"].iloc[0])
        top = reduced([d.hex() for d in block["digest"]], size, depth=depth)[-1][0]
        step = WIDTH**depth
        return pd.DataFrame({
            "tree": block["tree"].iloc[:1], "rank": block["rank"].iloc[:1] // step, "size": -(-size // step), "digest": bytes.fromhex(top)})

    levels = [nodes]
    while True:
        below = levels[-1].select("tree", "rank", "size", "digest", _block(depth).alias("block"))
        levels.append(materialise(below.groupBy("tree", "block").applyInPandas(reduce, NODES), label))
        largest = -(-largest // WIDTH**depth)
        if largest <= 1:
            return levels


def paths_down(levels: Sequence[DataFrame], outer: DataFrame, label: str, depth: int = DEPTH) -> DataFrame:
    """Rows of OUTER for the nodes of ``levels[0]``; ``outer`` has them for the trees' roots.

    At each level nodes are cogrouped with what lies outside their superblock.
    """

    def extend(block: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        rows = reduced([d.hex() for d in block["digest"]], int(block["size"].iloc[0]), depth=depth)
        paths = local_paths(rows, list(outside["path"].iloc[0]))
        return block[["tree", "rank", "digest"]].assign(root=[outside["root"].iloc[0]] * len(block), path=paths)

    for nodes in reversed(levels):
        left = nodes.select("tree", "rank", "size", "digest", _block(depth).alias("block")).groupBy("tree", "block")
        right = outer.withColumnRenamed("rank", "block").groupBy("tree", "block")
        outer = materialise(left.cogroup(right).applyInPandas(extend, OUTER), label)
    return outer


def prove(docs: DataFrame, altered: Mapping[str, Column] | None = None, tree: str = "lang", key: str = "doc_id",
          fields: Sequence[str] = FIELDS, depth: int = DEPTH) -> DataFrame:
    """Leaf, roots, proof and verification of each row.

    ``key``, ``leaf``, ``subroot`` (root of the row's tree), ``root`` (of all subroots), ``proof_sha256`` (hash of all
    siblings up to the root, left to right), ``folded_root`` (from the leaf of the row as ``altered`` has it, and the
    siblings of the unaltered tree) and ``verified``: that root is the manifest's.

    Rows with equal ``tree`` are a tree, null being one of its own. Its leaves are in order of ``key``, null first; rows
    with equal keys in order of their leaf, so equal rows have neighbouring places. Runs of eight nodes become
    one until a single node is left; the last run may be shorter. Any field may be null. No rows: no rows.
    Other columns are not read.

    Rows are numbered within their tree by sorted ranges and dealt to superblocks of ``8 ** depth`` leaves. Superblocks are
    reduced to their roots, these to the next ones, and the subroots form a last tree. Back down, each
    superblock's leaves meet its outer siblings in a cogroup that reduces, proves and folds in one go.
    """
    spark = pin(docs.sparkSession)
    altered = altered or {}
    leaf = leaf_digest([F.col(f) for f in fields])
    given = leaf_digest([altered.get(f, F.col(f)) for f in fields]) if altered else leaf
    leaves = docs.select(
        tree_key(F.col(tree)).alias("tree"), F.col(key).cast("long").alias("key"), leaf.alias("digest"), given.alias("given"),
        F.monotonically_increasing_id().alias("row"))
    leaves = materialise(leaves.withColumn("given", F.nullif("given", "digest")), "leaves")
    nodes, largest = ranked(leaves, ["key", "digest", "row"], "ranked-leaves")
    levels = levels_up(nodes, largest, "subtree-roots", depth)
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of_tree"), "digest")
    tops, trees = ranked(subroots, ["of_tree"], "ranked-subroots")
    top_levels = levels_up(tops, trees, "top-roots", depth)
    root = top_levels[-1].select(
        "tree", "rank", "digest", F.col("digest").alias("root"), F.array().cast("array<string>").alias("path"))
    outer = paths_down(top_levels[:-1], root, "top-paths", depth)
    named = tops.select(F.col("rank").alias("at"), "of_tree")
    outer = outer.join(named, F.col("rank") == F.col("at")).select(
        F.col("of_tree").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", "root", "path")
    outer = outer.withColumn("subroot", F.col("digest"))
    if len(levels) > 2:
        trees_of = outer.select(F.col("tree").alias("of"), "subroot")
        outer = paths_down(levels[1:-1], outer.drop("subroot"), "subtree-paths", depth)
        outer = outer.join(trees_of, F.col("tree") == F.col("of")).drop("of")

    def finish(block: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        digests = [d.hex() for d in block["digest"]]
        rows = reduced(digests, int(block["size"].iloc[0]), depth=depth)
        paths = local_paths(rows, list(outside["path"].iloc[0]))
        start = [d if g is None else g.hex() for d, g in zip(digests, block["given"])]
        return pd.DataFrame({
            "tree": block["tree"], "key": block["key"].astype("Int64"), "leaf": digests,
            "proof_sha256": [_hash("".join(p)) for p in paths], "folded_root": [folded(s, p) for s, p in zip(start, paths)],
            "root": [outside["root"].iloc[0]] * len(block), "subroot": [outside["subroot"].iloc[0]] * len(block)})

    left = nodes.select("tree", "rank", "size", "digest", "given", "key", _block(depth).alias("block")).groupBy("tree", "block")
    right = outer.withColumnRenamed("rank", "block").groupBy("tree", "block")
    proven = left.cogroup(right).applyInPandas(finish, PROVEN)
    root_text = F.lower(F.hex("root"))
    return proven.select(
        F.col("key").alias(key), "leaf", F.lower(F.hex("subroot")).alias("subroot"), root_text.alias("root"), "proof_sha256",
        "folded_root", (F.col("folded_root") == root_text).alias("verified"))


def lower_case_tampering(key: str = "doc_id", text: str = "text", divisor: int = 3) -> dict[str, Column]:
    """Alteration for tests: where the divisor divides the key's CRC-32, A-Z of the text are lower-cased."""
    chosen = F.crc32(F.col(key).cast("long").cast("string").cast("binary")) % divisor == 0
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {text: F.when(chosen, lowered).otherwise(F.col(text))}
