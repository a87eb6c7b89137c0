"""Inventories as hash trees: two of them are compared from their roots, and only rows of ranges that differ are joined.

A file (path, size_bytes, sha256) belongs to the range of its path's md5 that the first ``depth`` hex digits name, so ranges are
even whatever the paths, and two inventories have the same ones without agreeing on split points. A leaf's digest is made
of sums over its rows, which merge where rows lie: no rows are gathered, though a path be listed any number of times. A
node's digest is that of its 16 children at most. Rows with a null path are no files and left out; an empty inventory has an
empty tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemill.operators.lineage import inventory_diff
from wavemill.sources.scratch import written

#: Rows that a leaf has on average at most, and the most digits of a leaf.
LEAF_ROWS = 256
MOST_DIGITS = 8


def rows_digest(size: str = "size_bytes", sha256: str = "sha256", path: str = "path") -> Column:
    """Aggregate: sha256 (hex) over the number of rows and eight sums, each of 32 bits of the rows' own sha256. Rows may come in
    any order; repeated ones count as often as they are there. Two billion rows and more in one group fail the job."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    row = F.sha2(F.concat_ws("|", text(size), text(sha256), text(path)), 256)
    sums = (F.sum(F.conv(F.substring(row, 8 * k + 1, 8), 16, 10).cast("long")).cast("string") for k in range(8))
    return F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *sums), 256)


def tree_depth(rows: int) -> int:
    """Digits with which leaves have ``LEAF_ROWS`` rows on average at most."""
    return next((d for d in range(MOST_DIGITS) if LEAF_ROWS << (4 * d) >= rows), MOST_DIGITS)


def _leaf(depth: int) -> Column:
    return F.substring(F.md5("path"), 1, depth)


def hash_tree(files: DataFrame, depth: int) -> DataFrame:
    """level, node, rows, digest: the root is level 0 and node '', a leaf level ``depth``. One aggregate over the files, whose
    result is written; upper levels are made of it."""
    leaves = files.where("path is not null").groupBy(_leaf(depth).alias("node")).agg(F.count(F.lit(1)).alias("rows"), rows_digest().alias("digest"))
    below = written(leaves, "tree")
    tree = below.select(F.lit(depth).alias("level"), "node", "rows", "digest")
    for level in range(depth - 1, -1, -1):
        children = F.array_sort(F.collect_list(F.concat_ws(":", "node", "digest")))
        below = below.groupBy(F.substring("node", 1, level).alias("node")).agg(F.sum("rows").alias("rows"), F.sha2(F.array_join(children, "|"), 256).alias("digest"))
        tree = tree.unionByName(below.select(F.lit(level).alias("level"), "node", "rows", "digest"))
    return written(tree, "tree")


def unequal_ranges(a: DataFrame, b: DataFrame, depth: int) -> DataFrame:
    """node: the leaves in which two trees of one depth differ. Goes down from the root, at each level to the children of nodes
    that differ only, and no further than these; equal roots end it at once."""
    front = None
    for level in range(depth + 1):
        one, two = (t.where(F.col("level") == level).select("node", "digest") for t in (a, b))
        if front is not None:
            above = front.select(F.col("node").alias("above"))
            one, two = (t.join(above, F.substring("node", 1, level - 1) == F.col("above"), "left_semi") for t in (one, two))
        one, two = one.alias("a"), two.alias("b")
        both = one.join(two, F.col("a.node") == F.col("b.node"), "full_outer").where(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
        front = written(both.select(F.coalesce("a.node", "b.node").alias("node")), "ranges")
        if front.isEmpty():
            break
    return front


def in_ranges(files: DataFrame, ranges: DataFrame, depth: int) -> DataFrame:
    """The files whose path lies in one of the ranges (node)."""
    return files.where("path is not null").join(ranges.select(F.col("node").alias("range")), _leaf(depth) == F.col("range"), "left_semi")


def changed_files(baseline: DataFrame, observed: DataFrame, depth: int | None = None) -> DataFrame:
    """path, status: missing, extra, size or digest, as :func:`inventory_diff` says, without the files that are ok.

    Both inventories are read twice, but only rows of ranges that differ are exchanged: a few hundred for one changed file.
    Without ``depth`` both are counted first.
    """
    baseline, observed = (rows.select("path", "size_bytes", "sha256") for rows in (baseline, observed))
    if depth is None:
        depth = tree_depth(max(baseline.count(), observed.count()))
    ranges = unequal_ranges(hash_tree(baseline, depth), hash_tree(observed, depth), depth)
    return inventory_diff(in_ranges(baseline, ranges, depth), in_ranges(observed, ranges, depth)).where("status <> 'ok'")


def manifest_root(manifest: DataFrame) -> DataFrame:
    """By run: files, size_bytes, and digest, 64 hex digits that stand for the run's files and roles in any order."""
    named = manifest.withColumn("path", F.concat_ws(":", "role", "path"))
    return named.groupBy("run_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"), rows_digest().alias("digest"))
