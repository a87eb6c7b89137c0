"""Hash trees of inventories against full joins."""

import hashlib

from pyspark.sql import functions as F

from wavemill.operators import hashtree
from wavemill.operators.lineage import inventory_diff

FILES = "path string, size_bytes bigint, sha256 string"


def many(spark, n):
    return spark.range(n).select(F.concat(F.lit("doc/"), F.col("id").cast("string")).alias("path"), F.col("id").alias("size_bytes"), F.md5(F.col("id").cast("string")).alias("sha256"))


def changed(rows, status="status <> 'ok'"):
    return sorted(map(tuple, rows.where(status).collect()))


def test_all_changes_are_found_at_any_depth(spark):
    a = many(spark, 3000)
    b = a.where("size_bytes % 701 <> 3").withColumn("sha256", F.when(F.col("size_bytes") % 499 == 5, "x").otherwise(F.col("sha256")))
    b = b.withColumn("size_bytes", F.when(F.col("size_bytes") % 997 == 7, None).otherwise(F.col("size_bytes"))).unionByName(a.limit(1).withColumn("path", F.lit("new")))
    want = changed(inventory_diff(a, b))
    assert {status for _, status in want} == {"missing", "extra", "size", "digest"}
    for depth in (None, 0, 1, 3):
        assert changed(hashtree.changed_files(a, b, depth)) == want


def test_one_change_in_a_million_joins_a_leaf(spark):
    a = many(spark, 1_000_000)
    b = a.withColumn("sha256", F.when(F.col("size_bytes") == 123_456, "x").otherwise(F.col("sha256")))
    depth = hashtree.tree_depth(1_000_000)
    ranges = hashtree.unequal_ranges(hashtree.hash_tree(a, depth), hashtree.hash_tree(b, depth), depth)
    assert ranges.count() == 1
    assert 0 < hashtree.in_ranges(a, ranges, depth).count() < 4 * hashtree.LEAF_ROWS
    assert changed(hashtree.changed_files(a, b, depth)) == [("doc/123456", "digest")]


def test_equal_and_empty_inventories(spark):
    a, none = many(spark, 500), spark.createDataFrame([], FILES)
    assert hashtree.changed_files(a, a.orderBy(F.desc("path"))).isEmpty()
    assert hashtree.changed_files(none, none).isEmpty()
    assert changed(hashtree.changed_files(a, none)) == changed(inventory_diff(a, none))
    nulls = spark.createDataFrame([(None, 1, "x")], FILES)
    assert hashtree.changed_files(nulls, none).isEmpty()


def test_repeated_rows_count(spark):
    one = spark.createDataFrame([("a", 1, "x")], FILES)
    root = lambda rows: hashtree.hash_tree(rows, 2).where("level = 0").first()
    assert root(one)["digest"] != root(one.unionByName(one))["digest"]
    assert root(one.unionByName(one))["rows"] == 2
    assert not hashtree.unequal_ranges(hashtree.hash_tree(one, 2), hashtree.hash_tree(one.unionByName(one), 2), 2).isEmpty()


def test_digest_from_its_definition(spark):
    rows = [("a", 1, "x"), ("b", None, None), ("b", None, None)]
    own = [hashlib.sha256(t.encode()).hexdigest() for t in ("1|x|a", "null|null|b", "null|null|b")]
    sums = [sum(int(d[8 * k : 8 * k + 8], 16) for d in own) for k in range(8)]
    want = hashlib.sha256("|".join(map(str, [3, *sums])).encode()).hexdigest()
    assert hashtree.hash_tree(spark.createDataFrame(rows, FILES), 0).first()["digest"] == want


def test_depth_follows_the_rows():
    assert [hashtree.tree_depth(n) for n in (0, 256, 257, 4096, 10**6, 10**9, 10**15)] == [0, 0, 1, 1, 3, 6, 8]
