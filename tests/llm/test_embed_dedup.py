import numpy as np
import pytest

from tests.llm.conftest import union_components
from wavemill.llm import embed_dedup
from wavemill.llm.embed_dedup import embedding_components

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, least=0.93):
    fit = [(i, np.array(v, np.float32).astype(float), g) for i, v, g in rows if g is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a[0], b[0]) for k, a in enumerate(fit) for b in fit[k + 1 :] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / (np.sqrt(a[1] @ a[1]) * np.sqrt(b[1] @ b[1])) >= least]
    parts = union_components([r[0] for r in rows], links)
    return {(i, sum(i in link for link in links), parts[i], parts[i] == i) for i, _, _ in rows}


def test_same_as_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):
        base = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 12))):
            noisy = base + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.3])
            rows.append((len(rows), noisy.astype(np.float32).tolist(), k % 3))
    got = {tuple(r) for r in embedding_components(spark.createDataFrame(rows, SCHEMA), window=16).collect()}
    assert got == brute(rows)


def test_groups_larger_than_the_window(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(24)
    rows = [(k, (base + rng.standard_normal(24) * 0.05).astype(np.float32).tolist(), 1) for k in range(150)] + [(500 + k, base.astype(np.float32).tolist(), 1) for k in range(40)]
    got = {tuple(r) for r in embedding_components(spark.createDataFrame(rows, SCHEMA), window=4).collect()}
    assert got == brute(rows)


def test_unusable_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None), (10, [1.0], 1), (11, [], 1)]
    got = {tuple(r) for r in embedding_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)
    assert {r for r in got if r[1]} == {(1, 1, 1, True), (2, 1, 1, False)}


def test_repeated_ids_and_a_cosine_at_the_threshold(spark):
    # 3-4-5 triangles: the cosine of the first two is 0.96, exactly
    rows = [(1, [1.0, 0.0], 1), (2, [24.0, 7.0], 1), (7, [0.0, 1.0], 2), (7, [0.0, 1.0], 2), (8, [0.0, 2.0], 2)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in embedding_components(table, cosine=0.96).collect())
    assert got[:2] == [(1, 1, 1, True), (2, 1, 1, False)]
    assert got[2:] == [(7, 2, 7, True), (7, 2, 7, True), (8, 2, 7, False)]
    assert {r.n_links for r in embedding_components(table, cosine=0.9600001).where("vec_id < 3").collect()} == {0}


@pytest.mark.parametrize("partitions", [4, 16])
def test_a_group_many_times_a_chunk(spark, monkeypatch, partitions):
    monkeypatch.setattr(embed_dedup, "CHUNK_ROWS", 16)
    rng = np.random.default_rng(8)
    base = rng.standard_normal(24)
    rows = [(k, (base + rng.standard_normal(24) * 0.05).astype(np.float32).tolist(), 1) for k in range(600)]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {tuple(r) for r in embedding_components(spark.createDataFrame(rows, SCHEMA), window=4, passes=6).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows)


def test_clashing_columns_null_ids_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, [1.0, 0.0], 1, 5), (1, [1.0, 0.0], 1, 6)], SCHEMA + ", copies int")
    assert sorted(map(repr, embedding_components(rows).collect())) == sorted(map(repr, [(None, 0, None, True), (1, 0, 1, True)])) or [tuple(r) for r in embedding_components(rows).orderBy("vec_id").collect()] == [(None, 0, None, True), (1, 0, 1, True)]
    assert embedding_components(rows.limit(0)).collect() == []


def test_groups_larger_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CHUNK_ROWS", 64)
    rng = np.random.default_rng(6)
    base, rows = rng.standard_normal(24), []
    for spread, label, size in ((1e-4, 1, 500), (0.2, 1, 200), (0.05, 2, 300)):
        rows += [(len(rows) + k, (base + rng.standard_normal(24) * spread).astype(np.float32).tolist(), label) for k in range(size)]
    got = {tuple(r) for r in embedding_components(spark.createDataFrame(rows, SCHEMA), window=4, passes=6).collect()}
    assert got == brute(rows)


def test_doubles_are_compared_as_doubles(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [0.93, (1 - 0.93**2) ** 0.5], 1), (3, [1e300, 1e300], 2), (4, [1e-300, 1e-300], 2), (5, [-1e300, 1e300], 2)]
    table = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    got = sorted(tuple(r) for r in embedding_components(table).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True)]


def test_passes_grow_with_the_largest_label():
    assert [embed_dedup.passes_needed(10**k, 128, 0.93, 0.999) for k in range(2, 10)] == [1, 6, 12, 20, 33, 52, 81, 125]
    assert embed_dedup.passes_needed(0, 128, 0.93, 0.999) == 1 and embed_dedup.passes_needed(10**9, 128, 1.0, 0.999) == 1


def planted(rows, pairs, seed, cosine=0.931, width=64):
    """Vectors of random directions, the first ``pairs`` of which have a partner at the cosine: floats and the pairs."""
    rng = np.random.default_rng(seed)
    vectors = rng.standard_normal((rows, width))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    for k in range(pairs):
        away = rng.standard_normal(width)
        away -= (away @ vectors[k]) * vectors[k]
        vectors[pairs + k] = cosine * vectors[k] + (1 - cosine**2) ** 0.5 * away / np.linalg.norm(away)
    return vectors.astype(np.float32)


def test_lone_pairs_at_the_threshold_are_found_in_a_large_label(spark, monkeypatch):
    """A window of 8 in 6,400 rows is to them what 128 is to 100,000."""
    vectors = planted(6400, 300, 9)
    monkeypatch.setattr(embed_dedup, "LEAST_PASSES", 1)
    table = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(vectors)], SCHEMA)
    got = {r.vec_id: r.component_id for r in embedding_components(table, window=8).collect()}
    assert sum(got[300 + k] == k for k in range(300)) >= 297
