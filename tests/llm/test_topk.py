import numpy as np
import pytest

from wavemill.llm.topk import BallTree, search_shard, top_k


def brute(query_ids, queries, ids, rows, k):
    out = set()
    for q, v in zip(query_ids, queries, strict=True):
        found = sorted((-int(sum(int(a) * int(b) for a, b in zip(v, w, strict=True))), int(i)) for i, w in zip(ids, rows, strict=True) if i != q)[:k]
        out |= {(int(q), rank, i, -s) for rank, (s, i) in enumerate(found, 1)}
    return out


def frame(spark, ids, rows, name):
    return spark.createDataFrame([(int(i), [int(x) for x in r]) for i, r in zip(ids, rows, strict=True)], f"{name} bigint, vector array<bigint>")


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_same_as_all_pairs(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.integers(-6, 7, (250, 8)), np.tile(rng.integers(-6, 7, (1, 8)), (60, 1))])
    ids = rng.permutation(1000)[: len(rows)]
    pick = ids % 5 == 0
    got = {tuple(r) for r in top_k(frame(spark, ids[pick], rows[pick], "query_id"), frame(spark, ids, rows, "vec_id"), 7, shard_rows=shard_rows, block_queries=20).collect()}
    assert got == brute(ids[pick], rows[pick], ids, rows, 7)


def test_few_rows_nulls_and_lengths(spark):
    rows = spark.createDataFrame([(1, [1, 2]), (2, [3, 4]), (3, None), (None, [9, 9]), (4, [1, None]), (5, [7]), (6, [])], "vec_id bigint, vector array<bigint>")
    got = sorted(tuple(r) for r in top_k(rows.withColumnRenamed("vec_id", "query_id"), rows, 3).collect())
    assert got == [(1, 1, 2, 11), (2, 1, 1, 11)]
    assert top_k(rows.limit(0).withColumnRenamed("vec_id", "query_id"), rows, 3).collect() == []


@pytest.mark.parametrize("bits", [8, 24, 28])
def test_large_numbers_stay_exact_and_are_pruned(bits):
    rng = np.random.default_rng(2)
    # clusters, so that balls and cones leave most of them out, whatever the size of the numbers
    rows = rng.integers(-(1 << bits), 1 << bits, (12, 4))[rng.integers(0, 12, 3000)] + rng.integers(-3, 4, (3000, 4))
    ids, floor = np.arange(3000), np.full(40, -(1 << 62))
    query, vec, score, scored = search_shard(ids[:40], rows[:40], floor, ids, rows, 5)
    got = {(int(q), int(v), int(s)) for q, v, s in zip(query, vec, score, strict=True)}
    assert got == {(q, v, s) for q, _, v, s in brute(ids[:40], rows[:40], ids, rows, 5)}
    assert scored < 0.5 * 40 * 3000


def test_a_large_value_spoils_no_other(spark):
    rng = np.random.default_rng(7)
    rows = rng.integers(-9, 10, (60, 6))
    rows[3] = 1 << 30
    got = {tuple(r) for r in top_k(frame(spark, range(0, 60, 4), rows[::4], "query_id"), frame(spark, range(60), rows, "vec_id"), 4, shard_rows=7).collect()}
    assert got == brute(range(0, 60, 4), rows[::4], range(60), rows, 4)


def test_leaves_are_pruned_but_nothing_is_lost():
    rng = np.random.default_rng(3)
    rows = (rng.standard_normal((20, 16))[rng.integers(0, 20, 4000)] * 60 + rng.standard_normal((4000, 16)) * 4).astype(np.int64)
    ids = np.arange(4000)
    query, vec, score, scored = search_shard(ids[:50], rows[:50], np.full(50, -(1 << 62)), ids, rows, 20)
    full = rows[:50] @ rows.T
    full[np.arange(50), np.arange(50)] = -(1 << 60)
    for q in range(50):
        order = np.lexsort((ids, -full[q]))[:20]
        assert set(vec[query == q]) == set(order) and sorted(score[query == q]) == sorted(full[q][order])
    assert scored < 0.5 * 50 * 4000
    # with the k-th scores of another shard fewer still are scored
    floor = np.sort(full, axis=1)[:, -20]
    *_, again = search_shard(ids[:50], rows[:50], floor, ids, rows, 20)
    assert again <= scored


def test_bounds_hold():
    rng = np.random.default_rng(5)
    rows = np.concatenate([rng.standard_normal((500, 5)) * 40, rng.standard_normal((500, 5)) + 30, np.zeros((3, 5))])
    queries, tree = rng.standard_normal((60, 5)) * 9, BallTree(rows)
    lengths = np.sqrt((queries * queries).sum(axis=1))
    for node in range(len(tree.nodes)):
        low, high = tree.nodes[node][6:8]
        assert (tree.bound(node, queries, lengths) >= (queries @ rows[tree.order[low:high]].T).max(axis=1)).all()


def test_repeated_ids_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, [1, 2], 9, 8), (1, [1, 2], 9, 8), (1, [5, 5], 9, 8), (2, [3, 4], 9, 8)], "vec_id bigint, vector array<bigint>, score bigint, shard int")
    queries = spark.createDataFrame([(2, [3, 4], 7)], "query_id bigint, vector array<bigint>, floor bigint")
    got = sorted(tuple(r) for r in top_k(queries, rows, 3, shard_rows=1).collect())
    assert got == [(2, 1, 1, 35), (2, 2, 1, 11), (2, 3, 1, 11)]
