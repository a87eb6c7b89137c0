import math

import numpy as np
import pytest

from wavemill.llm.negatives import SlotLists, hard_negatives

KIND = "id bigint, label int, vector array<bigint>"


def brute(anchors, rows, positives, negatives, lowest=80, highest=100):
    fit = lambda r: None not in r and len(r[2]) > 0 and None not in r[2]
    rows, out = [r for r in rows if fit(r)], []
    for one, label, vector in sorted({(a, b, tuple(c)) for a, b, c in filter(fit, anchors)}):
        scored = [(sum(x * y for x, y in zip(vector, v, strict=True)), i, own) for i, own, v in rows if len(v) == len(vector)]
        near = sorted(((-s, i) for s, i, own in scored if own == label and i != one))[:positives]
        for p, positive in near:
            p = -p
            hard = sorted((-s, i) for s, i, own in scored if own != label and lowest * p <= 100 * s <= highest * p)[:negatives]
            out += [(one, positive, rank, i, p, -s) for rank, (s, i) in enumerate(hard, 1)]
    return sorted(out)


def found(spark, anchors, rows, **more):
    frames = (spark.createDataFrame(x, KIND) for x in (anchors, rows))
    return sorted(tuple(r) for r in hard_negatives(*frames, **more).collect())


@pytest.mark.parametrize("shard_rows, block_anchors", [(50, 7), (100_000, 2048)])
@pytest.mark.parametrize("highest", [100, 97, 130])
def test_same_as_all_pairs(spark, shard_rows, block_anchors, highest):
    rng = np.random.default_rng(1)
    centers = rng.integers(-20, 21, (6, 5))
    vectors = centers[rng.integers(0, 6, 400)] + rng.integers(-2, 3, (400, 5))
    vectors[300:360] = vectors[300]  # a group of copies
    labels = np.where(rng.random(400) < 0.4, 0, rng.integers(0, 5, 400))
    rows = [(int(i), int(x), [int(y) for y in v]) for i, x, v in zip(rng.permutation(1000)[:400], labels, vectors, strict=True)]
    anchors = [r for r in rows if r[0] % 9 == 0]
    got = found(spark, anchors, rows, positives=4, negatives=3, highest=highest, shard_rows=shard_rows, block_anchors=block_anchors)
    assert got == brute(anchors, rows, 4, 3, highest=highest)
    assert got


def test_nulls_lengths_repeats_and_empty_tables(spark):
    rows = [(1, 0, [3, 4]), (2, 0, [3, 3]), (2, 0, [3, 3]), (3, 1, [3, 3]), (4, 1, [3, 3]), (4, 1, [3, 3]), (5, None, [3, 4]), (6, 1, None), (None, 1, [3, 4]), (7, 1, [3, None]), (8, 1, []), (9, 1, [20]), (1, 0, [9, 9]), (10, 2, [-3, -4])]
    got = found(spark, rows + rows, rows, positives=2, negatives=4)
    assert got == brute(rows, rows, 2, 4)
    assert (1, 2, 1, 3, 21, 21) in got and (1, 2, 3, 4, 21, 21) in got
    assert found(spark, [], rows) == found(spark, rows, []) == []


def test_negative_and_zero_scores(spark):
    rows = [(1, 0, [1, 0]), (2, 0, [-2, 1]), (3, 0, [0, 1]), (4, 1, [-1, 0]), (5, 1, [0, 7]), (6, 1, [-3, 0])]
    got = found(spark, rows[:1], rows)
    assert got == brute(rows[:1], rows, 5, 5) == [(1, 3, 1, 5, 0, 0)]
    assert found(spark, rows[:1], rows, lowest=200, highest=50) == brute(rows[:1], rows, 5, 5, 200, 50)


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, [int(x) for x in rng.integers(1 << 28, 1 << 29, 3)]) for i in range(60)]
    assert found(spark, rows[::5], rows) == brute(rows[::5], rows, 5, 5)
    with pytest.raises(Exception, match="62 bits"):
        found(spark, [(1, 0, [1 << 60])], [(2, 0, [1 << 60])])


def test_extra_columns_that_clash(spark):
    rows = spark.createDataFrame([(1, 0, [1, 2], 9, 8), (2, 0, [2, 2], 9, 8), (3, 1, [2, 2], 9, 8)], KIND + ", key int, slot int")
    assert [tuple(r) for r in hard_negatives(rows.where("id = 1"), rows).collect()] == [(1, 2, 1, 3, 6, 6)]


def test_lists_keep_the_best_of_each_slot():
    rng = np.random.default_rng(4)
    lists, held = SlotLists(6, 3), {k: [] for k in range(6)}
    for _ in range(30):
        slots, scores, ids = rng.integers(0, 6, 20), rng.integers(-5, 6, 20), rng.integers(0, 99, 20)
        lists.offer(slots, scores, ids)
        for s, x, i in zip(slots, scores, ids, strict=True):
            held[int(s)].append((-int(x), int(i)))
    got = sorted(zip(*(x.tolist() for x in lists.found()), strict=True))
    assert got == sorted((s, -x, i) for s, own in held.items() for x, i in sorted(own)[:3])
    assert math.isfinite(lists.worst(np.arange(6)).max())
