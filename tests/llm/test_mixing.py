from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wavemill.llm.mixing import CURVES, demand_inverse, mix_documents, mixing_plan, source_targets, taken_words, training_order

SCHEMA = "doc_id bigint, text string, source string, size string"


def fill(sizes, weights=(1, 2, 3), limit=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > limit * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: limit * sizes[s] for s in over}
        left -= sum(limit * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 5, "c": 1, "d": 40, None: 3}, {"x": 0}, {"x": 0, "y": 7}, {"B": 10, "a": 1, "é": 500, "z": 2}])
def test_targets_like_the_stepwise_rule(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    assert {r.source: pytest.approx(r.target) for r in source_targets(rows).collect()} == fill(sizes)


def test_taken_near_target(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = mixing_plan(docs).cache()
    rows = plan.groupBy("source").agg(F.sum(F.col("size") * F.size("positions")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("largest"), F.max(F.size("positions")).alias("most"))
    for r in rows.collect():
        assert abs(r.taken - r.target) <= r.largest and r.most <= 3
    again = mixing_plan(docs.repartition(3))
    assert sorted(map(repr, plan.collect())) == sorted(map(repr, again.collect()))
    order = training_order(plan).collect()
    places = [r.position for r in order]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    assert [r.start for r in order] == list(accumulate((r["size"] for r in order), initial=0))[:-1]
    assert len(order) == plan.agg(F.sum(F.size("positions"))).first()[0]


def test_sources_follow_their_curves(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("").alias("size"))
    order = training_order(mixing_plan(docs)).select("source", "position", "target", "size").collect()
    for k, weight in enumerate((1, 2, 3)):
        own = [r for r in order if r.source == f"s{k}"]
        early = sum(r["size"] for r in own if r.position <= 0.5) / own[0].target
        # the integral of the weight up to the middle of training
        knots = CURVES[weight]
        halfway = sum((min(t1, 0.5) - t0) * (w0 + w0 + (w1 - w0) * (min(t1, 0.5) - t0) / (t1 - t0)) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False) if t0 < 0.5)
        assert early == pytest.approx(halfway, abs=0.01)


def test_early_sources_come_early(spark):
    rows = spark.range(11).select((F.col("id") / 10).alias("share"))
    found = rows.select("share", *(demand_inverse(F.col("share"), c).alias(f"w{w}") for w, c in CURVES.items())).collect()
    for r in found:
        assert r.w1 <= r.w2 + 1e-12 and r.w2 == pytest.approx(r.share) and r.w3 >= r.w2 - 1e-12
    assert found[-1].w1 == pytest.approx(1) and found[0].w3 == 0
    beyond = spark.range(1).select(*(demand_inverse(F.lit(1.0001), c).alias(f"w{w}") for w, c in CURVES.items())).first()
    assert beyond.w1 is None and beyond.w2 is None and beyond.w3 is None


def test_nulls_repeats_and_clashing_columns(spark):
    assert mixing_plan(spark.createDataFrame([(1, "w " * 200_000, "s", "q")], SCHEMA)).first()["size"] == 200_000
    rows = [(1, "a b c", "s", "q"), (1, "a b c", "s", "q"), (2, None, "s", "q"), (3, "", None, "q"), (None, "x y", None, "q"), (4, " \t\n", "t", "q")]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing_plan(docs).collect()
    assert len(plan) == 6 and {r["size"] for r in plan} == {3, 0, 2}
    assert all(not r.positions for r in plan if r["size"] == 0)
    taken = taken_words(mixing_plan(docs)).collect()
    assert len(taken) == 6 and all(r.taken == 0 and r.first_start is None for r in taken if r["size"] == 0)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns and sorted(map(repr, mixed.collect())) == sorted(repr(r) for r, n in zip(docs.collect(), brute.mixed([(r[0], r[2], r[1]) for r in rows])[0], strict=True) for _ in range(n))
    assert mixing_plan(docs.limit(0)).collect() == [] and mix_documents(docs.limit(0)).collect() == []


def test_rows_that_share_an_id_or_have_none_meet_the_targets(spark):
    rows = [(None if k % 2 else k % 7, f"w{k} " * (k % 5 + 1), "abc"[k % 3], "q") for k in range(1500)]
    rows += rows[:200]
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mix_documents(docs).collect()
    taken, targets = brute.mixed([(r[0], r[2], r[1]) for r in rows])
    want = Counter()
    for r, n in zip(rows, taken, strict=True):
        want[r] += n
    assert Counter(map(tuple, mixed)) == +want
    for source, (_, target) in targets.items():
        assert abs(sum(len(r["text"].split()) for r in mixed if r["source"] == source) - target) <= 5


def test_weights_have_curves(spark):
    with pytest.raises(ValueError, match="curve"):
        source_targets(spark.createDataFrame([("a", 1)], "source string, source_size bigint"), weights=(1, 5))
