"""Boosting by histograms against a plain search of every split, on raw values."""

import math
import random

import numpy as np
import pytest

from wavemill.operators import boosting

SCHEMA = "ordinal int, target_value int, window array<double>"


def table(n, width, seed, missing=0.0, values=40):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        x = [None if draw.random() < missing else float(draw.randrange(values)) for _ in range(width)]
        chance = 0.85 if (x[0] or 0) + (x[1] if x[1] is not None else 25) > values else 0.2
        rows.append((k, int(draw.random() < chance), x))
    return rows


def goes_left(x, threshold, missing_left):
    return missing_left if x is None else x <= threshold


class Brute:
    """Best-first trees from sums over rows, for every value of every feature as a threshold."""

    def __init__(self, rows, rounds, rate, leaves, leaf_rows, l2):
        ones = sum(y for _, y, _ in rows)
        weight = {1: len(rows) / (2 * ones), 0: len(rows) / (2 * (len(rows) - ones))}
        raw, self.trees = [0.0] * len(rows), []
        for _ in range(rounds):
            chance = [1 / (1 + math.exp(-s)) for s in raw]
            g = [weight[y] * (p - y) for p, (_, y, _) in zip(chance, rows)]
            h = [weight[y] * p * (1 - p) for p, (_, y, _) in zip(chance, rows)]
            score = lambda own: sum(g[i] for i in own) ** 2 / (sum(h[i] for i in own) + l2)  # noqa: B023, E731

            def best(own):
                found = None
                for f in range(len(rows[0][2])):
                    absent = any(rows[i][2][f] is None for i in own)
                    for side in (False, True) if absent else (False,):
                        for threshold in sorted({rows[i][2][f] for i in own} - {None}):
                            left = [i for i in own if goes_left(rows[i][2][f], threshold, side)]
                            right = [i for i in own if not goes_left(rows[i][2][f], threshold, side)]
                            if min(len(left), len(right)) >= leaf_rows:
                                gain = score(left) + score(right) - score(own)
                                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                                    found = (gain, f, left, right)
                return found

            open_ = [(list(range(len(rows))), best(range(len(rows))))]
            splits = []
            while len(open_) < leaves and any(s for _, s in open_):
                at = max((k for k in range(len(open_)) if open_[k][1]), key=lambda k: open_[k][1][0])
                _, split = open_.pop(at)
                splits.append((split[1], sorted((len(split[2]), len(split[3])))))
                open_ += [(split[2], best(split[2])), (split[3], best(split[3]))]
            for own, _ in open_:
                value = -rate * sum(g[i] for i in own) / (sum(h[i] for i in own) + l2)
                for i in own:
                    raw[i] += value
            self.trees.append((splits, len(open_)))
        self.raw = raw


@pytest.mark.parametrize("missing", [0.0, 0.15])
def test_every_split_is_the_best(spark, monkeypatch, missing):
    rows = table(400, 4, 7 + int(missing > 0), missing)
    settings = {"rounds": 5, "rate": 0.3, "leaves": 8, "leaf_rows": 12, "l2": 0.1}
    monkeypatch.setattr(boosting, "BLOCK_BYTES", 4 * 50)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = boosting.fit_boosted_trees(df, **settings, refresh=2)
    brute = Brute(rows, **settings)
    for tree, (splits, leaves) in zip(model.trees, brute.trees):
        used = [f for f in tree.feature if f >= 0]
        assert sorted(used) == sorted(f for f, _ in splits)
        assert tree.feature.count(-1) == leaves <= 8
    found = {r["ordinal"]: r["probability"] for r in boosting.predict_boosted(model, df).collect()}
    for (k, _, _), raw in zip(rows, brute.raw):
        assert math.isclose(found[k], 1 / (1 + math.exp(-raw)), abs_tol=1e-6)


def test_layout_changes_nothing_and_subtraction_is_exact(spark):
    rows = spark.createDataFrame(table(600, 3, 3, 0.1, values=1000), SCHEMA)
    settings = {"rounds": 3, "leaf_rows": 20, "rate": 0.2}
    one = boosting.fit_boosted_trees(rows.coalesce(1), **settings)
    many = boosting.fit_boosted_trees(rows.repartition(7).orderBy("window"), **settings)
    assert one.trees == many.trees and all((a == b).all() for a, b in zip(one.edges, many.edges))


def test_a_tree_takes_few_passes(spark, monkeypatch):
    passes = []
    plain = boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda *a: passes.append(len(a[3])) or plain(*a))
    rows = spark.createDataFrame(table(1500, 6, 5, values=500), SCHEMA)
    model = boosting.fit_boosted_trees(rows, rounds=1, leaf_rows=5)
    assert model.trees[0].feature.count(-1) == 31
    assert len(passes) <= 15 and sum(passes) <= 62  # split by split it would take 31


def test_learns(spark):
    rows = spark.createDataFrame(table(2400, 4, 11), SCHEMA)
    model = boosting.fit_boosted_trees(rows.where("ordinal % 3 != 0"), rounds=15, rate=0.2)
    held = boosting.predict_boosted(model, rows.where("ordinal % 3 = 0")).collect()
    assert sum(r["prediction"] == r["target_value"] for r in held) / len(held) > 0.75


def test_edges():
    assert boosting.edges_of(np.array([3.0, 1, np.nan, 1, 2]), 255).tolist() == [1.5, 2.5]
    assert boosting.edges_of(np.array([np.nan]), 255).tolist() == []
    assert boosting.edges_of(np.array([-np.inf, 0, np.inf]), 255).tolist() == [-np.inf, 0]
    many = np.random.default_rng(0).standard_normal(10_000)
    edges = boosting.edges_of(many, 16)
    shares = np.bincount(np.searchsorted(edges, many), minlength=16)
    assert len(edges) == 15 and shares.min() > 600 and shares.max() < 650
    assert len(boosting.edges_of(np.concatenate([np.zeros(9000), many[:1000]]), 16)) <= 15


def test_odd_rows(spark):
    rows = table(80, 2, 1)
    odd = [(900, 1, None), (901, 0, [1.0]), (902, None, [1.0, 2.0]), (903, 5, [1.0, 2.0]), (904, 1, []), (905, 1, [None, float("nan")]), (906, 0, [float("inf"), -float("inf")])]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumn("features", df_name()).withColumn("weight", df_name())
    model = boosting.fit_boosted_trees(df, rounds=2, leaf_rows=5)
    found = {r["ordinal"]: r for r in boosting.predict_boosted(model, df).collect()}
    assert len(found) == len(rows) + len(odd)
    assert all(found[k]["prediction"] is None and found[k]["probability"] is None for k in (900, 901, 904))
    assert all(0 < found[k]["probability"] < 1 for k in (902, 903, 905, 906))
    for none in (df.limit(0), df.where("target_value = 1")):
        empty = boosting.fit_boosted_trees(none)
        assert empty.trees == [] and boosting.predict_boosted(empty, df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        boosting.fit_boosted_trees(df, bins=256)


def df_name():
    from pyspark.sql import functions as F

    return F.lit("another column")
