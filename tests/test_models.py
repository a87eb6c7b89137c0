"""The registered models are fitted with the operators' own parameters."""

import inspect
import random

import numpy as np
from pyspark.sql import functions as F

from wavemill.operators import model
from wavemill.plans import catalog

SF = "/root/testdata/sf0.001"


def test_registered_models_are_whole(spark, monkeypatch):
    seen = []

    def noted(fit):
        def call(*args, **named):
            bound = inspect.signature(fit).bind(*args, **named)
            bound.apply_defaults()
            seen.append({k: v for k, v in bound.arguments.items() if k in ("depth", "trees", "rounds", "depths")})

        return call

    sweep = model.depth_sweep
    for name in ("fit_forest", "fit_gbt", "depth_sweep"):
        monkeypatch.setattr(model, name, noted(getattr(model, name)))
    monkeypatch.setattr(model, "predict", lambda fitted, rows, *_: rows.select("ordinal", F.lit(1).alias("label"), F.lit(1).alias("prediction")))
    for name in ("j5_forest", "j6_gradient_boosting", "j7_depth_sweep"):
        catalog.QUERIES[name](spark, SF)
    assert seen == [{"depth": 10, "trees": 20}, {"rounds": 20, "depth": 5}, {"depths": range(2, 21), "trees": 20}]
    rows = spark.createDataFrame([(1,)], "ordinal int")
    sweep(rows, rows, [3], trees=7)
    assert seen[-1] == {"depth": 3, "trees": 7}


def test_a_sweep_is_one_forest_cut_at_each_depth(spark, monkeypatch):
    """With two features MLlib takes both at every node, so that fits at each depth are the same forest, cut."""
    rng = random.Random(4)
    rows = [([rng.random(), rng.random()], k) for k in range(700)]
    rows = [(x, 0 if rng.random() < 0.1 else int(3 * x[0] + x[1]) % 3, k) for x, k in rows]
    frame = spark.createDataFrame(rows, "window array<double>, target_value int, k int")
    train, validation = frame.where("k % 3 > 0").coalesce(1), frame.where("k % 3 = 0")
    accuracy = lambda fitted, part: part.count() and sum(r.label == r.prediction for r in model.predict(fitted, part).collect()) / part.count()
    want = []
    for depth in (2, 3, 5, 9):
        fitted = model.fit_forest(train, depth=depth, trees=7)
        want.append((depth, accuracy(fitted, train), accuracy(fitted, validation)))
    fits, real = [], model.fit_forest
    monkeypatch.setattr(model, "fit_forest", lambda *args, **named: fits.append(1) or real(*args, **named))
    got = [tuple(r)[:3] for r in model.depth_sweep(train, validation, [2, 3, 5, 9], trees=7).collect()]
    assert got == want and len(fits) == 1 and len({x[1] for x in want}) > 2
    none = model.depth_sweep(train, validation.limit(0), [2, 3], trees=3).collect()
    assert [(r.validation_accuracy, r.gap) for r in none] == [(None, None)] * 2


def test_a_cut_forest_predicts_as_the_fitted_one(spark):
    """Where MLlib draws features at each node, the cut at its own depth is still the forest itself."""
    rng = random.Random(5)
    frame = spark.createDataFrame([([rng.random() for _ in range(9)], k % 4) for k in range(400)], "window array<double>, target_value int")
    fitted = model.fit_forest(frame, depth=6, trees=5)
    want = [(r.window, r.prediction) for r in model.predict(fitted, frame).collect()]
    found = list(model.tree_nodes(fitted).predictions(np.array([x for x, _ in want]), [3, 6, 20]))
    assert found[1].tolist() == found[2].tolist() == [p for _, p in want] != found[0].tolist()
