"""Small cases with exact expected values."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavemill.functions import scalars
from wavemill.operators import annotate, experiments, lineage, metrics, model, quality, split, windowing
from wavemill.operators.split import SplitConfig, partition_sizes

MAPPING = "symbol string, target_name string, target_value int, excluded boolean"
MARKS = "record_id string, ordinal bigint, sample_index bigint, symbol string"


def record(spark, n=12, rate=2.0):
    rows = [("100", rate, n, ["MLII", "V5"], ["mV", "mV"])]
    records = spark.createDataFrame(rows, "record_id string, sample_rate_hz double, sample_count bigint, channel_names array<string>, units array<string>")
    samples = [("100", c, k, float(base + k)) for c, base in (("MLII", 0), ("V5", 100)) for k in range(n)]
    return records, windowing.chunk_signal(spark.createDataFrame(samples, "record_id string, channel_name string, sample_index bigint, value double"), 8)


def mapping(spark, more=()):
    return spark.createDataFrame([("N", "normal", 0, False), ("V", "other", 1, False), ("A", "other", 1, False), ("!", None, None, True), *more], MAPPING)


def marks(spark, places):
    return spark.createDataFrame([("100", k, at, s) for k, (at, s) in enumerate(places)], MARKS)


CONFIG = windowing.WindowConfig(2.0, 2.0, channel_index=0)


def test_windows_and_report(spark):
    records, chunks = record(spark)
    mapped = annotate.map_annotations(marks(spark, [(2, "N"), (4, "V"), (6, "N"), (10, "V")]), mapping(spark))
    rows = windowing.extract_windows(mapped, chunks, records, CONFIG, 8).orderBy("ordinal").collect()
    assert [(r.center_sample_index, r.target_value, r.window) for r in rows] == [(4, 1, [float(x) for x in range(8)]), (6, 0, [float(x) for x in range(2, 10)])]
    report = windowing.extraction_report(mapped, records, CONFIG).first()
    assert (report.n_emitted, report.n_left, report.n_right, report.n_overlaps, report.class_0, report.class_1) == (2, 1, 1, 1, 1, 1)


def test_no_window_still_reports(spark):
    records, chunks = record(spark)
    mapped = annotate.map_annotations(marks(spark, [(1, "N"), (11, "V")]), mapping(spark))
    assert windowing.extract_windows(mapped, chunks, records, CONFIG, 8).count() == 0
    report = windowing.extraction_report(mapped, records, CONFIG).first()
    assert (report.n_emitted, report.n_left, report.n_right) == (0, 1, 1)


def test_named_channel_and_missing_channel(spark):
    records, chunks = record(spark)
    mapped = annotate.map_annotations(marks(spark, [(4, "V")]), mapping(spark))
    found = windowing.extract_windows(mapped, chunks, records, windowing.WindowConfig(2.0, 2.0, channel_name="V5"), 8).first()
    assert found.window == [float(100 + x) for x in range(8)]
    assert windowing.resolve_channel(records, windowing.WindowConfig(1, 1, channel_name="X")).first().message == "no channel X; available: MLII, V5"
    assert windowing.window_geometry(records, windowing.WindowConfig(0.3, 1.0)).first().pre is None


@pytest.mark.parametrize("size", [8, 16, 64])
def test_chunk_size_does_not_matter(spark, size):
    samples = spark.createDataFrame([("r", "c", k, float(k * k % 17)) for k in range(100)], "record_id string, channel_name string, sample_index bigint, value double")
    records = spark.createDataFrame([("r", 1.0, 100, ["c"], ["u"])], "record_id string, sample_rate_hz double, sample_count bigint, channel_names array<string>, units array<string>")
    annotations = spark.createDataFrame([("r", k, k, "N") for k in range(0, 100, 3)], MARKS)
    rows = windowing.extract_windows(annotate.map_annotations(annotations, mapping(spark)), windowing.chunk_signal(samples, size), records, windowing.WindowConfig(3, 4), size)
    got = {r.ordinal: r.window for r in rows.collect()}
    assert got == {k: [float(x * x % 17) for x in range(k - 3, k + 4)] for k in range(0, 100, 3) if k >= 3 and k + 4 <= 100}


def test_exclusions_and_unknown_symbols(spark):
    rows = marks(spark, [(2, "N"), (4, "V"), (6, "!"), (8, "A")])
    kept = annotate.map_annotations(rows, mapping(spark)).orderBy("sample_index").collect()
    assert [(r.sample_index, r.target_value) for r in kept] == [(2, 0), (4, 1), (8, 1)]
    assert annotate.mapping_totals(rows, mapping(spark)).first().asDict() == {"input": 4, "included": 3, "excluded": 1, "unknown": 0}
    strange = annotate.unknown_symbols(marks(spark, [(2, "?"), (3, "?")]), mapping(spark))
    assert [tuple(r) for r in strange.collect()] == [("?", 2)]
    with pytest.raises(quality.QualityError):
        quality.enforce(strange.select(F.lit("unknown_symbol").alias("check"), F.lit(None).cast("string").alias("partition"), F.lit("error").alias("severity"), F.col("symbol").alias("message")))


@pytest.mark.parametrize(("n", "sizes"), [(45, [31, 7, 7]), (150, [105, 23, 22]), (75, [53, 11, 11]), (20, [14, 3, 3]), (10, [7, 2, 1]), (3, [1, 1, 1])])
def test_apportionment(n, sizes):
    assert partition_sizes(n, (0.7, 0.15, 0.15)) == sizes


@settings(max_examples=100, deadline=None)
@given(st.integers(3, 5000), st.integers(1, 98), st.integers(1, 98))
def test_apportionment_is_whole(n, a, b):
    total = a + b + 1
    sizes = partition_sizes(n, (a / total, b / total, 1 / total))
    assert sum(sizes) == n and min(sizes) >= 1


@settings(max_examples=60, deadline=None)
@given(st.integers(3, 400))
def test_apportionment_by_its_definition(n):
    """Of all ways to fill three partitions, the one that is nearest to the quotas in its largest gap and then earliest."""
    ratios = (Fraction(7, 10), Fraction(3, 20), Fraction(3, 20))
    quotas = [n * r for r in ratios]
    sizes = partition_sizes(n, (0.7, 0.15, 0.15))
    assert sum(sizes) == n and all(abs(s - q) < 1 or s == 1 for s, q in zip(sizes, quotas, strict=True) if n >= 20)
    best = min(sum((s - q) ** 2 for s, q in zip((a, b, n - a - b), quotas, strict=True)) for a in range(1, n - 1) for b in range(1, n - a))
    assert sum((s - q) ** 2 for s, q in zip(sizes, quotas, strict=True)) == best


def test_too_few_subjects():
    with pytest.raises(ValueError, match="partitions"):
        partition_sizes(2, (0.7, 0.15, 0.15))


def test_subjects_stay_together(spark):
    subjects = spark.createDataFrame([("100", "a"), ("101", "a"), ("102", "b"), ("103", "c")], "record_id string, subject_id string")
    windows = spark.createDataFrame([(r, t) for r in ("100", "101", "102", "103") for t in (0, 1)], "record_id string, target_value int")
    for build in (split.split_subjects, split.split_subjects_shuffled):
        parts = {r.subject_id: r.partition for r in build(subjects, SplitConfig((0.5, 0.25, 0.25), 42)).collect()}
        assert sorted(parts.values()) == ["test", "train", "validation"]
    members = split.grouped_split(windows, subjects, SplitConfig((0.5, 0.25, 0.25), 42)).cache()
    assert split.leakage(members, "subject_id").count() == 0 and members.count() == 4
    summary = split.partition_summary(windows, members).collect()
    assert sum(r.windows for r in summary) == 8 and all(r.class_0 and r.class_1 for r in summary)
    again = split.grouped_split(windows.repartition(7), subjects.repartition(5), SplitConfig((0.5, 0.25, 0.25), 42))
    assert set(map(tuple, again.collect())) == set(map(tuple, members.collect()))


def test_shuffled_order_is_pythons(spark):
    names = [f"s{k}" for k in range(40)]
    found = split.split_subjects_shuffled(spark.createDataFrame([(x,) for x in names], "subject_id string").repartition(5), SplitConfig(seed=7))
    order = sorted(names)
    random.Random(7).shuffle(order)
    assert {r.subject_id: r.partition for r in found.collect()} == {x: p for x, p in zip(order, ["train"] * 28 + ["validation"] * 6 + ["test"] * 6, strict=True)}
    with pytest.raises(ValueError, match="split_subjects"):
        split.split_subjects_shuffled(found, SplitConfig(), most=39)


def test_subjects_must_cover_records_exactly(spark):
    rows = spark.createDataFrame([("1", 0), ("1", 1), ("2", 0)], "record_id string, x int")
    known = lambda *ids: spark.createDataFrame([(i, f"s{i}") for i in ids], "record_id string, subject_id string")
    assert split.attach_subjects(rows, known("1", "2")).count() == 3
    with pytest.raises(Exception, match="no subject for record 2"):
        split.attach_subjects(rows, known("1")).collect()
    with pytest.raises(Exception, match="first is 3"):
        split.attach_subjects(rows, known("1", "2", "3")).collect()


def test_shards_and_members_must_agree(spark):
    shards = spark.createDataFrame([("1", 5), ("2", 6)], "record_id string, window_count int")
    members = lambda *ids: spark.createDataFrame([(i, "s", "train") for i in ids], "record_id string, subject_id string, partition string")
    assert lineage.build_dataset_index(shards, members("1", "2")).columns == ["record_id", "subject_id", "partition", "window_count"]
    for ids, message in ((("1",), "no partition for the shard of record 2"), (("1", "2", "3"), "no shard of record 3"), (("1", "2", "2"), "several shards of record 2")):
        with pytest.raises(Exception, match=message):
            lineage.build_dataset_index(shards, members(*ids)).collect()


def test_run_manifest_refuses_repeats(spark):
    files = spark.createDataFrame([("a", 1, "00"), ("b", 2, "11"), ("c", 3, "22")], "path string, size_bytes bigint, sha256 string")
    roles = spark.createDataFrame([("a", "config"), ("b", "evidence")], "path string, role string")
    run = "00000000-0000-4000-8000-000000000009"
    found = lineage.run_manifest(files, roles, run)
    assert sorted(tuple(r) for r in found.collect()) == [(run, "config", "a", 1, "00"), (run, "evidence", "b", 2, "11")]
    sums = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in ("config|a|1|00", "evidence|b|2|11")]
    assert tuple(lineage.manifest_digest(found).first()) == (run, 2, 3, sum(sums))
    for bad_files, bad_roles in ((files.unionByName(files.limit(1)), roles), (files, roles.unionByName(roles.limit(1)))):
        with pytest.raises(Exception, match="listed twice"):
            lineage.run_manifest(bad_files, bad_roles, run).collect()
    with pytest.raises(ValueError, match="UUID"):
        lineage.run_manifest(files, roles, "run-1")


def test_evaluation_proves_what_it_reads(spark):
    rows = spark.createDataFrame([("1", "validation", 0, [0.0, 0.0]), ("1", "validation", 1, [9.0, 9.0]), ("2", "train", 0, [0.0, 0.0])], "record_id string, partition string, target_value int, window array<double>")
    index = spark.createDataFrame([("1", 2)], "record_id string, window_count bigint")
    files = spark.createDataFrame([("model", "m", 1, "00")], "role string, path string, size_bytes bigint, sha256 string")
    assert model.evaluate(rows, fitted(), index, files, files, [0, 1]).first().accuracy == 1
    with pytest.raises(Exception, match="not as recorded: model m"):
        model.evaluate(rows, fitted(), index, files, files.withColumn("sha256", F.lit("11")), [0, 1]).collect()
    with pytest.raises(Exception, match="record 1"):
        model.evaluate(rows, fitted(), index.withColumn("window_count", F.lit(3)), files, files, [0, 1]).collect()
    with pytest.raises(PermissionError):
        model.evaluate(rows, fitted(), index, files, files, [0, 1], partition="test")


def test_forest_and_boosting_learn(spark):
    rows = [(k, [float(k % 7), float(k % 2) * 10 + k % 3], k % 2) for k in range(120)]
    table = spark.createDataFrame(rows, "ordinal int, window array<double>, target_value int")
    for fit in (lambda t: model.fit_forest(t, depth=4, trees=5), lambda t: model.fit_gbt(t, rounds=3, depth=3)):
        found = model.predict(fit(table), table)
        assert found.where("label = prediction").count() == 120
    sweep = model.depth_sweep(table, table, [1, 3], trees=4).orderBy("depth").collect()
    assert [r.depth for r in sweep] == [1, 3] and sweep[1].train_accuracy == 1 and all(r.gap == 0 for r in sweep)


@pytest.mark.parametrize(("text", "paths"), [("a /home/x/y) b", ["/home/x/y"]), ('p="/Users/me/d.csv"', ["/Users/me/d.csv"]), ("x/home/user", []), ("C:\\data\\x (D:\\y)", ["C:\\data\\x", "D:\\y"]), ("abC:\\d", []), ("/home/", [])])
def test_local_paths(spark, text, paths):
    assert spark.createDataFrame([(text,)], "t string").select(scalars.local_paths(F.col("t"))).first()[0] == paths


@pytest.mark.parametrize(("name", "good"), [("a", True), ("a-b_c.9", True), ("", False), ("../evil", False), ("a/b", False), ("..", False), (".hidden", False), ("trailing-", False), ("a ", False)])
def test_candidate_names(spark, name, good):
    assert spark.createDataFrame([(name,)], "t string").select(scalars.matches(F.col("t"), scalars.CANDIDATE)).first()[0] is good


def test_severities(spark):
    assignment = spark.createDataFrame([("1", "a", "train"), ("2", "b", "validation"), ("3", "c", "test")], "record_id string, subject_id string, partition string")
    windows = spark.createDataFrame([(r, t) for r in "123" for t in (0, 1)], "record_id string, target_value int")
    config = quality.SplitQualityConfig(minimum_subjects=2, required_classes=(0, 1, 2), required_partitions=("validation", "test"), maximum_deviation=1.0)
    found = quality.split_quality(windows, assignment, config)
    assert {r.check for r in found.collect()} == {"minimum_subjects", "required_class_coverage"}
    assert quality.quality_status(found).first().status == "failed"
    warned = quality.split_quality(windows, assignment, quality.SplitQualityConfig(**{**config.__dict__, "warn_only": ("minimum_subjects", "required_class_coverage")}))
    assert quality.quality_status(warned).first().status == "warning"
    quality.enforce(warned)
    placed = assignment.unionByName(spark.createDataFrame([("1", "a", "test")], assignment.schema))
    assert [(r.subject_id, r.partitions) for r in split.leakage(placed, "subject_id").collect()] == [("a", ["test", "train"])]


def fitted():
    return model.CentroidModel(np.eye(2), [0, 1], np.array([[0.0, 0.0], [10.0, 10.0]]))


def test_nearest_centroid_scores(spark):
    rows = [(0, [0.0, 0.0]), (1, [10.0, 10.0]), (1, [1.0, 1.0]), (0, [0.0, 0.0])]
    scored = model.score(spark.createDataFrame(rows, "target_value int, window array<double>"), fitted())
    confusion = metrics.confusion_matrix(scored.select(F.col("target_value").alias("label"), "prediction"), [0, 1])
    assert {(r.label, r.prediction): r.n for r in confusion.collect()} == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}
    by_class = {r.label: (r.precision, r.recall, r.f1) for r in metrics.class_metrics(confusion).collect()}
    assert by_class[0] == pytest.approx((2 / 3, 1, 0.8)) and by_class[1] == pytest.approx((1, 0.5, 2 / 3))
    assert metrics.overall_metrics(confusion).first().accuracy == 0.75


def test_ties_go_to_the_lowest_class_and_bad_rows_have_no_score(spark):
    rows = spark.createDataFrame([(0, [5.0, 5.0]), (0, [1.0]), (0, None)], "target_value int, window array<double>")
    got = [(r.prediction, r.margin) for r in model.score(rows, fitted()).collect()]
    assert got == [(0, 0.0), (None, None), (None, None)]
    assert model.incompatible_rows(rows, fitted()).count() == 2


def test_zero_division(spark):
    preds = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    rows = {r.label: r for r in metrics.class_metrics(metrics.confusion_matrix(preds, [0, 1])).collect()}
    assert (rows[1].precision, rows[1].recall, rows[1].f1, rows[1].support) == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="zero_division"):
        metrics.class_metrics(preds, 0.5)


def test_threshold_sweep(spark):
    rows = spark.createDataFrame([(0, 0, 0.0), (0, 1, 0.5), (1, 1, 1.0), (1, 0, 1.5)], "label int, prediction int, margin double")
    got = {r.threshold: r for r in metrics.threshold_sweep(rows, [0.0, 1.0, 2.0], [0, 1], 1.0).collect()}
    assert (got[0.0].covered, got[0.0].macro_f1) == (4, 0.5)
    assert (got[2.0].covered, got[2.0].macro_precision, got[2.0].macro_recall, got[2.0].macro_f1) == (0, 1, 1, 1)
    zero = {r.threshold: r for r in metrics.threshold_sweep(rows, [1.0], [0, 1]).collect()}
    assert (zero[1.0].covered, zero[1.0].macro_precision, zero[1.0].macro_recall) == (2, 0.5, 0.25) and zero[1.0].macro_f1 == pytest.approx(1 / 3)


def cells(spark, matrix):
    return spark.createDataFrame([(a, b, matrix[a][b]) for a in (0, 1) for b in (0, 1)], "label int, prediction int, n bigint")


def test_published_matrices(spark):
    r = metrics.overall_metrics(cells(spark, [[6609, 9121], [99, 716]])).first()
    assert [round(x, 10) for x in (r.accuracy, r.macro_precision, r.macro_recall, r.macro_f1)] == [0.4427319432, 0.5290139607, 0.6493400910, 0.3617623923]
    confusion = cells(spark, [[7473, 17], [497, 2923]])
    by_class = {r.label: r for r in metrics.class_metrics(confusion).collect()}
    rates = metrics.binary_rates(confusion).first()
    assert [round(x, 3) for x in (metrics.overall_metrics(confusion).first().accuracy, by_class[1].recall, by_class[1].precision, by_class[1].f1, rates.fpr, rates.fnr)] == [0.953, 0.855, 0.994, 0.919, 0.002, 0.145]


def test_candidates(spark):
    rows = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.9), ("c", 3, 0.7), ("d", 4, None)], "candidate_id string, ordinal int, metric double")
    order = lambda **k: [r.candidate_id for r in experiments.rank_candidates(rows, **k).orderBy("place").collect()]
    assert order() == ["b", "c", "a", "d"] and order(higher_is_better=False) == ["a", "c", "b", "d"]
    assert order(higher_is_better=False, missing_last=False) == ["d", "a", "c", "b"]


@pytest.mark.parametrize("metrics", [[1e300] + [k % 50 / 7 for k in range(999)], [math.inf, -math.inf, math.nan, None, *(math.sin(k) for k in range(996))], [0.5] * 1000])
@pytest.mark.parametrize("higher", [True, False])
def test_ranks_are_spread_over_tasks(spark, monkeypatch, metrics, higher):
    ranked = []
    plain = experiments.written
    monkeypatch.setattr(experiments, "written", lambda *a: ranked.append(plain(*a)) or ranked[-1])
    rows = spark.createDataFrame([(k, m) for k, m in enumerate(metrics)], "ordinal int, metric double").withColumns({"rank": F.lit("x"), "part": F.lit(1)}).repartition(3)
    got = experiments.rank_candidates(rows, higher_is_better=higher).orderBy("place").collect()
    absent = lambda m: m is None or math.isnan(m)
    order = sorted(range(1000), key=lambda k: (absent(metrics[k]), 0 if absent(metrics[k]) else -metrics[k] if higher else metrics[k], k))
    assert [r["ordinal"] for r in got] == order and [r["place"] for r in got] == list(range(1, 1001))
    assert max(r["count"] for r in ranked[0].groupBy("part").count().collect()) < 500


def test_window_rules(spark):
    rows = [("a", 0, 5, [1.0]), ("a", 1, 4, [1.0]), ("b", 0, 1, [math.nan]), ("c", 0, -1, [1.0, 2.0]), ("c", 1, 3, [1.0])]
    got = {r.record_id: r for r in quality.validate_windows(spark.createDataFrame(rows, "record_id string, ordinal int, center_sample_index bigint, window array<double>")).collect()}
    assert not got["a"].centres_ordered and not got["b"].finite and not got["c"].centres_valid and not got["c"].equal_width


def test_gate(spark):
    rows = spark.createDataFrame([(1, "test"), (2, "train")], "id int, partition string")
    approvals = spark.createDataFrame([("run-1", "me")], "run_id string, owner string")
    assert lineage.gated_partition(rows, approvals, "run-1").count() == 1
    assert lineage.gated_partition(rows, approvals, "run-2").count() == 0
    with pytest.raises(PermissionError):
        lineage.read_partition(rows, "test")
