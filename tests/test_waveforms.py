"""Plans and edge cases of windows, ordered rows, window tables and ingest."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_golden import MARKS, mapping
from wavemill.operators import annotate, lineage, metrics, model, ordered, windowing
from wavemill.sources import ingest, window_table

SAMPLES = "record_id string, channel_name string, sample_index bigint, value double"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def records(spark, sizes, rate=1.0):
    rows = [(r, rate, n, ["x"], ["u"]) for r, n in sizes.items()]
    return spark.createDataFrame(rows, "record_id string, sample_rate_hz double, sample_count bigint, channel_names array<string>, units array<string>")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("chunk_size, pre, post", [(4, 9, 13), (7, 3, 2), (64, 5, 5), (5, 1, 12)])
def test_windows_like_slices_with_gaps_between_chunks(spark, chunk_size, pre, post):
    draw = random.Random(chunk_size)
    sizes = {"a": 90, "b": 31}
    gone = {("a", k) for c in (3, 11) for k in range(c * chunk_size, c * chunk_size + chunk_size)} | {("b", k) for k in range(4 * chunk_size - 2, 4 * chunk_size)}
    signal = {(r, k): draw.random() for r, n in sizes.items() for k in range(n) if (r, k) not in gone}
    chunks = windowing.chunk_signal(spark.createDataFrame([(r, "x", k, v) for (r, k), v in signal.items()], SAMPLES), chunk_size)
    places = [(r, k, k, draw.choice("NV")) for r, n in sizes.items() for k in range(n)]
    mapped = annotate.map_annotations(spark.createDataFrame(places, MARKS), mapping(spark))
    got = windowing.extract_windows(mapped, chunks, records(spark, sizes), windowing.WindowConfig(pre, post, "x"), chunk_size)
    want = {(r, k): [signal[r, x] for x in range(k - pre, k + post)] for r, n in sizes.items() for k in range(n) if k - pre >= 0 and k + post <= n and all((r, x) in signal for x in range(k - pre, k + post))}
    assert {(r.record_id, r.ordinal): r.window for r in got.collect()} == want
    scanned = chunks.drop("n_samples")
    assert windowing.extract_windows(mapped, scanned, records(spark, sizes), windowing.WindowConfig(pre, post, "x"), chunk_size).count() == len(want)


def test_samples_are_exchanged_once_and_windows_never(spark, no_broadcast, tmp_path):
    rows = spark.createDataFrame([("a", "x", k, float(k)) for k in range(100)], SAMPLES)
    windowing.chunk_signal(rows, 16).write.parquet(str(tmp_path / "c"))
    chunks = spark.read.parquet(str(tmp_path / "c"))
    mapped = annotate.map_annotations(spark.createDataFrame([("a", k, k, "N") for k in range(100)], MARKS), mapping(spark))
    found = windowing.extract_windows(mapped, chunks, records(spark, {"a": 100}), windowing.WindowConfig(5, 5, "x"), 16)
    plan = plan_of(found)
    top = plan[: plan.index("SortMergeJoin [record_id")]
    assert "Exchange" not in top and "slice" in top
    assert len(re.findall(r"Exchange hashpartitioning\(record_id#\d+, channel_name#\d+, chunk_id#\d+L", plan)) == 2  # the samples, and the annotations
    assert "samples" in re.findall(r"FileScan parquet.*", plan)[0]
    counted = plan_of(found.groupBy("record_id", "target_value").count())
    scan = re.findall(r"ReadSchema: \S+", counted)
    assert scan and not any(",samples:" in x for x in scan)


def test_holes_in_a_chunk_are_refused(spark):
    for places in ([0, 1, 3], [0, 1, 1, 2]):
        with pytest.raises(Exception, match="missing or repeated"):
            windowing.chunk_signal(spark.createDataFrame([("a", "x", k, 1.0) for k in places], SAMPLES), 8).collect()


@pytest.mark.parametrize("segment", [1, 3, 64, 100_000])
def test_the_row_before_is_found_across_segments(spark, segment):
    draw = random.Random(segment)
    rows = [("hot", k, draw.random()) for k in draw.sample(range(5000), 900)] + [(f"r{k % 17}", k, draw.random()) for k in range(100)] + [(None, 5, 1.0), (None, 900, 2.0), ("n", None, 3.0), ("n", 1, None), ("n", 2, 4.0), ("n", -3, 5.0)]
    frame = spark.createDataFrame(rows, "record_id string, ordinal bigint, value double")
    got = {(r.record_id, r.ordinal): r.before for r in ordered.with_previous(frame, "record_id", "ordinal", {"before": "value"}, segment).collect()}
    want, last = {}, {}
    for r, k, v in sorted(rows, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0)):
        want[r, k] = last.get(r)
        last[r] = v
    assert got == want


def test_a_long_record_is_spread_over_tasks(spark, no_broadcast):
    rows = spark.range(100_000).select(F.when(F.col("id") < 90_000, "hot").otherwise(F.col("id").cast("string")).alias("record_id"), "id")
    found = ordered.with_previous(rows, "record_id", "id", {"before": "id"}, segment=1000)
    by_task = found.groupBy(F.spark_partition_id().alias("task")).agg(F.count_if(F.col("record_id") == "hot").alias("n")).collect()
    assert max(r.n for r in by_task) < 45_000 and sum(r.n for r in by_task) == 90_000
    assert found.where("before = id - 1").count() == 89_999
    # rows travel once; the other two exchanges are of one row for each segment
    assert len(re.findall(r"Exchange hashpartitioning\(_key#\d+, _segment#\d+L", plan_of(found))) == 3


def test_all_lags_of_a_full_window(spark):
    draw = np.random.default_rng(1)
    windows = [("a", 0, draw.standard_normal(2160).tolist()), ("a", 1, [2.0] * 40), ("b", 0, [1.0, None, 2.0]), ("b", 1, [1.0, float("nan")]), ("b", 2, []), ("b", 3, None), ("c", 0, [1.0, 4.0, 2.0])]
    frame = spark.createDataFrame(windows, "record_id string, ordinal bigint, window array<double>")
    got = {(r.record_id, r.ordinal, r.lag): r.r for r in windowing.autocorrelation(frame, 5000).collect()}
    for name, k, values in windows:
        if not values:
            assert (name, k, 0) not in got
            continue
        if None in values or any(x != x for x in values) or len(set(values)) == 1:
            assert all(got[name, k, h] is None for h in range(len(values)))
            continue
        d = np.array(values) - np.mean(values)
        for h in range(len(values)):
            assert got[name, k, h] == pytest.approx((d[h:] * d[: len(d) - h]).sum() / (d * d).sum(), abs=1e-9)


def test_class_means_merge_whole_vectors(spark):
    rows = spark.range(100).select((F.col("id") % 3).cast("int").alias("target_value"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("projected"))
    found = model.class_mean_vectors(rows)
    assert "Generate" not in plan_of(found)
    assert {r.target_value: r["mean"] for r in found.collect()} == {k: [np.mean(range(k, 100, 3)), 1.0] for k in range(3)}


def test_quantiles_are_exact_and_no_task_holds_a_column(spark):
    draw = random.Random(5)
    rows = [(draw.choice([7.0, draw.random(), -1e300, 1e300, None]), draw.choice([None, 1, 2]), None) for _ in range(999)]
    frame = spark.createDataFrame(rows, "a double, b int, c double").repartition(7)
    shares = (0.0, 0.25, 0.333, 0.5, 0.75, 1.0)
    got = {(r.column, r.share): r.value for r in metrics.exact_quantiles(frame, ["a", "b", "c"], shares).collect()}
    for k, name in enumerate("ab"):
        values = [r[k] for r in rows if r[k] is not None]
        for p in shares:
            assert got[name, p] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert not any(name == "c" for name, _ in got)
    summary = {r.column: r for r in metrics.column_summary(frame, ["a", "c"]).collect()}
    assert summary["c"].n == 0 and summary["c"].p50 is None and summary["a"].p50 == got["a", 0.5]


def test_quantiles_hold_a_range_each(spark, no_broadcast):
    found = spark.range(20_000).select((F.col("id") * 7919 % 20_000).cast("double").alias("x"))
    seen = []
    real = metrics.written
    metrics.written = lambda df, label: seen.append(real(df, label)) or seen[-1]
    try:
        assert metrics.exact_quantiles(found, ["x"], [0.5]).first().value == 9999.5
    finally:
        metrics.written = real
    sizes = [r["count"] for r in seen[0].groupBy("part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000


def saved(spark, tmp_path, rows=400):
    frame = spark.range(rows).select((F.col("id") % 40).cast("string").alias("record_id"), "id", F.array(F.col("id").cast("double")).alias("window"))
    members = spark.range(40).select(F.col("id").cast("string").alias("record_id"), F.col("id").cast("string").alias("subject_id"), F.element_at(F.array(*map(F.lit, ("train", "validation", "test"))), (F.col("id") % 3 + 1).cast("int")).alias("partition"))
    name = f"w{random.getrandbits(60)}"
    return name, window_table.write_window_table(frame, members, name, str(tmp_path / name), buckets=4), members


def test_one_partition_of_a_window_table_is_read(spark, tmp_path):
    name, table, _ = saved(spark, tmp_path)
    rows = window_table.read_window_partition(spark, name, "train")
    assert rows.count() == 14 * 10 and "PartitionFilters: [isnotnull(partition" in plan_of(rows)
    assert {x.split("/")[-2] for x in rows.inputFiles()} == {"partition=train", "partition=validation", "partition=test"} or all("partition=train" in x for x in rows.inputFiles())
    for folder in ("validation", "test"):
        for file in (tmp_path / name / f"partition={folder}").glob("part-*"):
            file.write_bytes(b"not parquet")
    assert sum(r.window[0] for r in window_table.read_window_partition(spark, name, "train").collect()) > 0
    assert len(list((tmp_path / name / "partition=train").glob("part-*"))) <= 4
    with pytest.raises(PermissionError):
        window_table.read_window_partition(spark, name, "test")
    with pytest.raises(Exception, match="already exists"):
        window_table.write_bucketed(table.drop("partition"), name, str(tmp_path / name))


def test_bucketed_tables_join_where_they_lie(spark, tmp_path, no_broadcast):
    _, table, members = saved(spark, tmp_path)
    other = f"m{random.getrandbits(60)}"
    known = window_table.write_bucketed(members.select("record_id", "subject_id"), other, str(tmp_path / other), buckets=4)
    joined = table.select("record_id", "id").join(known, "record_id").groupBy("record_id", "subject_id").count()
    assert "Exchange" not in plan_of(joined) and joined.count() == 40


def files(spark, n, damage=()):
    rows = [(f"r{k // 3}", f"f{k}", bytearray(f"content {k}".encode() * (k % 4))) for k in range(n)]
    manifest = spark.createDataFrame([(r, p, len(c), hashlib.sha256(c).hexdigest()) for r, p, c in rows], "record_id string, path string, size_bytes bigint, sha256 string")
    return manifest, spark.createDataFrame([(p, c + b"!" if p in damage else c) for _, p, c in rows], "path string, content binary")


def state(spark, target):
    return {(r.record_id, r.path): r.commit for r in ingest.proven_files(spark, target).collect()}


def test_a_killed_run_is_resumed_between_records(spark, tmp_path, monkeypatch):
    manifest, contents = files(spark, 30)
    target = str(tmp_path / "t")
    batch = {r.record_id: r.k for r in manifest.select("record_id", F.pmod(F.xxhash64("record_id"), F.lit(4)).alias("k")).distinct().collect()}
    last = max(batch.values())
    real = ingest._commit

    def dying(wanted, contents, target, commit):
        if commit.endswith(f"-{last}"):  # half of it is written, as by a run that is killed
            wanted.select("record_id", "path").join(contents, "path").limit(2).write.partitionBy("record_id").parquet(f"{target}/data/commit={commit}")
            raise RuntimeError("killed")
        real(wanted, contents, target, commit)

    monkeypatch.setattr(ingest, "_commit", dying)
    with pytest.raises(RuntimeError, match="killed"):
        ingest.ingest(manifest, contents, target, batches=4)
    monkeypatch.undo()
    before = state(spark, target)
    assert {r for r, _ in before} == {r for r, k in batch.items() if k < last}
    plan = ingest.ingest(manifest, contents, target, batches=4)
    assert {(r.record_id, r.action) for r in plan.collect()} == {(r, "reuse" if k < last else "fetch") for r, k in batch.items()}
    after = state(spark, target)
    assert len(after) == 30 and all(after[x] == commit for x, commit in before.items())
    assert {r.path: bytes(r.content) for r in ingest.ingested(spark, target).collect()} == {r.path: bytes(r.content) for r in contents.collect()}
    assert {r.action for r in ingest.ingest(manifest, contents, target).collect()} == {"reuse"} and state(spark, target) == after


def test_data_without_proof_count_for_nothing(spark, tmp_path):
    manifest, contents = files(spark, 9)
    target = tmp_path / "t"
    ingest.ingest(manifest, contents, str(target))
    (proof,) = (target / "proof").glob("commit=*")
    for file in [*proof.iterdir()]:  # as if the run had died between its two writes
        file.unlink()
    proof.rmdir()
    assert state(spark, str(target)) == {} and ingest.ingested(spark, str(target)).count() == 0
    ingest.ingest(manifest, contents, str(target))
    assert len(state(spark, str(target))) == 9 and ingest.ingested(spark, str(target)).count() == 9
    assert ingest.sweep(spark, str(target)) == [proof.name] and ingest.ingested(spark, str(target)).count() == 9


def test_a_commit_has_files_by_task_not_by_record(spark, tmp_path):
    manifest, contents = files(spark, 300)
    target = tmp_path / "t"
    ingest.ingest(manifest, contents, str(target), batches=2)
    assert ingest.ingested(spark, str(target)).count() == 300
    written = [x for x in (target / "data").rglob("*") if x.is_dir() or x.suffix == ".parquet"]
    assert len([x for x in written if x.is_dir()]) == 2 and len(written) <= 2 + 2 * 8


def test_damaged_missing_and_drifted_files_are_not_proven(spark, tmp_path):
    manifest, contents = files(spark, 12, damage=("f4",))
    target = str(tmp_path / "t")
    ingest.ingest(manifest, contents.where("path <> 'f7'"), target)
    assert {r for r, _ in state(spark, target)} == {"r0", "r3"}
    twice = contents.unionByName(contents.where("path = 'f8'"))
    ingest.ingest(manifest, twice, target)  # f4 is damaged still, f8 there twice
    assert {r for r, _ in state(spark, target)} == {"r0", "r3"}
    changed = manifest.withColumn("size_bytes", F.when(F.col("path") == "f0", 99).otherwise(F.col("size_bytes")))
    plan = {r.path: r.action for r in ingest.ingest(changed, files(spark, 12)[1], target).collect()}
    assert plan["f0"] == "drifted" and plan["f1"] == "reuse" and plan["f4"] == "fetch"
    assert {r for r, _ in state(spark, target)} == {"r0", "r1", "r2", "r3"}
    empty = str(tmp_path / "none")
    assert ingest.ingest(manifest.limit(0), contents.limit(0), empty).collect() == [] and ingest.ingested(spark, empty).collect() == []


def test_a_role_without_its_file_is_refused(spark):
    run = "00000000-0000-4000-8000-000000000001"
    listed = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "path string, size_bytes bigint, sha256 string")
    roles = spark.createDataFrame([("a", "config"), ("b", "data")], "path string, role string")
    assert sorted(map(tuple, lineage.run_manifest(listed, roles, run).collect())) == [(run, "config", "a", 1, "x"), (run, "data", "b", 2, "y")]
    with pytest.raises(Exception, match="no file: b"):
        lineage.run_manifest(listed.where("path = 'a'"), roles, run).collect()
    assert [r.path for r in lineage.run_manifest(listed, roles.where("path = 'a'"), run).collect()] == ["a"]
    for files, known in ((listed.unionByName(listed.where("path = 'a'")), roles), (listed, roles.unionByName(roles.where("path = 'a'")))):
        with pytest.raises(Exception, match="listed twice: a"):
            lineage.run_manifest(files, known, run).collect()
