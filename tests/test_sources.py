import hashlib
import json
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wavemill.operators.experiments import pending_candidates, write_candidate
from wavemill.operators.lineage import read_partition
from wavemill.sources import tables
from wavemill.streaming.streams import score_stream, stream_symbol_counts

SF = "/root/testdata/sf0.001"


def windows(spark):
    rows = [("1", k, 5 * k, "N", [float(k), 2.0], k % 2, "train") for k in range(4)] + [("2", 0, 7, "N", [9.0, 9.0], 1, "test")]
    return spark.createDataFrame(rows, "record_id string, ordinal int, center_sample_index int, source_symbol string, window array<double>, target_value int, partition string")


def test_window_sink_is_create_only(spark, tmp_path):
    path = str(tmp_path / "w")
    tables.write_windows(windows(spark), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(AnalysisException):
        tables.write_windows(windows(spark), path)


def test_partitions_are_pruned_and_windows_not_read_for_metadata(spark, tmp_path):
    path = str(tmp_path / "p")
    windows(spark).write.partitionBy("partition").parquet(path)
    rows = read_partition(spark.read.parquet(path), "train")
    assert "PartitionFilters: [isnotnull(partition" in rows._jdf.queryExecution().toString()
    plan = tables.scan_window_metadata(spark.read.parquet(path)).groupBy("record_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "window" not in plan.split("ReadSchema")[1]


def test_metadata_of_another_version_or_without_fields_is_refused(spark):
    good = windows(spark).withColumn("schema_version", F.lit(1))
    assert tables.scan_window_metadata(good).count() == 5
    for version in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="schema version"):
            tables.scan_window_metadata(good.withColumn("schema_version", F.when(F.col("record_id") == "2", version).otherwise(1))).collect()
    with pytest.raises(ValueError, match="source_symbol"):
        tables.scan_window_metadata(good.drop("source_symbol"))


def test_protected_files_are_not_touched(spark, tmp_path):
    path = tmp_path / "p"
    windows(spark).write.partitionBy("partition").parquet(str(path))
    for file in (path / "partition=test").glob("*.parquet"):
        file.write_bytes(b"not parquet")
    assert read_partition(spark.read.schema(windows(spark).schema).parquet(str(path)), "train").count() == 4


def test_reports_sort_their_keys(spark, tmp_path):
    rows = spark.createDataFrame([(1, None)], "b int, a string")
    tables.write_report(rows, str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).first()[0] == '{"a":null,"b":1}'


def test_manifest_and_inventory(spark, tmp_path):
    (tmp_path / "one.dat").write_bytes(b"abc")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "two.dat").write_bytes(b"x")
    found = tables.file_inventory(spark, str(tmp_path), "*.dat").collect()
    assert [(r.size_bytes, r.sha256[:8]) for r in found] == [(3, "ba7816bf")]
    assert tables.discover_shards(spark, [str(tmp_path), str(tmp_path / "sub")], "*.dat").count() == 2
    with pytest.raises(Exception, match="named twice"):
        tables.discover_shards(spark, [str(tmp_path), str(tmp_path)], "*.dat").collect()
    (tmp_path / "m.json").write_text(json.dumps({"schema_version": 1, "files": [{"path": "one.dat", "size_bytes": 3, "sha256": "00"}]}, indent=1))
    assert [tuple(r) for r in tables.scan_manifest(spark, str(tmp_path / "m.json")).collect()] == [(1, "one.dat", 3, "00")]


def test_wide_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,2,3,0\n4,5,6,1\n")
    assert [tuple(r) for r in tables.scan_wide_csv(spark, str(tmp_path / "x.csv"), 4).orderBy("target_value").collect()] == [([1.0, 2.0, 3.0], 0), ([4.0, 5.0, 6.0], 1)]


def test_candidate_log(spark, tmp_path):
    path = str(tmp_path / "log")
    write_candidate(spark.createDataFrame([("a", 0.5)], "candidate_id string, metric double"), path)
    write_candidate(spark.createDataFrame([("b", 0.7)], "candidate_id string, metric double"), path)
    every = spark.createDataFrame([("a",), ("b",), ("c",)], "candidate_id string")
    assert [r[0] for r in pending_candidates(every, spark.read.parquet(path)).collect()] == ["c"]


def test_streams(spark, tmp_path):
    from tests.test_golden import fitted

    windows(spark).write.parquet(str(tmp_path / "in"))
    scored = score_stream(spark.readStream.schema(windows(spark).schema).parquet(str(tmp_path / "in")), fitted())
    scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start().awaitTermination(120)
    assert spark.table("scored").where("prediction is not null").count() == 5
    events = spark.read.parquet(f"{SF}/events.parquet").withColumnRenamed("event_type", "symbol")
    events.write.parquet(str(tmp_path / "events"))
    counts = stream_symbol_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")), "1 day")
    counts.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start().awaitTermination(120)
    assert spark.table("counts").agg(F.sum("n")).first()[0] == events.count()


def test_inventory_takes_empty_and_large_files_in_flat_memory(spark, tmp_path):
    folder = tmp_path / "of all sizes"
    folder.mkdir()
    (folder / "none %41+1.dat").touch()
    (folder / "some.dat").write_bytes(b"abc")
    with open(folder / "large é.dat", "wb") as file:
        file.truncate(3 << 30)
    (folder / "other.txt").touch()
    found = {r["path"].rsplit("/", 1)[-1]: r for r in tables.file_inventory(spark, str(folder), "*.dat").collect()}
    zeros = hashlib.sha256()
    for _ in range(3 << 10):
        zeros.update(bytes(1 << 20))
    want = {"none %41+1.dat": (0, hashlib.sha256().hexdigest()), "some.dat": (3, hashlib.sha256(b"abc").hexdigest()), "large é.dat": (3 << 30, zeros.hexdigest())}
    assert {name: (r["size_bytes"], r["sha256"]) for name, r in found.items()} == want
    for name, r in found.items():
        assert abs(r["modified"].timestamp() - (folder / name).stat().st_mtime) < 1
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    assert tables.stream_digest(str(folder / "large é.dat")) == zeros.hexdigest()
    assert tracemalloc.get_traced_memory()[1] < 8 << 20 and pa.total_allocated_bytes() - before < 8 << 20
    tracemalloc.stop()


def test_inventory_of_streamed_files_equals_that_of_rows(spark, tmp_path, monkeypatch):
    for k in range(20):
        (tmp_path / f"{k}.bin").write_bytes(bytes([k]) * (k * 1000))
    rows = lambda: sorted(map(tuple, tables.file_inventory(spark, str(tmp_path), recursive=True).collect()))
    whole = rows()
    monkeypatch.setattr(tables, "STREAMED_BYTES", 5000)
    assert len(whole) == 20 and rows() == whole
