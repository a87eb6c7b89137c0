"""Resumable ingest: records are fetched as a manifest states them, and count once their proof is written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemill.operators.lineage import resume_plan
from wavemill.sources.scratch import exists, file_system

PROOF = "record_id string, path string, size_bytes bigint, sha256 string, commit string"
DATA = "record_id string, path string, content binary, commit string"


def proven_files(spark: SparkSession, target: str) -> DataFrame:
    """Files whose record is proven: record_id, path, size_bytes, sha256, commit; none if nothing was ingested yet."""
    path = f"{target}/proof"
    return spark.read.schema(PROOF).parquet(path) if exists(spark, path) else spark.createDataFrame([], PROOF)


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """Contents of proven records: record_id, path, content, commit. What a killed run left without proof isn't among them: only
    folders of commits with proofs are read."""
    proof = proven_files(spark, target).select("commit", "record_id", "path")
    folders = [f"{target}/data/commit={r['commit']}" for r in proof.select("commit").distinct().collect()]
    if not folders:
        return spark.createDataFrame([], DATA)
    data = spark.read.schema(DATA).option("basePath", f"{target}/data").parquet(*folders)
    return data.join(proof, ["commit", "record_id", "path"], "left_semi").select("record_id", "path", "content", "commit")


def ingest(manifest: DataFrame, contents: DataFrame, target: str, batches: int = 1) -> DataFrame:
    """Fetch what is missing: (record_id, path, action) of the plan before, reuse, fetch or drifted.

    ``manifest`` has record_id, path, size_bytes and sha256, ``contents`` path and content (binary), read only for the records that
    the plan fetches. A record is fetched if none of its files is proven; one that is proven but differs from the manifest
    has drifted, is reported and left alone, as are its files.

    Each of ``batches`` parts of the records is a commit of two writes: first the contents, in a folder of the commit, and then,
    after these were read back and digested again, the proof of the records of which every file is there once with the stated
    size and digest. A commit has a file for each task, with all the task's records, so that the driver, which lists a commit's
    files, needs no memory for records. A run that is killed, at any place, leaves either a whole proof or
    none, since Spark's writers make files visible only when a job ends; data without proof are never read and don't stop the
    next run, which fetches them again. Only records that are not proven yet are written. Commits differ in their folders, so no run
    touches another's. Null record ids and paths are no files.
    """
    spark = manifest.sparkSession
    manifest = manifest.where("record_id is not null and path is not null").select("record_id", "path", "size_bytes", "sha256").distinct()
    plan = resume_plan(manifest, proven_files(spark, target))
    done = plan.groupBy("record_id").agg(F.count_if(F.col("action") != "fetch").alias("there")).where("there = 0").select("record_id")
    wanted = manifest.join(done, "record_id", "left_semi")
    plan.write.parquet(f"{target}/plans/{(run := uuid.uuid4().hex)}")
    for k in range(batches):
        mine = wanted.where(F.pmod(F.xxhash64("record_id"), F.lit(batches)) == k)
        commit = f"{run}-{k}"
        _commit(mine, contents, target, commit)
    return spark.read.schema(plan.schema).parquet(f"{target}/plans/{run}")


def _commit(wanted: DataFrame, contents: DataFrame, target: str, commit: str) -> None:
    spark, data = wanted.sparkSession, f"{target}/data/commit={commit}"
    found = wanted.select("record_id", "path").join(contents.where("path is not null").select("path", "content"), "path")
    found.select("record_id", "path", "content").write.parquet(data)
    there = spark.read.schema("record_id string, path string, content binary").parquet(data)
    seen = there.select("path", F.octet_length("content").cast("long").alias("size"), F.sha2("content", 256).alias("digest"))
    seen = seen.groupBy("path").agg(F.count(F.lit(1)).alias("times"), F.min("size").alias("size"), F.min("digest").alias("digest"))
    fine = F.coalesce((F.col("times") == 1) & (F.col("size") == F.col("size_bytes")) & (F.col("digest") == F.lower("sha256")), F.lit(False))
    judged = wanted.join(seen, "path", "left").withColumn("fine", fine)
    bad = judged.where(~F.col("fine")).select("record_id").distinct()
    proof = judged.join(bad, "record_id", "left_anti").select("record_id", "path", "size_bytes", "sha256")
    proof.write.parquet(f"{target}/proof/commit={commit}")


def sweep(spark: SparkSession, target: str) -> list[str]:
    """Delete the data of commits without proof, and name them; for when no run is at work."""
    files, folder = file_system(spark, f"{target}/data")
    if not files.exists(folder):
        return []
    left = [name for status in files.listStatus(folder) if (name := status.getPath().getName()).startswith("commit=") and not exists(spark, f"{target}/proof/{name}/_SUCCESS")]
    for name in left:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name), True)
    return left
