"""File inventories, manifests, shard indexes, and what they prove about a run.

Files are rows (path, size_bytes, sha256).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavemill.functions.scalars import DIGEST, UUID, matches, refuse


def expected_files(ids: DataFrame, extensions: Sequence[str], key: str = "record_id") -> DataFrame:
    """key, extension, path: every id with every extension."""
    rows = ids.select(key).distinct().withColumn("extension", F.explode(F.array(*map(F.lit, extensions))))
    return rows.withColumn("path", F.concat_ws(".", F.col(key).cast("string"), "extension"))


def missing_companions(inventory: DataFrame, ids: DataFrame, extensions: Sequence[str], key: str = "record_id") -> DataFrame:
    return expected_files(ids, extensions, key).join(inventory.select("path"), "path", "left_anti").select(key, "extension", "path")


def manifest_violations(files: DataFrame, version: int = 1) -> DataFrame:
    """path, rule: files with a repeated or blank path, a negative or missing size, a digest that isn't 64 hex digits, or (if the
    manifest has a schema_version) another version."""
    repeated = files.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("path", F.lit("unique_path").alias("rule"))
    rules = F.array_compact(
        F.array(
            F.when(~F.coalesce(F.col("size_bytes") >= 0, F.lit(False)), "size"),
            F.when(~matches(F.col("sha256"), DIGEST), "digest"),
            F.when(~F.coalesce(F.length(F.trim("path")) > 0, F.lit(False)), "path"),
            F.when(~F.col("schema_version").eqNullSafe(F.lit(version)), "schema_version") if "schema_version" in files.columns else F.lit(None).cast("string"),
        )
    )
    return files.select("path", F.explode(rules).alias("rule")).unionByName(repeated)


def inventory_diff(baseline: DataFrame, observed: DataFrame) -> DataFrame:
    """path, status: ok, missing, extra, size or digest."""
    a, b = baseline.alias("a"), observed.alias("b")
    status = (
        F.when(F.col("b.path").isNull(), "missing")
        .when(F.col("a.path").isNull(), "extra")
        .when(~F.col("a.size_bytes").eqNullSafe(F.col("b.size_bytes")), "size")
        .when(~F.col("a.sha256").eqNullSafe(F.col("b.sha256")), "digest")
        .otherwise("ok")
    )
    return a.join(b, F.col("a.path") == F.col("b.path"), "full_outer").select(F.coalesce("a.path", "b.path").alias("path"), status.alias("status"))


def verify_lineage(recorded: DataFrame, observed: DataFrame) -> DataFrame:
    """role, path, ok: whether each recorded file is there with the same size and digest."""
    a, b = recorded.alias("a"), observed.alias("b")
    ok = F.col("b.path").isNotNull() & F.col("a.size_bytes").eqNullSafe(F.col("b.size_bytes")) & F.col("a.sha256").eqNullSafe(F.col("b.sha256"))
    return a.join(b, F.col("a.path") == F.col("b.path"), "left").select("a.role", "a.path", ok.alias("ok"))


def resume_plan(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """record_id, path, action: reuse a file that is as stated, fetch one that isn't there, and report one that drifted."""
    a, b = manifest.alias("a"), inventory.alias("b")
    same = F.col("a.size_bytes").eqNullSafe(F.col("b.size_bytes")) & F.col("a.sha256").eqNullSafe(F.col("b.sha256"))
    action = F.when(F.col("b.path").isNull(), "fetch").when(same, "reuse").otherwise("drifted")
    return a.join(b, F.col("a.path") == F.col("b.path"), "left").select("a.record_id", "a.path", action.alias("action"))


def resume_progress(plan: DataFrame) -> DataFrame:
    n = lambda x: F.count_if(F.col("action") == x).alias(f"n_{x}")
    return plan.groupBy("record_id").agg(n("reuse"), n("fetch"), n("drifted"), F.count(F.lit(1)).alias("files"))


def manifest_identity_check(expected: DataFrame, stated: DataFrame, columns: Sequence[str]) -> DataFrame:
    """ordinal, ok: whether two lists agree place by place, nulls alike; a place that only one has isn't ok."""
    a, b = expected.alias("a"), stated.alias("b")
    ok = F.col("a.ordinal").isNotNull() & F.col("b.ordinal").isNotNull()
    for c in columns:
        ok = ok & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, F.col("a.ordinal") == F.col("b.ordinal"), "full_outer").select(F.coalesce("a.ordinal", "b.ordinal").alias("ordinal"), ok.alias("ok"))


def shard_summary(windows: DataFrame) -> DataFrame:
    """By record: window_count, width, class counts."""
    return windows.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("window_count"), F.max(F.size("window")).alias("width"), F.count_if(F.col("target_value") == 0).alias("class_0"), F.count_if(F.col("target_value") == 1).alias("class_1")
    )


def build_dataset_index(shards: DataFrame, assignment: DataFrame) -> DataFrame:
    """Shards with their partition and subject: partition, subject_id, and the shard's columns.

    Both must have the same records, a shard for each: a shard without membership, or the reverse, fails the job, since
    then they are of different runs. So does a second shard of a record.
    """
    known = assignment.select(F.col("record_id").alias("member"), "subject_id", "partition")
    both = shards.join(known, F.col("record_id") == F.col("member"), "full_outer")
    both = both.where(refuse(F.col("member").isNotNull(), F.concat(F.lit("no partition for the shard of record "), F.col("record_id"))))
    both = both.where(refuse(F.col("record_id").isNotNull(), F.concat(F.lit("no shard of record "), F.col("member"))))
    again = F.count(F.lit(1)).over(Window.partitionBy("record_id"))
    both = both.withColumn("again", again).where(refuse(F.col("again") == 1, F.concat(F.lit("several shards of record "), F.col("record_id"))))
    return both.select("record_id", "subject_id", "partition", *(c for c in shards.columns if c != "record_id"))


def repeated_shards(shards: DataFrame, shard: str = "path") -> DataFrame:
    """Records found in several shards."""
    return shards.groupBy("record_id").agg(F.count_distinct(shard).alias("shards")).where("shards > 1")


def index_summary(index: DataFrame) -> DataFrame:
    """By partition: records, subjects, windows, and class counts of the shards."""
    return index.groupBy("partition").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("subject_id").alias("subjects"), F.sum("window_count").alias("windows"), F.sum("class_0").alias("class_0"), F.sum("class_1").alias("class_1")
    )


def missing_files(index: DataFrame, inventory: DataFrame) -> DataFrame:
    """Paths that one side has and the other lacks: path, missing_from (index or inventory)."""
    a, b = index.select("path"), inventory.select("path")
    return a.join(b, "path", "left_anti").select("path", F.lit("inventory").alias("missing_from")).unionByName(b.join(a, "path", "left_anti").select("path", F.lit("index").alias("missing_from")))


def run_manifest(files: DataFrame, roles: DataFrame, run_id: str) -> DataFrame:
    """run_id, role, path, size_bytes, sha256 of the files that have a role in the run; other files of the inventory are none of
    it. A role without its file, or a path that is listed twice, in the files or in the roles, fails the job; a run id must be a UUID."""
    if not re.fullmatch(UUID, run_id):
        raise ValueError("a run id must be a UUID")
    known = roles.select(F.col("path").alias("listed"), "role")
    rows = files.select("path", "size_bytes", "sha256", F.lit(True).alias("there")).join(known, F.col("path") == F.col("listed"), "right")
    rows = rows.where(refuse(F.col("there").isNotNull(), F.concat(F.lit("no file: "), F.coalesce("listed", F.lit("null")))))
    times = F.count(F.lit(1)).over(Window.partitionBy("path"))
    rows = rows.withColumn("times", times).where(refuse(F.col("times") == 1, F.concat(F.lit("listed twice: "), F.col("path"))))
    return rows.select(F.lit(run_id).alias("run_id"), "role", "path", "size_bytes", "sha256")


def manifest_digest(manifest: DataFrame) -> DataFrame:
    """By run: files, size_bytes, and digest bigint, the sum of the first 32 bits of an md5 of each row, whatever their order."""
    row = F.md5(F.concat_ws("|", "role", "path", F.col("size_bytes").cast("string"), "sha256"))
    part = F.conv(F.substring(row, 1, 8), 16, 10).cast("long")
    return manifest.groupBy("run_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"), F.sum(part).alias("digest"))


def duplicate_paths(files: DataFrame) -> DataFrame:
    return files.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def disclosure(scored: DataFrame, approvals: DataFrame, run_id: str, policy: Mapping[str, object]) -> DataFrame:
    """One row on what a held-out evaluation discloses, if the run is approved: run_id, owner, policy_id, policy_version, the
    policy's sorted lists (disclosures, limitations, prohibited_claims), and records and windows scored (rows with record_id)."""
    lists = {k: F.array(*(F.lit(x) for x in sorted(policy[k]))) if policy[k] else F.expr("cast(array() as array<string>)") for k in ("disclosures", "limitations", "prohibited_claims")}
    counts = scored.agg(F.count_distinct("record_id").alias("records"), F.count(F.lit(1)).alias("windows"))
    run = approvals.where(F.col("run_id") == run_id).select("run_id", "owner").limit(1)
    stated = {"policy_id": F.lit(policy["policy_id"]), "policy_version": F.lit(policy["version"]), **lists}
    return run.crossJoin(F.broadcast(counts)).withColumns(stated)


def inventory_totals(files: DataFrame, by: str) -> DataFrame:
    return files.groupBy(by).agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"))


def run_usage(files: DataFrame) -> DataFrame:
    """By run: files, bytes and the last change, the newest run first."""
    return files.groupBy("run_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"), F.max("modified").alias("modified")).orderBy(F.desc("modified"), "run_id")


def latest(rows: DataFrame, value: str, by: str) -> DataFrame:
    return rows.agg(F.max_by(value, F.struct(by, value)).alias(value))


def record_approval(manifest: DataFrame, required_roles: DataFrame, run_id: str, owner: str) -> DataFrame:
    """A row (run_id, owner) if the run's manifest has every required role; no row otherwise."""
    run = manifest.where(F.col("run_id") == run_id)
    missing = required_roles.select("role").join(run.select("role"), "role", "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    return missing.where("missing = 0").select(F.lit(run_id).alias("run_id"), F.lit(owner).alias("owner"))


def gated_partition(rows: DataFrame, approvals: DataFrame, run_id: str, partition: str = "test") -> DataFrame:
    """Rows of the protected partition, if an approval of the same run is there; none otherwise."""
    run = approvals.where(F.col("run_id") == run_id).select("run_id").distinct()
    return rows.where(F.col("partition") == partition).withColumn("run_id", F.lit(run_id)).join(F.broadcast(run), "run_id", "left_semi").drop("run_id")


def read_partition(rows: DataFrame, partition: str, protected: Sequence[str] = ("test",)) -> DataFrame:
    """Rows of one partition; on a table partitioned by it only that partition's files are read. A protected one is refused
    when the plan is made: it is read through :func:`gated_partition`."""
    if partition in protected:
        raise PermissionError(f"partition {partition} is protected")
    return rows.where(F.col("partition") == partition)


def reconcile(extracted: DataFrame, split: DataFrame) -> DataFrame:
    """One row: windows extracted, windows in the split, and whether they agree."""
    a, b = extracted.agg(F.count(F.lit(1)).alias("extracted")), split.agg(F.count(F.lit(1)).alias("assigned"))
    return a.crossJoin(b).withColumn("ok", F.col("extracted") == F.col("assigned"))
