"""Rules over records, windows and splits, reported as rows; :func:`enforce` stops a job once they are written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.functions.scalars import all_finite, is_close, non_empty, ratio, refuse
from wavemill.operators.ordered import with_previous
from wavemill.operators.split import PARTITIONS, leakage, partition_summary


def coverage_diff(expected: DataFrame, observed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each distinct key with status ok, missing or unexpected."""
    a, b = expected.select(*key).distinct().withColumn("wanted", F.lit(1)), observed.select(*key).distinct().withColumn("seen", F.lit(1))
    status = F.when(F.col("seen").isNull(), "missing").when(F.col("wanted").isNull(), "unexpected").otherwise("ok")
    return a.join(b, list(key), "full_outer").select(*key, status.alias("status"))


def missing_required(required: DataFrame, present: DataFrame, key: str = "name") -> DataFrame:
    return required.select(key).distinct().join(present.select(key), key, "left_anti")


def validate_records(records: DataFrame, chunks: DataFrame, annotations: DataFrame, configured: DataFrame, rate: float) -> DataFrame:
    """A row (record_id, rule, ok) for each of nine rules on each record.

    configured: the id is expected; rate: the sample rate is close to ``rate``; non_empty: it has samples and channels;
    finite: all samples are; channels: names are non-empty and distinct; units: as many as channels, non-empty;
    annotated: each annotation has an index and a symbol; in_range: indices lie within the record; ordered: they never fall.
    A record without samples or annotations keeps the rules on those.
    """
    filled = lambda a: F.forall(a, lambda x: F.coalesce(F.length(F.trim(x)) > 0, F.lit(False)))
    finite = chunks.groupBy("record_id").agg(F.bool_and(all_finite(F.col("samples"))).alias("finite"))
    marks = with_previous(annotations.select("record_id", "ordinal", "sample_index", "symbol"), "record_id", "ordinal", {"before": "sample_index"})
    marks = marks.withColumn("fell", F.coalesce(F.col("sample_index") < F.col("before"), F.lit(False)))
    marks = marks.groupBy("record_id").agg(
        F.bool_and(F.col("sample_index").isNotNull() & F.coalesce(F.length("symbol") > 0, F.lit(False))).alias("annotated"),
        F.min("sample_index").alias("first"),
        F.max("sample_index").alias("last"),
        (~F.bool_or("fell")).alias("ordered"),
    )
    rows = records.join(configured.select("record_id").distinct().withColumn("known", F.lit(True)), "record_id", "left")
    rows = rows.join(finite, "record_id", "left").join(marks, "record_id", "left")
    true = F.lit(True)
    rules: dict[str, Column] = {
        "configured": F.coalesce("known", F.lit(False)),
        "rate": F.coalesce(is_close(F.col("sample_rate_hz"), F.lit(rate)), F.lit(False)),
        "non_empty": F.coalesce((F.col("sample_count") > 0) & (F.size("channel_names") > 0), F.lit(False)),
        "finite": F.coalesce("finite", true),
        "channels": (F.size(F.array_distinct("channel_names")) == F.size("channel_names")) & filled("channel_names"),
        "units": (F.size("units") == F.size("channel_names")) & filled("units"),
        "annotated": F.coalesce("annotated", true),
        "in_range": F.coalesce((F.col("first") >= 0) & (F.col("last") < F.col("sample_count")), true),
        "ordered": F.coalesce("ordered", true),
    }
    return rows.select("record_id", F.inline(F.array(*(F.struct(F.lit(r).alias("rule"), ok.alias("ok")) for r, ok in rules.items()))))


def record_report(records: DataFrame, annotations: DataFrame, rules: DataFrame) -> DataFrame:
    """record_id, sample_count, channels, annotations, counts by symbol as a sorted map, and the names of the rules that the
    record passed, sorted; ``rules`` has record_id, rule, ok, as from :func:`validate_records`."""
    passed = rules.where("ok").groupBy("record_id").agg(F.array_sort(F.collect_set("rule")).alias("passed"))
    counts = annotations.groupBy("record_id", "symbol").agg(F.count(F.lit(1)).alias("n")).groupBy("record_id")
    counts = counts.agg(F.sum("n").alias("annotations"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "n")))).alias("symbols"))
    out = records.join(counts, "record_id", "left").join(passed, "record_id", "left")
    none, empty = F.expr("cast(array() as array<string>)"), F.expr("cast(map() as map<string, bigint>)")
    found = (F.coalesce("annotations", F.lit(0)).alias("annotations"), F.coalesce("symbols", empty).alias("symbols"), F.coalesce("passed", none).alias("passed"))
    return out.select("record_id", "sample_count", F.size("channel_names").alias("channels"), *found)


def validate_windows(windows: DataFrame) -> DataFrame:
    """By record: rows, and whether widths are equal, samples finite, centres not negative, centres in order, and the id not blank."""
    facts = windows.select("record_id", "ordinal", "center_sample_index", F.size("window").alias("width"), all_finite(F.col("window")).alias("fine"))
    rows = with_previous(facts, "record_id", "ordinal", {"before": "center_sample_index"})
    rows = rows.withColumn("fell", F.coalesce(F.col("center_sample_index") < F.col("before"), F.lit(False)))
    return rows.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("windows"),
        (F.min("width") == F.max("width")).alias("equal_width"),
        F.bool_and("fine").alias("finite"),
        F.bool_and(F.col("center_sample_index") >= 0).alias("centres_valid"),
        (~F.bool_or("fell")).alias("centres_ordered"),
        F.bool_and(non_empty(F.col("record_id").cast("string"))).alias("ids_filled"),
    )


@dataclass(frozen=True)
class SplitQualityConfig:
    """Least numbers by partition, classes required in partitions, the largest deviation of subject ratios, and the checks
    that only warn."""

    minimum_subjects: int = 1
    minimum_records: int = 1
    minimum_windows: int = 1
    minimum_positives: int = 1
    required_classes: tuple[int, ...] = (0, 1)
    required_partitions: tuple[str, ...] = PARTITIONS
    ratios: tuple[float, float, float] = (0.7, 0.15, 0.15)
    maximum_deviation: float = 0.1
    warn_only: tuple[str, ...] = ()


def split_diagnostics(windows: DataFrame, assignment: DataFrame, ratios: Sequence[float] = (0.7, 0.15, 0.15), shards: DataFrame | None = None) -> DataFrame:
    """By partition: subjects, records, shards, windows and counts of both classes, its shares of them and of positives, its
    prevalence, the share of subjects that was asked for, and how far the real one is off.

    ``shards`` has record_id and path of each shard; without it each record is a shard.
    """
    rows, spark = partition_summary(windows, assignment), windows.sparkSession
    if shards is None:
        rows = rows.withColumn("shards", F.col("records"))
    else:
        held = shards.join(assignment, "record_id").groupBy("partition").agg(F.count_distinct("path").alias("shards"))
        rows = rows.join(held, "partition", "left").na.fill(0, ["shards"])
    asked = spark.createDataFrame(list(zip(PARTITIONS, map(float, ratios), strict=True)), "partition string, asked double")
    totals = rows.agg(*(F.sum(c).alias(f"all_{c}") for c in ("subjects", "records", "shards", "windows", "class_1")))
    rows = rows.join(asked, "partition").crossJoin(F.broadcast(totals))
    share = lambda c, name: ratio(F.col(c), F.col(f"all_{c}")).alias(name)
    return rows.select(
        *("partition", "subjects", "records", "shards", "windows", "class_0", "class_1"),
        share("subjects", "subject_share"),
        share("records", "record_share"),
        share("shards", "shard_share"),
        share("windows", "window_share"),
        share("class_1", "positive_share"),
        ratio(F.col("class_1"), F.col("windows")).alias("prevalence"),
        "asked",
        F.abs(ratio(F.col("subjects"), F.col("all_subjects")) - F.col("asked")).alias("deviation"),
    )


def split_quality(windows: DataFrame, assignment: DataFrame, config: SplitQualityConfig) -> DataFrame:
    """Violations (check, partition, severity, message) of the limits; subjects and records must not be in two partitions."""
    spark = windows.sparkSession
    summary = partition_summary(windows, assignment)
    observed = windows.select("target_value").distinct()
    binary = observed.agg((F.sort_array(F.collect_set("target_value")) == F.array(F.lit(0), F.lit(1))).alias("binary"))
    least = lambda check, column, limit: F.struct(F.lit(check).alias("check"), (F.col(column) < limit).alias("bad"), F.concat_ws(" ", F.col(column).cast("string"), F.lit(f"< {limit}")).alias("message"))
    wanted = F.element_at(F.create_map(*(x for p, r in zip(PARTITIONS, config.ratios, strict=True) for x in (F.lit(p), F.lit(r)))), F.col("partition"))
    share = F.col("subjects") / F.sum("subjects").over(Window.partitionBy())
    off = F.abs(share - wanted) > config.maximum_deviation
    rows = summary.crossJoin(F.broadcast(binary)).withColumn("off", off)
    limits = rows.select(
        "partition",
        F.inline(
            F.array(
                least("minimum_subjects", "subjects", config.minimum_subjects),
                least("minimum_records", "records", config.minimum_records),
                least("minimum_windows", "windows", config.minimum_windows),
                F.struct(F.lit("minimum_positives").alias("check"), (F.col("binary") & (F.col("class_1") < config.minimum_positives)).alias("bad"), F.concat_ws(" ", F.col("class_1").cast("string"), F.lit(f"< {config.minimum_positives}")).alias("message")),
                F.struct(F.lit("ratio_deviation").alias("check"), F.col("off").alias("bad"), F.lit(f"subject share differs by over {config.maximum_deviation}").alias("message")),
            )
        ),
    ).where("bad")
    need = spark.createDataFrame([(p, c) for p in config.required_partitions for c in config.required_classes], "partition string, target_value int")
    there = windows.select("record_id", "target_value").join(assignment.select("record_id", "partition"), "record_id").select("partition", "target_value").distinct()
    absent = need.join(there, ["partition", "target_value"], "left_anti").select(F.lit("required_class_coverage").alias("check"), "partition", F.concat(F.lit("no class "), F.col("target_value").cast("string")).alias("message"))
    shared = lambda key: leakage(assignment, key).select(F.lit(f"{key.split('_')[0]}_disjoint").alias("check"), F.lit(None).cast("string").alias("partition"), F.concat_ws(" ", F.col(key).cast("string"), F.lit("in"), F.array_join("partitions", ", ")).alias("message"))
    found = limits.select("check", "partition", "message").unionByName(absent).unionByName(shared("subject_id")).unionByName(shared("record_id"))
    severity = F.when(F.col("check").isin(*config.warn_only), "warning").otherwise("error") if config.warn_only else F.lit("error")
    return found.select("check", "partition", severity.alias("severity"), "message")


def quality_status(violations: DataFrame) -> DataFrame:
    """One row: failed, warning or passed, and the numbers of each."""
    counts = violations.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return counts.select(F.when(F.col("errors") > 0, "failed").when(F.col("warnings") > 0, "warning").otherwise("passed").alias("status"), "errors", "warnings")


def ordered_violations(violations: DataFrame) -> DataFrame:
    return violations.orderBy("check", F.coalesce("partition", F.lit("")), "message")


def validate_split(assignment: DataFrame, summary: DataFrame, windows: DataFrame) -> DataFrame:
    """Whether an assignment and its stated summary agree: rows (invariant, ok)."""
    actual = partition_summary(windows, assignment)
    pairs = summary.select("partition", *(F.col(c).alias(f"said_{c}") for c in ("subjects", "records", "windows", "class_0", "class_1"))).join(actual, "partition", "full_outer")
    same = lambda c: F.coalesce(F.bool_and(F.coalesce(F.col(f"said_{c}") == F.col(c), F.lit(False))), F.lit(True)).alias(f"{c}_agree")
    a = pairs.agg(*map(same, ("subjects", "records", "windows", "class_0", "class_1")), F.bool_and(F.col("partition").isin(*PARTITIONS)).alias("partitions_known"))
    a = a.crossJoin(summary.agg(F.bool_and(F.col("class_0") + F.col("class_1") == F.col("windows")).alias("classes_sum"), F.bool_and(F.col("subjects") <= F.col("records")).alias("subjects_within_records"), F.bool_and(F.col("subjects") > 0).alias("none_empty")))
    a = a.crossJoin(leakage(assignment, "subject_id").agg((F.count(F.lit(1)) == 0).alias("subjects_disjoint")))
    a = a.crossJoin(leakage(assignment, "record_id").agg((F.count(F.lit(1)) == 0).alias("records_disjoint")))
    a = a.crossJoin(coverage_diff(windows, assignment, ["record_id"]).agg(F.coalesce(F.bool_and(F.col("status") == "ok"), F.lit(True)).alias("records_covered")))
    return a.select(F.inline(F.array(*(F.struct(F.lit(c).alias("invariant"), F.col(c).alias("ok")) for c in a.columns))))


def identity_check(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many different values the identity columns have together, and whether it is one at most."""
    return rows.agg(F.count_distinct(F.struct(*columns)).alias("identities")).withColumn("single", F.col("identities") <= 1)


def odd_records(rows: DataFrame, columns: Sequence[str], key: str = "record_id") -> DataFrame:
    """Rows whose identity columns differ, nulls alike, from those of the row of the smallest key: key and the columns."""
    said = F.struct(*columns)
    first = rows.agg(F.min_by(said, key).alias("first"))
    return rows.crossJoin(F.broadcast(first)).where(~said.eqNullSafe(F.col("first"))).select(key, *columns)


def channel_usage(channels: DataFrame) -> DataFrame:
    """How many records use each channel: channel_name (null where a record has none), n."""
    return channels.groupBy("channel_name").agg(F.count(F.lit(1)).alias("n"))


def verify_counts(rows: DataFrame, index: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows by key counted again and compared with an index (key, window_count): key, stated, counted, ok."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("counted"))
    both = index.select(key, F.col("window_count").alias("stated")).join(counted, key, "full_outer")
    return both.select(key, "stated", "counted", F.coalesce(F.col("stated") == F.col("counted"), F.lit(False)).alias("ok"))


def require_none(rows: DataFrame, violations: DataFrame, message: Column) -> DataFrame:
    """``rows`` if there are no violations; otherwise the job that reads them fails with the smallest message and their number."""
    found = violations.agg(F.count(F.lit(1)).alias("n"), F.min(message).alias("first"))
    clear = found.where(refuse(F.col("n") == 0, F.concat_ws(" ", F.col("n").cast("string"), F.lit("violations:"), F.col("first")))).select(F.lit(1).alias("clear"))
    return rows.crossJoin(F.broadcast(clear)).drop("clear")


class QualityError(RuntimeError):
    """Data violate rules that stop a job."""


def enforce(violations: DataFrame, severity: str = "error") -> None:
    """Raise if there are violations of the severity; write the report first. One action, which ends at the first row."""
    found = violations.where(F.col("severity") == severity).limit(20).collect()
    if found:
        raise QualityError("; ".join(f"{r['check']} {r['partition'] or ''}: {r['message']}" for r in found))
