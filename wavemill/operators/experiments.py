"""Candidates, their results, and progress logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavemill.sources.scratch import written


def pending_candidates(candidates: DataFrame, done: DataFrame) -> DataFrame:
    return candidates.join(done.select("candidate_id"), "candidate_id", "left_anti")


def rank_candidates(results: DataFrame, higher_is_better: bool = True, missing_last: bool = True) -> DataFrame:
    """Adds place (from 1) by metric; ties keep the order of submission (ordinal); a missing metric comes last, or first.

    Results are range-partitioned by (missing, metric, ordinal), at split points that Spark draws from the rows, so that outliers,
    infinite metrics and a metric that most results share are spread too, and counts by partition put each in its place; no
    task orders all results. NaN counts as missing.
    """
    missing = F.col("metric").isNull() | F.isnan("metric")
    better = F.col("rank").desc() if higher_is_better else F.col("rank").asc()
    parts = int(results.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = results.select(F.struct("*").alias("own"), F.when(missing, 1 if missing_last else -1).otherwise(0).alias("at"), F.when(~missing, F.col("metric")).alias("rank"), "ordinal")
    placed = written(rows.repartitionByRange(parts, "at", better, "ordinal").withColumn("part", F.spark_partition_id()), "ranked")
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("at", better, "ordinal"))
    return placed.withColumn("within", within).join(F.broadcast(counts), "part").select("own.*", (F.col("ahead") + F.col("within")).cast("int").alias("place"))


def compare_models(candidate: DataFrame, baseline: DataFrame) -> DataFrame:
    """name, value, baseline and difference of each metric; null where the baseline lacks it."""
    rows = candidate.join(baseline.select("name", F.col("value").alias("baseline")), "name", "left")
    return rows.select("name", "value", "baseline", (F.col("value") - F.col("baseline")).alias("difference"))


def write_candidate(result: DataFrame, path: str) -> None:
    """Append results, one folder for each candidate_id; a candidate is done once its folder is there."""
    result.write.mode("append").partitionBy("candidate_id").parquet(path)


def progress_estimates(log: DataFrame, units: DataFrame, at_least: int = 3) -> DataFrame:
    """Time of each completed unit and what is left: run_id, ordinal, seconds, elapsed, done, eta.

    ``log`` has run_id, ordinal and finished (seconds from the run's start); ``units`` run_id and total. Times that run
    backwards count as 0. The estimate is the mean time of a unit so far times the units left: null until ``at_least`` are
    done, 0 at the end.
    """
    order = Window.partitionBy("run_id").orderBy("ordinal")
    before = F.coalesce(F.lag("finished").over(order), F.lit(0.0))
    rows = log.join(units, "run_id").withColumns({"seconds": F.greatest(F.lit(0.0), F.col("finished") - before), "elapsed": F.greatest(F.lit(0.0), F.col("finished")), "done": F.row_number().over(order)})
    left = F.col("total") - F.col("done")
    eta = F.when(left <= 0, 0.0).when(F.col("done") >= at_least, F.col("elapsed") / F.col("done") * left)
    return rows.select("run_id", "ordinal", "seconds", "elapsed", "done", eta.alias("eta"))


def stage_durations(log: DataFrame, stages: DataFrame) -> DataFrame:
    """Seconds by run and stage, with zero for stages that a run has no entry of."""
    sums = log.groupBy("run_id", "stage").agg(F.sum("seconds").alias("seconds"))
    grid = log.select("run_id").distinct().crossJoin(stages.select("stage"))
    return grid.join(sums, ["run_id", "stage"], "left").select("run_id", "stage", F.coalesce("seconds", F.lit(0.0)).alias("seconds"))


def sample_rows(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The first n rows in the order of a seeded md5 of the key: the same sample on every run and layout."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
