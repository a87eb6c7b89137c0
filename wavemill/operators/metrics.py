"""Classification metrics as tables.

Predictions have label and prediction; a confusion table has label, prediction and n, zero-filled over the classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavemill.functions.scalars import ratio
from wavemill.sources.scratch import written


def confusion_matrix(predictions: DataFrame, classes: Sequence[int]) -> DataFrame:
    """label, prediction, n for every pair of classes."""
    spark = predictions.sparkSession
    cells = spark.createDataFrame([(a, b) for a in classes for b in classes], "label int, prediction int")
    counts = predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(counts, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def class_metrics(confusion: DataFrame, zero_division: float = 0.0) -> DataFrame:
    """label, precision, recall, f1, support; ``zero_division`` (0 or 1) stands where a denominator is 0."""
    if zero_division not in (0.0, 1.0):
        raise ValueError("zero_division must be 0 or 1")
    hit = F.col("label") == F.col("prediction")
    as_label = confusion.groupBy("label").agg(F.sum("n").alias("support"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("hits"))
    as_prediction = confusion.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    rows = as_label.join(as_prediction, "label")
    rows = rows.withColumns({"precision": ratio(F.col("hits"), F.col("predicted"), zero_division), "recall": ratio(F.col("hits"), F.col("support"), zero_division)})
    both = F.col("precision") + F.col("recall")
    return rows.select("label", "precision", "recall", ratio(2 * F.col("precision") * F.col("recall"), both, zero_division).alias("f1"), "support")


def overall_metrics(confusion: DataFrame, zero_division: float = 0.0) -> DataFrame:
    """One row: accuracy, macro and support-weighted precision, recall and F1, and n."""
    by_class = class_metrics(confusion, zero_division)
    n = F.sum("support")
    weighed = lambda c: (F.sum(F.col(c) * F.col("support")) / n).alias(f"weighted_{c}")
    means = by_class.agg(*(F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")), *map(weighed, ("precision", "recall", "f1")), n.alias("n"))
    hits = confusion.agg((F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    return hits.crossJoin(means)


def binary_rates(confusion: DataFrame, positive: int = 1) -> DataFrame:
    """One row: tp, fp, tn, fn and tpr, fpr, tnr, fnr (0 where the denominator is 0)."""
    real, said = F.col("label") == positive, F.col("prediction") == positive
    cell = lambda c, name: F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name)
    cells = confusion.agg(cell(real & said, "tp"), cell(~real & said, "fp"), cell(~real & ~said, "tn"), cell(real & ~said, "fn"))
    c = F.col
    return cells.select("*", ratio(c("tp"), c("tp") + c("fn")).alias("tpr"), ratio(c("fp"), c("fp") + c("tn")).alias("fpr"), ratio(c("tn"), c("fp") + c("tn")).alias("tnr"), ratio(c("fn"), c("tp") + c("fn")).alias("fnr"))


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float], classes: Sequence[int], zero_division: float = 0.0) -> DataFrame:
    """Macro metrics of the rows whose margin reaches each threshold: threshold, covered, macro_precision, macro_recall, macro_f1.

    The thresholds (a parameter) meet the counts, not the rows: each row's margin is first put in its interval between
    thresholds, rows are counted by interval, label and prediction, and sums of these few counts give every threshold.
    """
    spark, levels = scored.sparkSession, sorted(set(thresholds))
    reached = F.lit(0)
    for t in levels:
        reached = reached + F.when(F.col("margin") >= t, 1).otherwise(0)
    counts = scored.withColumn("reached", reached).groupBy("reached", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    grid = spark.createDataFrame([(k, float(t), c) for k, t in enumerate(levels, 1) for c in classes], "k int, threshold double, label int")
    hit = (F.col("counts.label") == F.col("grid.label")) & (F.col("prediction") == F.col("grid.label"))
    there = F.coalesce(F.col("n"), F.lit(0))
    sums = F.broadcast(grid).alias("grid").join(counts.alias("counts"), F.col("reached") >= F.col("k"), "left").groupBy("threshold", F.col("grid.label").alias("label")).agg(
        F.sum(F.when(hit, there).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("counts.label") == F.col("grid.label"), there).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("prediction") == F.col("grid.label"), there).otherwise(0)).alias("predicted"),
        F.sum(there).alias("covered"),
    )
    sums = sums.withColumns({"p": ratio(F.col("hits"), F.col("predicted"), zero_division), "r": ratio(F.col("hits"), F.col("support"), zero_division)})
    sums = sums.withColumn("f", ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"), zero_division))
    return sums.groupBy("threshold").agg(F.max("covered").alias("covered"), F.avg("p").alias("macro_precision"), F.avg("r").alias("macro_recall"), F.avg("f").alias("macro_f1"))


def majority_baseline(predictions: DataFrame) -> DataFrame:
    """One row: the commonest label (ties to the lowest), its accuracy, the predictions' accuracy, and the relative gain."""
    counts = predictions.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("hits"))
    total = F.sum("n")
    out = counts.agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("majority"), (F.max("n") / total).alias("majority_accuracy"), (F.sum("hits") / total).alias("accuracy"))
    return out.withColumn("gain", ratio(F.col("accuracy") - F.col("majority_accuracy"), F.col("majority_accuracy")))


def error_breakdown(predictions: DataFrame, by: str, positive: int = 1) -> DataFrame:
    """Positives by ``by``: missed, caught, and the share that each has of all missed and of all caught."""
    rows = predictions.where(F.col("label") == positive).groupBy(by)
    rows = rows.agg(F.count_if(F.col("prediction") != positive).alias("missed"), F.count_if(F.col("prediction") == positive).alias("caught"))
    totals = rows.agg(F.sum("missed").alias("all_missed"), F.sum("caught").alias("all_caught"))
    share = lambda c: ratio(F.col(c), F.col(f"all_{c}")).alias(f"{c}_share")
    return rows.crossJoin(F.broadcast(totals)).select(*rows.columns, share("missed"), share("caught"))


def class_balance(rows: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Counts of each label and their share within ``by``."""
    counts = rows.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def null_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns))


def exact_quantiles(rows: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Exact quantiles of each numeric column: column, share, value, between neighbours in proportion; nulls are left out.

    Equal values are counted where they lie, so each is one row. The values of all columns are range-partitioned and sorted, each
    partition sums its own counts, and one row for each tells how many are ahead of it; so every value knows its ranks, and
    those that hold a wanted rank are kept. No task holds more than its range. NaN is the largest value. A column without
    values has no rows.
    """
    each = F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns)))
    counts = rows.select(each).where("x is not null").groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), np.asarray(batch.column(2))
            ends = np.zeros(len(sizes), np.int64)
            for name in dict.fromkeys(names):
                own = np.array([x == name for x in names])
                ends[own] = held.get(name, 0) + np.cumsum(sizes[own])
                held[name] = int(ends[own][-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(ends)], ["column", "x", "n", "part", "end"])

    # written down, so that the sums of the partitions fit the order that is read
    order = ["column", "x"]
    ranked = written(counts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(summed, "column string, x double, n bigint, part int, end bigint"), "ranks")
    ahead = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranked.groupBy("column", "part").agg(F.sum("n").alias("own")).withColumn("ahead", F.coalesce(F.sum("own").over(ahead), F.lit(0)))
    parts = parts.withColumn("total", F.sum("own").over(Window.partitionBy("column")))
    placed = ranked.join(parts, ["column", "part"]).withColumn("end", F.col("ahead") + F.col("end"))
    wanted = F.explode(F.array(*(F.struct(F.lit(float(p)).alias("share"), (F.lit(float(p)) * (F.col("total") - 1)).alias("rank")) for p in shares))).alias("want")
    met = placed.select("column", "x", "end", (F.col("end") - F.col("n")).alias("start"), wanted).select("column", "x", "start", "end", "want.*")
    holds = lambda rank: (F.col("start") <= rank) & (rank < F.col("end"))
    low, high = F.floor("rank"), F.ceil("rank")
    met = met.where(holds(low) | holds(high)).groupBy("column", "share", "rank").agg(F.max(F.when(holds(low), F.col("x"))).alias("low"), F.max(F.when(holds(high), F.col("x"))).alias("high"))
    between = F.when(low == high, F.col("low")).otherwise((high - F.col("rank")) * F.col("low") + (F.col("rank") - low) * F.col("high"))
    return met.select("column", "share", between.alias("value"))


def column_summary(rows: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """A row for each numeric column: column, n, mean, stddev, lowest, p25, p50, p75, highest.

    Percentiles are exact, by :func:`exact_quantiles`; with ``accuracy`` they are approximate in one pass.
    """
    shares, stats = {0.25: "p25", 0.5: "p50", 0.75: "p75"}, []
    for c in columns:
        x = F.col(c).cast("double")
        quarters = [] if accuracy is None else [F.percentile_approx(x, p, accuracy).alias(name) for p, name in shares.items()]
        stats.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"), F.min(x).alias("lowest"), *quarters, F.max(x).alias("highest")))
    found = rows.agg(F.array(*stats).alias("rows")).select(F.inline("rows"))
    if accuracy is None:
        exact = exact_quantiles(rows, columns, list(shares)).groupBy("column").agg(*(F.max(F.when(F.col("share") == p, F.col("value"))).alias(name) for p, name in shares.items()))
        found = found.join(exact, "column", "left")
    return found.select("column", "n", "mean", "stddev", "lowest", *shares.values(), "highest")
