"""Subject-grouped splits, their summaries, and leakage."""

from __future__ import annotations

import heapq
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavemill.functions.scalars import refuse
from wavemill.operators.ordered import with_previous

PARTITIONS = ("train", "validation", "test")


@dataclass(frozen=True)
class SplitConfig:
    ratios: tuple[float, float, float] = (0.7, 0.15, 0.15)
    seed: int = 2022


def partition_sizes(n: int, ratios: Sequence[float]) -> list[int]:
    """Whole subjects for each partition by largest remainders, none empty.

    Each partition is due its quota, n times its ratio as it is written. The parts of the quotas below 1 add up to a whole
    number of subjects, which go to the largest of those parts, the first of equal ones. A partition that would be left
    with none is given one; what that gives too many is taken from the largest, one by one, the first of equal ones. Fewer
    subjects than partitions is an error.
    """
    if n < len(ratios):
        raise ValueError(f"{n} subjects can't fill {len(ratios)} partitions")
    quotas = [Fraction(str(r)) * n for r in ratios]
    rest = n - sum(int(q) for q in quotas)
    favoured = heapq.nlargest(rest, range(len(quotas)), key=lambda k: (quotas[k] % 1, -k))
    sizes = [max(1, int(q) + (k in favoured)) for k, q in enumerate(quotas)]
    for _ in range(sum(sizes) - n):
        sizes[max(range(len(sizes)), key=lambda k: (sizes[k], -k))] -= 1
    return sizes


def attach_subjects(rows: DataFrame, record_subjects: DataFrame) -> DataFrame:
    """Rows with the subject_id of their record. The map must cover the records exactly: a record without a subject, or a
    subject's record without rows, fails the job, since either would let records escape the grouping; see :func:`narrow_subjects`."""
    known = record_subjects.select("record_id", "subject_id")
    spare = known.join(rows.select("record_id").distinct(), "record_id", "left_anti").agg(F.count(F.lit(1)).alias("n"), F.min("record_id").alias("first"))
    spare = spare.where(refuse(F.col("n") == 0, F.concat_ws(" ", F.col("n").cast("string"), F.lit("records have a subject and no rows; the first is"), F.col("first")))).select(F.lit(1).alias("covered"))
    out = rows.join(known, "record_id", "left").where(refuse(F.col("subject_id").isNotNull(), F.concat(F.lit("no subject for record "), F.coalesce("record_id", F.lit("null")))))
    return out.crossJoin(F.broadcast(spare)).drop("covered")


def narrow_subjects(record_subjects: DataFrame, rows: DataFrame) -> DataFrame:
    """The subject map of the records that occur in ``rows``."""
    return record_subjects.join(rows.select("record_id").distinct(), "record_id", "left_semi")


def split_subjects(subjects: DataFrame, config: SplitConfig) -> DataFrame:
    """subject_id, partition: subjects in the order of a seeded md5, cut at the sizes of the partitions.

    The order is by 256 ranges of the hash. One action counts the subjects of each range (256 rows), which gives the sizes
    and each range's offset; ranks are local to a range, so no task orders all subjects.
    """
    subjects = subjects.select("subject_id").distinct()
    rows = subjects.withColumn("draw", F.md5(F.concat(F.lit(f"{config.seed}:"), F.col("subject_id").cast("string")))).withColumn("slice", F.substring("draw", 1, 2))
    counts = sorted((r["slice"] or "", r["n"]) for r in rows.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).collect())
    sizes = partition_sizes(sum(n for _, n in counts), config.ratios)
    ahead = list(accumulate((n for _, n in counts), initial=0))
    offsets = F.create_map(*(F.lit(x) for (name, _), upto in zip(counts, ahead, strict=False) for x in (name, upto)))
    place = offsets[F.coalesce("slice", F.lit(""))] + F.row_number().over(Window.partitionBy("slice").orderBy("draw", "subject_id"))
    return _cut(rows.withColumn("place", place), sizes)


def _cut(rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """subject_id, partition of rows with a place from 1."""
    cut = F.when(F.col("place") <= sizes[0], PARTITIONS[0]).when(F.col("place") <= sizes[0] + sizes[1], PARTITIONS[1]).otherwise(PARTITIONS[2])
    return rows.select("subject_id", cut.alias("partition"))


def split_subjects_shuffled(subjects: DataFrame, config: SplitConfig, most: int = 10_000_000) -> DataFrame:
    """The same with the order of Python's seeded shuffle over the sorted subjects, for at most ``most`` of them.

    Subjects are ranked in Spark: they are counted by the first characters of their ids, and ranked within those. That
    shuffle is one sequence of swaps, so the order of the places (whole numbers, no subjects) is made in one task, and joined
    to the ranks. Only the counts reach the driver.
    """
    rows = subjects.select("subject_id").distinct().withColumn("head", F.substring(F.col("subject_id").cast("string"), 1, 4))
    counts = rows.groupBy("head").agg(F.count(F.lit(1)).alias("n"))
    n = rows.count()
    if n > most:
        raise ValueError(f"over {most} subjects: use split_subjects")
    sizes, seed = partition_sizes(n, config.ratios), config.seed
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("head").orderBy("subject_id"))
    ranked = rows.withColumn("within", within).join(ahead.select("head", "ahead"), "head").select("subject_id", (F.col("ahead") + F.col("within") - 1).alias("rank"))

    def shuffled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            order = list(range(n))
            random.Random(seed).shuffle(order)
            for low in range(0, n, 10_000):
                some = order[low : low + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(range(low + 1, low + 1 + len(some)), pa.int64())], ["rank", "place"])

    places = subjects.sparkSession.range(0, 1, 1, 1).mapInArrow(shuffled, "rank bigint, place bigint")
    return _cut(ranked.join(places, "rank"), sizes)


def grouped_split(windows: DataFrame, record_subjects: DataFrame, config: SplitConfig) -> DataFrame:
    """record_id, subject_id, partition of every record that has windows; records of a subject stay together."""
    members = narrow_subjects(record_subjects, windows)
    return members.join(split_subjects(members, config), "subject_id").select("record_id", "subject_id", "partition")


def random_row_split(rows: DataFrame, key: Sequence[str], seed: int, shares: Sequence[tuple[str, float]] = (("train", 0.72), ("validation", 0.18), ("test", 0.10))) -> DataFrame:
    """Adds split by a hash of the row: the leaky split that grouped_split replaces, kept to measure what it leaks."""
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in key))), 1, 8), 16, 10).cast("long") / (1 << 32)
    out, upto = None, 0.0
    for name, share in shares[:-1]:
        upto += share
        out = F.when(draw < upto, name) if out is None else out.when(draw < upto, name)
    return rows.withColumn("split", out.otherwise(shares[-1][0]))


def partition_summary(windows: DataFrame, assignment: DataFrame) -> DataFrame:
    """By partition: subjects, records, windows and counts of both classes, zero where there are none."""
    rows = windows.select("record_id", "target_value").join(assignment, "record_id")
    counts = rows.groupBy("partition").agg(
        F.count_distinct("subject_id").alias("subjects"),
        F.count_distinct("record_id").alias("records"),
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("target_value") == 0).alias("class_0"),
        F.count_if(F.col("target_value") == 1).alias("class_1"),
    )
    names = windows.sparkSession.createDataFrame([(p,) for p in PARTITIONS], "partition string")
    return names.join(counts, "partition", "left").na.fill(0)


def partition_totals(windows: DataFrame, assignment: DataFrame) -> DataFrame:
    """The same counts with a grand total, where partition is null."""
    rows = windows.select("record_id", "target_value").join(assignment, "record_id")
    return rows.rollup("partition").agg(F.count_distinct("subject_id").alias("subjects"), F.count_distinct("record_id").alias("records"), F.count(F.lit(1)).alias("windows"))


def leakage(rows: DataFrame, key: str, partition: str = "partition") -> DataFrame:
    """Keys found in more than one partition: key, partitions (sorted array), in one shuffle."""
    found = rows.groupBy(key).agg(F.array_sort(F.collect_set(partition)).alias("partitions"))
    return found.where(F.size("partitions") > 1)


def overlap_leakage(windows: DataFrame, split: str = "split") -> DataFrame:
    """By record: neighbouring windows that overlap, and those of them that a row split put in different parts."""
    rows = windows.select("record_id", "ordinal", "left", "right", F.col(split).alias("own"))
    rows = with_previous(rows, "record_id", "ordinal", {"before": "right", "other": "own"})
    overlap = F.coalesce(F.col("left") < F.col("before"), F.lit(False))
    return rows.groupBy("record_id").agg(F.count_if(overlap).alias("overlaps"), F.count_if(overlap & (F.col("other") != F.col("own"))).alias("leaks"))


def balanced_weights(rows: DataFrame, label: str = "target_value") -> DataFrame:
    """label, n, weight: n of all / (classes x n of the class)."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    return counts.withColumn("weight", F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n")))
