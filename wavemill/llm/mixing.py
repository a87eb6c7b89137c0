"""Mixing sources to target weights along a curriculum whose weights change with training progress."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemill.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Knots (progress, multiple of the source's mean weight), one curve for each weight: early, level and late sources.
CURVES: dict[int, Sequence[tuple[float, float]]] = {
    1: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    2: ((0.0, 1.0), (1.0, 1.0)),
    3: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
}
#: Leading hex digits of the shuffling hash that name a range of it: 4,096 ranges bound what one task orders of a hot source.
SLICE_DIGITS = 3


def source_targets(sizes: DataFrame, *, weights: Sequence[int] = (1, 2, 3), limit: float = 3.0) -> DataFrame:
    """Words to take of each source: source, source_size, weight, target.

    ``sizes`` has a row (source, source_size) for each source. Sources by code point, null last, get the weights in turn
    and share the sum of all sizes by them; a target stops at ``limit`` times its source's size, and the excess is shared
    again by weight among the rest until none is above. That end is found directly: with sources ordered by the level
    (limit x size / weight) at which they stop, it is the first level at which those that have not stopped take exactly what
    is left. A weight without a curve is refused. One row per source is ordered in one task, and nothing else: sources are
    names, of which a task holds millions, and not hosts or documents.
    """
    if not set(weights) <= set(CURVES):
        raise ValueError(f"weights without a curve: {sorted(set(weights) - set(CURVES))}")
    order = F.col("source").asc_nulls_last()
    rank = F.row_number().over(Window.orderBy(order)) - 1
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.alias("weight"))
    rows = rows.withColumn("stops", F.lit(float(limit)) * F.col("source_size") / F.col("weight"))
    before = Window.orderBy("stops", order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("stops", order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(full) - F.lit(float(limit)) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    rows = rows.withColumn("share", F.min(F.when(F.col("level") <= F.col("stops"), F.struct("stops", order_key("source"), "level"))).over(full)["level"])
    target = F.least(F.lit(float(limit)) * F.col("source_size"), F.col("weight") * F.coalesce("share", F.lit(float("inf"))))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def order_key(name: str) -> Column:
    """Sorts as by code point with null last."""
    return F.struct(F.col(name).isNull().alias("absent"), F.col(name).alias("present")).alias("key")


def demand_inverse(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Progress at which a source whose weight runs through ``knots`` (straight between them) has met ``share`` of its demand;
    null if it never does, the share being over 1.

    The weight is integrated over each stretch, and the quadratic that this gives is solved for the progress.
    """
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    total, met, out = sum(areas), 0.0, F.when(share <= 1, F.lit(float(knots[-1][0])))
    stretches = []
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        stretches.append((met, met + area, t0, w0, (w1 - w0) / (t1 - t0)))
        met += area
    for low, high, t0, w0, slope in reversed(stretches):
        need = share * total - low
        step = need / w0 if slope == 0 else 2 * need / (w0 + F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + 2 * slope * need)))
        out = F.when(share * total < high, F.lit(t0) + step).otherwise(out)
    return out


def mixing_plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key_col: str | None = None, seed: int = 17, limit: float = 3.0) -> DataFrame:
    """How often and where in training each document is taken: one row per input row.

    id_col, source_col, size bigint, source_size bigint, target double, middle double, positions array<double> (progress from
    0 to 1, one for each copy that is taken, ascending), and key_col, if it is given, a column that goes along. A size is the number of runs of anything but ASCII white space (null:
    0). Each source's documents are laid end to end in a seeded order, again and again up to ``limit`` times. The weights of
    ``CURVES`` integrate to a source's cumulative demand, which ends at its target; a copy gets the progress at which the
    demand reaches its middle, by the inverse of that integral, and is taken if the demand reaches it at all. So what is taken
    is within half a document of the target. Documents of size 0 are never taken. Equal inputs give equal results whatever
    their partitions; rows with equal ids and sizes follow one another in the seeded order, so each has a middle of its own.
    Null sources are one source, ordered last; an empty table gives no rows. Only the size of a very long text travels.

    The order is cut into ranges of the hash, so that a hot source is summed in many tasks; only (id, source, size) is
    shuffled, and the texts are read once.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text))
    keys = [F.col(key_col).alias("key")] if key_col else []
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), draw.alias("draw"), *keys)
    rows = materialise(rows.withColumn("slice", F.substring("draw", 1, SLICE_DIGITS)), "sizes")
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)))
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), limit=limit)
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    slices = slices.alias("s").join(targets.alias("t"), same).select("s.source", "slice", "ahead", "source_size", "weight", "target")
    both = F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.slice") == F.col("s.slice"))
    rows = rows.alias("r").join(slices.alias("s"), both).select("r.*", "ahead", "source_size", "weight", "target")
    within = Window.partitionBy("source", "slice").orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("middle", F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / 2)

    def position(k: Column) -> Column:
        share = (F.col("middle") + k * F.col("source_size")) / F.col("target")
        found = F.lit(None).cast("double")
        for weight, knots in CURVES.items():
            found = F.when(F.col("weight") == weight, demand_inverse(share, knots)).otherwise(found)
        return found

    turns = F.array(*(F.lit(k) for k in range(int(limit))))
    positions = F.when(F.col("size") > 0, F.filter(F.transform(turns, position), lambda x: x.isNotNull())).otherwise(F.expr("cast(array() as array<double>)"))
    keys = [F.col("key").alias(key_col)] if key_col else []
    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "middle", positions.alias("positions"), *keys)


def training_order(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The taken copies in training order: the plan's columns but positions, and copy int (from 0), position double and start
    bigint, the words of the mix before it.

    Range-partitioned and sorted by position (then id, middle and copy), and numbered where they lie: each partition counts
    its own words, and one row for each partition tells how many are ahead of it. The sorted rows are written down first, so
    that the numbers fit the order that is read. An empty plan gives no rows.
    """
    spark = plan.sparkSession
    taken = plan.select(*(c for c in plan.columns if c != "positions"), F.posexplode("positions").alias("copy", "position"))
    order = ["position", id_col, "middle", "copy"]
    fields = ", ".join(f"`{c}` {taken.schema[c].dataType.simpleString()}" for c in taken.columns)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = np.asarray(batch.column(batch.schema.get_field_index("size")))
            ends = first + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(ends - sizes)], [*batch.schema.names, "part", "first"])
            first = int(ends[-1]) if len(ends) else first

    rows = taken.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(numbered, f"{fields}, part int, first bigint")
    rows = materialise(rows, "order")
    ahead = rows.groupBy("part").agg(F.sum("size").alias("n"))
    ahead = ahead.withColumn("ahead", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.join(F.broadcast(ahead.select("part", "ahead")), "part").select(*taken.columns, (F.col("ahead") + F.col("first")).alias("start"))


def taken_words(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What the training order takes of each row of a plan: id_col, size, source_size, target, taken bigint (words, repeats
    counted), first_position and last_position double, and first_start bigint (words of the mix before its first copy); the
    last three are null where nothing is taken."""
    own = [c for c in plan.columns if c != "positions"]
    copies = training_order(plan, id_col).groupBy(*own).agg(F.sum("size").alias("taken"), F.min("position").alias("first_position"), F.max("position").alias("last_position"), F.min("start").alias("first_start"))
    none = {"taken": F.lit(0).cast("long"), "first_position": F.lit(None).cast("double"), "last_position": F.lit(None).cast("double"), "first_start": F.lit(None).cast("long")}
    left_out = plan.where(F.size("positions") == 0).select(*own).withColumns(none)
    return copies.unionByName(left_out).select(id_col, "size", "source_size", "target", "taken", "first_position", "last_position", "first_start")


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents themselves, each as often as the mix takes it, in training order and with their own columns only.

    Rows are told apart by a hash of all their columns, so rows that share an id, or have none, each follow their own plan;
    rows that are equal in all columns are one here, taken as often as they are together. So the words of a source come within
    half a document of its target, whatever the ids. Names of columns can't clash.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.lit(23), *docs.columns).alias("key"), F.xxhash64(F.lit(41), *docs.columns).alias("more"))
    rows = rows.select("doc", F.struct("key", "more").alias("key"), *(F.col(f"doc.`{c}`").alias(name) for c, name in ((id_col, "id"), (text_col, "text"), (source_col, "source"))))
    plan = mixing_plan(rows, id_col="id", text_col="text", source_col="source", key_col="key")
    taken = plan.select(F.col("key").alias("planned"), F.explode("positions").alias("position"))
    one = rows.groupBy("key").agg(F.first("doc").alias("doc"))
    mixed = one.join(taken, F.col("key") == F.col("planned")).select("key", "doc", "position")
    return mixed.repartitionByRange("position", "key").sortWithinPartitions("position", "key").select("doc.*")
