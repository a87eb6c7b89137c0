"""The row before, in records of any length."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Places of a record that one task orders at once.
SEGMENT = 65_536


def with_previous(rows: DataFrame, key: str, order: str, columns: Mapping[str, str], segment: int = SEGMENT) -> DataFrame:
    """Adds to each row, for each (name, column), the column's value in the row before it of the same key; null in the first.

    ``order`` is a whole number, a place in the record; rows are cut into segments of ``segment`` places, so a record of any
    length spreads over tasks. Within a segment the row before is found by a local ``lag``; the last row of each segment,
    one row in ``segment``, is carried to the next one that has rows, by a join on the partitioning that the rows already have.
    Rows of one place come in any order, as with ``lag``. A null key is a key, and a null place comes first, by itself.
    """
    # a key without nulls, so that the join finds the rows where the window has put them
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    known = rows.withColumns({"_key": name, "_segment": F.coalesce(F.floor(F.col(order) / segment), F.lit(-(1 << 62)))})
    whole = F.struct(*(F.col(c).alias(name) for name, c in columns.items()))
    borders = known.groupBy("_key", "_segment").agg(F.max_by(whole, F.struct(F.col(order).isNotNull(), F.col(order))).alias("_last"))
    carried = borders.select("_key", "_segment", F.lag("_last").over(Window.partitionBy("_key").orderBy("_segment")).alias("_carried"))
    within = Window.partitionBy("_key", "_segment").orderBy(F.col(order).asc_nulls_first())
    local = known.withColumn("_before", F.lag(whole).over(within))
    both = local.join(carried, ["_key", "_segment"], "left")
    before = F.coalesce("_before", "_carried")
    return both.select(*rows.columns, *(before[name].alias(name) for name in columns))
