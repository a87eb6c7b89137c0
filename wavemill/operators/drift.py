"""Items whose attributes left a closed vocabulary or disagree with a snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vocabulary_drift(items: DataFrame, key: str, values: str, vocabulary: DataFrame) -> DataFrame:
    """key, unknown: for each item with values outside the vocabulary, those values in their order.

    ``values`` names an array column; ``vocabulary`` has value.
    """
    rows = items.select(key, F.posexplode(values).alias("place", "value"))
    rows = rows.join(vocabulary.select("value"), "value", "left_anti")
    found = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("rows"))
    return found.select(key, F.transform("rows", lambda x: x["value"]).alias("unknown"))


def snapshot_drift(items: DataFrame, snapshot: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """key, problems: not_in_snapshot for an item without a row there, else the names of the rules that hold."""
    there = F.col("__there").isNotNull()
    named = [F.when(~there, "not_in_snapshot"), *(F.when(there & F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items())]
    rows = items.join(snapshot.withColumn("__there", F.lit(1)), key, "left")
    return rows.select(key, F.array_compact(F.array(*named)).alias("problems")).where(F.size("problems") > 0)


def conflicting_options(rows: DataFrame, field: str, option: str) -> DataFrame:
    """Fields with more than one option."""
    return rows.groupBy(field).agg(F.count_distinct(option).alias("options")).where("options > 1")
