"""Annotation symbols and their targets under a closed vocabulary.

Mappings have symbol, target_name, target_value and excluded; they are parameters of a few rows, which Spark broadcasts by
their size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_annotations(annotations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Annotations of symbols that the mapping has and doesn't exclude, with their targets."""
    known = mapping.where(~F.col("excluded")).select("symbol", "target_name", "target_value")
    return annotations.join(known, "symbol")


def exclude_records(rows: DataFrame, ids: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows of all records but those listed. A null id is never excluded."""
    return rows.join(ids.select(key), key, "left_anti")


def unknown_symbols(annotations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Symbols that the mapping doesn't have, with how often they occur; a closed world has none."""
    counts = annotations.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(mapping.select("symbol"), "symbol", "left_anti")


def mapping_report(annotations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Counts of each mapped symbol, zero where it doesn't occur: symbol, target_name, target_value, excluded, n."""
    counts = annotations.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return mapping.join(counts, "symbol", "left").select("symbol", "target_name", "target_value", "excluded", F.coalesce("n", F.lit(0)).alias("n"))


def mapping_totals(annotations: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row: input, included, excluded and unknown annotations."""
    flagged = annotations.join(mapping.select("symbol", "excluded"), "symbol", "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(~F.col("excluded")).alias("included"),
        F.count_if(F.col("excluded")).alias("excluded"),
        F.count_if(F.col("excluded").isNull()).alias("unknown"),
    )


def symbol_counts(annotations: DataFrame) -> DataFrame:
    """Counts by record and symbol, by record, and in all; level 0, 1 and 3."""
    return annotations.rollup("record_id", "symbol").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("level"))


def categorise(symbol: Column, normal: str, abnormal: Sequence[str]) -> Column:
    """0 for normal beats, 1 for abnormal ones, -1 for anything else."""
    return F.when(symbol == normal, 0).when(symbol.isin(*abnormal), 1).otherwise(-1)


def first_n_per_key(rows: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= n).drop("place")
