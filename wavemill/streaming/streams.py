"""Stateless scoring with a frozen model, and symbol counts under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemill.operators.model import CentroidModel, score


def score_stream(windows: DataFrame, model: CentroidModel, vector: str = "window") -> DataFrame:
    """Streaming windows with prediction and margin; stateless."""
    return score(windows, model, vector)


def stream_symbol_counts(annotations: DataFrame, every: str = "1 hour", late: str = "10 minutes", time: str = "ts") -> DataFrame:
    """Counts by event-time window and symbol; rows over ``late`` behind the watermark are left out of closed windows."""
    rows = annotations.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    counts = rows.groupBy(F.window(time, every).alias("w"), "symbol").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), "symbol", "n")
