"""Windows around annotations: an interval join written as an equi join on chunks of the sample axis, each with a halo."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemill.functions.scalars import refuse, seconds_to_samples
from wavemill.operators.ordered import with_previous


@dataclass(frozen=True)
class WindowConfig:
    """Seconds before and after an annotation, and the channel by name or else by index."""

    pre_seconds: float
    post_seconds: float
    channel_name: str | None = None
    channel_index: int | None = None


def chunk_signal(samples: DataFrame, chunk_size: int) -> DataFrame:
    """Chunks of (record_id, channel_name, sample_index, value) rows, of ``chunk_size`` samples each: record_id, channel_name,
    chunk_id, start_index, n_samples, samples.

    A chunk may begin late or end early, which is a gap between chunks; a sample that is missing or repeated within one fails the job.
    """
    rows = samples.withColumn("chunk_id", F.floor(F.col("sample_index") / chunk_size)).groupBy("record_id", "channel_name", "chunk_id")
    ordered = F.array_sort(F.collect_list(F.struct("sample_index", "value")))
    found = rows.agg(F.min("sample_index").alias("start_index"), F.max("sample_index").alias("last"), F.count(F.lit(1)).alias("n_samples"), ordered.alias("rows"))
    whole = refuse(F.col("last") - F.col("start_index") + 1 == F.col("n_samples"), F.concat(F.lit("samples missing or repeated in a chunk of record "), F.col("record_id")))
    return found.where(whole).select("record_id", "channel_name", "chunk_id", "start_index", "n_samples", F.transform("rows", lambda x: x["value"]).alias("samples"))


def haloed_chunks(chunks: DataFrame, pre: Column, post: Column, chunk_size: int) -> DataFrame:
    """Each chunk with the ``pre`` samples before and the ``post`` after it: record_id, channel_name, chunk_id, parts, samples.

    Chunks send their borders to their neighbours, as many as a border reaches, in the one exchange that groups them.
    parts is a sorted array of (start, n) of what came, which shows gaps; samples is all of it, in order.
    """
    size = F.col("n_samples") if "n_samples" in chunks.columns else F.size("samples")
    rows = chunks.select("record_id", "channel_name", F.col("start_index").alias("start"), (F.col("start_index") + size).alias("end"), "samples", pre.alias("pre"), post.alias("post"))
    first = F.greatest(F.floor((F.col("start") + 1 - F.col("post")) / chunk_size), F.lit(0))
    last = F.ceil((F.col("end") + F.col("pre")) / chunk_size) - 1
    rows = rows.where("end > start").withColumn("chunk_id", F.explode(F.sequence(first, F.greatest(first, last))))
    low = F.greatest(F.col("start"), F.col("chunk_id") * chunk_size - F.col("pre"))
    high = F.least(F.col("end"), (F.col("chunk_id") + 1) * chunk_size - 1 + F.col("post"))
    rows = rows.withColumns({"low": low, "n": high - low}).where("n > 0")
    piece = F.slice("samples", (F.col("low") - F.col("start") + 1).cast("int"), F.col("n").cast("int"))
    # two lists, so that a plan that needs no samples carries none
    parts = F.array_sort(F.collect_list(F.struct(F.col("low").alias("start"), "n"))).alias("parts")
    pieces = F.array_sort(F.collect_list(F.struct("low", piece.alias("piece")))).alias("pieces")
    grouped = rows.groupBy("record_id", "channel_name", "chunk_id").agg(parts, pieces)
    return grouped.select("record_id", "channel_name", "chunk_id", "parts", F.flatten(F.transform("pieces", lambda x: x["piece"])).alias("samples"))


def window_geometry(records: DataFrame, config: WindowConfig) -> DataFrame:
    """record_id with pre and post in samples; null where a duration isn't a positive whole number of samples."""
    rate = F.col("sample_rate_hz")
    return records.select("*", seconds_to_samples(F.lit(config.pre_seconds), rate).alias("pre"), seconds_to_samples(F.lit(config.post_seconds), rate).alias("post"))


def resolve_channel(records: DataFrame, config: WindowConfig) -> DataFrame:
    """record_id, channel_index, channel_name and, where the channel isn't there, a message that lists those available."""
    names = F.col("channel_names")
    if config.channel_name is not None:
        index = F.array_position(names, config.channel_name) - 1
    else:
        index = F.lit(config.channel_index if config.channel_index is not None else 0).cast("long")
    found = records.withColumn("found", index)
    there = (F.col("found") >= 0) & (F.col("found") < F.size(names))
    missing = F.concat(F.lit(f"no channel {config.channel_name or config.channel_index}; available: "), F.array_join(names, ", "))
    return found.select(
        "record_id",
        F.when(there, F.col("found")).alias("channel_index"),
        F.when(there, F.try_element_at(names, (F.col("found") + 1).cast("int"))).alias("channel_name"),
        F.when(there, F.lit(None).cast("string")).otherwise(missing).alias("message"),
    )


def classify_bounds(left: Column, right: Column, sample_count: Column) -> Column:
    """'left' if a window begins before the record, else 'right' if it ends after it, else 'emitted'."""
    return F.when(left < 0, "left").when(right > sample_count, "right").otherwise("emitted")


def window_bounds(annotations: DataFrame, records: DataFrame, config: WindowConfig) -> DataFrame:
    """Annotations with left (inclusive), right (exclusive) and status."""
    geometry = window_geometry(records, config).select("record_id", "sample_count", "pre", "post")
    rows = annotations.join(geometry, "record_id")
    rows = rows.withColumns({"left": F.col("sample_index") - F.col("pre"), "right": F.col("sample_index") + F.col("post")})
    return rows.withColumn("status", classify_bounds(F.col("left"), F.col("right"), F.col("sample_count")))


def records_with_windows(annotations: DataFrame, records: DataFrame, config: WindowConfig) -> DataFrame:
    """record_id of the records that have a window within their bounds, without reading samples."""
    bounds = window_bounds(annotations, records, config).where("status = 'emitted'")
    channels = resolve_channel(records, config).where("channel_name is not null").select("record_id")
    return bounds.select("record_id").distinct().join(channels, "record_id", "left_semi")


def extract_windows(annotations: DataFrame, chunks: DataFrame, records: DataFrame, config: WindowConfig, chunk_size: int) -> DataFrame:
    """One array of samples for each mapped annotation whose window lies within its record.

    Overlap-save: a window belongs to the chunk of its centre, which with its halo holds all of it, so each window is one slice.
    Samples are exchanged once, by (record_id, channel_name, chunk_id), which spreads long records over tasks; annotations
    meet them there, and no window is exchanged. The halo is that of the longest window of any record. Windows of
    less than full width (a gap in the samples) are left out. Where ``window`` isn't used, no sample is read or moved.
    """
    channels = resolve_channel(records, config).where("channel_name is not null").select("record_id", "channel_name")
    bounds = window_bounds(annotations, records, config).where("status = 'emitted'").join(channels, "record_id")
    bounds = bounds.withColumn("chunk_id", F.floor(F.col("sample_index") / chunk_size))
    widest = window_geometry(records, config).agg(F.max("pre").alias("widest_pre"), F.max("post").alias("widest_post"))
    halos = haloed_chunks(chunks.crossJoin(F.broadcast(widest)), F.col("widest_pre"), F.col("widest_post"), chunk_size)
    met = bounds.join(halos, ["record_id", "channel_name", "chunk_id"])
    within = lambda x, low, high: F.greatest(F.least(high, x["start"] + x["n"]) - F.greatest(low, x["start"]), F.lit(0))
    total = lambda low, high: F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + within(x, low, high))
    left, right = F.col("left"), F.col("right")
    whole = met.where(total(left, right) == right - left)
    skipped = total(F.lit(-(1 << 62)), left)
    window = F.slice("samples", (skipped + 1).cast("int"), (right - left).cast("int"))
    return whole.select("record_id", "ordinal", F.col("sample_index").alias("center_sample_index"), F.col("symbol").alias("source_symbol"), "target_value", "left", "right", window.alias("window"))


def with_overlap(bounds: DataFrame) -> DataFrame:
    """Adds overlaps: whether an emitted window begins before the one before it ends (strictly)."""
    rows = with_previous(bounds.where("status = 'emitted'"), "record_id", "ordinal", {"before": "right"})
    return rows.withColumn("overlaps", F.coalesce(F.col("left") < F.col("before"), F.lit(False))).drop("before")


def extraction_report(annotations: DataFrame, records: DataFrame, config: WindowConfig) -> DataFrame:
    """Counts by record, zeros where a record has no window: record_id, emitted, left, right, overlaps, class_0, class_1."""
    bounds = window_bounds(annotations, records, config)
    status = lambda x: F.count_if(F.col("status") == x).alias(f"n_{x}")
    target = lambda x: F.count_if((F.col("status") == "emitted") & (F.col("target_value") == x)).alias(f"class_{x}")
    counts = bounds.groupBy("record_id").agg(status("emitted"), status("left"), status("right"), target(0), target(1))
    overlaps = with_overlap(bounds).groupBy("record_id").agg(F.count_if("overlaps").alias("n_overlaps"))
    out = records.select("record_id").join(counts, "record_id", "left").join(overlaps, "record_id", "left")
    return out.na.fill(0, [c for c in out.columns if c != "record_id"])


def autocorrelation(windows: DataFrame, max_lag: int, key: tuple[str, ...] = ("record_id", "ordinal")) -> DataFrame:
    """r(h) of each window for lags 0 to ``max_lag``, or to its last: key, lag int, r double (null for a constant window, or one
    with a null or a number that isn't finite).

    By the power spectrum of the window, padded with zeros to twice its length: all lags take O(n log n) in one Arrow pass,
    in which windows of one length are transformed together. A null or an empty window gives no rows.
    """
    rows = windows.where(F.size("window") > 0).select(*key, "window")

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(key))
            lengths = np.diff(np.asarray(column.offsets))
            for n in np.unique(lengths):
                some = np.flatnonzero(lengths == n)
                for low in range(0, len(some), max(1, (1 << 20) // int(n))):
                    at = some[low : low + max(1, (1 << 20) // int(n))]
                    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), n)
                    lags = min(max_lag, int(n) - 1) + 1
                    with np.errstate(invalid="ignore", over="ignore"):
                        away = values - values.mean(axis=1)[:, None]
                        size = 1 << (2 * int(n) - 1).bit_length()
                        spectrum = np.fft.rfft(away, size, axis=1)
                        power = (away * away).sum(axis=1)
                        r = np.fft.irfft(np.abs(spectrum) ** 2, size, axis=1)[:, :lags] / np.where(power > 0, power, np.nan)[:, None]
                    r = r.ravel()
                    columns = [batch.column(k).take(pa.array(np.repeat(at, lags))) for k in range(len(key))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.tile(np.arange(lags, dtype=np.int32), len(at))), pa.array(r, mask=~np.isfinite(r))], [*key, "lag", "r"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in key)
    return rows.mapInArrow(transform, f"{kinds}, lag int, r double")
