"""Scalar functions, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGEST = r"^[0-9a-fA-F]{64}$"
COMMIT = r"^[0-9a-f]{40}$"
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
# These two patterns decide what counts.
CANDIDATE = r"^[A-Za-z0-9](?:[A-Za-z0-9_.-]*[A-Za-z0-9])?$"
LOCAL_PATH = r"(?:^|[\s\"'(=])(?:/Users/[^\s\"')]+|/home/[^\s\"')]+|[A-Za-z]:\\[^\s\"')]+)"


def is_close(value: Column, target: Column, relative: float = 1e-5, absolute: float = 1e-8) -> Column:
    return F.abs(value - target) <= F.lit(absolute) + F.lit(relative) * F.abs(target)


def seconds_to_samples(seconds: Column, rate: Column) -> Column:
    """Whole samples of a duration; null if that isn't a positive whole number, within rounding."""
    samples = seconds * rate
    whole = F.rint(samples)
    return F.when(is_close(samples, whole) & (whole > 0), whole.cast("long"))


def all_finite(values: Column) -> Column:
    return F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def non_empty(text: Column) -> Column:
    return F.coalesce(F.length(F.trim(text)) > 0, F.lit(False))


def matches(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))


def is_https_url(url: Column) -> Column:
    """An https address with a host, without user, query or fragment."""
    part = lambda name: F.try_parse_url(url, F.lit(name))
    good = (part("PROTOCOL") == "https") & (F.length(part("HOST")) > 0) & part("USERINFO").isNull() & part("QUERY").isNull() & part("REF").isNull()
    return F.coalesce(good, F.lit(False))


def file_url(base: Column, name: Column) -> Column:
    return F.concat(base, F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")))


def local_paths(text: Column) -> Column:
    """Paths of one machine in a text, without the white space, quote, bracket or equals sign before each; white space is ASCII's."""
    found = F.regexp_extract_all(text, F.lit(f"({LOCAL_PATH})"), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, r"^[\s\"'(=]", ""))


def utc_text(moment: Column) -> Column:
    """UTC in ISO 8601 with microseconds and Z, for a session in UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def minutes_seconds(seconds: Column) -> Column:
    """MM:SS of whole seconds, halves to even; minutes go beyond 59."""
    whole = F.rint(F.greatest(seconds, F.lit(0.0))).cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60), whole % 60)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def count_map(entries: Column) -> Column:
    """Map of collected (key, count) structs, in key order."""
    return F.map_from_entries(F.array_sort(entries))


def refuse(ok: Column, message: Column) -> Column:
    """True where ``ok``; anything else fails the job with the message."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole == 0, F.lit(empty)).otherwise(part / whole)
