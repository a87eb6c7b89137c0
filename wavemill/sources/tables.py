"""Scans and sinks. Paths go through Spark's readers and writers, so any store that Spark knows will do; only digests of large files
and times of empty ones need a store that Arrow knows too."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemill import schemas
from wavemill.functions.scalars import all_finite, refuse


def scan_records(spark: SparkSession, path: str, schema: str, configured: DataFrame | None = None, key: str = "record_id", form: str = "parquet") -> DataFrame:
    """Typed scan; with ``configured``, rows of those ids only."""
    rows = spark.read.schema(schema).format(form).load(path)
    return rows if configured is None else rows.join(configured.select(key).distinct(), key, "left_semi")


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of JSON manifests: schema_version, path, size_bytes, sha256; malformed JSON fails the read."""
    rows = spark.read.schema(schemas.MANIFEST).option("mode", "FAILFAST").option("multiLine", True).json(path)
    return rows.select("schema_version", F.inline("files"))


#: Files of this size and larger are read in blocks instead of as one row.
STREAMED_BYTES = 64 << 20
_BLOCK = 1 << 20


def _files(spark: SparkSession, path: str, glob: str, recursive: bool) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that a path names, and the path as it takes it."""
    where = urlsplit(quote(path, safe="/:@=+,"))
    return (fs.LocalFileSystem(), unquote(where.path)) if where.scheme in ("", "file") else fs.FileSystem.from_uri(where.geturl())


def stream_digest(path: str) -> str:
    """sha256 of a file of any size, read in blocks of 1 MiB from the store that its path names."""
    store, name = _store(path)
    digest = hashlib.sha256()
    with store.open_input_stream(name, buffer_size=0) as file:
        while block := file.read(_BLOCK):
            digest.update(block)
    return digest.hexdigest()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [stream_digest(path) for path in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], ["path", "size_bytes", "modified", "sha256"])


def _empty_files(spark: SparkSession, found: DataFrame) -> DataFrame:
    """path, size_bytes, modified of files without bytes, which Spark lists but doesn't scan. The list of names is the one that
    the driver holds for the scan anyway; tasks ask the store for the size and time of those that the scan left out."""
    listed = [(re.sub("^([^:/]+):///", r"\1:/", unquote(name)),) for name in found.inputFiles()]
    names = spark.createDataFrame(listed, "path string").join(found.select("path"), "path", "left_anti")

    def stat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            infos = [store.get_file_info(name) for store, name in map(_store, batch.column(0).to_pylist())]
            sizes, times = pa.array([i.size for i in infos], pa.int64()), pa.array([i.mtime for i in infos], pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, times], ["path", "size_bytes", "modified"])

    return names.mapInArrow(stat, "path string, size_bytes bigint, modified timestamp").where("size_bytes = 0")


def file_inventory(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """path, size_bytes, sha256, modified of files of any size, those without bytes included.

    Files below ``STREAMED_BYTES`` are digested as rows, where Spark reads them; contents of larger ones are no row, but are read
    in blocks by the task that has the path, through the store's own file system, in flat memory. Names that begin with an
    underscore or a dot are no files to Spark.
    """
    found = _files(spark, path, glob, recursive)
    small = found.where(F.col("length") < STREAMED_BYTES).select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    large = found.where(F.col("length") >= STREAMED_BYTES).select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    large = large.mapInArrow(_streamed, "path string, size_bytes bigint, modified timestamp, sha256 string")
    empty = _empty_files(spark, found).withColumn("sha256", F.sha2(F.lit(b""), 256))
    return small.unionByName(large).unionByName(empty).select("path", "size_bytes", "sha256", "modified")


def file_sizes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The same without digests: contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def discover_shards(spark: SparkSession, paths: Sequence[str], glob: str = "*.parquet") -> DataFrame:
    """Files directly in the folders, sorted: path. A file that the folders name twice fails the job."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", False)
    found = None
    for path in paths:
        one = files.load(path).select("path")
        found = one if found is None else found.unionByName(one)
    found = found.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    return found.where(refuse(F.col("n") == 1, F.concat(F.lit("named twice: "), F.col("path")))).select("path").orderBy("path")


#: Columns that windows must have.
WINDOW_FIELDS = ("record_id", "ordinal", "center_sample_index", "source_symbol", "target_value")


def scan_window_metadata(windows: DataFrame, version: int = 1, required: Sequence[str] = WINDOW_FIELDS) -> DataFrame:
    """Windows without their samples, which a columnar scan then doesn't read.

    A required column that isn't there is an error when the plan is made; a row of another schema version (a table without
    schema_version is of the first) fails the job.
    """
    absent = [c for c in required if c not in windows.columns]
    if absent:
        raise ValueError(f"windows lack {', '.join(absent)}")
    rows = windows.drop("window")
    if "schema_version" not in rows.columns:
        return rows
    said = F.coalesce(F.col("schema_version").cast("string"), F.lit("null"))
    return rows.where(refuse(F.col("schema_version").eqNullSafe(F.lit(version)), F.concat(F.lit("windows of schema version "), said)))


def scan_windows(windows: DataFrame, width: int, classes: Sequence[int]) -> DataFrame:
    """Windows with valid: right width, all finite, a known class."""
    valid = (F.size("window") == width) & all_finite(F.col("window")) & F.col("target_value").isin(*classes)
    return windows.withColumn("valid", F.coalesce(valid, F.lit(False)))


def write_windows(windows: DataFrame, path: str) -> None:
    """One folder for each record; an existing path is an error, never overwritten."""
    windows.repartition("record_id").write.partitionBy("record_id").mode("errorifexists").parquet(path)


def write_new(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").parquet(path)


def as_report(rows: DataFrame) -> DataFrame:
    """Rows as JSON with their keys in order: json string."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("json"))


def write_report(rows: DataFrame, path: str) -> None:
    """A small report as sorted JSON lines in one file, create-only."""
    as_report(rows).orderBy("json").coalesce(1).write.mode("errorifexists").text(path)


def scan_wide_csv(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """A header-less numeric CSV: the last column is the label, those before it the window."""
    schema = ", ".join(f"c{k} double" for k in range(columns))
    rows = spark.read.schema(schema).option("header", False).csv(path)
    return rows.select(F.array(*(f"c{k}" for k in range(columns - 1))).alias("window"), F.col(f"c{columns - 1}").cast("int").alias("target_value"))
