"""Shared-storage scratch tables and connected components."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``. If that is unset, a local folder serves a local
    master, as in tests; on a cluster it is an error, since each machine would write to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "wavemill-scratch")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/wavemill/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder when the application's JVM ends: a lazy result may be read until then."""
    files, path = _file_system(spark, path)
    files.deleteOnExit(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Let Arrow batches have ``rows`` rows at most for what is written within, for the memory of workers that hold whole texts."""
    before = spark.conf.get(_BATCH_ROWS, "10000")
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def give_back() -> None:
    """Hand memory that this process has freed back to the system: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim is not None:
        trim(0)


def giving_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's batches, after which the worker keeps no freed memory: it waits for tasks of other stages."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back: lineage ends there, so a lost executor costs only a reread.

    The files go with :func:`discard`, or when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialised tables that nothing reads any more."""
    for df in tables:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            if "/wavemill/" in folder:
                files, path = _file_system(df.sparkSession, folder)
                files.delete(path, True)


#: Edges beyond which a node is a hub, and the most hubs that are broadcast; with more of them, none is a large part of a task.
HUB_EDGES = 100_000
MOST_HUBS = 100_000


def _with_low(edges: DataFrame, low: DataFrame, total: int) -> DataFrame:
    """``edges`` (u, v), ``total`` at most, with the m of their u from ``low`` (u, m, n), n being the number of u's edges.

    The edges of hubs stay where they are and look it up among the hubs, of which there are fewer than edges / ``HUB_EDGES``;
    the others meet by a shuffle. So no task gathers the edges of a hub.
    """
    hubs = low.where(F.col("n") > HUB_EDGES).select("u", "m")
    if total <= HUB_EDGES or not 0 < hubs.count() <= MOST_HUBS:
        return edges.join(low.select("u", "m"), "u")
    rest = edges.join(F.broadcast(hubs.select("u")), "u", "left_anti")
    return edges.join(F.broadcast(hubs), "u").unionByName(rest.join(low.where(F.col("n") <= HUB_EDGES).select("u", "m"), "u"))


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Components of an undirected graph: one row (node, component) per node that has an edge to another.

    Alternates the large-star and small-star rewirings until the edge set stops changing, which ends with every node
    joined to the smallest id of its component. Each round is a partial aggregate for the minima and a join by node, in
    which hubs are looked up where their edges lie. Rounds grow with the logarithm of the longest chain. Edges with a null
    end and loops are ignored; repeated edges count once; an empty graph gives no rows.
    """
    a, b = F.col(left), F.col(right)
    edges = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, state = _round_end(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        above = F.col("v") > F.col("u")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(above).alias("n"))
        large = _with_low(both.where(above), low, state[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = _with_low(large, low, state[0]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, now = _round_end(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        discard(edges)
        edges, before, state = after, state, now
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _round_end(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = materialise(edges, "edges")
    return edges, tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
