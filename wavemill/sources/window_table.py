"""A table of windows in folders by partition and in buckets by record."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wavemill.operators.lineage import gated_partition, read_partition
from wavemill.sources.scratch import shared_path


def write_bucketed(rows: DataFrame, name: str, path: str, buckets: int = 64, partition_by: str | None = None, key: str = "record_id") -> DataFrame:
    """Save ``rows`` as table ``name`` at ``path``, in buckets by ``key`` and, if wanted, in folders by ``partition_by``; create-only.

    Rows are dealt by the key as buckets are, so each bucket of a folder is one file, sorted by the key. Tables with equal
    numbers of buckets join on the key where they lie. A record is in one bucket: choose so many that one holds few records.
    """
    writer = rows.repartition(buckets, key).write.format("parquet").mode("errorifexists").option("path", path)
    writer = writer.bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
    return rows.sparkSession.table(name)


def write_window_table(windows: DataFrame, assignment: DataFrame, name: str, path: str, buckets: int = 64) -> DataFrame:
    """Windows with the partition and subject of their record, in folders by partition and in buckets by record."""
    members = assignment.select("record_id", "subject_id", "partition")
    return write_bucketed(windows.join(members, "record_id"), name, path, buckets, "partition")


def read_window_partition(spark: SparkSession, name: str, partition: str, approvals: DataFrame | None = None, run_id: str | None = None) -> DataFrame:
    """Windows of one partition of a table, from the files of its folder only. The protected one, test, takes an approval of
    the run, and is refused without."""
    rows = spark.table(name)
    if approvals is not None:
        return gated_partition(rows, approvals, run_id, partition)
    return read_partition(rows, partition)


def scratch_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """A new table name and path, for tables that live as long as the application."""
    return f"{label}_{uuid.uuid4().hex}", shared_path(spark, label)
