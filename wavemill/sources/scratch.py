"""Folders that all executors share, for what a query writes and reads back."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``, deleted when the application ends. If that is unset a local master gets a local
    folder, as in tests; on a cluster that is an error, since each machine would write to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "wavemill-scratch")
    path = f"{root.rstrip('/')}/wavemill/{label}-{uuid.uuid4().hex}"
    files, folder = file_system(spark, path)
    files.deleteOnExit(folder)
    return path


def file_system(spark: SparkSession, path: str) -> tuple:
    """The store's own file system, and the path as it takes it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = file_system(spark, path)
    return files.exists(folder)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read back: lineage ends there, so a lost executor costs only a reread."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
