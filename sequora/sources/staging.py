"""Frames written to the folder that all executors share and read again: lineage and plans stay short."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; a temporary one if that is unset and Spark runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-stage-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """The rows of df, computed once and read back, so a lost executor costs a task and readers know their size."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was staged at a path, if anything is there."""
    fs, p = _path(spark, path)
    fs.delete(p, True)
