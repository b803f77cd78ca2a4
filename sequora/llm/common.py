"""What the operators of this package share: staged tables, batches of bounded size, id columns."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one where it is unset and Spark runs on this machine alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-stages-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that column `text` of each holds about max_bytes at most (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * max_bytes / max(1, batch.column(text).nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def gathered(batches, least: int):
    """Record batches joined until they hold `least` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def limit_threads() -> None:
    """Tasks share cores with other tasks: native libraries must not start a pool in each."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def prepare(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch (rows hold whole texts) and let Python workers import this package.

    On a cluster the package is installed or given with --py-files; there this adds a path that
    does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
