"""The corpus pipeline: toxic documents go, repeated passages go, near-duplicates go, the rest is packed.

Each stage gets what its predecessor kept, written as Parquet and read again. All but the last
return the columns of documents. SQL cannot express the fitted classifier or the tokenizer, so
tests/llm holds the operators behind the stages against brute-force versions instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sequora.llm.common import stage, table, prepare
from sequora.llm.jaccard_join import near_dedup_stage
from sequora.llm.line_dedup import line_dedup_stage
from sequora.llm.packing import packing_stage
from sequora.llm.toxicity import toxicity_stage


def _prepared(f):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return f(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _prepared(toxicity_stage)),
    ("line_dedup", _prepared(line_dedup_stage)),
    ("near_dedup", _prepared(near_dedup_stage)),
    ("packing", _prepared(packing_stage)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
