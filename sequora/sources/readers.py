"""Reading text tables, giving them types, and finding values that no type can hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequora.functions import any_of
from sequora.sources.contracts import SOURCE_COLUMNS, Table, declared

UINT_MAX = 2**64 - 1


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def load(spark: SparkSession, folder: str, format: str = "parquet", tables: dict[str, list[str]] = SOURCE_COLUMNS, **options) -> dict[str, DataFrame]:
    """One frame for each table, read from <folder>/<table> with a declared schema; nothing is inferred."""
    return {t: spark.read.format(format).options(**options).schema(text_schema(c)).load(f"{folder.rstrip('/')}/{t}") for t, c in tables.items()}


def typed(d: Table, raw: DataFrame) -> DataFrame:
    """Declared types in one projection; nullable strings read null as empty; what can't be cast is null."""
    value = lambda f: F.coalesce(F.col(f.name), F.lit("")) if "empty_for_null" in f.metadata else F.col(f.name)
    return raw.select(*[value(f).try_cast(f.dataType).alias(f.name) for f in d.schema])


def bad_value(d: Table) -> Column:
    """Whether a raw row has a value that the contract or a delimited file can't carry.

    A comparison with null is false here, as a null is counted by its own test, or allowed.
    """
    tests = []
    for field in d.schema:
        c = F.col(field.name)
        if "empty_for_null" not in field.metadata:
            tests.append(c.isNull())
        bad = {"UINT": ~c.rlike(r"\A[0-9]+\z"), "INT": ~c.rlike(r"\A-?[0-9]+\z"), "BOOL": ~F.lower(c).isin("true", "false"), "STRING": c.rlike(r'[|\\\r\n\t"]')}.get(declared(field))
        if bad is not None:
            tests.append(F.coalesce(bad, F.lit(False)))
    return any_of(tests)


def out_of_range(d: Table) -> Column:
    """Whether an unsigned value of a raw row lies beyond 64 bits."""
    number = lambda c: F.col(c).try_cast("decimal(38,0)")
    return any_of([F.coalesce((number(c) < 0) | (number(c) > F.lit(str(UINT_MAX)).cast("decimal(38,0)")), F.lit(False)) for c in (f.name for f in d.schema if declared(f) == "UINT")])


def inventory(tables: dict[str, DataFrame], expected: list[str]) -> DataFrame:
    """One row for each column of each table (rows counted), and one for each expected table that is missing."""
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for t in sorted(tables):
        columns = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable")) for k, f in enumerate(tables[t].schema)])
        parts.append(tables[t].agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), F.lit("found" if t in expected else "unexpected").alias("state"), "rows", F.explode(columns).alias("c")).select("table_name", "state", "rows", "c.*"))
    missing = [(t, "missing") for t in expected if t not in tables]
    if missing:
        parts.append(spark.createDataFrame(missing, "table_name string, state string").selectExpr("table_name", "state", "cast(null as long) rows", "cast(null as int) position", "cast(null as string) column_name", "cast(null as string) type", "cast(null as boolean) nullable"))
    return reduce(DataFrame.unionByName, parts)
