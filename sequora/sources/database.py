"""Source tables of a database, read in pieces that the database itself has counted."""

from __future__ import annotations

import os.path
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from sequora.sources.contracts import SOURCE_COLUMNS
from sequora.sources.readers import text_schema

#: A condition on rows, and how many rows meet it.
Piece = tuple[str, int]


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _starts(column: str, n: int, starts: list[str]) -> str:
    return f"SUBSTR({column}, 1, {n}) IN ({', '.join(map(_literal, starts))})"


def pieces(ask: Callable[[str], list[tuple]], table: str, columns: list[str], rows_per_read: int, where: str = "1=1") -> Iterator[Piece]:
    """Conditions that each row of the table meets exactly one of, for rows_per_read rows at most where values tell rows apart.

    Rows are parted by the first characters of the first column, as many as are needed; those that
    share one value of it, or have none, by the columns after it. Only rows equal in all columns
    stay together. `ask` is given SQL that returns a row for each start of a crowded start, so what
    comes to the driver grows with the number of reads and not with the table.
    """
    ((rows,),) = ask(f"SELECT COUNT(*) AS c FROM {table} WHERE {where}")
    if rows <= rows_per_read or not columns:
        if rows:
            yield where, rows
        return
    k, n, crowded, seen = columns[0], 1, None, 0
    while crowded is None or crowded:
        inside = f"({where}) AND {_starts(k, crowded_n, [p for p, _ in crowded])}" if crowded else f"({where}) AND {k} IS NOT NULL"
        groups = ask(f"SELECT p, COUNT(*) AS c, MIN(k) AS low, MAX(k) AS high FROM (SELECT SUBSTR({k}, 1, {n}) AS p, {k} AS k FROM {table} WHERE {inside}) x GROUP BY p")
        if crowded is None:
            seen = sum(r[1] for r in groups)
        crowded, crowded_n = [], n
        for p, count, low, high in groups:
            if count <= rows_per_read:
                yield f"({where}) AND {_starts(k, n, [p])}", count
            elif low == high or len(p) < n:
                yield from pieces(ask, table, columns[1:], rows_per_read, f"({where}) AND {_starts(k, n, [p])}")
            else:
                crowded.append((p, len(os.path.commonprefix([low, high]))))
        if crowded:
            n = max(n, min(shared for _, shared in crowded)) + 1
    if rows > seen:
        yield from pieces(ask, table, columns[1:], rows_per_read, f"({where}) AND {k} IS NULL")


def together(found: Iterator[Piece], rows_per_read: int) -> list[str]:
    """One condition for each read: neighbouring pieces joined as long as they stay within rows_per_read."""
    reads, held, rows = [], [], 0
    for where, count in found:
        if held and rows + count > rows_per_read:
            reads.append(" OR ".join(held))
            held, rows = [], 0
        held.append(f"({where})")
        rows += count
    return [*reads, " OR ".join(held)] if held else reads


def read_table(spark: SparkSession, url: str, name: str, columns: list[str], schema: str = "", rows_per_read: int = 1_000_000, as_text: str = "{}", **options: str) -> DataFrame:
    """These columns of a table as text; each partition reads about rows_per_read rows over its own connection.

    Rows are counted when the frame is made: rows that come later with a start nobody had are not
    read. For one state of the database over all connections give `sessionInitStatement` (PostgreSQL:
    SET TRANSACTION ISOLATION LEVEL REPEATABLE READ; SET TRANSACTION SNAPSHOT '<one that is held>').
    Columns must be text in the database; `as_text` says how others are made so for the conditions
    (CAST({} AS VARCHAR(64))). The database counts characters as Unicode code points, or keys have
    none beyond 16 bits. An empty table gives an empty frame, a missing one the database's error.
    """
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    table = ".".join(quote(x) for x in (schema, name) if x)
    given = {"fetchsize": "10000"} | options

    def ask(sql: str) -> list[tuple]:
        return [tuple(r) for r in spark.read.format("jdbc").options(url=url, query=sql, **given).load().collect()]

    reads = together(pieces(ask, table, [as_text.format(quote(c)) for c in columns], rows_per_read), rows_per_read)
    shape = ", ".join(f"`{f.name}` STRING" for f in text_schema(columns))
    return spark.read.jdbc(url, table, predicates=reads or ["1=0"], properties=given | {"customSchema": shape}).select(*columns)


def load_database(spark: SparkSession, url: str, tables: dict[str, list[str]] = SOURCE_COLUMNS, **how) -> dict[str, DataFrame]:
    """One frame for each table, as `readers.load` gives them from files."""
    return {t: read_table(spark, url, t, columns, **how) for t, columns in tables.items()}
