"""Line deduplication by overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.common import stage, table, text_of

WIDTH = 3


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove later occurrences of passages of three or more lines that occur elsewhere before.

    Lines are split at line feeds. Each run of three lines that are not blank (spaces and tabs
    only; blank lines between them are passed over) is a window. Of the windows with the same
    three lines, the one with the lowest (id, md5 of the text, place) stays; the lines of all
    others are covered, and every covered line goes. Windows overlap, so longer passages go
    whole. Windows are compared by 128 bits of hash.

    Returns all columns of docs with text_col replaced, and `n_lines`, `removed_lines` (ascending
    line numbers from 0); columns of these names, or "covered id" and "covered doc", are refused. Null
    texts stay null. Texts of fewer than three filled lines are never changed, and a repeated
    passage of one or two lines between unlike lines stays. Rows that share id and text are one document: what
    goes from one goes from the other. Null ids come first. No rows: no rows.
    """
    if clash := {"n_lines", "removed_lines", "covered id", "covered doc"}.intersection(docs.columns):
        raise ValueError(f"columns in the way: {sorted(clash)}")
    lines = F.split(text_of(text_col), "\n")
    # windows and their counts are small beside the texts: staged once, read for the counts and for the places
    filled = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line"))), lambda x: x["line"].rlike(r"[^ \t\r]"))
    w = F.col("filled")
    count = F.size(w) - (WIDTH - 1)
    three = lambda i, of: [w[i + k][of] for k in range(WIDTH)]
    window = lambda i: F.struct(i.alias("n"), F.array(*three(i, "at")).alias("at"), F.xxhash64(*three(i, "line")).alias("h1"), F.xxhash64(F.lit("second"), *three(i, "line")).alias("h2"))
    each = docs.select(F.col(id_col).alias("id"), F.md5(text_of(text_col)).alias("doc"), filled.alias("filled")).where(F.size("filled") >= WIDTH)
    windows = stage(each.select("id", "doc", F.explode(F.transform(F.sequence(F.lit(0), count - 1), window)).alias("w")).select("id", "doc", "w.*"), "line-windows")
    place = F.struct("id", "doc", "n")
    repeated = stage(windows.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1").drop("times"), "line-windows-repeated")
    later = windows.join(repeated.hint("merge"), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    covered = later.select("id", "doc", F.explode("at").alias("line")).groupBy("id", "doc").agg(F.collect_set("line").alias("covered"))
    covered = stage(covered.select(F.col("id").alias("covered id"), F.col("doc").alias("covered doc"), F.array_sort("covered").alias("removed_lines")), "lines-covered")

    joined = docs.join(covered.hint("merge"), docs[id_col].eqNullSafe(F.col("covered id")) & (F.md5(text_of(text_col)) == F.col("covered doc")), "left")
    n = F.size(F.split(text_of(text_col), "\n"))
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("removed_lines"))
    # an array of one, so that lines and places are made once and not for every line
    both = F.array(F.struct(lines.alias("lines"), kept.alias("kept")))
    left = F.transform(both, lambda x: F.array_join(F.transform(x["kept"], lambda i: F.get(x["lines"], i)), "\n"))
    text = F.when(F.col("removed_lines").isNull(), docs[text_col]).otherwise(F.get(left, 0))
    return joined.select(
        *[text.alias(c) if c == text_col else docs[c] for c in docs.columns],
        F.when(docs[text_col].isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.size("removed_lines").cast("long").alias("n_removed"), F.array_join("removed_lines", ",").alias("removed_lines"), F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


OP7_SQL = r"""
WITH doc AS (SELECT doc_id, text, md5(coalesce(text, '')) AS h, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT DISTINCT doc_id, h, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM doc),
filled AS (SELECT *, row_number() OVER w - 1 AS n FROM line WHERE regexp_matches(line, '[^ \t\r]') WINDOW w AS (PARTITION BY doc_id, h ORDER BY pos)),
wins AS (SELECT doc_id, h, n, pos AS a0, lead(pos, 1) OVER w AS a1, lead(pos, 2) OVER w AS a2, line AS l0, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2 FROM filled WINDOW w AS (PARTITION BY doc_id, h ORDER BY n)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id NULLS FIRST, h, n) AS place FROM wins WHERE a2 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, h, unnest([a0, a1, a2]) AS pos FROM ranked WHERE place > 1),
removed AS (SELECT doc_id, h, count(*) AS n, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS list FROM gone GROUP BY ALL),
kept AS (SELECT l.doc_id, l.h, string_agg(line, chr(10) ORDER BY l.pos) AS text FROM line l ANTI JOIN gone g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.h = g.h AND l.pos = g.pos GROUP BY ALL)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(d.lines) END::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_removed, coalesce(r.list, '') AS removed_lines,
       length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END)::BIGINT AS kept_chars, md5(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END) AS kept_md5
FROM doc d LEFT JOIN removed r ON d.doc_id IS NOT DISTINCT FROM r.doc_id AND d.h = r.h LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.h = k.h
"""


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of repeated passages; n_chars follows the text."""
    out = dedup_lines(docs).drop("n_lines", "removed_lines")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else out
