"""Toxicity by cumulative-link (proportional-odds) ordinal regression on sparse text features.

P(grade > k) = sigmoid(w.x - theta_k) with one weight vector w for all of the ordered thresholds
theta_0 < theta_1 < ...; the expected severity is the sum of these over k. A feature is a word, or
the first four or five letters of one; x holds 1 for each selected feature that a text has.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.common import slices, stage, table, text_of

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)


def word_features(word: str) -> list[str]:
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def features(text: str) -> set[str]:
    return {f for w in set(WORD.findall(text.lower())) for f in word_features(w)}


@dataclass
class OrdinalModel:
    """Weights by feature, thresholds in ascending order, the severity from which texts are rejected."""

    weights: dict[str, float]
    thresholds: list[float]
    reject_from: float

    def known_features(self, words: set[str]) -> dict[str, tuple[str, ...]]:
        """The words that have features of the model, and these."""
        return {w: found for w in words if (found := tuple(f for f in word_features(w) if f in self.weights))}

    def severity(self, scores: np.ndarray) -> np.ndarray:
        return sum(1 / (1 + np.exp(np.clip(t - scores, -40, 40))) for t in self.thresholds)


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, dims: int, steps: int = 300, l2: float = 3e-4, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the cumulative-link likelihood, by Adam on all rows.

    rows: the columns at which each row is 1. Thresholds are kept in order by writing their
    differences as exponentials.
    """
    levels = int(grades.max()) + 1
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], np.int64)
    share = np.array([np.mean(grades > k) for k in range(levels - 1)]).clip(1e-4, 1 - 1e-4)
    theta0 = -np.log(share / (1 - share))
    p = np.concatenate([np.zeros(dims), theta0[:1], np.log(np.maximum(np.diff(theta0), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = len(rows)
    for t in range(1, steps + 1):
        w, theta = p[:dims], np.cumsum(np.r_[p[dims], np.exp(p[dims + 1 :])])
        s = np.bincount(row, w[col], minlength=n)
        above = 1 / (1 + np.exp(np.clip(theta[None] - s[:, None], -40, 40)))  # P(grade > k)
        edges = np.c_[np.ones(n), above, np.zeros(n)]
        density = above * (1 - above)
        d_edges = np.c_[np.zeros(n), density, np.zeros(n)]
        at = np.arange(n)
        prob = np.maximum(edges[at, grades] - edges[at, grades + 1], 1e-12)
        ds = (d_edges[at, grades] - d_edges[at, grades + 1]) / prob
        dtheta = np.zeros((n, levels - 1))
        has_low, has_high = grades > 0, grades < levels - 1
        dtheta[at[has_low], grades[has_low] - 1] -= (density[at[has_low], grades[has_low] - 1] / prob[has_low])
        dtheta[at[has_high], grades[has_high]] += density[at[has_high], grades[has_high]] / prob[has_high]
        dt = dtheta.sum(0) / n
        tail = np.cumsum(dt[::-1])[::-1]
        g = np.concatenate([np.bincount(col, ds[row], minlength=dims) / n - l2 * w, tail[:1], tail[1:] * np.exp(p[dims + 1 :])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[:dims], np.cumsum(np.r_[p[dims], np.exp(p[dims + 1 :])])


def _count(batches):
    counts = [Counter(), Counter()]
    for b in batches:
        for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts[y].update(features(text))
    for y, c in enumerate(counts):
        items = list(c.items())
        for at in range(0, len(items), 50_000):
            part = items[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in part], pa.string()), pa.array([y] * len(part), pa.int32()), pa.array([n for _, n in part], pa.int64())], names=["feature", "y", "n"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, least_gain: float = 10.83, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> OrdinalModel:
    """Fit severity grades on at most max_rows labelled documents, taken by a hash of their ids.

    The labels say toxic or not. Grades: 0 for a clean text; for a toxic one 1 or 2, as its share of
    words with a feature of the toxic side is below the toxic texts' median or not; so the middle
    threshold orders texts by how much of them is toxic, not by a reader's grade. Features are all those
    whose log-likelihood ratio between toxic and clean texts is least_gain or more (10.83: one in a
    thousand by chance), whichever side they speak for. Texts are rejected from the severity that gives the best F1
    on the sample, of those at which at most one clean text in a thousand is rejected.

    Null labels and ids are left out; of labels that disagree the highest counts; documents that
    share an id count once. Without labels of both classes the model rejects nothing.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    taken = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # max_rows ids and flags: a side of bounded size
    sample = stage(texts.join(F.broadcast(taken), "id").groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text")), "toxicity-sample")
    classes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = classes.get(0, 0), sum(n for y, n in classes.items() if y)
    if not n0 or not n1:
        return OrdinalModel({}, [40.0, 41.0], 1.0)
    counts = sample.select(F.least("y", F.lit(1)).alias("y"), "text").mapInArrow(_count, "feature string, y int, n long")
    side = counts.groupBy("feature").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / ((F.col("a") + F.col("b")) * share))).otherwise(0.0)
    rest = lambda n, seen, share: F.when(seen < n, (n - seen) * F.log((n - seen) / ((n0 + n1 - F.col("a") - F.col("b")) * share))).otherwise(0.0)
    s1, s0 = n1 / (n0 + n1), n0 / (n0 + n1)
    gain = 2 * (part(F.col("a"), s1) + part(F.col("b"), s0) + rest(n1, F.col("a"), s1) + rest(n0, F.col("b"), s0))
    # features of max_rows texts at most
    best = side.where(gain >= least_gain).select("feature", (F.col("a") * n0 > F.col("b") * n1).alias("toxic")).orderBy("feature").collect()
    chosen, speaks = {r["feature"]: k for k, r in enumerate(best)}, {r["feature"] for r in best if r["toxic"]}
    if not chosen:
        return OrdinalModel({}, [40.0, 41.0], 1.0)

    def vectors(batches):
        for b in slices(batches, 2):
            found, share = [], []
            for text in b.column(2).to_pylist():
                words = WORD.findall(text.lower())
                hit = sum(any(f in speaks for f in word_features(w)) for w in words)
                found.append(sorted({chosen[f] for w in set(words) for f in word_features(w) if f in chosen}))
                share.append(hit / max(1, len(words)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32())), pa.array(share, pa.float64())], names=["id", "y", "columns", "share"])

    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.select("id", "y", "text").mapInArrow(vectors, f"id {kind}, y int, columns array<int>, share double").toPandas().sort_values("id")
    toxic, share = rows["y"].to_numpy() > 0, rows["share"].to_numpy()
    grades = toxic.astype(np.int64) + (toxic & (share >= np.median(share[toxic])))
    columns = [list(x) for x in rows["columns"]]
    w, theta = fit_ordinal(columns, grades, len(chosen))
    model = OrdinalModel({f: float(w[k]) for f, k in chosen.items()}, [float(t) for t in theta], 1.0)
    severity = model.severity(np.array([w[c].sum() for c in columns]))
    scored = []
    for cut in np.arange(0.05, 1.0, 0.05):
        hit = severity >= cut
        if hit[~toxic].mean() <= 1e-3:
            scored.append((2 * hit[toxic].sum() / max(1, hit.sum() + toxic.sum()), cut))
    model.reject_from = float(max(scored)[1]) if scored else 1.0
    return model


def score(docs: DataFrame, model: OrdinalModel, keep: list[str], text_col: str = "text", out: str = "severity") -> DataFrame:
    """Columns `keep` of every document and its expected severity (0 to the highest grade) in `out`.

    Whole texts are read. Null and empty texts have no features. `out` among `keep` is refused;
    other columns may have any names. No row is dropped.
    """
    if out in keep:
        raise ValueError(f"{out} is among the columns to keep")
    rows = docs.select(*keep, text_of(text_col).alias(text_col + " for severity"))
    last, schema = len(keep), docs.select(*keep, F.lit(0.0).alias(out)).schema
    weights = model.weights

    def task(batches):
        for b in slices(batches, last):
            texts = [set(WORD.findall(x.lower())) for x in b.column(last).to_pylist()]
            known = model.known_features(set().union(*texts))
            scores = [sum(weights[f] for f in sorted({f for w in x & known.keys() for f in known[w]})) for x in texts]
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(model.severity(np.array(scores, float)), pa.float64())], names=[*keep, out])

    return rows.mapInArrow(task, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).withColumn("rejected", F.col("severity") >= model.reject_from)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those whose expected severity is at or above the fitted cut."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, docs.columns, out="severity of toxicity").where(F.col("severity of toxicity") < model.reject_from).drop("severity of toxicity")
