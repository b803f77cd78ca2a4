"""Validation of written vertex and edge tables: what a traversal of the graph would find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequora import functions as fn
from sequora.operators.gates import as_gates, beside, count_if, each_of, ends_met, rows_of, union
from sequora.operators.sequence import distinct_ranks
from sequora.operators.temporal import bad_interval, bad_label, event_value, from_source, known
from sequora.sources.contracts import BY_NAME, DATASETS


def vertex_counts(vertices: dict[str, DataFrame]) -> DataFrame:
    return union([rows_of(df, "vertices").select(F.lit(n).alias("vertex_type"), "vertices") for n, df in vertices.items()])


def edge_counts(edges: dict[str, tuple[DataFrame, tuple[str, str]]], homes: dict[str, DataFrame]) -> DataFrame:
    """Edges of each type (frame, the two columns of its ends) that a walk from their sources reaches, and one from their targets.

    A walk starts at vertices that exist and takes edges that lead to such. homes: the vertices of each column of ids.
    """
    registry = union([df.select(F.lit(c).alias("kind"), F.col(c).alias("id")) for c, df in homes.items()]).distinct()
    one = lambda n, df, x, y: df.select(F.lit(n).alias("edge_type"), F.lit(x).alias("kind_a"), F.col(x).alias("a"), F.lit(y).alias("kind_b"), F.col(y).alias("b"))
    met = ends_met(union([one(n, df, x, y) for n, (df, (x, y)) in edges.items()]), registry)
    forward, backward = F.col("met_a") & F.col("met_b"), F.col("met_b") & F.col("met_a")
    return each_of(met.groupBy("edge_type").agg(count_if(forward, "forward"), count_if(backward, "backward")), "edge_type", list(edges), "forward", "backward")


def density(transactions: DataFrame) -> DataFrame:
    """Least and greatest rank, their sum against that of 1..N, and ranks of 0."""
    s, n = F.col("event_seq"), F.count("*").cast("decimal(38,0)")
    return transactions.agg(F.count("*").alias("events"), F.min(s).alias("lowest"), F.max(s).alias("highest"), (F.sum(s.cast("decimal(38,0)")) * 2 - n * (n + 1)).cast("long").alias("sum_difference"), count_if(s == 0, "zero_rows"))


def stamp_mismatches(edge: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """Participations whose clock is not their event's."""
    e = events.select("transaction_id", F.col("event_seq").alias("_s"), F.col("event_ts_ms").alias("_m"))
    return edge.join(e, "transaction_id").agg(count_if((F.col("event_seq") != F.col("_s")) | (F.col("event_ts_ms") != F.col("_m")), name))


def frontier(edge: DataFrame, events: DataFrame) -> DataFrame:
    """Events without an edge of the type, and edges beyond one an event; events are told apart by their rank."""
    return beside(rows_of(events, "n"), distinct_ranks(edge).select(F.col("ranks").alias("r")), rows_of(edge, "m")).select((F.col("n") - F.col("r")).alias("missing"), (F.col("m") - F.col("r")).alias("extra"))


def degree_above(edge: DataFrame, target: str, bound: int, name: str) -> DataFrame:
    """Targets that more than `bound` edges lead to."""
    return rows_of(edge.groupBy(target).count().where(F.col("count") > bound), name)


def stamp_report(p) -> DataFrame:
    """Stamps and intervals of the written tables."""
    d, names = p.datasets, list(p.datasets)
    stamps, every = union([d[n].select("first_seen_seq") for n in names[:11]]), union([d[n].select("valid_from_seq", "valid_to_seq") for n in names[11:21]])
    start, end = F.col("valid_from_seq"), F.col("valid_to_seq")
    return beside(stamps.agg(count_if(F.col("first_seen_seq") <= 0, "zero_first_seen")), every.agg(count_if(start <= 0, "zero_valid_from"), count_if((end != 0) & (end <= start), "empty_intervals"), count_if(end != 0, "closed_tenures")))


def label_violations(t: DataFrame) -> DataFrame:
    known_, fraud = F.col("label_known") == "true", F.col("fraud_label") == 1
    seq = F.col("label_available_seq")
    return t.agg(
        count_if(known_ & ((seq == 0) | (F.col("label_available_ts_ms") == 0)), "known_without_availability"), count_if(~known_ & ((seq != 0) | (F.col("label_available_ts_ms") != 0)), "unknown_with_availability"), count_if(fraud & (F.col("label_available_ts_ms") <= F.col("event_ts_ms")), "fraud_available_too_early"),
        count_if(~F.col("fraud_label").isin(0, 1), "label_out_of_domain"), count_if(known_, "known_labels"), count_if(~known_, "unknown_labels"), count_if(fraud, "fraud_labels"),
    )


def measures(t: DataFrame, merchants: DataFrame, locations: DataFrame) -> DataFrame:
    yes = lambda c: F.col(c) == "true"
    return beside(
        t.agg(F.round(F.sum("amount"), 2).alias("amount_sum"), count_if(~yes("amount_present"), "absent_amounts"), count_if(yes("card_present"), "card_present"), count_if(F.col("channel") == "ecommerce", "ecommerce"), count_if(F.col("channel") == "unknown", "unknown_channel"), count_if(yes("has_event_location"), "with_event_location")),
        merchants.agg(count_if(yes("is_online"), "online_merchants")),
        locations.agg(count_if(yes("has_coordinates"), "located_outlets"), count_if(~yes("has_coordinates"), "masked_outlets")),
    )


#: What each dataset becomes in the graph; payments feed a vertex type and four edge types.
OBJECTS = {"22_transactions": ("Payment_Transaction", "By_Account", "By_Card", "To_Merchant", "At_Location")}


def expected_and_found(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Rows that the manifest states against objects found (object, rows); a place edge may be missing from a payment.

    Columns: object, expected, found, fits.
    """
    stated = manifest.groupBy("dataset").agg(F.sum("rows").alias("expected"))
    names = F.coalesce(*[F.when(F.col("dataset") == d, F.array(*map(F.lit, o))) for d, o in OBJECTS.items()], F.array(F.col("dataset")))
    out = stated.select(F.explode(names).alias("object"), "expected").join(found.select("object", F.col("rows").alias("found")), "object", "full")
    fits = F.when(F.col("object") == "At_Location", F.col("found") <= F.col("expected")).otherwise(F.col("found") == F.col("expected"))
    return out.select("object", "expected", "found", F.coalesce(fits, F.lit(False)).alias("fits"))


def empty_mandatory(counts: DataFrame, may_be_empty: tuple[str, ...]) -> DataFrame:
    return counts.where((F.col("rows") == 0) & ~F.col("dataset").isin(*may_be_empty))


def temporal_invariants(t: dict[str, DataFrame]) -> DataFrame:
    """Invariants of each typed temporal table, edges from both ends, with the target's first time among them."""
    out = []
    for d in DATASETS:
        df = t[d.name]
        if d.role == "entity":
            out.append(as_gates(df.agg(count_if(known((F.col("first_seen_seq") <= 0) | (F.col("first_seen_ts_ms") <= 0) | ~fn.opaque_id(F.col(d.key))), f"{d.name}: vertex"))))
        elif d.role == "event":
            extra = bad_label() if d.name == "Zelle_Transfer" else known(F.lower("payment_rail") == "zelle")
            out.append(as_gates(df.agg(count_if(event_value() | extra, f"{d.name}: vertex"))))
        else:
            source, target = BY_NAME[d.ends.source], BY_NAME[d.ends.target]
            tenure = d.role == "association"
            start = F.col("valid_from_seq" if tenure else "event_seq")
            clocks = {"_as": "first_seen_seq"} if tenure else {"_as": "event_seq", "_am": "event_ts_ms"}
            wrong = bad_interval() | known(F.col("_as") > start) if tenure else known((start != F.col("_as")) | (F.col("event_ts_ms") != F.col("_am")))
            met = from_source(df, t[d.ends.source], source.key, clocks, _start=start, _met=F.col("_a").isNotNull(), _bad=wrong, **({} if tenure else {"_ms": F.col("event_ts_ms")}))
            z = t[d.ends.target].select(F.col(target.key).alias("_z"), F.col("first_seen_seq").alias("_zs"), *([] if tenure else [F.col("first_seen_ts_ms").alias("_zm")]))
            late = F.col("_zs") > F.col("_start") if tenure else (F.col("_zs") > F.col("_start")) | (F.col("_zm") > F.col("_ms"))
            lost = F.col("_z").isNull()
            # a walk from the target takes each edge once, whatever stands at its source
            found = met.join(z, F.col("to_id") == F.col("_z"), "left").agg(count_if(F.col("_met") & ~lost & (F.col("_bad") | known(late)), f"{d.name}: edge"), count_if(lost & F.col("_first"), f"{d.ends.reverse}: target"))
            out.append(as_gates(found))
    return union(out)


def same_distribution(source: DataFrame, written: DataFrame) -> DataFrame:
    """Two distributions (attribute, value, accounts) beside each other: counts before and after, and whether they are the same."""
    on = ["attribute", "value"]
    return _beside(source, written, on).select(*on, "before", "after", (F.col("before") == F.col("after")).alias("fits"))


def _beside(source: DataFrame, written: DataFrame, on: list[str]) -> DataFrame:
    """Null values are a value of their own, so the two are summed up and not joined."""
    zero = F.lit(0).cast("long")
    all_ = source.select(*on, F.col("accounts").alias("before"), zero.alias("after")).unionByName(written.select(*on, zero.alias("before"), F.col("accounts").alias("after")))
    return all_.groupBy(*on).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
