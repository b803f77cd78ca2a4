"""Checks of the temporal contract over vertex and edge tables, generic over the dataset descriptor.

All checks make one frame (check_name, failure_count); nothing stops at the first failure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sequora import functions as fn
from sequora.operators.gates import as_gates, beside, count_if, repeated, rows_of, union
from sequora.operators.relations import covered
from sequora.operators.sequence import distinct_ranks
from sequora.sources.contracts import BY_NAME, DATASETS, TAKES_PART, Table
from sequora.sources.readers import bad_value, out_of_range, typed



def known(c: Column) -> Column:
    """True where a condition holds; unknown counts as not."""
    return F.coalesce(c, F.lit(False))


def raw_checks(d: Table, raw: DataFrame) -> DataFrame:
    return as_gates(raw.agg(count_if(bad_value(d), f"{d.name}: source values"), count_if(out_of_range(d), f"{d.name}: unsigned range")))


def entity_checks(d: Table, t: DataFrame) -> DataFrame:
    k = F.col(d.key)
    identity = (F.count("*") - F.countDistinct(k) + F.count_if(known(k == ""))).alias(f"{d.name}: identity")
    if d.role == "event":
        return as_gates(t.agg(identity, count_if(event_value(), f"{d.name}: event values")))
    first = known((F.col("first_seen_seq") <= 0) | (F.col("first_seen_ts_ms") <= 0))
    return as_gates(t.agg(identity, count_if(first, f"{d.name}: first observation"), count_if(known(~fn.opaque_id(k)), f"{d.name}: opaque ids")))


def event_value() -> Column:
    """An event without a positive clock, with two clocks that differ, or with an impossible amount."""
    amount, present = F.col("amount"), F.col("amount_present")
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("event_time"))
    clock = (F.col("event_seq") <= 0) | (F.col("event_ts_ms") <= 0) | (F.floor(at / 1000) != F.col("event_ts_ms"))
    return known(clock) | known((amount < 0) | F.isnan(amount) | (F.abs(amount) == float("inf"))) | known(~present & (amount != 0))


def nth(key: str) -> Column:
    """The number of a row among those of its key, in no stated order; a join on the key needs no other exchange or sort."""
    return F.row_number().over(Window.partitionBy(key).orderBy(key))


def from_source(t: DataFrame, source: DataFrame, key: str, clocks: dict[str, str], **said: Column) -> DataFrame:
    """Edges with their source's columns (clocks: name to column; `_a` its key): what is `said` of both, and what the target is asked with.

    Only `said` goes on to the target, and not the columns it is made of. `_first` holds once for each
    edge, also where several sources have its id, and `_again` for one of each edges with the same source.
    """
    a = source.select(F.col(key).alias("_a"), *[F.col(c).alias(n) for n, c in clocks.items()]).withColumn("_n", nth("_a"))
    first = F.coalesce(F.col("_n") == 1, F.lit(True))
    met = t.withColumn("_second", nth("from_id") == 2).join(a, F.col("from_id") == F.col("_a"), "left")
    return met.select("to_id", *[x.alias(n) for n, x in said.items()], first.alias("_first"), (first & F.col("_second")).alias("_again"))


def edge_checks(d: Table, t: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    source, target = BY_NAME[d.ends.source], BY_NAME[d.ends.target]
    tenure = d.role == "association"
    start, clock = ("valid_from_seq", "first_seen_seq") if tenure else ("event_seq", "event_seq")
    lost = F.col("_a").isNull()
    said = {"_start": F.col(start), "_bad": lost | known(F.col("_a_clock") > F.col(start))}
    if not tenure:
        said["_off"] = known(~lost & ((F.col("event_seq") != F.col("_a_clock")) | (F.col("event_ts_ms") != F.col("_a_ms"))))
    met = from_source(t, tables[d.ends.source], source.key, {"_a_clock": clock} | ({} if tenure else {"_a_ms": "event_ts_ms"}), **said)
    z = tables[d.ends.target].select(F.col(target.key).alias("_z"), F.col("first_seen_seq").alias("_z_clock")).withColumn("_m", nth("_z"))
    ends = met.join(z, F.col("to_id") == F.col("_z"), "left")
    measures = [count_if(F.col("_bad") | F.col("_z").isNull() | known(F.col("_z_clock") > F.col("_start")), f"{d.name}: endpoints")]
    if not tenure:
        again = F.col("_again") & F.coalesce(F.col("_m") == 1, F.lit(True))
        return as_gates(ends.agg(*measures, count_if(F.col("_off"), f"{d.name}: repeated clocks"), count_if(again, f"{d.name}: unique identity")))
    return union([
        as_gates(ends.agg(*measures)), as_gates(repeated(t, ["from_id", "to_id", "valid_from_seq"], f"{d.name}: unique identity")),
        as_gates(t.agg(count_if(bad_interval(), f"{d.name}: intervals"))), as_gates(rows_of(overlapping(t), f"{d.name}: overlapping tenures")),
    ])


def bad_interval() -> Column:
    start, end, confidence = F.col("valid_from_seq"), F.col("valid_to_seq"), F.col("confidence")
    return known(start <= 0) | known((end != 0) & (end <= start)) | known((confidence < 0) | (confidence > 1) | F.isnan(confidence)) | known(F.col("source_system") == "")


def overlapping(t: DataFrame) -> DataFrame:
    """Tenures of a pair that begin before the latest end among the pair's earlier ones; an open end is 2^64."""
    end = F.when(F.col("valid_to_seq") == 0, F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(F.col("valid_to_seq"))
    prior = F.max(end).over(Window.partitionBy("from_id", "to_id").orderBy("valid_from_seq").rowsBetween(Window.unboundedPreceding, -1))
    return t.withColumn("_prior", prior).where("valid_from_seq < _prior")


def running_back(rows: DataFrame, bucket: int = 1_000_000) -> DataFrame:
    """Rows (event_seq, event_ts_ms) whose time is before that of the row with the next lower sequence.

    The previous row is looked up within buckets of the sequence; the first row of a bucket is compared
    with the last of the bucket before, in a window that has one row for each bucket.
    """
    b = rows.withColumn("_b", F.floor(F.col("event_seq") / bucket).cast("long"))
    order = Window.partitionBy("_b").orderBy("event_seq", "event_ts_ms")
    edge = b.groupBy("_b").agg(F.max(F.struct("event_seq", "event_ts_ms")).alias("_last"))
    edge = edge.select(F.col("_b").alias("_c"), F.lag("_last").over(Window.orderBy("_b"))["event_ts_ms"].alias("_carried"))
    seen = b.withColumns({"_prior": F.lag("event_ts_ms").over(order), "_n": F.row_number().over(order)}).join(edge, F.col("_b") == F.col("_c"))
    return seen.where(F.col("event_ts_ms") < F.when(F.col("_n") == 1, F.col("_carried")).otherwise(F.col("_prior")))


def witnesses(tables: dict[str, DataFrame]) -> DataFrame:
    """Every (sequence, time) pair that the tables state: events, first observations, label clocks."""
    stamp = lambda df, s, m: df.select(F.col(s).alias("event_seq"), F.col(m).alias("event_ts_ms"))
    out = [events(tables)] + [stamp(tables[d.name], "first_seen_seq", "first_seen_ts_ms") for d in DATASETS if d.role == "entity"]
    return union([*out, stamp(tables["Zelle_Transfer"].where("label_known"), "label_available_seq", "label_available_ts_ms")])


def events(tables: dict[str, DataFrame]) -> DataFrame:
    return union([tables[n].select("event_seq", "event_ts_ms") for n in ("Payment_Transaction", "Zelle_Transfer")])


def bad_label() -> Column:
    label, seq, ms, known_ = (F.col(c) for c in ("fraud_label", "label_available_seq", "label_available_ts_ms", "label_known"))
    return known(known_ & (~label.isin(0, 1) | (seq <= F.col("event_seq")) | (ms < F.col("event_ts_ms")))) | known(~known_ & ((label != -1) | (seq != 0) | (ms != 0)))


def clashing_bindings(t: DataFrame, bucket: int = 1_000_000) -> DataFrame:
    """How many pairs of tenures bind one token to two accounts at once (clashes), by a sweep over starts and ends.

    At each start, tenures of the token that are running then, less those of the same account, are
    its clashes with earlier ones; of two that start together one comes first. Running sums are taken
    within buckets of the clock and carried on, so a hub token is spread. Tenures that end at or before
    their start, a fault that has a check of its own, are joined with those around them.
    """
    rows = t.select("from_id", "to_id", F.col("valid_from_seq").alias("s"), F.col("valid_to_seq").alias("e")).where("from_id IS NOT NULL AND to_id IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL")
    turned = rows.where("e <> 0 AND e <= s")
    sound = rows.where("e = 0 OR e > s")
    change = lambda at, by: F.struct(F.col(at).alias("at"), F.lit(by).cast("long").alias("by"))
    moves = sound.select("from_id", "to_id", F.explode(F.array(change("s", 1), change("e", -1))).alias("m")).select("from_id", "to_id", "m.*").where("by > 0 OR at <> 0").withColumn("b", F.floor(F.col("at") / bucket).cast("long"))
    parts = []
    for keys, sign in ((["from_id"], 1), (["from_id", "to_id"], -1)):
        # ends come before starts of the same place
        order = Window.partitionBy(*keys, "b").orderBy("at", "by", "to_id").rowsBetween(Window.unboundedPreceding, -1)
        before = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        carried = moves.groupBy(*keys, "b").agg(F.sum("by").alias("all")).select(*[F.col(k).alias(f"_{k}") for k in [*keys, "b"]], F.coalesce(F.sum("all").over(before), F.lit(0)).alias("carried"))
        on = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_{k}") for k in [*keys, "b"]])
        own = moves.withColumn("run", F.coalesce(F.sum("by").over(order), F.lit(0))).where("by > 0").join(carried, on)
        parts.append(own.agg((F.coalesce(F.sum(F.col("run") + F.col("carried")), F.lit(0)) * sign).alias("n")))
    around = turned.select("from_id", F.col("to_id").alias("_to"), F.col("s").alias("_s"), F.col("e").alias("_e")).join(sound, "from_id").where("to_id <> _to AND s < _e AND (e = 0 OR _s < e)").agg(F.count("*").alias("n"))
    return union([*parts, around]).agg(F.sum("n").cast("long").alias("clashes"))


def unbound(tokens: DataFrame, accounts: DataFrame, bindings: DataFrame) -> DataFrame:
    """Transfers of a token and an account without a binding in force at their sequence."""
    used = tokens.select("from_id", F.col("to_id").alias("_token"), F.col("event_seq").alias("_seq")).join(accounts.select("from_id", F.col("to_id").alias("_account")), "from_id")
    held = bindings.select(F.col("from_id").alias("_token"), F.col("to_id").alias("_account"), "valid_from_seq", "valid_to_seq")
    return used.join(covered(used, held, ["_token", "_account"], "_seq"), ["_token", "_account", "_seq"], "left_anti")


def without_role(e: Table, tables: dict[str, DataFrame], role: str) -> DataFrame:
    out = tables[e.name]
    for kind in ("Account", "Token"):
        out = out.join(tables[f"{TAKES_PART[e.name]}_{role}_{kind}"].select(F.col("from_id").alias("_f")), F.col(e.key) == F.col("_f"), "left_anti")
    return out


def across_tables(t: dict[str, DataFrame]) -> DataFrame:
    """Checks that take more than one table, or are of one table only."""
    p, z, both = t["Payment_Transaction"], t["Zelle_Transfer"], events(t)
    clock = witnesses(t)
    n = lambda df, name: as_gates(rows_of(df, name))
    frames = [
        as_gates(beside(rows_of(p, "a"), rows_of(z, "b")).select(F.when(F.col("a") + F.col("b") == 0, 1).otherwise(0).alias("no payments"))),
        n(p.join(z, F.col("transaction_id") == F.col("transfer_id")), "exclusive payment identities"),
        as_gates(p.agg(count_if(known(F.lower("payment_rail") == "zelle"), "transfer rail among payments"))),
        beside(rows_of(both, "n"), distinct_ranks(both, "event_seq")).select(F.lit("shared event sequence").alias("check_name"), (F.col("n") - F.col("ranks")).alias("failure_count")),
        n(running_back(both), "chronological events"),
        as_gates(z.agg(count_if(bad_label(), "label availability"))),
        n(clock.groupBy("event_seq").agg(F.min("event_ts_ms").alias("a"), F.max("event_ts_ms").alias("b")).where("a <> b"), "common clock witnesses"),
        n(running_back(clock.distinct()), "chronological clock witnesses"),
        *[n(without_role(BY_NAME[e], t, r), f"{e}: {r} role present") for e in ("Zelle_Transfer", "Payment_Transaction") for r in ("From", "To")],
        clashing_bindings(t["Token_Bound_To_Account"]).select(F.lit("exclusive token account tenures").alias("check_name"), F.col("clashes").alias("failure_count")),
        *[n(unbound(t[f"Transfer_{r}_Token"], t[f"Transfer_{r}_Account"], t["Token_Bound_To_Account"]), f"Transfer {r}: visible binding") for r in ("From", "To")],
        as_gates(t["Account"].agg(count_if(known(~F.col("is_mule").isin(-1, 0, 1)), "account mule flag"), count_if(known(F.col("mule_ring_id") < -1), "account mule ring"))),
    ]
    return union(frames)


def distributions(account: DataFrame) -> DataFrame:
    """How many accounts have each mule flag and ring, to be met again after a load."""
    count = lambda c: account.groupBy(F.col(c).cast("int").alias("value")).agg(F.count("*").alias("accounts")).select(F.lit(c).alias("attribute"), "value", "accounts")
    return union([count("is_mule"), count("mule_ring_id")])


def typed_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {d.name: typed(d, raw[d.name]) for d in DATASETS}


def audit(raw: dict[str, DataFrame]) -> DataFrame:
    """Every check of the contract over the raw text tables."""
    t = typed_tables(raw)
    own = [raw_checks(d, raw[d.name]) for d in DATASETS]
    shape = [edge_checks(d, t[d.name], t) if d.ends else entity_checks(d, t[d.name]) for d in DATASETS]
    return union([*own, *shape, across_tables(t)])
