"""Gates and reports of the card-fraud preparation.

A gate is a row (check_name, failure_count) that must be 0; a report is one row of figures. Checks of
one input are taken together in one aggregation, so an input is not read once for each.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequora.operators.entities import located
from sequora.operators.sequence import dense_rank_by, distinct_ranks
from sequora.plans.card_fraud import CardFraud
from sequora.sources.contracts import CORE_TABLES, FORBIDDEN, OPTIONAL_TABLES


def count_if(c: Column, name: str) -> Column:
    return F.count_if(c).alias(name)


def beside(*frames: DataFrame) -> DataFrame:
    """One-row frames as one row."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), frames)


def as_gates(report: DataFrame, *names: str) -> DataFrame:
    """Columns of a one-row frame as rows (check_name, failure_count)."""
    cells = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).cast("long").alias("failure_count")) for n in names or report.columns])
    return report.select(F.explode(cells).alias("g")).select("g.*")


def rows_of(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def orphans(edges: DataFrame, key: str, registry: DataFrame, registry_key: str, name: str) -> DataFrame:
    """Rows whose key its registry lacks (null keys among them)."""
    return rows_of(edges.join(registry.select(F.col(registry_key).alias("_k")), F.col(key) == F.col("_k"), "left_anti"), name)


def membership(asked: DataFrame, registry: DataFrame, checks: dict[str, str]) -> DataFrame:
    """For each check, rows of `asked` (kind, id, check) whose id the registry (kind, id) of that kind lacks; a null id is in none.

    checks: the kind of each check. One pass: both sides are summed up by (kind, id) before they are
    dealt out, so an id that many rows name is one row of each task, and no join is made.
    """
    of = {c: F.when(F.col("check") == c, 1) for c in checks}
    rows = asked.select("kind", "id", "check", F.lit(0).alias("held")).unionByName(registry.where("id IS NOT NULL").select("kind", "id", F.lit(None).cast("string").alias("check"), F.lit(1).alias("held")))
    by_id = rows.groupBy("kind", "id").agg(F.max("held").alias("held"), F.sum("held").alias("times"), *[F.count(x).alias(f"n{k}") for k, x in enumerate(of.values())])
    return by_id.agg(*[F.coalesce(F.sum(F.when((F.col("held") == 0), F.col(f"n{k}"))), F.lit(0)).alias(c) for k, c in enumerate(of)], *[F.count_if((F.col("kind") == k) & (F.col("times") > 1)).alias(f"{k} held by many") for k in dict.fromkeys(checks.values())])


def ids(df: DataFrame, kind: str, key: str, check: str | None = None) -> DataFrame:
    """Ids of a frame for `membership`: (kind, id) of a registry, or with a check (kind, id, check) of rows that ask."""
    out = df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"))
    return out.withColumn("check", F.lit(check)) if check else out


def ends_met(edges: DataFrame, registry: DataFrame) -> DataFrame:
    """Edges (kind_a, a, kind_b, b, ...) with what the registry (kind, id, ...) has of either end: its columns with _a and _b, `met_a`, `met_b`.

    Edges of all types in one frame meet vertices of all types in two joins, whatever the number of types.
    """
    out = edges
    for end in "ab":
        more = [F.col(c).alias(f"{c}_{end}") for c in registry.columns if c not in ("kind", "id")]
        r = registry.select(F.col("kind").alias("_k"), F.col("id").alias("_i"), *more, F.lit(True).alias(f"_met_{end}"))
        out = out.join(r, (F.col(f"kind_{end}") == F.col("_k")) & (F.col(end) == F.col("_i")), "left").drop("_k", "_i")
        out = out.withColumn(f"met_{end}", F.coalesce(f"_met_{end}", F.lit(False))).drop(f"_met_{end}")
    return out


def repeated(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys that more than one row has."""
    return rows_of(df.groupBy(*keys).count().where("count > 1"), name)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def source_gates(src: dict[str, DataFrame]) -> DataFrame:
    """Integrity of the sources, before anything is derived."""
    txn = src["transaction"]
    epoch = F.col("unix_time").try_cast("long")
    read_as = F.unix_seconds(F.col("transaction_time").try_cast("timestamp"))
    values = txn.agg(
        count_if(F.coalesce(epoch <= 0, F.lit(True)), "transactions_with_invalid_epoch"),
        count_if(F.coalesce(read_as != epoch, F.lit(True)) & F.coalesce(epoch > 0, F.lit(False)), "transactions_with_other_readable_time"),
        count_if(~F.coalesce(F.col("is_fraud").isin("0", "1"), F.lit(False)), "transactions_with_other_label"),
        F.count("*").alias("n"),
    )
    counts = beside(values.select("n"), rows_of(src["card_edge"], "c"), rows_of(src["merchant_edge"], "m")).select(F.abs(F.col("n") - F.col("c")).alias("card_edge_count_mismatch"), F.abs(F.col("n") - F.col("m")).alias("merchant_edge_count_mismatch"))
    frames = [
        as_gates(values, *values.columns[:3]),
        as_gates(counts),
        as_gates(orphans(src["card_edge"], "card_number", src["card"], "card_number", "card_edges_without_card")),
        as_gates(orphans(src["merchant_edge"], "merchant_id", src["merchant"], "id", "merchant_edges_without_merchant")),
        *[as_gates(repeated(src[t], ["txn_id"], f"transactions_with_many_{t}s")) for t in ("device_edge", "ip_edge", "card_edge", "merchant_edge")],
        as_gates(repeated(txn, ["id"], "transaction_ids_repeated")),
        as_gates(instrument_premise(src["card"]).select(F.when((F.col("cards") > 0) & (F.col("without_prefix") == F.col("cards")), 1).otherwise(0).alias("no_card_has_a_known_prefix"))),
        *[as_gates(src[t].limit(1).agg((F.lit(1) - F.count("*")).alias(f"{t}_is_empty"))) for t in CORE_TABLES],
    ]
    return union(frames)


def instrument_premise(cards: DataFrame) -> DataFrame:
    """Report: cards, those without a C or D prefix, reissues."""
    c = F.coalesce("card_number", F.lit(""))
    return cards.agg(F.count("*").alias("cards"), count_if(~F.trim(c).rlike("^[CD]"), "without_prefix"), count_if(c.rlike(r"-G[0-9]+\z"), "reissued"))


def optional_notices(src: dict[str, DataFrame]) -> DataFrame:
    """Report: which optional relations are empty, and how many of their rows name no known payment."""
    txn = src["transaction"]
    return union([beside(rows_of(src[t], "rows"), orphans(src[t], "txn_id", txn, "id", "rows_without_transaction")).select(F.lit(t).alias("relation"), "rows", (F.col("rows") == 0).alias("is_empty"), "rows_without_transaction") for t in OPTIONAL_TABLES])


# reports over the prepared frames


def source_counts(p: CardFraud) -> DataFrame:
    names = {"transactions": "transaction", "card_edges": "card_edge", "merchant_edges": "merchant_edge", "device_edges": "device_edge", "ip_edges": "ip_edge", "cards": "card", "merchants": "merchant", "parties": "party"}
    return beside(*[rows_of(p.src[t], n) for n, t in names.items()], rows_of(p.account_seen, "accounts"))


def event_sequence_report(p: CardFraud) -> DataFrame:
    ranked = dense_rank_by(p.sequence, "unix_time", "transaction_id", "_again")
    seen = ranked.agg(count_if(F.col("event_seq") <= 0, "zero_event_seq_rows"), count_if(F.col("event_seq") != F.col("_again"), "out_of_order_rows"))
    return beside(p.limits, distinct_ranks(p.sequence).select(F.col("ranks").alias("distinct_event_seq")), seen)


def label_report(m: DataFrame) -> DataFrame:
    known, fraud = F.col("label_known"), F.col("fraud_label") == 1
    at, seq = F.col("label_available_unix_time"), F.col("label_available_seq")
    return m.agg(
        F.count("*").alias("transactions"), count_if(fraud, "fraud_rows"), count_if(F.col("fraud_label") == 0, "clean_rows"), count_if(known, "known_rows"), count_if(~known, "unknown_rows"),
        count_if(known & ((at == 0) | (seq == 0)), "known_without_availability"), count_if(~known & ((at != 0) | (seq != 0) | (F.col("label_source") != "")), "unknown_with_availability"),
        count_if(fraud & (at <= F.col("unix_time")), "fraud_available_not_after_event"), count_if(fraud & ~known, "fraud_rows_unknown"), count_if(~F.col("fraud_label").isin(0, 1), "label_out_of_domain"),
    )


#: The kind of id that each check of ends asks for.
ENDPOINT_CHECKS = {
    "transactions_without_account": "account", "transactions_without_card": "card", "transactions_without_merchant": "merchant", "transactions_without_location": "location",
    "device_edges_without_device": "device", "ip_edges_without_ip": "ip", "accounts_without_owner": "owned", "merchants_without_operator": "operated",
}


def endpoint_report(p: CardFraud) -> DataFrame:
    """Rows whose end is in no registry, for eight checks in one pass, and merchants of several operators."""
    m = p.manifest
    ends = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_id").cast("string").alias("id"), F.lit(f"transactions_without_{k}").alias("check")) for k in ("account", "card", "merchant", "location")])
    paid = m.select(F.explode(ends).alias("x")).select("x.*").where("kind <> 'location' OR id IS NOT NULL")
    asked = union([paid, ids(p.used_device, "device", "device_id", "device_edges_without_device"), ids(p.from_ip, "ip", "ip_id", "ip_edges_without_ip"), ids(p.accounts, "owned", "account_id", "accounts_without_owner"), ids(p.merchants, "operated", "merchant_id", "merchants_without_operator")])
    registry = union([ids(p.accounts, "account", "account_id"), ids(p.cards, "card", "card_id"), ids(p.merchants, "merchant", "merchant_id"), ids(p.locations, "location", "location_id"), ids(p.devices, "device", "id"), ids(p.ips, "ip", "id"), ids(p.party_owns_account, "owned", "account_id"), ids(p.party_operates_merchant, "operated", "merchant_id")])
    found = membership(asked, registry, ENDPOINT_CHECKS)
    return found.select(*list(ENDPOINT_CHECKS)[:7], F.col("operated held by many").alias("merchants_with_multiple_operators"), "merchants_without_operator")


VERTICES = 11
RELATIONS = slice(11, 21)
HOME_KEYS = ("party_id", "account_id", "card_id", "merchant_id", "location_id", "device_id", "ip_id", "email_id", "phone_id", "address_id", "document_id")


def first_seen_report(p: CardFraud) -> DataFrame:
    stamps = union([p.datasets[n].select("first_seen_seq") for n in list(p.datasets)[:VERTICES]])
    floor = lambda df, n: df.agg(count_if(F.col("first_seen_is_floor"), n))
    return beside(stamps.agg(count_if(F.col("first_seen_seq") <= 0, "vertices_with_zero_first_seen")), floor(p.parties, "parties_at_floor"), floor(p.cards, "cards_at_floor"), floor(p.merchants, "merchants_at_floor"))


def interval_report(p: CardFraud) -> DataFrame:
    """With how many pairs of generations stay open since the later one was not seen later."""
    every = union([p.datasets[n].select("valid_from_seq", "valid_to_seq") for n in list(p.datasets)[RELATIONS]])
    start, end = F.col("valid_from_seq"), F.col("valid_to_seq")
    held = p.account_has_card.groupBy("account_id").agg(F.count("*").alias("n"), F.count_if(end == 0).alias("still_open"))
    return beside(
        every.agg(count_if(start <= 0, "relations_with_zero_valid_from"), count_if((end != 0) & (end <= start), "relations_with_empty_interval")),
        p.account_has_card.agg(count_if(end != 0, "closed_card_tenures")),
        held.agg(count_if(F.col("n") > 1, "accounts_with_multiple_cards"), count_if(F.col("still_open") > 1, "accounts_with_many_open_cards")),
    )


def geography_report(p: CardFraud) -> DataFrame:
    parts = sum((F.col(c).isNotNull().cast("int") for c in ("city_id", "state_id", "zipcode_id")), F.lit(0))
    many = [count_if(F.col(f"{c}_count") > 1, f"merchants_with_many_{n}") for c, n in (("city", "cities"), ("state", "states"), ("zipcode", "zips"))]
    return p.geography.agg(F.count("*").alias("merchants"), count_if(parts.between(1, 2), "merchants_with_partial_geography"), *many, count_if(located(), "physical_merchants"), count_if(parts == 0, "online_merchants"))


def coordinate_report(p: CardFraud) -> DataFrame:
    has = F.col("has_coordinates")
    return beside(
        p.locations.agg(F.count("*").alias("merchant_locations"), count_if(has, "locations_with_coordinates"), count_if(~has, "locations_masked")),
        p.manifest.agg(count_if(F.col("has_event_location"), "transactions_with_event_location"), count_if(F.col("has_event_location") & ~F.col("card_present"), "card_not_present_with_event_location")),
        p.addresses.agg(count_if(F.col("distinct_area_count") > 1, "addresses_masked_ambiguous"), count_if((F.col("region_code") != "") | (F.col("postal_code_prefix") != ""), "addresses_with_area")),
    )


def category_report(p: CardFraud) -> DataFrame:
    return beside(p.category.agg(F.count("*").alias("merchants_with_category"), count_if(F.col("category_count") > 1, "merchants_with_many_categories")), p.merchants.agg(count_if(F.col("merchant_category_code") == "", "merchants_without_category")))


def vocabulary_report(p: CardFraud) -> DataFrame:
    party = [count_if(F.col("party_type") == t, f"parties_{n}") for t, n in (("unknown", "unknown_type"), ("individual", "individual"), ("company", "company"), ("merchant_entity", "merchant_entity"))]
    card = [count_if(F.col("card_type") == t, f"cards_{n}") for t, n in (("credit", "credit"), ("debit", "debit"), ("unknown", "unknown_type"))]
    return beside(p.manifest.agg(count_if(F.col("channel") == "unknown", "transactions_unknown_channel"), count_if(F.col("entry_mode") == "unknown", "transactions_unknown_entry_mode"), count_if(F.col("channel") == "ecommerce", "transactions_ecommerce"), count_if(F.col("card_present"), "transactions_card_present")), p.parties.agg(*party), p.cards.agg(*card))


def token_report(p: CardFraud) -> DataFrame:
    kinds = {"emails": p.emails, "phones": p.phones, "addresses": p.addresses, "documents": p.documents, "devices": p.devices, "ip_addresses": p.ips}
    each = beside(*[df.agg(F.count("*").alias(n), F.countDistinct("id").alias(f"{n}_ids")) for n, df in kinds.items()])
    lone = lambda df, n: df.agg(count_if(F.col("used_by_transaction") & ~F.col("held_by_party"), n))
    total = sum((F.col(n) - F.col(f"{n}_ids") for n in kinds), F.lit(0))
    return beside(each.select(*kinds, total.alias("token_collisions")), lone(p.devices, "devices_transacting_without_party"), lone(p.ips, "ips_transacting_without_party"))


def forbidden_columns(datasets: dict[str, DataFrame]) -> DataFrame:
    """How many columns of the datasets have a forbidden name, which, and how many values stand in them."""
    rows = next(iter(datasets.values()))
    found = sorted((t, c) for t, df in datasets.items() for c in df.columns if c in FORBIDDEN)
    held = [datasets[t].agg(F.count(F.col(c)).alias("n")) for t, c in found] or [rows.limit(0).agg(F.count("*").alias("n"))]
    names = F.lit(", ".join(f"{t}.{c}" for t, c in found))
    return union(held).agg(F.lit(len(found)).cast("long").alias("forbidden_columns"), F.sum("n").alias("forbidden_values"), names.alias("detail"))


def fan_out_report(p: CardFraud) -> DataFrame:
    """For each kind of identifier: values, relations, the most and the mean number of parties that share one.

    Over the datasets, which an export has staged: their ids are the tokens, that hold nothing to be cleaned.
    """
    held = {k: next(n for n in p.datasets if n.endswith(f"_party_has_{k}")) for k in p.party_values}
    shared = union([df.groupBy(F.col(df.columns[1]).alias("value")).agg(F.count("*").alias("parties")).select(F.lit(k).alias("pii_kind"), "parties") for k, df in ((k, p.datasets[n]) for k, n in held.items())])
    return shared.groupBy("pii_kind").agg(F.count("*").alias("distinct_values"), F.sum("parties").alias("relations"), F.max("parties").alias("max_parties_per_value"), F.round(F.avg("parties"), 4).alias("mean_parties_per_value"), count_if(F.col("parties") > 1, "shared_values"))


def registry_report(p: CardFraud) -> DataFrame:
    spec = (("email", "email", p.emails, "emails"), ("phone", "phone_number", p.phones, "phones"), ("address", "address", p.addresses, "addresses"), ("document", "id", p.documents, "documents"), ("device", "id", p.devices, "devices"), ("ip", "id", p.ips, "ips"))
    return beside(*[orphans(p.src[t], c, values, "raw", f"unreferenced_{n}") for t, c, values, n in spec])


def load_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    return union([rows_of(df, "rows").select(F.lit(n).alias("dataset"), "rows") for n, df in datasets.items()])


def agreement(audited: DataFrame, exported: DataFrame) -> DataFrame:
    """Audited datasets beside exported ones (dataset, rows): a row for each that either side has, null where one lacks it."""
    both = audited.select("dataset", F.col("rows").alias("audited")).join(exported.select("dataset", F.col("rows").alias("exported")), "dataset", "full")
    return both.select("dataset", "audited", "exported", F.col("audited").eqNullSafe(F.col("exported")).alias("fits"))


def verification_report(p: CardFraud, policies: dict[str, int]) -> DataFrame:
    """Everything that decides on an export, as rows (section, item, value): policies, audits, fan-out, counts, failures, passed."""
    # each part is a few rows, one for a gate, an identifier or a dataset, and is computed once
    audits = [(r["check_name"], r["failure_count"]) for r in gates(p).collect()]
    fan_out = [(r["pii_kind"], r["max_parties_per_value"]) for r in fan_out_report(p).collect()]
    counts = [(r["dataset"], r["rows"]) for r in load_counts(p.datasets).collect()]
    failures = sum(n > 0 for _, n in audits)
    parts = {"policy": sorted(policies.items()), "audit": audits, "fan-out": fan_out, "count": counts, "result": [("failures", failures), ("passed", int(not failures))]}
    return p.datasets["01_parties"].sparkSession.createDataFrame([(k, i, v) for k, rows in parts.items() for i, v in rows], "section string, item string, value long")


def relation_endpoints(p: CardFraud) -> DataFrame:
    """Relations whose ends are no vertex, or whose start lies before an end was first seen: one row for each relation."""
    d = list(p.datasets)
    registry = union([p.datasets[n].select(F.lit(HOME_KEYS[k]).alias("kind"), F.col(HOME_KEYS[k]).alias("id"), F.col("first_seen_seq").alias("seen")) for k, n in enumerate(d[:VERTICES])])
    relation = lambda n, e: e.select(F.lit(n).alias("check_name"), F.lit(e.columns[0]).alias("kind_a"), F.col(e.columns[0]).alias("a"), F.lit(e.columns[1]).alias("kind_b"), F.col(e.columns[1]).alias("b"), "valid_from_seq")
    met = ends_met(union([relation(n, p.datasets[n]) for n in d[RELATIONS]]), registry)
    bad = ~F.col("met_a") | ~F.col("met_b") | (F.col("seen_a") > F.col("valid_from_seq")) | (F.col("seen_b") > F.col("valid_from_seq"))
    return each_of(met.groupBy("check_name").agg(F.count_if(bad).alias("failure_count")), "check_name", d[RELATIONS], "failure_count")


def each_of(found: DataFrame, name: str, names: list[str], *counts: str) -> DataFrame:
    """A row for each name, with 0 where nothing was found of it."""
    zeros = found.sparkSession.createDataFrame([(n,) for n in names], f"{name} string")
    return zeros.join(found, name, "left").select(name, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def gates(p: CardFraud, names: Collection[str] | None = None) -> DataFrame:
    """The thirty gates; any count over 0 stops an export. With names of datasets, those gates that look at no other dataset."""
    every, payments, sites = set(p.datasets), {"22_transactions"}, {"04_merchants", "05_merchant_locations"}
    names = every if names is None else set(names)
    off = lambda t: F.abs(F.col("transaction") - F.col(f"{t}_edge")).alias(f"transaction_{t}_edge_count_mismatch")
    each = [
        (payments, lambda: as_gates(beside(*[rows_of(p.src[t], t) for t in ("transaction", "card_edge", "merchant_edge")]).select(off("card"), off("merchant")))),
        (payments, lambda: as_gates(event_sequence_report(p).select(
            F.when(F.col("minimum_event_seq") == 1, 0).otherwise(1).alias("event_seq_not_starting_at_one"),
            F.when((F.col("maximum_event_seq") == F.col("transaction_count")) & (F.col("distinct_event_seq") == F.col("transaction_count")), 0).otherwise(1).alias("event_seq_not_dense"),
            F.col("zero_event_seq_rows").alias("event_seq_zero_rows"), F.col("out_of_order_rows").alias("event_seq_out_of_order_rows"),
        ))),
        (payments, lambda: as_gates(label_report(p.manifest).select(F.col("known_without_availability").alias("label_known_without_availability"), F.col("unknown_with_availability").alias("label_unknown_with_availability"), F.col("fraud_available_not_after_event").alias("label_fraud_available_not_after_event"), F.col("fraud_rows_unknown").alias("label_fraud_rows_unknown"), "label_out_of_domain"))),
        (every, lambda: as_gates(endpoint_report(p).drop("merchants_without_operator"))),
        (every, lambda: as_gates(first_seen_report(p), "vertices_with_zero_first_seen")),
        (every, lambda: as_gates(interval_report(p), "relations_with_zero_valid_from", "relations_with_empty_interval")),
        (sites, lambda: as_gates(geography_report(p), "merchants_with_partial_geography", "merchants_with_many_cities", "merchants_with_many_states", "merchants_with_many_zips")),
        (every, lambda: as_gates(coordinate_report(p), "card_not_present_with_event_location")),
        (sites, lambda: as_gates(category_report(p), "merchants_with_many_categories")),
        (every, lambda: as_gates(token_report(p).select(F.col("token_collisions").alias("pii_token_collisions")))),
        (set(), lambda: as_gates(forbidden_columns({n: p.datasets[n] for n in p.datasets if n in names}).select(F.col("forbidden_columns").alias("forbidden_columns_in_load_views")))),
    ]
    return union([make() for of, make in each if of <= names])


class GateError(RuntimeError):
    pass


def require(checked: DataFrame) -> None:
    """Raise, naming every gate that failed."""
    if failed := checked.where("failure_count <> 0").orderBy("check_name").collect():
        raise GateError("; ".join(f"{r['check_name']}: {r['failure_count']}" for r in failed))
