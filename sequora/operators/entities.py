"""Parties, accounts, cards, merchants, their places, and tokenised identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sequora import functions as fn
from sequora.operators.sequence import FIRST, earliest, with_floor


def card_account(cards: DataFrame) -> DataFrame:
    c = "card_number"
    return cards.select(F.col(c).alias("card_id"), fn.funding_account_id(c).alias("account_id"), fn.card_generation(c).alias("generation"), fn.instrument_type(c).alias("instrument_type"))


def account_first_seen(card_seen: DataFrame) -> DataFrame:
    return earliest(card_seen.withColumn("account_id", fn.funding_account_id("card_number")), "account_id")


def parties(party: DataFrame, seen: DataFrame, limits: DataFrame) -> DataFrame:
    out = with_floor(party, seen, "id", "party_id", limits)
    return out.select(F.col("id").alias("party_id"), *FIRST, fn.epoch_of_text("created_at").alias("customer_since_unix_time"), fn.vocabulary("party_type", fn.PARTY_TYPES).alias("party_type"), F.lit("").alias("home_country"), "first_seen_is_floor")


def accounts(account: DataFrame, seen: DataFrame) -> DataFrame:
    """An account that has never paid is dropped: it has no stamp of its own."""
    joined = account.join(seen, "account_id").groupBy("account_id", *FIRST).agg(F.min("instrument_type").alias("account_type"))
    return joined.select("account_id", *FIRST, F.lit(0).cast("long").alias("opened_unix_time"), "account_type", F.lit("").alias("base_currency"), F.lit("").alias("country_code"))


def cards(account: DataFrame, seen: DataFrame, limits: DataFrame) -> DataFrame:
    out = with_floor(account, seen, "card_id", "card_number", limits)
    return out.select("card_id", *FIRST, F.lit(0).cast("long").alias("issued_unix_time"), F.col("instrument_type").alias("card_type"), F.lit("unknown").alias("card_network"), F.lit("unknown").alias("card_product"), F.lit(False).alias("is_virtual"), "first_seen_is_floor")


def merchant_category(edges: DataFrame) -> DataFrame:
    return edges.groupBy("merchant_id").agg(F.countDistinct("category").alias("category_count"), F.min("category").alias("category"))


def merchants(merchant: DataFrame, seen: DataFrame, category: DataFrame, geography: DataFrame, limits: DataFrame) -> DataFrame:
    out = with_floor(merchant, seen, "id", "merchant_id", limits).withColumnRenamed("id", "merchant_id")
    out = out.join(category, "merchant_id", "left").join(is_online(geography), "merchant_id", "left")
    return out.select("merchant_id", *FIRST, F.lit(0).cast("long").alias("onboarded_unix_time"), fn.clean_text("category").alias("merchant_category_code"), F.lit("").alias("merchant_country"), F.lit("unknown").alias("merchant_type"), F.coalesce("is_online", F.lit(True)).alias("is_online"), "first_seen_is_floor")


def merchant_geography(merchant: DataFrame, city: DataFrame, state: DataFrame, zipcode: DataFrame) -> DataFrame:
    """Counts and least values of places; each edge table is summed up first, so their rows don't multiply."""
    out = merchant.select(F.col("id").alias("merchant_id")).distinct()
    for edges, c, n in ((city, "city_id", "city_count"), (state, "state_id", "state_count"), (zipcode, "zipcode_id", "zipcode_count")):
        out = out.join(edges.groupBy("merchant_id").agg(F.countDistinct(c).alias(n), F.min(c).alias(c)), "merchant_id", "left").withColumn(n, F.coalesce(n, F.lit(0)))
    return out


def located() -> Column:
    return F.col("city_id").isNotNull() & F.col("state_id").isNotNull() & F.col("zipcode_id").isNotNull()


def is_online(geography: DataFrame) -> DataFrame:
    return geography.select("merchant_id", (~located()).alias("is_online"))


def merchant_locations(geography: DataFrame, coordinates: DataFrame, seen: DataFrame) -> DataFrame:
    """Outlets with a full place whose merchant has been paid. Only has_coordinates tells whether 0, 0 is a place."""
    at = coordinates.select("merchant_id", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.lit(True).alias("has"))
    out = geography.where(located()).join(at, "merchant_id", "left").join(seen, "merchant_id")
    has = F.coalesce("has", F.lit(False))
    return out.select("merchant_id", F.concat("merchant_id", F.lit("@"), "zipcode_id").alias("location_id"), F.lit("").alias("country_code"), fn.clean_text("state_id").alias("region_code"), fn.postal_prefix("zipcode_id").alias("postal_code_prefix"), F.when(has, F.col("lat")).otherwise(0.0).alias("latitude"), F.when(has, F.col("lon")).otherwise(0.0).alias("longitude"), has.alias("has_coordinates"), *FIRST)


def _home(tenures: DataFrame, c: str, n: str) -> DataFrame:
    """The earliest tenure of each party (ties: the lesser value) and how many values it has had."""
    since = F.col("since_unix_time").cast("long")
    # nulls come last in an order, but first in a struct
    first = F.min_by(F.col(c), F.struct(since.isNull(), since, F.col(c).isNull(), F.col(c)))
    return tenures.groupBy("party_id").agg(first.alias(c), F.countDistinct(c).alias(n))


def party_home_area(party: DataFrame, states: DataFrame, zips: DataFrame) -> DataFrame:
    out = party.select(F.col("id").alias("party_id")).join(_home(states, "state_id", "s"), "party_id", "left").join(_home(zips, "zipcode_id", "z"), "party_id", "left")
    return out.select("party_id", "state_id", "zipcode_id", F.coalesce("z", F.lit(0)).alias("postcode_tenure_count"), F.coalesce("s", F.lit(0)).alias("state_tenure_count"))


def not_blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit(""))) != ""


def held_values(edges: DataFrame, c: str, party_seen: DataFrame, limits: DataFrame, token: Column) -> DataFrame:
    """Distinct values that parties hold: raw, id (the token, made once a value) and stamps."""
    holders = earliest(edges.join(party_seen, "party_id"), c)
    values = edges.where(not_blank(c)).select(F.col(c).alias("raw")).distinct()
    return with_floor(values, holders, "raw", c, limits, "_floor").select("raw", token.alias("id"), *FIRST)


def address_areas(edges: DataFrame, homes: DataFrame) -> DataFrame:
    """Areas among the holders of an address; a pair with one null part is an area of its own."""
    known = edges.join(homes, "party_id").where("state_id IS NOT NULL OR zipcode_id IS NOT NULL")
    return known.groupBy(F.col("address").alias("raw")).agg(F.countDistinct(F.struct("state_id", "zipcode_id")).alias("areas"), F.min("state_id").alias("state_id"), F.min("zipcode_id").alias("zipcode_id"))


def address_values(values: DataFrame, areas: DataFrame) -> DataFrame:
    n = F.coalesce("areas", F.lit(0))
    one = lambda c: F.when(n == 1, c).otherwise("")
    return values.join(areas, "raw", "left").select("raw", "id", F.lit("").alias("country_code"), one(fn.clean_text("state_id")).alias("region_code"), one(fn.postal_prefix("zipcode_id")).alias("postal_code_prefix"), n.alias("distinct_area_count"), *FIRST)


def document_values(values: DataFrame, registry: DataFrame) -> DataFrame:
    kind = fn.clean_text(F.lower(F.trim(F.coalesce("id_type", F.lit("unknown")))))
    return values.join(registry.select(F.col("id").alias("raw"), "id_type"), "raw", "left").select("raw", "id", kind.alias("document_type"), F.lit("").alias("issuing_country"), *FIRST)


def endpoint_values(held: DataFrame, used: DataFrame, c: str, seen: DataFrame, limits: DataFrame, token: Column) -> DataFrame:
    """Devices or addresses that parties hold or payments use, flagged by which."""
    mark = lambda df, h: df.where(not_blank(c)).select(F.col(c).alias("raw"), F.lit(h).alias("h"), F.lit(not h).alias("u"))
    values = mark(held, True).unionByName(mark(used, False)).groupBy("raw").agg(F.bool_or("h").alias("held_by_party"), F.bool_or("u").alias("used_by_transaction"))
    return with_floor(values, seen, "raw", c, limits, "_floor").select("raw", token.alias("id"), *FIRST, "held_by_party", "used_by_transaction")


def lower_bound(edges: DataFrame, left: str, left_seen: DataFrame, right_values: DataFrame, raw: str, right: str) -> DataFrame:
    """Distinct pairs valid from the later of the two first-seen stamps, open at the end.

    The stamp is a bound from below: never a feature of when the pair began.
    """
    a = left_seen.select(left, F.col("first_seen_event_seq").alias("_a"))
    b = right_values.select(F.col(raw).alias("_raw"), F.col(right), F.col("first_seen_event_seq").alias("_b"))
    return edges.join(b, F.col("_edge") == F.col("_raw")).join(a, left).select(left, right, F.greatest("_a", "_b").alias("valid_from_seq"), F.lit(0).cast("long").alias("valid_to_seq")).distinct()


def party_value_relation(edges: DataFrame, c: str, values: DataFrame, party_seen: DataFrame, name: str) -> DataFrame:
    return lower_bound(edges.withColumn("_edge", F.col(c)).select("party_id", "_edge"), "party_id", party_seen, values.withColumnRenamed("id", name), "raw", name)


def account_has_card(account: DataFrame, card_seen: DataFrame, limits: DataFrame) -> DataFrame:
    """Card tenures of an account: one ends where the next generation starts, if that is strictly later."""
    start = with_floor(account, card_seen, "card_id", "card_number", limits).withColumnRenamed("first_seen_event_seq", "valid_from_seq")
    follower = F.lead("valid_from_seq").over(Window.partitionBy("account_id").orderBy("generation", "card_id"))
    out = start.withColumn("_next", follower)
    return out.select("account_id", "card_id", "valid_from_seq", F.when(F.col("_next") > F.col("valid_from_seq"), F.col("_next")).otherwise(0).cast("long").alias("valid_to_seq"))
