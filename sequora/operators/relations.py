"""What is visible at a seed of the event clock, in either direction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sequora.functions import visible


def visible_tenures(tenures: DataFrame, seeds: DataFrame, key: str, seed: str = "seed_seq") -> DataFrame:
    """Tenures in force at each seed of the same key.

    Tenures are laid in blocks of the clock that are as wide as the next power of two of their
    length, so each lies in two of them at most; a seed looks into its block of each width that its
    key has (64 at most), so it is repeated for these and not for all that occur; the widths of a key
    are one row, and AQE splits a hub key's seeds where they meet it. What meets is a tenure that covers a good part of the seed's block, so a
    hub key with many tenures after each other isn't paired with all its seeds, and its rows are spread
    over its blocks. Open tenures reach to just behind the last seed.
    """
    start, end = F.col("valid_from_seq"), F.col("valid_to_seq")
    last = seeds.agg((F.max(seed) + 1).cast("long").alias("_last"))
    closed = tenures.where(start.isNotNull() & end.isNotNull() & tenures[key].isNotNull()).crossJoin(F.broadcast(last))
    closed = closed.withColumn("_end", F.when(end == 0, F.greatest("_last", start + 1)).otherwise(end).cast("long")).where(F.col("_end") > start)
    width = F.ceil(F.log2((F.col("_end") - start).cast("double"))).cast("int")
    block = lambda t, w: F.call_function("shiftright", t.cast("long"), w)
    laid = closed.withColumn("_width", width).withColumn("_block", F.explode(F.sequence(block(start, F.col("_width")), block(F.col("_end") - 1, F.col("_width"))))).drop("_last", "_end")
    laid = laid.withColumnRenamed(key, "_key")
    widths = laid.groupBy(F.col("_key").alias("_of")).agg(F.collect_set("_width").alias("_widths"))
    asked = seeds.join(widths, F.col(key) == F.col("_of")).drop("_of").withColumn("_w", F.explode("_widths")).drop("_widths").withColumn("_at", block(F.col(seed), F.col("_w")))
    met = asked.join(laid, (F.col(key) == F.col("_key")) & (F.col("_w") == F.col("_width")) & (F.col("_at") == F.col("_block")) & visible("valid_from_seq", "valid_to_seq", seed))
    return met.drop("_w", "_at", "_key", "_width", "_block")


def events_before(events: DataFrame, seeds: DataFrame, key: str, seed: str = "seed_seq", bucket: int = 1_000_000) -> DataFrame:
    """(key, seed, events, latest): how many events lie strictly before each distinct seed of the same key, and the last of them.

    No pair of event and seed is formed: a running count within buckets of the clock starts from the
    sums of the buckets before, so a hub key is spread over its buckets. Seeds without an event, and
    null keys, have no row.
    """
    asked = seeds.select(key, F.col(seed).alias("t"), F.lit(0).alias("n")).distinct()
    rows = events.select(key, F.col("event_seq").alias("t"), F.lit(1).alias("n")).unionByName(asked).withColumn("b", F.floor(F.col("t") / bucket))
    at = F.when(F.col("n") == 1, F.col("t"))
    prior = Window.partitionBy(key).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(key, "b").agg(F.sum("n").alias("s"), F.max(at).alias("m")).select(key, "b", F.sum("s").over(prior).alias("carried"), F.max("m").over(prior).alias("carried_at"))
    within = Window.partitionBy(key, "b").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    run = rows.select(key, "b", "t", "n", F.sum("n").over(within).alias("run"), F.max(at).over(within).alias("run_at")).where("n = 0")
    counted = F.coalesce("run", F.lit(0)) + F.coalesce("carried", F.lit(0))
    return run.join(carried, [key, "b"]).select(key, F.col("t").alias(seed), counted.alias("events"), F.coalesce("run_at", "carried_at").alias("latest")).where("events > 0")


def covered(seeds: DataFrame, tenures: DataFrame, keys: list[str], seed: str, bucket: int = 1_000_000) -> DataFrame:
    """Distinct (keys, seed) at which a tenure of the keys is in force: the latest end among those begun by then lies behind the seed.

    No pair is formed: a running maximum within buckets of the clock, carried on from the buckets before.
    """
    top = F.lit(str(2**64)).cast("decimal(20,0)")
    begun = tenures.select(*keys, F.col("valid_from_seq").cast("decimal(20,0)").alias("t"), F.when(F.col("valid_to_seq") == 0, top).otherwise(F.col("valid_to_seq")).cast("decimal(20,0)").alias("end"), F.lit(None).cast("boolean").alias("asked"))
    asked = seeds.select(*keys, F.col(seed).cast("decimal(20,0)").alias("t"), F.lit(None).cast("decimal(20,0)").alias("end"), F.lit(True).alias("asked")).distinct()
    rows = begun.unionByName(asked).where(F.col("t").isNotNull()).withColumn("b", F.floor(F.col("t") / bucket))
    within = Window.partitionBy(*keys, "b").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*keys, "b").agg(F.max("end").alias("m")).select(*keys, "b", F.max("m").over(before).alias("carried"))
    run = rows.withColumn("run", F.max("end").over(within)).where("asked").join(carried, [*keys, "b"])
    return run.where(F.greatest("run", "carried") > F.col("t")).select(*keys, F.col("t").alias(seed))


def visible_entities(entities: DataFrame, seeds: DataFrame, key: str, seed: str = "seed_seq") -> DataFrame:
    """Entities first seen at or before each seed that asks for them."""
    return seeds.join(entities, (seeds[key] == entities[key]) & (entities["first_seen_event_seq"] <= seeds[seed])).drop(entities[key])


def instrument_in_force(payments: DataFrame, tenures: DataFrame) -> DataFrame:
    """The card tenure of the paying account that is in force at each payment."""
    seeds = payments.select("transaction_id", "account_id", F.col("event_seq").alias("seed_seq"), F.col("card_id").alias("used_card_id"))
    return visible_tenures(tenures, seeds, "account_id").select("transaction_id", "account_id", "seed_seq", "used_card_id", "card_id", "valid_from_seq", "valid_to_seq")


def reverse(edges: DataFrame, source: str = "from_id", target: str = "to_id") -> DataFrame:
    """The same rows walked from their targets: ends change places, everything else stays."""
    swap = {source: target, target: source}
    return edges.select(*[F.col(swap.get(c, c)).alias(c) for c in edges.columns])


def edge_key(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Tenures of one pair are told apart by their start; returns keys and how many rows have each."""
    return edges.groupBy(source, target, "valid_from_seq").agg(F.count("*").alias("rows"))
