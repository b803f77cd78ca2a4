"""The event clock: dense global rank, as-of rank, first-seen stamps. No sort in a single partition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def dense_rank_by(df: DataFrame, time: str, id: str, out: str = "event_seq", bucket: int = DAY) -> DataFrame:
    """Adds the rank 1..N over (time, id).

    Rows are ranked by id within one moment only; a moment is shifted by the rows of its bucket before
    it, and a bucket by those of all buckets before. So a window holds the rows of one moment, or a row
    for each moment of a bucket, or a row for each bucket, however busy a bucket is. `bucket` is in
    units of `time`. Null times come first; ids are ordered by their bytes.
    """
    moment = ["_timed", "_at"]
    keyed = df.withColumns({"_timed": F.col(time).isNotNull(), "_at": F.coalesce(F.col(time), F.lit(0))})
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*moment).agg(F.count("*").alias("_n")).withColumn("_bucket", F.floor(F.col("_at") / bucket))
    buckets = counts.groupBy("_timed", "_bucket").agg(F.sum("_n").alias("_n")).select("_timed", "_bucket", F.coalesce(F.sum("_n").over(before.orderBy("_timed", "_bucket")), F.lit(0)).alias("_buckets_before"))
    moments = counts.select(*moment, "_bucket", F.coalesce(F.sum("_n").over(before.partitionBy("_timed", "_bucket").orderBy("_at")), F.lit(0)).alias("_moments_before"))
    shift = moments.join(buckets, ["_timed", "_bucket"]).select(*moment, (F.col("_moments_before") + F.col("_buckets_before")).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*moment).orderBy(id))
    ranked = keyed.withColumn("_within", within).join(shift, moment)
    return ranked.select(*df.columns, (F.col("_within") + F.col("_before")).cast("long").alias(out))


def event_sequence(transactions: DataFrame, bucket: int = DAY) -> DataFrame:
    rows = transactions.select(F.col("id").alias("transaction_id"), F.col("unix_time").cast("long").alias("unix_time"))
    return dense_rank_by(rows, "unix_time", "transaction_id", bucket=bucket).select("transaction_id", "unix_time", "event_seq")


def rank_by_second(sequence: DataFrame) -> DataFrame:
    return sequence.groupBy("unix_time").agg(F.max("event_seq").alias("latest_event_seq"))


def seq_after(by_time: DataFrame, probes: DataFrame, epoch: str, bucket: int = DAY) -> DataFrame:
    """(epoch, seq_after): the rank after the last event at or before each distinct epoch of `probes`; 1 before all events.

    Events and probes lie in the same buckets of time; a running maximum within a bucket starts from
    the maximum of all buckets before.
    """
    asked = probes.select(F.col(epoch).alias("t")).where("t IS NOT NULL").distinct().select("t", F.lit(None).cast("long").alias("s"))
    rows = by_time.select(F.col("unix_time").alias("t"), F.col("latest_event_seq").alias("s")).unionByName(asked).withColumn("b", F.floor(F.col("t") / bucket))
    prior = F.max("m").over(Window.orderBy("b0").rowsBetween(Window.unboundedPreceding, -1))
    start = rows.groupBy(F.col("b").alias("b0")).agg(F.max("s").alias("m")).select("b0", prior.alias("carried"))
    run = F.max("s").over(Window.partitionBy("b").orderBy("t").rangeBetween(Window.unboundedPreceding, 0))
    ranked = rows.withColumn("run", run).join(start, F.col("b") == F.col("b0"))
    return ranked.where("s IS NULL").select(F.col("t").alias("epoch"), (F.coalesce("run", "carried", F.lit(0)) + 1).cast("long").alias("seq_after"))


def bounds(sequence: DataFrame) -> DataFrame:
    return sequence.agg(F.min("unix_time").alias("minimum_epoch"), F.max("unix_time").alias("maximum_epoch"), F.min("event_seq").alias("minimum_event_seq"), F.max("event_seq").alias("maximum_event_seq"), F.count("*").alias("transaction_count"))


FIRST = ("first_seen_unix_time", "first_seen_event_seq")


def first_seen_of_events(edges: DataFrame, key: str, sequence: DataFrame) -> DataFrame:
    """Earliest stamps of each key over its own events."""
    return edges.join(sequence, edges["txn_id"] == sequence["transaction_id"]).groupBy(key).agg(F.min("unix_time").alias(FIRST[0]), F.min("event_seq").alias(FIRST[1]))


def earliest(rows: DataFrame, key: str | Column) -> DataFrame:
    return rows.groupBy(key).agg(*[F.min(c).alias(c) for c in FIRST])


def first_seen_over(key: str, *paths: DataFrame) -> DataFrame:
    """Earliest stamps over several ways in which a key is seen."""
    return earliest(reduce(DataFrame.unionByName, [p.select(key, *FIRST) for p in paths]), key)


def through(edges: DataFrame, by: str, seen: DataFrame, key: str) -> DataFrame:
    """Stamps that `key` takes over from the other end of an edge."""
    return edges.join(seen, by).select(key, *FIRST)


def with_floor(df: DataFrame, seen: DataFrame, on: str, key: str, limits: DataFrame, flag: str = "first_seen_is_floor") -> DataFrame:
    """Adds the stamps of `seen`, or of the first event of all where a row has none (flag true)."""
    floor = F.broadcast(limits.select(F.col("minimum_epoch").alias("_t"), F.col("minimum_event_seq").alias("_s")))  # one row
    joined = df.join(seen.select(F.col(key).alias("_k"), *FIRST), F.col(on) == F.col("_k"), "left").crossJoin(floor)
    return joined.withColumns({flag: F.col("_k").isNull(), FIRST[0]: F.coalesce(FIRST[0], "_t"), FIRST[1]: F.coalesce(FIRST[1], "_s")}).drop("_k", "_t", "_s")


_BLOCK = 32768  # ranks in one of Spark's bitmaps


def rank_blocks(df: DataFrame, c: str = "event_seq") -> DataFrame:
    """Which ranks occur, as bitmaps of 4 KB for each 32,768 of them: block (from 0), ranks (how many occur).

    What is shuffled is a bitmap for each block and task, not a row for each rank. Ranks from 1 to 2^63-1.
    """
    rank = F.col(c).try_cast("long")
    return df.where(rank > 0).groupBy((F.bitmap_bucket_number(rank) - 1).alias("block")).agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(rank))).alias("ranks"))


def distinct_ranks(df: DataFrame, c: str = "event_seq") -> DataFrame:
    """One row: how many distinct values c has (ranks). Those that are no rank, which a sound sequence lacks, are counted one by one."""
    other = df.where(F.coalesce(F.col(c).try_cast("long") <= 0, F.col(c).isNotNull())).agg(F.countDistinct(c).alias("ranks"))
    return rank_blocks(df.where(F.col(c).try_cast("long") > 0), c).agg(F.coalesce(F.sum("ranks"), F.lit(0)).alias("ranks")).unionByName(other).agg(F.sum("ranks").alias("ranks"))


def missing_ranks(df: DataFrame, c: str = "event_seq") -> DataFrame:
    """Ranks from 1 to the highest that no row has. Only blocks whose bitmap isn't full are looked through."""
    rank = F.col(c).try_cast("long")
    top = df.agg(F.max(rank).alias("top"))
    all_blocks = top.where("top > 0").select("top", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("top") - 1) / _BLOCK))).alias("block"))
    due = all_blocks.withColumn("due", F.least(F.lit(_BLOCK).cast("long"), F.col("top") - F.col("block") * _BLOCK))
    torn = due.join(rank_blocks(df, c), "block", "left").where(F.coalesce("ranks", F.lit(0)) < F.col("due"))
    each = torn.select(F.explode(F.sequence(F.col("block") * _BLOCK + 1, F.col("block") * _BLOCK + F.col("due"))).alias(c))
    held = df.select(rank.alias(c), F.floor((rank - 1) / _BLOCK).alias("block")).join(torn.select("block"), "block", "left_semi").select(c)
    return each.join(held, c, "left_anti")
