"""The payment manifest: one row for each payment with all endpoint keys, place and label clocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequora import functions as fn
from sequora.operators.sequence import rank_by_second, seq_after


def label_maturity(txn: DataFrame, sequence: DataFrame, limits: DataFrame, policy: fn.LabelPolicy) -> DataFrame:
    """Adds label_known, label_available_unix_time, label_available_seq and label_source.

    Fraud is known whether or not its confirmation falls inside the data (its rank may then be the
    one after the last event); a clean label once its window has run out before the data end.
    `txn` has transaction_id, unix_time and fraud_label.
    """
    end = F.broadcast(limits.select(F.col("maximum_epoch").alias("_end")))  # one row
    fraud, ripe = F.col("fraud_label") == 1, F.col("unix_time") + policy.maturation_window_seconds
    out = txn.crossJoin(end)
    known = fraud | (ripe <= F.col("_end"))
    at = F.when(fraud, F.col("unix_time") + policy.fraud_confirmation_delay_seconds).when(ripe <= F.col("_end"), ripe)
    out = out.withColumns({"label_known": known, "_at": at})
    ranks = seq_after(rank_by_second(sequence), out, "_at")
    out = out.join(ranks, F.col("_at") == F.col("epoch"), "left")
    return out.withColumns({"label_available_unix_time": F.coalesce("_at", F.lit(0)).cast("long"), "label_available_seq": F.coalesce("seq_after", F.lit(0)).cast("long"), "label_source": F.when(F.coalesce("label_known", F.lit(False)), policy.policy_id).otherwise("")}).drop("_end", "_at", "epoch", "seq_after")


def payments(txn: DataFrame, card_edges: DataFrame, merchant_edges: DataFrame, sequence: DataFrame, locations: DataFrame) -> DataFrame:
    """Payments with their rank, their ends and their place: the rows of the manifest before labels, which add columns and no rows."""
    t = txn.select(F.col("id").alias("transaction_id"), F.col("amount").cast("double").alias("amount"), F.col("amount").isNotNull().alias("amount_present"), "use_chip", fn.clean_text("mer_cat").alias("merchant_category_code"), F.col("is_fraud").cast("int").alias("fraud_label"))
    t = t.join(sequence, "transaction_id")
    t = t.join(card_edges.select(F.col("txn_id").alias("transaction_id"), F.col("card_number").alias("card_id")), "transaction_id")
    t = t.join(merchant_edges.select(F.col("txn_id").alias("transaction_id"), "merchant_id"), "transaction_id")
    t = t.join(locations.select("merchant_id", "location_id", "latitude", "longitude", "has_coordinates"), "merchant_id", "left")
    return t.withColumn("account_id", fn.funding_account_id("card_id"))


def manifest(paid: DataFrame, sequence: DataFrame, limits: DataFrame, policy: fn.LabelPolicy) -> DataFrame:
    t = label_maturity(paid, sequence, limits, policy)
    shown = F.coalesce(fn.card_present("use_chip") & F.col("has_coordinates"), F.lit(False))
    return t.select(
        "transaction_id", "unix_time", "event_seq", "amount", "amount_present", F.lit("").alias("currency"), F.lit("purchase").alias("transaction_type"),
        fn.channel("use_chip").alias("channel"), fn.entry_mode("use_chip").alias("entry_mode"), fn.card_present("use_chip").alias("card_present"), F.lit(False).alias("is_cross_border"), F.lit(False).alias("is_recurring"),
        "merchant_category_code", shown.alias("has_event_location"), F.when(shown, F.col("latitude")).otherwise(0.0).alias("event_latitude"), F.when(shown, F.col("longitude")).otherwise(0.0).alias("event_longitude"),
        F.lit(-1.0).alias("device_risk_score"), F.lit(-1.0).alias("ip_risk_score"), "fraud_label", "label_known", "label_available_unix_time", "label_available_seq", "label_source",
        "card_id", "account_id", "merchant_id", "location_id",
    )


def endpoint_edges(edges: DataFrame, c: str, sequence: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Device or address of a payment, with the payment's clock (the edge's own is not read)."""
    return edges.select(F.col("txn_id").alias("transaction_id"), F.col(c).alias("raw")).join(sequence, "transaction_id").join(values.select("raw", F.col("id").alias(name)), "raw").select("transaction_id", name, "unix_time", "event_seq")
