"""Known breaches of the card-fraud sources, so that every gate has rows to find; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequora.sources.projection import SQL, picked


def mutate_sources(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    t = dict(src)
    t["card_edge"] = t["card_edge"].where(~picked("txn_id", 2)).union(t["card_edge"].where(picked("txn_id", 3)))
    t["merchant_edge"] = t["merchant_edge"].withColumn("merchant_id", F.when(picked("txn_id", 4), "nobody").otherwise(F.col("merchant_id")))
    t["device_edge"] = t["device_edge"].union(t["device_edge"].where(picked("txn_id", 5)))
    x = t["transaction"]
    x = x.withColumn("unix_time", F.when(picked("id", 6), "-5").when(picked("id", 10), "").otherwise(F.col("unix_time")))
    x = x.withColumn("transaction_time", F.when(picked("id", 7), "2000-01-01 00:00:01").otherwise(F.col("transaction_time")))
    x = x.withColumn("is_fraud", F.when(picked("id", 8), "2").otherwise(F.col("is_fraud")))
    t["transaction"] = x.union(x.where(picked("id", 9)))
    return t


def mutate_entities(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Breaches that the reports over prepared frames find."""
    t = dict(src)
    t["merchant_city"] = t["merchant_city"].where(~picked("merchant_id", 2)).union(t["merchant_city"].where(picked("merchant_id", 3)).withColumn("city_id", F.lit("ELSEWHERE")))
    t["merchant_zip"] = t["merchant_zip"].union(t["merchant_zip"].where(picked("merchant_id", 4)).withColumn("zipcode_id", F.lit("99999")))
    t["merchant_category"] = t["merchant_category"].union(t["merchant_category"].where(picked("merchant_id", 5)).withColumn("category", F.lit("MCC99")))
    t["operator"] = t["operator"].union(t["operator"].withColumn("party_id", F.lit("P4"))).where(~picked("merchant_id", 6))
    t["party_has_card"] = t["party_has_card"].where(~picked("card_number", 7))
    t["card_edge"] = t["card_edge"].withColumn("card_number", F.when(picked("txn_id", 8), "X1").otherwise(F.col("card_number")))
    return t


def hit(c: str, digit: int) -> str:
    return f"substr(md5({c}),{digit},1)='3'"


SOURCES_SQL = {
    "card_edge": f"SELECT txn_id, card card_number FROM base WHERE NOT {hit('txn_id', 2)} UNION ALL SELECT txn_id, card FROM base WHERE {hit('txn_id', 3)}",
    "merchant_edge": f"SELECT txn_id, CASE WHEN {hit('txn_id', 4)} THEN 'nobody' ELSE s::VARCHAR END merchant_id FROM base",
    "device_edge": f"SELECT txn_id, device_id FROM used UNION ALL SELECT txn_id, device_id FROM used WHERE {hit('txn_id', 5)}",
    "transaction0": SQL["transaction"],
    "transaction1": f"SELECT id, CASE WHEN {hit('id', 7)} THEN '2000-01-01 00:00:01' ELSE transaction_time END transaction_time, amount, CASE WHEN {hit('id', 8)} THEN 2 ELSE is_fraud END is_fraud, CASE WHEN {hit('id', 6)} THEN -5 WHEN {hit('id', 10)} THEN NULL ELSE unix_time END unix_time, mer_cat, use_chip FROM transaction0",
    "transaction": f"SELECT * FROM transaction1 UNION ALL SELECT * FROM transaction1 WHERE {hit('id', 9)}",
}
ENTITIES_SQL = {
    "merchant_city": f"SELECT s_suppkey::VARCHAR merchant_id, n_name city_id FROM physical WHERE NOT {hit('s_suppkey::VARCHAR', 2)} UNION ALL SELECT s_suppkey::VARCHAR, 'ELSEWHERE' FROM physical WHERE {hit('s_suppkey::VARCHAR', 3)}",
    "merchant_zip": SQL["merchant_zip"] + f" UNION ALL SELECT s_suppkey::VARCHAR, '99999' FROM physical WHERE {hit('s_suppkey::VARCHAR', 4)}",
    "merchant_category": SQL["merchant_category"] + f" UNION ALL SELECT s_suppkey::VARCHAR, 'MCC99' FROM supplier WHERE {hit('s_suppkey::VARCHAR', 5)}",
    "operator0": SQL["operator"],
    "operator": f"SELECT * FROM operator0 WHERE NOT {hit('merchant_id', 6)} UNION ALL SELECT merchant_id, 'P4' FROM operator0 WHERE NOT {hit('merchant_id', 6)}",
    "party_has_card": f"SELECT * FROM (SELECT DISTINCT 'P'||o_custkey::VARCHAR party_id, card card_number FROM base) WHERE NOT {hit('card_number', 7)}",
    "card_edge": f"SELECT txn_id, CASE WHEN {hit('txn_id', 8)} THEN 'X1' ELSE card END card_number FROM base",
}
