"""The payment model's source tables as projections of an order, customer, supplier and event schema.

All columns are text, as the source contract asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.sources.contracts import BY_NAME, SOURCE_COLUMNS
from sequora.sources.staging import staged


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def epoch(c):
    """Seconds of a timestamp without zone, read as UTC, whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, lines, customers, suppliers, nation, region, events = (read(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "supplier", "nation", "region", "events"))
    key = F.col("o_orderkey")
    of_line = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("s"))
    base = orders.join(of_line, "o_orderkey", "left").select(
        text(key).alias("txn_id"),
        epoch("o_orderdate").alias("t"),
        text("o_totalprice").alias("amount"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (key % 5 == 0), "1").otherwise("0").alias("is_fraud"),
        F.element_at(F.array(*map(F.lit, ("Online Transaction", "Chip Transaction", "Swipe Transaction", "Contactless"))), (key % 4 + 1).cast("int")).alias("use_chip"),
        F.coalesce("s", key % 10).alias("s"),
        "o_custkey",
        F.expr("(year(o_orderdate) - 1995) div 2").alias("g"),
    )
    card = F.concat(F.when(F.col("o_custkey") % 2 == 0, "C").otherwise("D"), F.lpad(text("o_custkey"), 7, "0"), F.when(F.col("g") == 0, "").otherwise(F.concat(F.lit("-G"), text("g"))))
    base = staged(base.withColumn("card", card).withColumn("t_text", text("t")))  # seven tables are cut from it
    place = suppliers.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    physical = place.where("s_suppkey % 5 <> 0")
    zipcode = lambda n: F.lpad(text(n * 137), 5, "0")
    merchant = text("s_suppkey").alias("merchant_id")
    party = F.concat(F.lit("P"), text("c_custkey"))
    homes = customers.select(party.alias("party_id"), F.explode(F.when(F.col("c_custkey") % 9 == 0, F.array(F.struct(F.col("c_nationkey").alias("n"), F.lit("0").alias("since")), F.struct(((F.col("c_nationkey") + 1) % 25).alias("n"), F.lit("1000").alias("since")))).otherwise(F.array(F.struct(F.col("c_nationkey").alias("n"), F.lit("0").alias("since"))))).alias("h")).select("party_id", "h.*")
    homes = homes.join(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")), F.col("n") == F.col("n_nationkey"))
    count = customers.agg(F.count("*").alias("customers"))
    used = events.join(orders.agg(F.count("*").alias("n_orders")), F.col("event_id") < F.col("n_orders"))
    device, ip = F.get_json_object("props", "$.k"), F.concat(F.lit("ip"), text(F.col("event_id") % 211))
    held = events.where("event_type = 'signup'").select(F.concat(F.lit("P"), text("user_id")).alias("party_id"), device.alias("device_id"), ip.alias("ip_id"))
    has = customers.select(
        party.alias("party_id"),
        F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email"),
        F.concat(F.lit("ph-"), text(F.expr("c_custkey div 2"))).alias("phone_number"),
        F.concat(F.lit("addr-"), text(F.col("c_custkey") % 300)).alias("address"),
        F.concat(F.lit("doc-"), text("c_custkey")).alias("id"),
        F.when(F.col("c_custkey") % 3 == 0, "Passport").when(F.col("c_custkey") % 3 == 1, "license").alias("id_type"),
    )
    one = lambda df, c, extra: df.select(c).where(F.col(c).isNotNull()).distinct().union(spark.range(1).select(F.lit(extra)))
    out = {
        "transaction": base.select(F.col("txn_id").alias("id"), F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd HH:mm:ss").alias("transaction_time"), "amount", "is_fraud", F.col("t_text").alias("unix_time"), F.concat(F.lit("MCC"), text(F.col("s") % 20)).alias("mer_cat"), "use_chip"),
        "card_edge": base.select("txn_id", F.col("card").alias("card_number"), F.col("t_text").alias("edge_unix_time")),
        "merchant_edge": base.select("txn_id", text("s").alias("merchant_id"), F.col("t_text").alias("edge_unix_time")),
        "device_edge": used.select(text("event_id").alias("txn_id"), device.alias("device_id"), text(epoch("ts")).alias("edge_unix_time")),
        "ip_edge": used.select(text("event_id").alias("txn_id"), ip.alias("ip_id"), text(epoch("ts")).alias("edge_unix_time")),
        "card": base.select(F.col("card").alias("card_number")).distinct(),
        "merchant": suppliers.select(text("s_suppkey").alias("id")),
        "party": customers.select(
            party.alias("id"),
            F.element_at(F.array(*map(F.lit, ("Individual", "business", " merchant ", "other"))), (F.col("c_custkey") % 4 + 1).cast("int")).alias("party_type"),
            F.when(F.col("c_custkey") % 11 != 0, F.concat(text(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))), F.lit(" 12:30:00"))).alias("created_at"),
        ),
        "party_has_card": base.select(F.concat(F.lit("P"), text("o_custkey")).alias("party_id"), F.col("card").alias("card_number")).distinct(),
        "operator": suppliers.crossJoin(F.broadcast(count)).select(merchant, F.concat(F.lit("P"), text(F.col("s_suppkey") % F.col("customers"))).alias("party_id")),
        "merchant_category": suppliers.select(merchant, F.concat(F.lit("MCC"), text(F.col("s_suppkey") % 20)).alias("category")),
        "merchant_coordinates": physical.where("s_suppkey % 7 <> 0").select(merchant, text(F.col("s_nationkey") * 1.5).alias("lat"), text(F.col("s_nationkey") * -2.25).alias("lon")),
        "merchant_city": physical.select(merchant, F.col("n_name").alias("city_id")),
        "merchant_state": physical.select(merchant, F.col("r_name").alias("state_id")),
        "merchant_zip": physical.select(merchant, zipcode(F.col("s_nationkey")).alias("zipcode_id")),
        "home_state": homes.select("party_id", F.col("r_name").alias("state_id"), F.col("since").alias("since_unix_time")),
        "home_zip": homes.select("party_id", zipcode(F.col("n")).alias("zipcode_id"), F.col("since").alias("since_unix_time")),
        "has_email": has.select("party_id", "email"),
        "has_phone": has.select("party_id", "phone_number"),
        "has_address": has.select("party_id", "address"),
        "has_document": has.select("party_id", "id"),
        "has_device": held.select("party_id", "device_id"),
        "has_ip": held.select("party_id", "ip_id"),
        "email": one(has, "email", "unused@nowhere.example"),
        "phone": one(has, "phone_number", "ph-unused"),
        "address": one(has, "address", "addr-unused"),
        "document": has.select("id", "id_type").distinct(),
        "device": one(used.select(device.alias("id")), "id", "dev-unused"),
        "ip": one(used.select(ip.alias("id")), "id", "ip-unused"),
    }
    return {t: out[t].select(c) for t, c in SOURCE_COLUMNS.items()}


#: The same projections in DuckDB's SQL, by table.
SQL = {
    "base": """SELECT o_orderkey::VARCHAR txn_id, epoch(o_orderdate)::BIGINT t, o_totalprice amount, CASE WHEN o_orderpriority='1-URGENT' AND o_orderkey%5=0 THEN 1 ELSE 0 END is_fraud,
      (['Online Transaction','Chip Transaction','Swipe Transaction','Contactless'])[(o_orderkey%4+1)::INT] use_chip, coalesce(s, o_orderkey%10) s, o_custkey,
      CASE WHEN o_custkey%2=0 THEN 'C' ELSE 'D' END || lpad(o_custkey::VARCHAR,7,'0') || CASE WHEN (year(o_orderdate)-1995)//2=0 THEN '' ELSE '-G'||((year(o_orderdate)-1995)//2)::VARCHAR END card
      FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) s FROM lineitem GROUP BY 1) ON l_orderkey=o_orderkey""",
    "transaction": "SELECT txn_id id, strftime(to_timestamp(t) AT TIME ZONE 'UTC','%Y-%m-%d %H:%M:%S') transaction_time, amount, is_fraud, t unix_time, 'MCC'||(s%20)::VARCHAR mer_cat, use_chip FROM base",
    "card_edge": "SELECT txn_id, card card_number FROM base",
    "merchant_edge": "SELECT txn_id, s::VARCHAR merchant_id FROM base",
    "used": "SELECT event_id::VARCHAR txn_id, props->>'$.k' device_id, 'ip'||(event_id%211)::VARCHAR ip_id FROM events WHERE event_id < (SELECT count(*) FROM orders)",
    "device_edge": "SELECT txn_id, device_id FROM used",
    "ip_edge": "SELECT txn_id, ip_id FROM used",
    "card": "SELECT DISTINCT card card_number FROM base",
    "merchant": "SELECT s_suppkey::VARCHAR id FROM supplier",
    "party": "SELECT 'P'||c_custkey::VARCHAR id, (['Individual','business',' merchant ','other'])[(c_custkey%4+1)::INT] party_type, CASE WHEN c_custkey%11<>0 THEN (DATE '1995-01-01' + (c_custkey%1000)::INT)::VARCHAR||' 12:30:00' END created_at FROM customer",
    "party_has_card": "SELECT DISTINCT 'P'||o_custkey::VARCHAR party_id, card card_number FROM base",
    "operator": "SELECT s_suppkey::VARCHAR merchant_id, 'P'||(s_suppkey % (SELECT count(*) FROM customer))::VARCHAR party_id FROM supplier",
    "merchant_category": "SELECT s_suppkey::VARCHAR merchant_id, 'MCC'||(s_suppkey%20)::VARCHAR category FROM supplier",
    "physical": "SELECT s_suppkey, s_nationkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey WHERE s_suppkey%5<>0",
    "merchant_coordinates": "SELECT s_suppkey::VARCHAR merchant_id, s_nationkey*1.5::DOUBLE lat, s_nationkey*(-2.25::DOUBLE) lon FROM physical WHERE s_suppkey%7<>0",
    "merchant_city": "SELECT s_suppkey::VARCHAR merchant_id, n_name city_id FROM physical",
    "merchant_state": "SELECT s_suppkey::VARCHAR merchant_id, r_name state_id FROM physical",
    "merchant_zip": "SELECT s_suppkey::VARCHAR merchant_id, lpad((s_nationkey*137)::VARCHAR,5,'0') zipcode_id FROM physical",
    "homes": "SELECT party_id, n, since, r_name FROM (SELECT 'P'||c_custkey::VARCHAR party_id, c_nationkey n, 0 since FROM customer UNION ALL SELECT 'P'||c_custkey::VARCHAR, (c_nationkey+1)%25, 1000 FROM customer WHERE c_custkey%9=0) JOIN nation ON n=n_nationkey JOIN region ON n_regionkey=r_regionkey",
    "home_state": "SELECT party_id, r_name state_id, since since_unix_time FROM homes",
    "home_zip": "SELECT party_id, lpad((n*137)::VARCHAR,5,'0') zipcode_id, since since_unix_time FROM homes",
    "has": "SELECT 'P'||c_custkey::VARCHAR party_id, lower(c_name)||'@'||lower(c_mktsegment)||'.example' email, 'ph-'||(c_custkey//2)::VARCHAR phone_number, 'addr-'||(c_custkey%300)::VARCHAR address, 'doc-'||c_custkey::VARCHAR id, CASE c_custkey%3 WHEN 0 THEN 'Passport' WHEN 1 THEN 'license' END id_type FROM customer",
    "has_email": "SELECT party_id, email FROM has",
    "has_phone": "SELECT party_id, phone_number FROM has",
    "has_address": "SELECT party_id, address FROM has",
    "has_document": "SELECT party_id, id FROM has",
    "held": "SELECT 'P'||user_id::VARCHAR party_id, props->>'$.k' device_id, 'ip'||(event_id%211)::VARCHAR ip_id FROM events WHERE event_type='signup'",
    "has_device": "SELECT party_id, device_id FROM held",
    "has_ip": "SELECT party_id, ip_id FROM held",
    "email": "SELECT DISTINCT email FROM has UNION ALL SELECT 'unused@nowhere.example'",
    "phone": "SELECT DISTINCT phone_number FROM has UNION ALL SELECT 'ph-unused'",
    "address": "SELECT DISTINCT address FROM has UNION ALL SELECT 'addr-unused'",
    "document": "SELECT DISTINCT id, id_type FROM has",
    "device": "SELECT DISTINCT device_id id FROM used WHERE device_id IS NOT NULL UNION ALL SELECT 'dev-unused'",
    "ip": "SELECT DISTINCT ip_id id FROM used UNION ALL SELECT 'ip-unused'",
}


def temporal(spark: SparkSession, sf_dir: str, mutated: bool = False) -> dict[str, DataFrame]:
    """The 27 temporal tables, as text, from the event stream.

    `mutated` breaks the contract in known places, so that every check has rows to find.
    """
    events = read(spark, sf_dir, "events").where("event_id IS NOT NULL")
    t = epoch("ts") * 1000 + 1
    k, user = F.get_json_object("props", "$.k"), text("user_id")
    hashed = lambda prefix, c: F.concat(F.lit(prefix + "_"), F.md5(c))
    # the stream's ids are unique, and its clock never runs back along (time, id): the rank is given, with gaps
    from sequora.operators.sequence import dense_rank_by

    ranked = dense_rank_by(events.select("event_id", "user_id", "event_type", "value", k.alias("k"), t.alias("ms")), "ms", "event_id", "r", bucket=3_600_000).withColumn("seq", F.col("r") * 3)
    u = F.col("user_id")
    other = (u + 1) % 150
    base = staged(ranked.select(
        "event_id", "event_type", "value", "ms", "seq",
        hashed("a", text(u)).alias("sender"), hashed("a", text(other)).alias("receiver"), hashed("d", F.coalesce("k", F.lit("none"))).alias("device"), hashed("i", text(F.col("event_id") % 211)).alias("ip"),
        hashed("p", text(u)).alias("party"), hashed("t", text(u)).alias("s_token"), hashed("t", text(other)).alias("r_token"), hashed("h", text(u % 40)).alias("address"),
    ))  # fmt: skip  # all 27 tables are cut from it
    is_payment = F.col("event_type").isin("purchase", "view")
    payment, transfer = base.where(is_payment), base.where(~is_payment)
    num = lambda c: F.format_string("%d", c)
    seen = lambda rows, c: rows.groupBy(F.col(c).alias("id")).agg(F.min("seq").alias("s"), F.min("ms").alias("m"))
    both = lambda a, b: base.select(F.col(a).alias("x"), "seq", "ms").union(base.select(F.col(b).alias("x"), "seq", "ms"))
    stamps = lambda df: [num(df["s"]).alias("first_seen_seq"), num(df["m"]).alias("first_seen_ts_ms")]
    lit = F.lit
    account, token, device, ip, party, address = seen(both("sender", "receiver"), "x"), seen(both("s_token", "r_token"), "x"), seen(base, "device"), seen(base, "ip"), seen(base, "party"), seen(base, "address")
    when = F.date_format(F.timestamp_seconds((F.col("ms") / 1000).cast("long")), "yyyy-MM-dd HH:mm:ss")
    when = F.concat(when, lit(".001"))
    mule = picked("id", 1)
    fraud = F.col("event_type") == "error"
    out = {
        "Party": party.select("id", lit("unknown").alias("party_type"), *stamps(party)),
        "Account": account.select("id", lit("unknown").alias("account_type"), F.when(mule, "True").otherwise("False").alias("is_external"), *stamps(account), F.when(mule, "1").otherwise("0").alias("is_mule"), lit("False").alias("mule_label_known"), lit("true").alias("is_mule_masked"), lit("0").alias("pu_label"), num(account["s"]).alias("mule_label_effective_seq"), num(account["m"]).alias("mule_label_effective_ts_ms"), num(account["s"]).alias("mule_label_available_seq"), num(account["m"]).alias("mule_label_available_ts_ms"), F.when(mule, "3").otherwise("-1").alias("mule_ring_id"), F.when(mule, "role").alias("mule_label_source")),
        "Token": token.select(F.col("id").alias("token_id"), *stamps(token), lit("unknown").alias("token_kind"), lit("unknown").alias("token_network")),
        "Device": device.select("id", lit("unknown").alias("device_type"), *stamps(device)),
        "IP": ip.select("id", *stamps(ip)),
        "Address": address.select(F.col("id").alias("address_id"), *stamps(address), lit("unknown").alias("country_code")),
        "Payment_Transaction": payment.select(F.concat(lit("T"), text("event_id")).alias("transaction_id"), text(F.coalesce(F.abs("value"), lit(0.0))).alias("amount"), lit("USD").alias("currency"), lit("ach").alias("payment_rail"), lit("digital").alias("channel"), when.alias("event_time"), num("ms").alias("event_ts_ms"), num("seq").alias("event_seq"), F.when(F.col("value").isNull(), "false").otherwise("true").alias("amount_present")),
        "Zelle_Transfer": transfer.select(F.concat(lit("Z"), text("event_id")).alias("transfer_id"), when.alias("event_time"), num("ms").alias("event_ts_ms"), num("seq").alias("event_seq"), text(F.coalesce(F.abs("value"), lit(0.0))).alias("amount"), F.when(F.col("value").isNull(), "false").otherwise("true").alias("amount_present"), lit("USD").alias("currency"), lit("digital").alias("channel"), F.when(fraud, "1").otherwise("-1").alias("fraud_label"), F.when(fraud, "true").otherwise("false").alias("label_known"), F.when(fraud, num(F.col("seq") + 1)).otherwise("0").alias("label_available_seq"), F.when(fraud, num("ms")).otherwise("0").alias("label_available_ts_ms")),
    }
    pairs = {"Party_Owns_Account": ("party", "sender"), "Party_Uses_Token": ("party", "s_token"), "Party_Uses_Device": ("party", "device"), "Account_Uses_Device": ("sender", "device"), "Party_Uses_IP": ("party", "ip"), "Party_Has_Address": ("party", "address")}
    tenure = lambda rows: rows.select("from_id", "to_id", num("s").alias("valid_from_seq"), lit("0").alias("valid_to_seq"), lit("1").alias("confidence"), lit("synthetic_registry").alias("source_system"))
    for name, (a, b) in pairs.items():
        out[name] = tenure(base.groupBy(F.col(a).alias("from_id"), F.col(b).alias("to_id")).agg(F.min("seq").alias("s")))
    bound = base.select(F.col("s_token").alias("from_id"), F.col("sender").alias("to_id"), "seq").union(base.select("r_token", "receiver", "seq"))
    out["Token_Bound_To_Account"] = tenure(bound.groupBy("from_id", "to_id").agg(F.min("seq").alias("s")))
    roles = {"From_Account": "sender", "To_Account": "receiver", "From_Token": "s_token", "To_Token": "r_token", "Used_Device": "device", "Used_IP": "ip"}
    for e, rows, prefix in (("Transfer", transfer, "Z"), ("Transaction", payment, "T")):
        for role, c in roles.items():
            out[f"{e}_{role}"] = rows.select(F.concat(lit(prefix), text("event_id")).alias("from_id"), F.col(c).alias("to_id"), num("ms").alias("event_ts_ms"), num("seq").alias("event_seq"))
    if mutated:
        out = mutate(out)
    return {n: out[n].select(BY_NAME[n].columns) for n in BY_NAME}


def picked(c: str, digit: int):
    """About one row in sixteen, by a hex digit of the id's MD5."""
    return F.substring(F.md5(c), digit, 1) == "3"


def mutate(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Known breaches of the contract, on rows picked by their ids."""
    t = dict(t)
    change = lambda name, c, cond, v: t.__setitem__(name, t[name].withColumn(c, F.when(cond, F.lit(v)).otherwise(F.col(c))))
    change("Party", "party_type", picked("id", 2), "first|second")
    change("Party", "id", picked("id", 3), "person@example.com")
    change("Account", "is_mule", picked("id", 4), "2")
    change("Account", "mule_ring_id", picked("id", 5), "-2")
    change("Device", "first_seen_seq", picked("id", 6), "999999999")
    change("IP", "first_seen_seq", picked("id", 7), "0")
    change("Address", "first_seen_seq", picked("address_id", 8), "99999999999999999999")
    change("Payment_Transaction", "payment_rail", picked("transaction_id", 9), "Zelle")
    change("Payment_Transaction", "amount", picked("transaction_id", 10), "-1")
    change("Payment_Transaction", "event_ts_ms", picked("transaction_id", 11), "5000")
    change("Zelle_Transfer", "label_available_seq", (F.col("label_known") == "true") & picked("transfer_id", 12), "1")
    change("Zelle_Transfer", "transfer_id", picked("transfer_id", 13), "T0")
    change("Transfer_Used_Device", "event_seq", picked("from_id", 14), "12")
    change("Token_Bound_To_Account", "valid_to_seq", picked("from_id", 15), "900")
    change("Party_Uses_IP", "confidence", picked("to_id", 16), "1.5")
    t["Party_Owns_Account"] = t["Party_Owns_Account"].union(t["Party_Owns_Account"].where(picked("from_id", 17)).withColumn("valid_from_seq", F.lit("77777")))
    t["Token_Bound_To_Account"] = t["Token_Bound_To_Account"].union(t["Token_Bound_To_Account"].where(picked("from_id", 18)).withColumn("to_id", F.concat(F.lit("a_"), F.md5("to_id"))))
    t["Transaction_From_Account"] = t["Transaction_From_Account"].where(~picked("from_id", 22))
    t["Transaction_From_Token"] = t["Transaction_From_Token"].where(~picked("from_id", 22))
    t["Transaction_Used_IP"] = t["Transaction_Used_IP"].union(t["Transaction_Used_IP"].where(picked("from_id", 21)))
    return t
