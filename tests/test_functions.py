import hashlib
import hmac
import random

import pytest
from pyspark.sql import functions as F

from sequora import functions as fn
from sequora.operators import sequence as s
from sequora.operators.relations import reverse
from sequora.sources.contracts import BY_NAME, ContractError, check_ordered, check_schema, check_tables, features_only, stored_fields


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make("v").alias("r")).first()["r"]


@pytest.mark.parametrize("value, expected", [(None, ""), (" a|b\t", "a b"), ("x\\y\r\nz", "x y  z")])
def test_clean_text(spark, value, expected):
    assert one(spark, value, fn.clean_text) == expected


@pytest.mark.parametrize("value, generation, account", [("C1-G2", 2, "C1"), ("C1-G2 ", 0, "C1"), ("C1-G2\n", 0, "C1-G2\n"), ("D7", 0, "D7"), (None, 0, "")])
def test_card_parts(spark, value, generation, account):
    assert one(spark, value, fn.card_generation) == generation
    assert one(spark, value, fn.funding_account_id) == account


@pytest.mark.parametrize("value, expected", [("a@X.Org ", "x.org"), ("none", ""), (None, "")])
def test_email_domain(spark, value, expected):
    assert one(spark, value, fn.email_domain) == expected


def test_token_is_hmac(spark):
    policy = fn.TokenPolicy("0123456789abcdef")
    key = hashlib.sha256(b"0123456789abcdef").digest()
    for value in ("a@b.c", "ünï", ""):
        expected = "eml_" + hmac.new(key, f"email:{value}".encode(), hashlib.sha256).hexdigest()[:32]
        assert one(spark, value, lambda c: policy.token("email", "eml", c)) == expected


def test_salt_policy():
    with pytest.raises(ValueError):
        fn.TokenPolicy("short")
    good = fn.TokenPolicy("0123456789abcdef")
    assert fn.TokenPolicy("0123456789abcdef", pinned_digest=good.digest)
    with pytest.raises(ValueError):
        fn.TokenPolicy("another salt of 16", pinned_digest=good.digest)
    assert "0123456789" not in repr(good)


def test_visibility_is_a_half_open_span(spark):
    rng = random.Random(17)
    rows = [(k, rng.randrange(1, 60), rng.choice([0, rng.randrange(1, 90)]), rng.randrange(0, 100)) for k in range(400)]
    t = spark.createDataFrame(rows, "id long, a long, b long, at long")
    got = {r["id"] for r in t.where(fn.visible("a", "b", "at")).collect()}
    assert got == {k for k, a, b, at in rows if at in range(a, b or 1000)}
    assert {r["id"] for r in t.where(fn.visible("a", "b", 30)).collect()} == {k for k, a, b, _ in rows if 30 in range(a, b or 1000)}


def test_rank_is_a_dense_permutation_in_order(spark):
    rows = [(str(k), (k * 37) % 500) for k in range(1000)]
    got = s.dense_rank_by(spark.createDataFrame(rows, "id string, t long"), "t", "id", bucket=7).orderBy("event_seq").collect()
    assert [r["event_seq"] for r in got] == list(range(1, 1001))
    assert [(r["t"], r["id"]) for r in got] == sorted((t, i) for i, t in rows)


def test_seq_after(spark):
    times = spark.createDataFrame([(10, 2), (20, 5), (500_000, 9)], "unix_time long, latest_event_seq long")
    probes = spark.createDataFrame([(9,), (10,), (19,), (20,), (499_999,), (500_000,), (9_000_000,), (None,)], "e long")
    got = {r["epoch"]: r["seq_after"] for r in s.seq_after(times, probes, "e").collect()}
    assert got == {9: 1, 10: 3, 19: 3, 20: 6, 499_999: 6, 500_000: 10, 9_000_000: 10}


def test_reverse_twice_is_the_same(spark):
    e = spark.createDataFrame([("a", "b", 1)], "from_id string, to_id string, w int")
    assert reverse(e).collect() == [("b", "a", 1)]
    assert reverse(reverse(e)).collect() == e.collect()


def test_contracts(spark):
    d = BY_NAME["IP"]
    good = spark.createDataFrame([], d.schema)
    check_ordered(d, good)
    check_schema(d, good)
    with pytest.raises(ContractError):
        check_ordered(d, good.select("first_seen_seq", "id", "first_seen_ts_ms"))
    with pytest.raises(ContractError):
        check_schema(d, good.withColumn("id", F.col("id").cast("int")))
    with pytest.raises(ContractError, match="missing table"):
        check_tables({})
    with pytest.raises(ContractError):
        features_only(spark.createDataFrame([], "transaction_id string, fraud_label int"))
    assert stored_fields(BY_NAME["Account"])[-1].name == "is_mule"
