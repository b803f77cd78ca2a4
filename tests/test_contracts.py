"""The contract as a store describes it, and as frames stand in it."""

import pytest
from pyspark.sql import functions as F

from sequora.sources import contracts as c


def good():
    return {d.name: c.described(d) for d in c.DATASETS} | {d.ends.reverse: c.Description([]) for d in c.DATASETS if d.ends}


def test_as_declared():
    assert c.schema_faults(good()) == []
    assert c.schema_faults(good() | {"Scope": c.Description([])}, ("Scope",)) == []


@pytest.mark.parametrize(
    "name,change,fault",
    [
        ("Scope", lambda _: c.Description([]), "not declared"),
        ("Party", lambda d: d._replace(attributes=[*d.attributes, ("more", "STRING")]), "attributes, their types or order"),
        ("Account", lambda d: d._replace(attributes=[(f.name, c.declared(f)) for f in c.BY_NAME["Account"].schema]), "attributes, their types or order"),
        ("Zelle_Transfer", lambda d: d._replace(attributes=d.attributes[:12]), "attributes, their types or order"),
        ("Device", lambda d: d._replace(key_is_attribute=False), "key as attribute"),
        ("Party_Uses_IP", lambda d: d._replace(ends=d.ends._replace(target="Device")), "ends or reverse"),
        ("Party_Uses_IP", lambda d: d._replace(ends=d.ends._replace(reverse="IP_Of")), "ends or reverse"),
        ("Party_Uses_IP", lambda d: d._replace(told_apart_by=()), "what tells edges apart"),
        ("Transfer_Used_IP", lambda d: d._replace(told_apart_by=("event_seq",)), "what tells edges apart"),
        ("Token", lambda _: None, "missing"),
    ],
)
def test_each_difference_is_named(name, change, fault):
    found = good()
    found[name] = change(found.get(name))
    assert c.schema_faults({k: v for k, v in found.items() if v}) == [(name, fault)]


def test_stored_order(spark):
    account = c.BY_NAME["Account"]
    df = c.stored(account, spark.createDataFrame([], account.schema))
    assert df.columns[-1] == "is_mule" and sorted(df.columns) == sorted(account.columns)
    event = c.BY_NAME["Payment_Transaction"]
    one = spark.createDataFrame([tuple([None] * len(event.schema))], event.schema)
    row = c.stored(event, one.withColumn("pair_sender_id", F.lit("x"))).first().asDict()
    assert list(row)[: len(event.columns)] == event.columns
    assert [row[f.name] for f in c.KEPT_DEFAULTS] == [0, False, [], "", "", "", "", ""]


def test_load_order(spark):
    found = spark.createDataFrame([("v", 1), ("e", 2), ("f", 3)], "dataset string, rows long")
    needs = {"e": ["v"], "f": ["e", "gone"]}
    rows = lambda order: sorted(tuple(r) for r in c.load_order(found, order, needs).collect())
    assert rows(["v", "e", "f"]) == [("e", "v", 2, True), ("f", "e", 3, True), ("f", "gone", 3, False)]
    assert rows(["e", "v", "f"])[0] == ("e", "v", 2, False)
