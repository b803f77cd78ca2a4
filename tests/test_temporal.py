"""One valid row in each table passes every check; one changed cell fails the check that names it."""

import pytest
from pyspark.sql import functions as F

from sequora.operators import temporal
from sequora.operators.gates import GateError, require
from sequora.sources.contracts import DATASETS
from sequora.sources.readers import text_schema

P, A, T, D, I, H = (c + "_" + "0" * 32 for c in "patdih")
ROWS = {
    "Party": [(P, "unknown", "1", "1000")],
    "Account": [(A, "unknown", "False", "1", "1000", "0", "False", "True", "0", "1", "1000", "1", "1000", "-1", "role")],
    "Token": [(T, "1", "1000", "unknown", "unknown")],
    "Device": [(D, "unknown", "1", "1000")],
    "IP": [(I, "1", "1000")],
    "Address": [(H, "1", "1000", "unknown")],
    "Payment_Transaction": [("T1", "10", "USD", "ach", "digital", "1970-01-01 00:00:05", "5000", "5", "true")],
    "Zelle_Transfer": [("T2", "1970-01-01 00:00:10", "10000", "10", "10", "true", "USD", "digital", "0", "true", "11", "10000")],
}
ENDS = {"Party": P, "Account": A, "Token": T, "Device": D, "IP": I, "Address": H, "Payment_Transaction": "T1", "Zelle_Transfer": "T2"}
CLOCK = {"Payment_Transaction": ("5000", "5"), "Zelle_Transfer": ("10000", "10")}
for _d in DATASETS:
    if _d.role == "association":
        ROWS[_d.name] = [(ENDS[_d.ends.source], ENDS[_d.ends.target], "2", "0", "1", "synthetic_registry")]
    elif _d.role == "participation":
        ROWS[_d.name] = [(ENDS[_d.ends.source], ENDS[_d.ends.target], *CLOCK[_d.ends.source])]


@pytest.fixture(scope="module")
def raw(spark):
    return {d.name: spark.createDataFrame(ROWS[d.name], text_schema(d.columns)).coalesce(1).cache() for d in DATASETS}


def failing(tables, *names):
    """Names of failed checks of the given tables, and across tables where none are given."""
    t = temporal.typed_tables(tables)
    frames = [temporal.raw_checks(d, tables[d.name]) for d in DATASETS if d.name in names]
    frames += [temporal.edge_checks(d, t[d.name], t) if d.ends else temporal.entity_checks(d, t[d.name]) for d in DATASETS if d.name in names]
    frames = frames or [temporal.across_tables(t)]
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return {r["check_name"] for r in out.where("failure_count > 0").collect()}


def changed(raw, table, **cells):
    return raw | {table: raw[table].withColumns({c: F.lit(v) for c, v in cells.items()})}


def test_the_fixture_passes(raw):
    assert failing(raw, "Party", "Account", "Payment_Transaction", "Zelle_Transfer", "Party_Owns_Account", "Transfer_Used_Device") == set()
    assert failing(raw) == set()


@pytest.mark.parametrize(
    "table, cells, check",
    [
        ("Account", {"mule_ring_id": None}, "Account: source values"),
        ("Account", {"mule_label_known": "yes"}, "Account: source values"),
        ("Account", {"pu_label": "0.5"}, "Account: source values"),
        ("Account", {"mule_label_available_ts_ms": "-1"}, "Account: source values"),
        ("Account", {"mule_label_source": "a|b"}, "Account: source values"),
        ("Party", {"first_seen_seq": "0"}, "Party: first observation"),
        ("Party", {"first_seen_seq": "1.1"}, "Party: source values"),
        ("Party", {"party_type": "first|second"}, "Party: source values"),
        ("Party", {"id": "person@example.com"}, "Party: opaque ids"),
        ("IP", {"first_seen_seq": "18446744073709551616"}, "IP: unsigned range"),
        ("Transfer_Used_Device", {"event_seq": "12"}, "Transfer_Used_Device: repeated clocks"),
        ("Payment_Transaction", {"amount_present": "false"}, "Payment_Transaction: event values"),
        ("Payment_Transaction", {"amount": "NaN"}, "Payment_Transaction: event values"),
        ("Party_Uses_IP", {"confidence": "1.5"}, "Party_Uses_IP: intervals"),
    ],
)
def test_one_cell_fails_its_check(raw, table, cells, check):
    assert check in failing(changed(raw, table, **cells), table)


def test_null_label_source_is_empty(raw):
    assert failing(changed(raw, "Account", mule_label_source=None), "Account") == set()


def test_late_device_fails_endpoints(raw):
    assert "Transfer_Used_Device: endpoints" in failing(changed(raw, "Device", first_seen_seq="20"), "Transfer_Used_Device")


def test_overlapping_tenures(raw, spark):
    d = next(d for d in DATASETS if d.name == "Party_Owns_Account")
    row = ROWS[d.name][0]
    more = lambda *rows: raw | {d.name: spark.createDataFrame(list(rows), text_schema(d.columns))}
    closed, later = (*row[:3], "4", *row[4:]), (*row[:2], "6", *row[3:])
    assert failing(more(closed, later), d.name) == set()
    assert f"{d.name}: overlapping tenures" in failing(more(row, later), d.name)


@pytest.mark.parametrize(
    "table, cells, check",
    [
        ("Account", {"is_mule": "2"}, "account mule flag"),
        ("Account", {"mule_ring_id": "-2"}, "account mule ring"),
        ("Zelle_Transfer", {"transfer_id": "T1"}, "exclusive payment identities"),
        ("Token_Bound_To_Account", {"valid_to_seq": "10"}, "Transfer From: visible binding"),
        ("Zelle_Transfer", {"label_known": "false"}, "label availability"),
        ("Payment_Transaction", {"payment_rail": "Zelle"}, "transfer rail among payments"),
    ],
)
def test_across_tables(raw, table, cells, check):
    assert check in failing(changed(raw, table, **cells))


def test_unknown_label_with_sentinels_passes(raw):
    t = changed(raw, "Zelle_Transfer", label_known="false", fraud_label="-1", label_available_seq="0", label_available_ts_ms="0")
    assert failing(t) == set()


def test_require_names_every_failure(spark):
    with pytest.raises(GateError, match="a: 1; b: 2"):
        require(spark.createDataFrame([("a", 1), ("b", 2), ("c", 0)], "check_name string, failure_count long"))


def test_running_back_inside_and_between_buckets(spark):
    rows = spark.createDataFrame([(1, 10), (2, 9), (3, 12), (11, 11), (12, 13), (25, 12)], "event_seq long, event_ts_ms long")
    assert sorted(r["event_seq"] for r in temporal.running_back(rows, bucket=10).collect()) == [2, 11, 25]


def test_participations_are_read_once(raw):
    """Edges that repeat are found on the way to their source, also where sources and targets repeat: each is one, while ends count as the join gives them."""
    d = next(x for x in DATASETS if x.name == "Transfer_Used_Device")
    t = temporal.typed_tables(raw)
    plan = temporal.edge_checks(d, t[d.name], t)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 3
    late = changed(raw, "Device", first_seen_seq="20")
    many = {n: late[n].union(late[n]) for n in ("Zelle_Transfer", "Device")} | {d.name: raw[d.name].union(raw[d.name]).union(raw[d.name])}
    t = temporal.typed_tables(raw | many)
    found = {r["check_name"]: r["failure_count"] for r in temporal.edge_checks(d, t[d.name], t).collect()}
    assert found == {f"{d.name}: endpoints": 12, f"{d.name}: repeated clocks": 0, f"{d.name}: unique identity": 1}
