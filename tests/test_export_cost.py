"""What an export and its readers cost: expressions that compile, lines split once, hashing in many tasks."""

from pyspark.sql import functions as F

from sequora.operators import export


def test_rows_of_many_numbers_compile(spark, tmp_path):
    """Without a way back to interpreted rows: code that grows too long is an error."""
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.codegen.fallback", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        rows = spark.range(50).select("id", *[(F.col("id") * F.pow(F.lit(10.0), F.lit(k - 6))).alias(f"x{k}") for k in range(12)])
        lines = export.psv_rows(rows).collect()
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(lines) == 50 and all(r.value.count("|") == 12 for r in lines) and not any("E" in r.value for r in lines)


def test_lines_are_split_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 1.5), ("b", 2, None)], "s string, n long, d double")
    export.write_psv(rows, f"file://{tmp_path}/x")
    read = export.read_psv(spark, f"file://{tmp_path}/x", rows.schema)
    good = read.where(F.col(export.CORRUPT).isNull()).drop(export.CORRUPT)
    assert sorted(map(tuple, good.collect())) == [("a", 1, 1.5), ("b", 2, None)]
    assert good._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2


def test_a_failed_dataset_leaves_no_lines(spark, tmp_path):
    """Lines are staged ahead of the shards; whatever ends an export, none of them stay."""
    import glob

    import pytest

    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(glob.glob(f"{base}/lines-*"))
    one = spark.range(5).selectExpr("concat('r', id) s")
    bad = one.withColumn("x", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        export.write_all({"1": one, "2": bad, "3": one}, f"file://{tmp_path}/out", 1000, (), None)
    assert (tmp_path / "out" / "1").is_dir() and not (tmp_path / "out" / "3").exists()
    assert set(glob.glob(f"{base}/lines-*")) == before


def test_audits_stage_endpoints_once(spark):
    """Devices and IPs stand in several datasets and audits: an audit reads them, and doesn't join the events for each."""
    import os

    import pytest

    from sequora.plans.queries import prepared

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no tables here")
    p = prepared(spark, sf, keep=True)
    for df in (p.devices, p.ips):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString() and df.count()


def test_visibility_reads_payments_once(spark):
    """Queries that look at the payments twice read them, and don't join the clock for each look; labels are not made for them."""
    import os

    import pytest

    from sequora.plans.queries import prepared

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no tables here")
    p = prepared(spark, sf, clock=True)
    columns = ["transaction_id", "account_id", "card_id", "event_seq"]
    for df in (p.paid, p.sequence, p.limits):
        assert not any(x in df._jdf.queryExecution().optimizedPlan().toString() for x in ("Join", "Window"))
    q = prepared(spark, sf)
    assert sorted(map(tuple, p.paid.collect())) == sorted(map(tuple, q.manifest.select(*columns).collect()))


def test_an_export_stages_each_frame_once(spark, monkeypatch):
    """With `whole`, datasets and audits are cut from staged frames: no join is left in them, and none is written twice, though several threads ask."""
    import os
    from collections import Counter

    import pytest

    from sequora.plans import card_fraud
    from sequora.plans.queries import prepared

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no tables here")
    written, real = Counter(), card_fraud.staged
    monkeypatch.setattr(card_fraud, "staged", lambda df, *a: written.update([df._jdf.queryExecution().analyzed().canonicalized().hashCode()]) or real(df, *a))
    p = prepared(spark, sf, whole=True).stage()
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for name, df in p.datasets.items():
        assert not any(x in plan(df) for x in ("Join", "Aggregate", "Window")), name
    for df in (p.accounts, p.merchants, p.emails, p.party_owns_account, p.party_values["ip"]):
        assert "Join" not in plan(df)
    assert max(written.values()) == 1


def test_a_damaged_export_needs_no_sound_one(spark, monkeypatch):
    """Queries over a damaged export, over lines or shards don't pay for an export that they don't read."""
    from sequora.plans import queries

    monkeypatch.setattr(queries, "exported", lambda *a: 1 / 0)
    monkeypatch.setattr(queries, "_exports", {})
    sf = "/root/testdata/sf0.001"
    import os

    import pytest

    if not os.path.isdir(sf):
        pytest.skip("no tables here")
    assert queries.QUERIES["val_empty_mandatory_mutated"](spark, sf).collect()[0]["dataset"] == "07_ip_addresses"
    assert queries.QUERIES["out_shard_sizes"](spark, sf).first()["bounded"]


def test_a_validation_exports_what_it_reads(spark, monkeypatch):
    """Files of some datasets need no export of all; they are held to the gates that look at no others."""
    import os

    import pytest

    from sequora.operators import gates
    from sequora.plans import queries as q

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no tables here")
    for name in ("_sets", "_exports", "_reports", "_partial"):
        monkeypatch.setattr(q, name, {}, raising=False)
    assert q.QUERIES["val_density"](spark, sf).first()["zero_rows"] == 0 and not q._exports
    (folder,) = q._partial.values()
    assert export.published(spark, folder)["order"] == ["22_transactions"]
    p = q.stored_set(spark, sf)
    named = lambda names=None: {r["check_name"] for r in gates.gates(p, names).select("check_name").collect()}
    of_payments, sites = named(["22_transactions"]), named(["04_merchants", "05_merchant_locations"])
    assert {"event_seq_not_dense", "label_fraud_rows_unknown", "transaction_card_edge_count_mismatch", "forbidden_columns_in_load_views"} <= of_payments
    assert "merchants_with_many_zips" in sites and not (of_payments | sites) - named() and "vertices_with_zero_first_seen" not in of_payments | sites
    bad = gates.gates(p, ["22_transactions"]).withColumn("failure_count", F.lit(1))
    monkeypatch.setattr(q, "_partial", {})
    monkeypatch.setattr(gates, "gates", lambda *_: bad)
    with pytest.raises(gates.GateError):
        q.QUERIES["val_density"](spark, sf)
