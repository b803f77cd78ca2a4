"""Every query with SQL against DuckDB on the smallest tables (a part of them here; all with FULL_ORACLE=1)."""

import math
import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SOME = ("src_text_tables", "gat_source_gates_mutated", "fn_pii_token", "seq_event_sequence", "seq_label_rank", "geo_party_home_area", "pii_addresses", "txn_manifest", "rel_account_has_card", "rel_instrument_in_force", "out_22_transactions", "aud_geography_mutated", "mul_across_tables_mutated", "val_measures")


def value(v):
    if isinstance(v, float):
        return round(v, 6) if abs(v) < 1e6 else float(f"{v:.10g}")
    return float(v) if type(v).__name__ == "Decimal" else v


def key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return c


def names():
    from sequora.plans.queries import ORACLE_SQL

    return sorted(ORACLE_SQL) if os.environ.get("FULL_ORACLE") else SOME


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", names())
def test_query_equals_its_sql(spark, duck, name):
    from sequora.plans.queries import ORACLE_SQL, QUERIES

    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(map(value, r)) for r in df.select(*columns).collect()), key=key)
    result = duck.execute(ORACLE_SQL[name])
    at = [d[0] for d in result.description]
    assert sorted(at) == columns
    want = sorted((tuple(value(r[at.index(c)]) for c in columns) for r in result.fetchall()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9)) for x, y in zip(a, b)), (a, b)


def test_registry_is_complete():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    prefixes = {n.split("_")[0] for n in e.queries()}
    assert {"src", "gat", "fn", "seq", "ent", "geo", "pii", "txn", "rel", "out", "aud", "mul", "val"} <= prefixes


def test_plans_have_no_python_and_no_global_sort(spark):
    from sequora.plans.queries import QUERIES

    for name in ("seq_event_sequence", "txn_manifest"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan


@pytest.mark.parametrize("name", ("rel_visible_tenures", "rel_visible_events"))
def test_every_payment_is_a_seed(spark, duck, name):
    from sequora.plans.queries import QUERIES

    test_query_equals_its_sql(spark, duck, name)
    rest = {r[0] % 10 for r in QUERIES[name](spark, SF).select("seed_seq").distinct().collect()}
    assert rest == set(range(10))


@pytest.mark.parametrize("name", ("out_export_manifest", "out_report", "val_operators_above", "val_operators_above_mutated", "out_export_verified", "out_export_verified_mutated", "out_psv_rows", "out_shard_sizes", "val_against_manifest", "val_against_manifest_mutated", "val_edge_counts_mutated", "val_corrupt_lines_mutated", "val_corrupt_text_mutated", "val_empty_mandatory_mutated", "val_same_distribution", "val_same_distribution_mutated", "out_load_order", "out_load_order_mutated", "out_stored_order", "seq_missing_ranks_mutated", "aud_forbidden_columns"))
def test_export_is_whole(spark, duck, name):
    test_query_equals_its_sql(spark, duck, name)
