"""Interval lookups, sweeps and rank bitmaps against pairs formed one by one."""

import random
import time

import pytest
from pyspark.sql import functions as F

from sequora.operators import relations, sequence, temporal
from sequora.operators.gates import each_of, ends_met, ids, membership

TENURE = "k string, name string, valid_from_seq long, valid_to_seq long"


def tenures(n, seed, top=5000):
    rng = random.Random(seed)
    out = []
    for j in range(n):
        start = rng.randint(1, top)
        out.append((rng.choice("aab"), f"t{j}", start, rng.choice([0, start + 1, start + rng.randint(1, 9), start + rng.randint(1, top), start, start - 1])))
    return [*out, (None, "null", 1, 0), ("a", "no end", 1, None), ("a", "no start", None, 0)]


def in_force(t, seed):
    return t[2] is not None and t[3] is not None and t[2] <= seed and (t[3] == 0 or seed < t[3])


@pytest.mark.parametrize("seed", [1, 2])
def test_visible_tenures(spark, seed):
    rows = tenures(300, seed)
    seeds = [(k, s) for k in ("a", "b", "c", None) for s in random.Random(seed).sample(range(0, 6000), 200)]
    got = relations.visible_tenures(spark.createDataFrame(rows, TENURE), spark.createDataFrame(seeds, "k string, seed_seq long"), "k")
    assert got.columns == ["k", "seed_seq", "name", "valid_from_seq", "valid_to_seq"]
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted((k, s, t[1]) for k, s in seeds for t in rows if k is not None and t[0] == k and in_force(t, s))
    held = relations.covered(spark.createDataFrame(seeds, "k string, seed_seq long"), spark.createDataFrame(rows, TENURE), ["k"], "seed_seq", bucket=700)
    assert {(r.k, int(r.seed_seq)) for r in held.collect()} == {(k, s) for k, s in seeds if k is not None and any(t[0] == k and in_force(t, s) for t in rows)}


def test_no_tenures_and_no_seeds(spark):
    some, none = spark.createDataFrame(tenures(5, 3), TENURE), spark.createDataFrame([], TENURE)
    seeds = spark.createDataFrame([("a", 5)], "k string, seed_seq long")
    assert relations.visible_tenures(none, seeds, "k").count() == 0
    assert relations.visible_tenures(some, seeds.limit(0), "k").count() == 0


def test_a_hub_key_is_not_paired(spark):
    """10^4 tenures one after the other and 10^5 seeds of one key: each seed meets one tenure."""
    hub = spark.range(10_000).selectExpr("'hub' k", "cast(id as string) name", "id * 100 + 1 valid_from_seq", "id * 100 + 101 valid_to_seq")
    seeds = spark.range(100_000).selectExpr("'hub' k", "id * 10 + 1 seed_seq")
    began = time.time()
    got = relations.visible_tenures(hub, seeds, "k")
    assert got.count() == 100_000 and got.where("cast(name as long) <> (seed_seq - 1) div 100").count() == 0
    assert relations.covered(seeds, hub, ["k"], "seed_seq").count() == 100_000
    assert time.time() - began < 60


BOUND = "from_id string, to_id string, valid_from_seq decimal(20,0), valid_to_seq decimal(20,0)"


@pytest.mark.parametrize("seed,bucket", [(1, 1_000_000), (2, 13), (3, 50)])
def test_clashes(spark, seed, bucket):
    from decimal import Decimal

    rng = random.Random(seed)
    rows = []
    for _ in range(150):
        start = rng.randint(1, 120)
        rows.append((rng.choice(["t", "t", "u", None]), rng.choice(["x", "y", "z", None]), Decimal(start), rng.choice([Decimal(0), Decimal(start + rng.randint(1, 60)), Decimal(start + 1), Decimal(max(1, start - rng.randint(0, 40))), None])))
    before = lambda e, s: e == 0 or s < e
    want = sum(1 for a in rows for b in rows if None not in (*a, *b) and a[0] == b[0] and a[1] < b[1] and before(a[3], b[2]) and before(b[3], a[2]))
    df = spark.createDataFrame(rows, BOUND)
    assert temporal.clashing_bindings(df, bucket).first()[0] == want > 0
    assert temporal.clashing_bindings(df.limit(0), bucket).first()[0] == 0


def test_a_hub_token_is_swept(spark):
    t = spark.range(40_000).selectExpr("'hub' from_id", "concat('a', id % 7) to_id", "cast(id + 1 as decimal(20,0)) valid_from_seq", "cast(id + 1 + 1 as decimal(20,0)) valid_to_seq")
    assert temporal.clashing_bindings(t).first()[0] == 0
    plan = temporal.clashing_bindings(t)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan


def test_rank_bitmaps(spark):
    rng = random.Random(4)
    ranks = [*(r for r in range(1, 100_001) if r % 977 and not 40_000 < r < 40_100), *rng.choices(range(1, 1000), k=50), 100_000]
    ranks = [r for r in ranks if r != 99_999]
    df = spark.createDataFrame([(r,) for r in ranks], "event_seq long")
    assert sequence.distinct_ranks(df).first()[0] == len(set(ranks))
    assert sorted(r[0] for r in sequence.missing_ranks(df).collect()) == sorted(set(range(1, 100_001)) - set(ranks))
    odd = spark.createDataFrame([(r,) for r in (5, 5, 0, -3, -3, None)], "event_seq long")
    assert sequence.distinct_ranks(odd).first()[0] == 3
    assert sequence.distinct_ranks(odd.limit(0)).first()[0] == 0 and sequence.missing_ranks(odd.limit(0)).count() == 0
    plan = sequence.rank_blocks(df)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "distinct" not in plan.lower()


def test_membership_and_ends(spark):
    asked = spark.createDataFrame([("1", "p"), ("1", "p"), ("3", "p"), (None, "p"), ("1", "q")], "id string, who string")
    registry = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string")
    found = membership(ids(asked.where("who = 'p'"), "x", "id", "lost").unionByName(ids(asked.where("who = 'q'"), "y", "id", "other")), ids(registry, "x", "id"), {"lost": "x", "other": "y"}).first()
    assert found.asDict() == {"lost": 2, "other": 1, "x held by many": 1, "y held by many": 0}
    edges = spark.createDataFrame([("x", "1", "y", "1"), ("x", "1", "x", "2"), ("x", None, "x", "9")], "kind_a string, a string, kind_b string, b string")
    homes = spark.createDataFrame([("x", "1", 7), ("x", "2", 8)], "kind string, id string, seen int")
    got = sorted((r.kind_b, r.met_a, r.met_b, r.seen_a, r.seen_b) for r in ends_met(edges, homes).collect() if r.a)
    assert got == [("x", True, True, 7, 8), ("y", True, False, 7, None)]
    assert sorted(map(tuple, each_of(spark.createDataFrame([("a", 3)], "n string, c long"), "n", ["a", "b"], "c").collect())) == [("a", 3), ("b", 0)]


def test_seeds_are_repeated_for_widths_of_their_key_only(spark):
    """One key has tenures of many lengths, another one of one: seeds of the latter are not repeated for the lengths of the former."""
    long = [("many", f"t{k}", 1, 1 + 2**k) for k in range(1, 20)]
    tenures = spark.createDataFrame([*long, ("one", "x", 1, 0)], "k string, card string, valid_from_seq long, valid_to_seq long")
    seeds = spark.range(1, 301).select(F.lit("one").alias("k"), F.col("id").alias("seed_seq")).union(spark.createDataFrame([("many", 5)], "k string, seed_seq long"))
    met = relations.visible_tenures(tenures, seeds, "k")
    found = sorted((r.k, r.card, r.seed_seq) for r in met.collect())
    assert found == sorted([("one", "x", n) for n in range(1, 301)] + [("many", c, 5) for _, c, a, z in long if a <= 5 < z])
    assert "collect_set" in met._jdf.queryExecution().optimizedPlan().toString()
