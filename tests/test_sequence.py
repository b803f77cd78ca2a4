"""The event clock against plain Python: ties, null times, busy buckets, hub keys."""

import random

import pytest

from sequora.operators.relations import events_before
from sequora.operators.sequence import dense_rank_by


@pytest.mark.parametrize("bucket", (1, 7, 10**6))
def test_dense_rank(spark, bucket):
    r = random.Random(bucket)
    rows = [(r.choice([None, -3, 0, 5, 5, 6, 90, 91, 10**9]), f"e{i:03d}") for i in range(300)]
    got = dense_rank_by(spark.createDataFrame(rows, "t long, id string"), "t", "id", "rank", bucket)
    assert got.columns == ["t", "id", "rank"]
    want = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [(x["t"], x["id"]) for x in got.orderBy("rank").collect()] == want
    assert [x["rank"] for x in got.orderBy("rank").collect()] == list(range(1, 301))


def test_dense_rank_of_nothing(spark):
    assert dense_rank_by(spark.createDataFrame([], "t long, id string"), "t", "id").count() == 0


@pytest.mark.parametrize("bucket", (3, 10**6))
def test_events_before(spark, bucket):
    r = random.Random(bucket)
    events = [("hub" if r.random() < 0.6 else r.choice(["a", "b", None]), i) for i in range(1, 200)]
    seeds = [(r.choice(["hub", "a", "b", "none", None]), r.randrange(220)) for _ in range(150)]
    got = events_before(spark.createDataFrame(events, "k string, event_seq long"), spark.createDataFrame(seeds, "k string, seed_seq long"), "k", bucket=bucket).collect()
    want = set()
    for k, s in set(seeds):
        mine = [e for key, e in events if k is not None and key == k and e < s]
        if mine:
            want.add((k, s, len(mine), max(mine)))
    assert {tuple(x) for x in got} == want and len(got) == len(want)
