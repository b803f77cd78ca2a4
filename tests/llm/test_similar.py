import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from sequora.llm import jaccard_join as jaccard
from sequora.llm import vectors
from sequora.llm.components import connected_components
from sequora.llm.jaccard_join import EDGE, ON, Rules, Sift, compare_cold, compare_hot, jaccard_join, near_dedup_stage, runs_needed, sketch, whole_buckets


def components(ids, pairs):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 6, 60, 200]))] for _ in range(40)]
    shared = [rng.choice(words) for _ in range(30)]
    out = [None, "", " \n", "one two", "ONE two", "one"]
    for b in base:
        out.append(" ".join(b))
        for _ in range(rng.choice([0, 1, 4])):
            c = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                c[rng.randrange(len(c))] = rng.choice(words)
            out.append(" ".join(c))
    out += [" ".join([rng.choice(words) for _ in range(60)] + shared) for _ in range(90)]  # one passage in many
    hot = [rng.choice(words) for _ in range(150)]
    for _ in range(120):  # a large group of near copies
        c = list(hot)
        c[rng.randrange(150)] = rng.choice(words)
        out.append(" ".join(c))
    return out + ["very " * 20_000] * 2


def test_jaccard_join_equals_brute_force(spark, rows):
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(rows)] + [(None, rows[6], 1, 2)], "doc_id long, text string, key int, node int")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join(docs, block=50, limit=3, salts=4).collect()}
    sets = [shingles(t) for t in rows]
    pairs = [(a, b) for b in range(len(rows)) for a in range(b) if sets[a] and len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b])) >= 0.8]
    links = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    up = components(range(len(rows)), pairs)
    assert got == {k: (up[k], links[k]) for k in range(len(rows))} | {None: (None, 0)}


def test_near_dedup_stage_keeps_one_of_each_class(spark, rows):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words stand here now"), (4, None), (5, ""), (None, "x"), (None, "x"), (3, "other words stand here now")], "doc_id long, text string")
    got = near_dedup_stage(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 0, 1, 3, 4, 5]


def test_empty_tables(spark):
    assert jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(empty).count() == 0
    assert vectors.top_k(empty, F.col("vec_id") % 2 == 0).count() == 0


def bucket_rows(bits, rules, salts, step=1 << 30):
    """What one bucket's parts give, fed `step` rows at a time."""
    found = []
    sifted = []
    node = np.arange(len(bits))
    salt = (node % salts).astype(np.int32)
    order = np.lexsort((node, salt))
    own = Sift(rules)
    for at in range(0, len(order), step):
        k = order[at : at + step]
        sifted.append(own.batch(np.zeros(len(k), np.int64), salt[k], node[k], bits[k]))
    sifted.append(own.end())
    sifted = pa.Table.from_batches([x for x in sifted if x is not None])
    leaders = sifted.filter(pc.equal(sifted["kind"], 2))
    for p in range(salts):
        part = pa.concat_tables([leaders, sifted.filter(pc.and_(pc.equal(sifted["salt"], p), pc.equal(sifted["kind"], 1)))])
        part = part.set_column(2, "salt", pa.array([p] * len(part), pa.int32()))
        found += [x for b in compare_hot(part.combine_chunks().to_batches(), rules, salts) for x in b.to_pylist()]
    edges = [(r["a"], r["b"]) for r in found if r["kind"] == EDGE]
    return edges, {r["b"] for r in found if r["kind"] == ON}, sifted


def test_leaders_stand_for_near_copies_and_lose_no_pair():
    rng = np.random.default_rng(3)
    group = [np.concatenate([np.arange(300), rng.integers(1000, 10**9, k)]).astype(np.uint64) for k in rng.integers(0, 40, 500)]
    apart = [rng.integers(0, 10**12, 300).astype(np.uint64) for _ in range(200)]
    bits = np.array([sketch(np.unique(s)) for s in group + apart])
    for step in (7, 10**6):
        edges, on, _ = bucket_rows(bits, Rules(16, 4, 28, 12, False), 8, step)
        up = components(range(700), edges)
        assert len({up[k] for k in range(500) if k not in on}) == 1 and len(edges) < 1500
        assert len(on & set(range(500))) < 100 and len(on & set(range(500, 700))) > 150
        distance = np.bitwise_count((bits[:, None] ^ bits[None]).view(np.uint64)).sum(-1)
        for a, b in zip(*np.nonzero(distance <= 28)):
            assert up[a] == up[b] or {int(a), int(b)} <= on
    edges, on, _ = bucket_rows(bits, Rules(16, 4, 28, 12, True), 8, 50)
    up = components(range(700), edges)
    assert not on and all(up[a] == up[b] for a, b in zip(*np.nonzero(distance <= 28)))


def test_a_set_near_leaders_of_many_buckets_has_one_edge():
    rng = np.random.default_rng(5)
    bits = np.array([sketch(np.unique(np.concatenate([np.arange(300), rng.integers(1000, 10**9, 9)]).astype(np.uint64))) for _ in range(400)])
    rules, buckets, salts = Rules(16, 4, 28, 12, False), 12, 8
    _, _, sifted = bucket_rows(bits, rules, salts)
    leaders, found = sifted.filter(pc.equal(sifted["kind"], 2)), []
    for salt in range(salts):
        own = pa.concat_tables([leaders, sifted.filter(pc.and_(pc.equal(sifted["salt"], salt), pc.equal(sifted["kind"], 1)))])
        own = own.set_column(2, "salt", pa.array([salt] * len(own), pa.int32()))
        parts = [own.set_column(1, "path", pa.array([path] * len(own), pa.int64())) for path in range(buckets)]
        found += [x for b in compare_hot(pa.concat_tables(parts).combine_chunks().to_batches(), rules, salts) for x in b.to_pylist()]
    edges = [(r["a"], r["b"]) for r in found if r["kind"] == EDGE]
    on = {r["b"] for r in found if r["kind"] == ON}
    up = components(range(400), edges)
    assert len({up[k] for k in range(400) if k not in on}) == 1
    assert len(edges) < 400 + buckets * 4 * salts  # an edge for each set and leader, and not for each set of each bucket


def test_small_parts_of_a_last_level_stay_cold_and_lose_no_pair():
    rng = np.random.default_rng(9)
    bits = np.array([sketch(np.unique(np.concatenate([np.arange(k % 40 * 1000, k % 40 * 1000 + 300), rng.integers(10**6, 10**9, 20)]).astype(np.uint64))) for k in range(400)])
    rules, node = Rules(16, 4, 28, 12, True), np.arange(400)
    salt = np.where(node < 300, node % 4, 4 + node % 20).astype(np.int32)  # four hot parts, twenty small ones
    order, own = np.lexsort((node, salt)), Sift(rules)
    sifted = pa.Table.from_batches([own.batch(np.zeros(400, np.int64), salt[order], node[order], bits[order]), own.end()])
    kind, leaders = sifted["kind"], sifted.filter(pc.equal(sifted["kind"], 2))
    assert pc.sum(pc.equal(kind, 0)).as_py() == 100 and leaders.num_rows == 4
    found = list(compare_cold(pa.concat_tables([sifted.filter(pc.equal(kind, 0)), leaders]).combine_chunks().to_batches()[0], rules))
    for p in range(24):
        part = pa.concat_tables([leaders, sifted.filter(pc.and_(pc.equal(sifted["salt"], p), pc.equal(kind, 1)))])
        found += compare_hot(part.set_column(2, "salt", pa.array([p] * len(part), pa.int32())).combine_chunks().to_batches(), rules, 24)
    edges = [(r["a"], r["b"]) for b in found for r in b.to_pylist()]
    distance = np.bitwise_count((bits[:, None] ^ bits[None]).view(np.uint64)).sum(-1)
    near = np.argwhere(np.triu(distance <= 28, 1)).tolist()
    assert all(r["kind"] == EDGE for b in found for r in b.to_pylist())
    assert components(range(400), edges) == components(range(400), near)


def test_buckets_that_are_cheap_to_compare_end_the_levels(spark, rows, monkeypatch):
    levels, buckets = [], jaccard._buckets
    monkeypatch.setattr(jaccard, "_buckets", lambda rows, rules, salts: levels.append(rules.last) or buckets(rows, rules, salts))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    links = lambda: jaccard_join(docs, limit=3, salts=4, block=50).select("doc_id", "class_id", "n_links").collect()
    got = sorted(links())
    assert levels == [False, True]
    monkeypatch.setattr(jaccard, "WHOLE", 0)  # as if buckets were too large
    assert sorted(links()) == got and len(levels) > 4


def test_buckets_are_not_cut():
    path = np.repeat(np.arange(50), np.arange(50))
    rows = pa.record_batch({"path": path, "x": np.arange(len(path))})
    seen = list(whole_buckets([rows.slice(k, 100) for k in range(0, len(path), 100)]))
    assert sum(b.num_rows for b in seen) == len(path)
    ends = [(b["path"][0].as_py(), b["path"][-1].as_py()) for b in seen]
    assert all(e < f for (_, e), (f, _) in zip(ends, ends[1:]))


def test_runs_follow_the_recall():
    assert runs_needed(0.9, 1.4) < runs_needed(0.9999, 1.4) < runs_needed(0.9999, 1.2)


def test_a_group_of_2000_near_copies(spark):
    rng = random.Random(11)
    words = [f"v{k}" for k in range(500)]
    base = [rng.choice(words) for _ in range(120)]
    texts = []
    for _ in range(2000):
        c = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            c[rng.randrange(120)] = rng.choice(words)
        texts.append(" ".join(c))
    passage = [rng.choice(words) for _ in range(40)]
    texts += [" ".join([rng.choice(words) for _ in range(rng.choice([20, 60, 200]))] + passage) for _ in range(500)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    number: dict = {}
    sets = [sorted({number.setdefault(x, len(number)) for x in shingles(t)}) for t in texts]
    m = np.zeros((len(texts), len(number)), np.float32)
    for k, s in enumerate(sets):
        m[k, s] = 1
    common = m @ m.T
    size = m.sum(1)
    linked = common.astype(float) / (size[:, None] + size[None] - common) >= 0.8
    np.fill_diagonal(linked, False)
    up = components(range(len(texts)), np.argwhere(np.triu(linked)).tolist())
    assert got == {k: (up[k], int(linked[k].sum())) for k in range(len(texts))}


def test_unlike_texts_of_one_id_both_stay(spark):
    near = [f"a{k}" for k in range(60)]
    rows = [(7, " ".join(near)), (7, "quite other words stand here alone"), (3, " ".join([*near[:59], "x"])), (7, " ".join(near)), (9, "quite other words stand here alone"), (8, None), (8, None)]
    docs = spark.createDataFrame([(i, t, "m") for i, t in rows], "doc_id long, text string, key string")
    got = sorted(near_dedup_stage(spark, docs, "").select("doc_id", "text").collect(), key=str)
    assert sorted((r["doc_id"], (r["text"] or "")[:5]) for r in got) == [(3, "a0 a1"), (7, "quite"), (8, ""), (8, "")]


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = components({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in up.items() if any(k in e and e[0] != e[1] for e in edges)}


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 8))
    x = [base[rng.integers(60)] + rng.normal(size=8) * rng.choice([0, 0.01, 0.1, 0.3]) for _ in range(500)]
    x += [list(3.0 * x[0]), [0.0] * 8, None, [], [None] * 8, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0, 2.0], [1.0, 2.1], [1e300] * 8, [1e-300] * 8]
    return [None if v is None else [None if c is None else float(c) for c in v] for v in x]


def test_near_duplicates_equal_brute_force(spark, points):
    df = spark.createDataFrame([(k, v, "x") for k, v in enumerate(points)], "vec_id long, embedding array<double>, rep string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(df, block=64).collect()}

    def unit(v):
        if not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    u = [unit(v) for v in points]
    pairs = [(a, b) for b in range(len(u)) for a in range(b) if u[a] is not None and u[b] is not None and len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.95]
    links, up = np.bincount(np.array(pairs).ravel(), minlength=len(u)), components(range(len(u)), pairs)
    assert got == {k: (links[k], up[k], up[k] == k) for k in range(len(u))}


def test_top_k_equals_brute_force(spark, points):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(points)], "vec_id long, embedding array<double>").where("vec_id <> 509")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vectors.top_k(df, F.col("vec_id") % 50 == 0, block=64).collect())
    good = {k: [int(np.floor(256 * c)) for c in v] for k, v in enumerate(points) if v and k != 509 and all(c is not None and np.isfinite(c) for c in v)}
    want = []
    for q in good:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(good[q], v)), k) for k, v in good.items() if k != q and len(v) == len(good[q]))
            want += [(q, n + 1, k, -x) for n, (x, k) in enumerate(s[:5])]
    assert got == sorted(want)


def test_blocks_that_cannot_hold_a_top_score_do_not_meet(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centre = np.repeat(np.eye(20) * 4, 200, 0)
    x = centre + rng.normal(size=centre.shape) * 0.02
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    seen = {}

    def counted(groups, data, of=vectors._open_pairs):
        pairs = of(groups, data)
        seen.update(met=pairs.count(), all=groups.select("block").distinct().count() * data.count())
        return pairs

    monkeypatch.setattr(vectors, "_open_pairs", counted)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vectors.top_k(df, F.col("vec_id") % 2 == 0, block=128).collect())
    whole = np.floor(256 * x).astype(np.int64)
    product = whole @ whole.T
    want = [(q, n + 1, v, int(product[q, v])) for q in range(0, len(x), 2) for n, v in enumerate([v for v in np.lexsort((np.arange(len(x)), -product[q])).tolist() if v != q][:5])]
    assert got == sorted(want)
    assert seen["all"] > 50 and seen["met"] * 2 < seen["all"], seen


def test_known_scores_leave_the_best_and_ties():
    from sequora.llm import covertree

    rng = np.random.default_rng(9)
    q, d = (np.floor(256 * rng.normal(size=(n, 4))) for n in (40, 300))
    d[200:] = d[:100]  # repeated rows tie
    (q_order, q_tree), (d_order, d_tree) = covertree.build(q), covertree.build(d)
    whole = np.sort(q_tree.x @ d_tree.x.T, 1)[:, ::-1]
    q_ids, d_ids = [10_000 + int(k) for k in q_order], [int(k) for k in d_order]
    want = sorted(vectors.best_scores(q_tree, d_tree, q_ids, d_ids, 5))
    got = vectors.best_scores(q_tree, d_tree, q_ids, d_ids, 5, whole[:, 4])
    assert sorted(got) == want and len(want) == 200
    assert not vectors.best_scores(q_tree, d_tree, q_ids, d_ids, 5, whole[:, 0] + 1)


def test_top_k_of_vectors_beyond_doubles(spark):
    df = spark.createDataFrame([(0, [1e18, 1.0]), (1, [1.0, 3.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in vectors.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(2, 2**63 - 1), (1, 2**63 - 1)] or got == [(1, 2**63 - 1), (2, 2**63 - 1)]


def test_a_dense_group_needs_little_memory():
    import tracemalloc

    from sequora.llm import covertree

    rng = np.random.default_rng(5)
    x = rng.normal(size=16) + rng.normal(size=(3000, 16)) * 0.16
    x /= np.sqrt((x * x).sum(1))[:, None]
    order, tree = covertree.build(x)
    tracemalloc.start()
    links, edges = vectors.cosine_links(tree, tree, np.ones(3000, np.int64), np.ones(3000, np.int64), 0.95, float(np.sqrt(0.1)), True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    close = tree.x @ tree.x.T >= 0.95
    assert (links == close.sum(1) - 1).all() and peak < 400e6
    assert len({v for v in components(range(3000), edges).values()}) == len({v for v in components(range(3000), np.argwhere(np.triu(close, 1)).tolist()).values()})
    assert len(order) == 3000


def test_short_vectors_bound_products_and_leave_few():
    from sequora.llm import covertree

    rng = np.random.default_rng(6)
    x, y = (rng.normal(size=(3000, 64)) for _ in range(2))
    x[:20] = y[:20] + rng.normal(size=(20, 64)) * 0.2
    (_, a), (_, b) = (covertree.build(v / np.sqrt((v * v).sum(1))[:, None]) for v in (x, y))
    covertree.shorten(a, b)
    product = a.x @ b.x.T
    assert (a.low @ b.low.T >= product - covertree.LOW_SLACK).all()
    p, q = covertree._open_cells(a.low, b.low, np.full(3000, 0.95 - covertree.LOW_SLACK))
    assert {*zip(*np.nonzero(product >= 0.95))} <= {*zip(p, q)} and len(p) < 3000 * 3000 / 1000
    assert covertree._open_cells(a.low, b.low, np.full(3000, -1.0)) is None
    links, _ = vectors.cosine_links(a, b, np.ones(3000, np.int64), np.ones(3000, np.int64), 0.95, float(np.sqrt(0.1)), False)
    assert (links == np.r_[(product >= 0.95).sum(1), (product >= 0.95).sum(0)]).all() and links.sum() >= 20
