import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sequora.llm import html_text, language_model, line_dedup, toxicity


def dedup(spark, texts):
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n int")
    return {r["doc_id"]: (r["text"], r["removed_lines"]) for r in line_dedup.dedup_lines(df).collect()}


def test_line_dedup(spark):
    got = dedup(spark, ["a\nb\nc\nd\nx", "y\na\nb\n \nc\nd\nz", "a\nb", None, "", "q\nq\nq\nq\nq", "n\nb\nc\nm"])
    assert got[0] == ("a\nb\nc\nd\nx", [])
    assert got[1] == ("y\n \nz", [1, 2, 4, 5])
    assert got[2] == ("a\nb", []) and got[3] == (None, []) and got[4] == ("", [])
    assert got[5] == ("q", [1, 2, 3, 4]) and got[6] == ("n\nb\nc\nm", [])


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    texts = ["\n".join(rng.choice("abcd ") for _ in range(rng.randrange(0, 12))) for _ in range(60)]
    got, seen = dedup(spark, texts), set()
    import hashlib

    for k, t in enumerate(texts):
        lines = t.split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for w in zip(filled, filled[1:], filled[2:]):
            key = tuple(lines[i] for i in w)
            gone |= set(w) if key in seen else set()
            seen.add(key)
        assert got[k] == ("\n".join(x for i, x in enumerate(lines) if i not in gone), sorted(gone)), hashlib.md5(t.encode()).hexdigest()


def test_line_dedup_of_long_texts_and_odd_rows(spark):
    import time

    rng = random.Random(4)
    long = "\n".join(f"line {rng.randrange(10**9)}" for _ in range(100_000))
    df = spark.createDataFrame([(1, "x\ny\nz\n" + long), (2, long + "\nend"), (None, long), (2, long + "\nend")], "doc_id long, text string")
    began = time.perf_counter()
    got = sorted((r["doc_id"] or 0, len(r["removed_lines"]), r["text"][:3], r["text"][-3:]) for r in line_dedup.dedup_lines(df).collect())
    assert [g[:2] for g in got] == [(0, 0), (1, 100_000), (2, 100_000), (2, 100_000)] and got[2][2:] == ("end", "end")
    assert time.perf_counter() - began < 60
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(df.withColumn("n_lines", F.lit(1)))


def test_line_dedup_stage(spark):
    df = spark.createDataFrame([(0, "a\nb\nc", 5), (1, "a\nb\nc\nd", 7)], "doc_id long, text string, n_chars long")
    assert sorted(line_dedup.line_dedup_stage(spark, df, "").collect()) == [(0, "a\nb\nc", 5), (1, "d", 1)]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    clean, bad = [f"c{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)], ["vile", "nasty", "rotten", "foul"]
    rows = []
    for k in range(900):
        toxic = int(k % 6 == 0)
        w = [rng.choice(clean) for _ in range(rng.randrange(20, 90))]
        for _ in range(toxic * rng.choice([2, 3, 8])):
            w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", ".", "ly"]))
        rows.append((k, " ".join(w), toxic))
    return rows


def test_toxicity_on_held_out_rows(spark, labelled):
    docs = spark.createDataFrame([(k, t) for k, t, _ in labelled] + [(1000, None), (1001, ""), (1002, "vile " * 30_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in labelled if k % 5] + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, max_rows=500)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    got = {r["doc_id"]: r["severity"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    rejected = {k for k, s in got.items() if s >= model.reject_from}
    held = [(k, y) for k, _, y in labelled if not k % 5]
    assert np.mean([k in rejected for k, y in held if y]) > 0.95
    assert np.mean([k in rejected for k, y in held if not y]) < 0.01
    assert 1002 in rejected and not {1000, 1001} & rejected


def test_severity_orders_held_out_texts_and_tables_may_be_odd(spark, labelled):
    docs = spark.createDataFrame([(k, t) for k, t, _ in labelled] + [(7, "vile foul nasty")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in labelled if k % 5] + [(1, 0), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, max_rows=500)
    held = [(k, len([w for w in t.split() if w.startswith(("vile", "nasty", "rotten", "foul"))])) for k, t, y in labelled if y and not k % 5]
    got = {r["doc_id"]: r["severity"] for r in toxicity.score(docs.where("doc_id <> 7"), model, ["doc_id"]).collect()}
    few, many = [got[k] for k, n in held if n == 2], [got[k] for k, n in held if n == 8]
    assert np.mean(few) < np.mean(many)
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        toxicity.score(docs, model, ["doc_id"], out="doc_id")
    plain = {k: sum(1 / (1 + math.exp(c - sum(model.weights.get(f, 0) for f in toxicity.features(t)))) for c in model.thresholds) for k, t, _ in labelled}
    assert all(math.isclose(got[k], plain[k], rel_tol=1e-6) for k in got)


def test_toxicity_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert all(r["severity"] < model.reject_from for r in toxicity.score(docs, model, ["doc_id"]).collect())


def test_ordinal_gradient_orders_grades():
    rng = np.random.default_rng(0)
    g = rng.integers(0, 4, 600)
    rows = [[c for c in range(5) if rng.random() < (c <= x) * 0.8 + 0.05] for x in g]
    w, theta = toxicity.fit_ordinal(rows, g, 5)
    assert (np.diff(theta) > 0).all()
    s = np.array([w[r].sum() for r in rows])
    assert (np.diff([s[g == k].mean() for k in range(4)]) > 0).all()


def test_language_model_counts(spark):
    rng = random.Random(9)
    common = ["the", "of", "and", "to", "in"]
    texts = {k: " ".join(rng.choice(common) if j % 2 else f"w{rng.randrange(300)}" for j in range(rng.randrange(1, 80))) for k in range(300)}
    texts |= {300: None, 301: "", 302: "The\x0bTHE É é x", 303: "unseen " * 3, 304: "the w1 " * 20_000}
    docs = spark.createDataFrame([(k, t, 1) for k, t in texts.items()] + [(None, "the w1", 1)], "doc_id long, text string, kind int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = language_model.score(docs, held, words=20, dims=8, block_bytes=4000).collect()
    got = {r["doc_id"]: r for r in rows}
    texts[None] = "the w1"
    assert len(rows) == len(texts)
    cut = {k: [*(t or "").encode().lower().split(), None] for k, t in texts.items()}
    out = {k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    c = Counter(w for k, t in cut.items() if not out[k] for w in t)
    n, v = sum(c.values()), len(c)
    for k, t in cut.items():
        r = got[k]
        assert (bool(r["held_out"]), r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[k], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r["score"] < 0


def test_class_model_adds_up_and_learns():
    word = np.tile([3, 4, 5], 4000)
    counts = language_model.Counts(0, 0, 0, {b"a": 3}, np.array([2, 4000, 0, 4000, 4000, 4000]), np.array([1, 0]), 1)
    model = language_model._of_classes(counts, (6, 6), 8)
    context = [np.roll(word, 1), np.roll(word, 2)]
    before = model.log10(context, word).mean()
    model.train(context, word)
    assert model.log10(context, word).mean() > before + 0.3
    for u, v in [(3, 5), (0, 2), (4, 4)]:
        every = 10 ** model.log10([np.full(6, u), np.full(6, v)], np.arange(6))
        assert math.isclose(every.sum(), 1, rel_tol=1e-5) and every[2] < 1e-9 and every[0] > 0


def test_language_model_predicts_words_that_are_not_frequent(spark):
    rng = random.Random(12)
    rows = []
    for k in range(2000):
        at = rng.randrange(200)
        rows.append((k, " ".join(f"w{(at + j) % 200}" for j in range(100))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = language_model.score(docs, F.col("doc_id") % 7 == 2, words=3, dims=16).where("held_out").agg((F.sum("score") / F.sum("n_tokens")).alias("model"), (F.sum("base_score") / F.sum("n_tokens")).alias("base")).first()
    assert got["model"] > got["base"] + 1.0


def test_language_model_learns_from_all_blocks(spark):
    rng = random.Random(3)
    rows = []
    for k in range(400):
        at = rng.randrange(40)
        rows.append((k, " ".join(f"w{(at + j) % 40}" for j in range(60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def held_out(df, block_bytes):
        scored = language_model.score(df, F.col("doc_id") % 7 == 2, words=50, dims=16, block_bytes=block_bytes)
        return scored.where("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()[0]

    one, many = held_out(docs, 1 << 20), held_out(docs.repartition(8, "doc_id"), 1000)
    assert one > -0.5 and abs(one - many) < 0.05, (one, many)


def test_counts_teach_what_tokens_teach():
    word = np.tile([3, 4, 5], 4000)
    counts = language_model.Counts(0, 0, 0, {b"a": 3}, np.array([2, 4000, 0, 4000, 4000, 4000]), np.array([1, 0]), 1)
    model = language_model._of_classes(counts, (6,), 8)
    context = [np.roll(word, 1)]
    model.train(context, word)
    taught = language_model._of_classes(counts, (6,), 8)
    table = np.zeros((6, 6))
    np.add.at(table, (context[0], word), 1)
    taught.train_counts(table)
    assert taught.log10(context, word).mean() > model.log10(context, word).mean() - 0.02
    assert (taught.r[0][:3] == 0).all() and math.isclose((10 ** taught.log10([np.full(6, 4)], np.arange(6))).sum(), 1, rel_tol=1e-5)


def test_words_of_a_class_add_up():
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 50, 37).astype(float)
    within = language_model.Within(counts, 5, 4)
    assert within.groups == 6
    within.train(rng.integers(0, 4, 900), rng.integers(0, 37, 900))
    for before in range(5):
        assert math.isclose((10 ** within.log10(np.full(37, before), np.arange(37))).sum(), 1, rel_tol=1e-5)
    untrained = 10 ** within.log10(np.full(37, 4), np.arange(37))  # a context never seen: near the shares
    assert np.corrcoef(untrained, counts)[0, 1] > 0.5
    counts = language_model.Counts(0, 0, 0, {b"a": 3}, np.zeros(0), np.array([1, 0]), 3)
    places = [(b, *map(int, x)) for b in (0, 1) for x in zip(*counts.split(b, np.arange(int(counts.own[b]), 20)))]
    assert len(set(places)) == 39 and {c for _, c, _ in places} == set(range(4, 10))
    columns = [np.array([3, 3, 254, 255, 600, 10**9]), np.array([0, 255, 256, 65535, 65536, 2**24 - 1]), np.arange(6)]
    assert [c.tolist() for c in language_model.unpacked(language_model.packed(columns), 3)] == [c.tolist() for c in columns]


def test_language_model_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert language_model.score(docs, F.lit(False)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>One <b>two</b>\n three<p>Next", "One two three\n\nNext"),
        ("<ul><li>a<li>b<ol start=3><li>x</li><li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
        ("<table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td>Very long<td>10</table>", "Name       Qty\nApple      3\nVery long  10"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("a<div hidden>no</div><script>x='<p>'</script><style>p{}</style><div style='display: none'>no</div>b", "ab"),  # what isn't shown makes no box, so no break
        ("<title>t</title>x &amp; y &lt;z&gt;", "x & y <z>"),
        ("<pre> a\n  b</pre>", " a\n  b"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<dl><dt>T<dd>D</dl>", "T\n  D"),
        ("<!-- x --><p>unclosed <b", "unclosed"),
        ("a < b", "a < b"),
        ("", ""),
        ("<" * 50, "<" * 50),
        ("<ol start=0><li>a</ol><ol start=-3><li>b<li>c</ol><ol start=x><li>d</ol>", "0. a\n\n-3. b\n-2. c\n\n1. d"),
        ("<table><tr><td colspan='²'>a<td colspan=" + "9" * 5000 + ">b<td rowspan=-1>c</table>", "a  b  c"),
        ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
        ("<div style='display:none'>no <b style='visibility: visible'>no</b></div>x", "x"),
        ("<p>a<table><tr><td>b<p>c<td>d</table>e", "a\n\nb  d\n\nc\n\ne"),
        ("<p>a<b>b<div>c</p>d</div></b>e", "ab\n\nc\n\nd\ne"),
        ("a<math><mi>x</mi><annotation>no</annotation></math>b", "axb"),
        ("a<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><g>no<text>one</text><text>two <tspan>three</tspan></text></g></svg>b", "a one two three b"),
        ("<svg><path d='x'/><text/>no<foreignObject><p>yes</p></foreignObject></svg>", "yes"),
        ("<svg><g><path><p>after an open drawing<svg/>on", "after an open drawing on"),
        ("<svg><style/><text>t</text></svg><svg fill=a/><text>u</text></svg>", "t u"),
        ("<colgroup hidden><p>kept", "kept"),
        ("<table><tr><td>a<math><td>b</td><tr><mi>c</math>d<td>e</table>", "abcd  e"),
        ("<table><colgroup hidden><col><tr><td>a</table>b", "a\n\nb"),
        ("<td hidden>a</td><tr style='display:none'>b", "ab"),
        ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
        ("<ol reversed start=9><li>a<li value=4>b<li value=x>c</ol>", "9. a\n4. b\n3. c"),
        ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
        ("<pre>\n\n a\n</pre><pre>\r\nb</pre>", "\n a\n\nb"),
        ("<pre><b>\nx</b></pre>", "\nx"),
        ("a<b style='display:/**/none'>no</b><b style='/* display:none */'>yes</b>", "ayes"),
    ],
)
def test_html(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize("part", ["<div>", "<p><b>", "<div></b>", "<p></div>", "<li>", "<div><p>", "</p>", "<b><td>", "<table><tr><td>", "<span></p>", "<svg><g><text>", "<svg><p>", "<math><mi>", "<svg><foreignobject><svg><text>"])
def test_html_takes_time_in_proportion(part):
    import time

    began = time.perf_counter()
    page = html_text.page_text(part * 60_000 + "deep")
    assert page.endswith("deep") and time.perf_counter() - began < 20


def test_html_loses_no_visible_word_of_tag_soup():
    rng = random.Random(21)
    tags = "div p b i ul ol li table tr td th tbody caption h1 h2 span dl dt dd blockquote pre section option select a math mi".split()
    for _ in range(400):
        words, page = [], []
        for k in range(rng.randrange(1, 40)):
            page.append(rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", f"<{rng.choice(tags)} class=x>", "<br>", "&nbsp;"]))
            if rng.random() < 0.6:
                words.append(f"word{k}x")
                page.append(words[-1])
        text = html_text.page_text("".join(page))
        assert all(text.count(w) == 1 for w in words), page


def test_html_deep_nesting_and_frames(spark):
    assert html_text.page_text("<div>" * 30_000 + "deep") == "deep"
    pages = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (None, "<p>x", "u"), (2, "<p>y", "u")], "page_id long, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"] or "-") for r in got) == [(0, "x"), (1, "-"), (2, "-"), (2, "y")]
