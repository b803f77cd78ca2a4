"""Phrases against counting every phrase of every text."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from sequora.llm.collocations import OP12_SQL, Words, _tables, mine, unary_paths

SCHEMA = "doc_id long, lang string, text string"


def pieces(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [w for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(fold)) if (w := re.findall(r"[^ \t]+", p))]


def brute(rows, least, share=80, top=2000):
    count, total = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            total[lang] += len(w)
            count[lang].update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        found, around = [], Counter()
        for p, a in f.items():
            if len(p) > 2 and a >= least:
                for k in range(2, len(p)):
                    for i in range(len(p) - k + 1):
                        around[p[i : i + k]] = max(around[p[i : i + k]], a)
        for p, a in f.items():
            if len(p) > 1 and a >= least and 100 * around[p] < share * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n, p.decode(), -a, l, r, total[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def texts(n, seed):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "sat", "on", "é", "漢字", "x" * 200, "mat", "a-b", "I", "İ", "Ａ"] + [f"w{k}" for k in range(30)]
    weights = [20] * 9 + [4] * (len(words) - 9)
    say = lambda: "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b"]) for w in rng.choices(words, weights, k=rng.randint(0, 60)))
    rows = [(k, rng.choice(["en", "de", None, ""]), say()) for k in range(n)]
    passage = "one long passage that goes on and on for many words without a stop so that it is one path"
    return [*rows, *[(9000 + k, "en", passage) for k in range(9)], *[(9100 + k, "en", "go go go go go go go") for k in range(4)], (9999, None, None), (9998, "en", ""), (9998, "en", " \t.,"), (9997, "en", "big " * 60_000)]


@pytest.mark.parametrize("least,bits", [(5, 20), (8, 15), (2, 28)])
def test_against_counting(spark, least, bits):
    rows = texts(300, least)
    got = mine(spark.createDataFrame(rows, SCHEMA).repartition(5), least=least, bits=bits)
    assert sorted(map(tuple, got.collect())) == brute(rows, least)


def test_top_counts_from_the_best(spark):
    rows = texts(200, 1)
    got = mine(spark.createDataFrame(rows, SCHEMA), least=3, top=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, top=7)
    with pytest.raises(ValueError):
        mine(spark.createDataFrame(rows, SCHEMA), least=0)


def test_no_rows_and_clashing_columns(spark):
    assert mine(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(k, "en", "so it goes") for k in range(5)]
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA + ", phrase string, n int, score double")
    assert sorted(map(tuple, mine(df, least=5).collect())) == brute(rows, 5)


def test_unary_paths(spark):
    edges = [("en", " ".join("abcdefghijklmno"[i : i + 4]), 10 + i) for i in range(12)]
    edges += [("en", "x y z a", 3), ("en", "x y z b", 4)]  # a fork
    edges += [("en", "r r r r", 5), ("en", "s t s t", 6), ("en", "t s t s", 6)]  # rings
    edges += [("de", "b c d e", 1)]
    got = {(r.lang, " ".join(r.words)): list(r.weights) for r in unary_paths(spark.createDataFrame(edges, "lang string, phrase string, n long")).collect()}
    assert got.pop(("en", " ".join("abcdefghijklmno"))) == list(range(10, 22))
    assert got == {("en", "x y z a"): [3], ("en", "x y z b"): [4], ("en", "r r r r"): [5], ("en", "s t s t"): [6], ("en", "t s t s"): [6], ("de", "b c d e"): [1]}


def test_words_of_a_batch():
    import pyarrow as pa

    all_texts = ["Ab c", "", "d", "x.y  z", "\t", "Ünï,ß"]
    w = Words(pa.array(["a", "a", "b", "a", "b", "a"]), pa.array(all_texts), _tables(1))
    assert [w.word(k).decode() for k in range(len(w.start))] == ["ab", "c", "d", "x", "y", "z", "Ünï", "ß"]
    assert w.begins.tolist() == [True, False, True, True, True, False, True, True]
    assert w.doc.tolist() == [0, 0, 2, 3, 3, 3, 5, 5]
    same = Words(pa.array(["a", "b"]), pa.array(["ab ab", "ab"]), _tables(1))
    assert same.h[0][0] == same.h[0][1] == w.h[0][0] != same.h[0][2]


def test_query_against_sql(spark, small_folder, duck):
    from __spark_entry__ import queries

    assert sorted(map(tuple, queries()["op12_collocations"](spark, small_folder).collect())) == sorted(duck.sql(OP12_SQL).fetchall()) != []
