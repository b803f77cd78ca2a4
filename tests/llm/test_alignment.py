"""Alignment of two tokenizers against encoding whole texts and walking through the bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sequora.llm.alignment import Aligner, align, byte_level, refine

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def brute(rows):
    a, b, raw = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_level()
    a.encode_special_tokens = True
    of_b = lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
    found, count = [], Counter()
    for id_, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        ends = []
        for ids, of in ((ids_a, lambda k: bytes(raw[c] for c in a.id_to_token(k))), (ids_b, of_b)):
            parts = [of(k) for k in ids]
            ends.append((b"".join(parts), [sum(map(len, parts[: k + 1])) for k in range(len(parts))] if len(parts) < 3000 else None))
        if not text or any(e[0] != (" " + text).encode() for e in ends):
            found.append((id_, 0, 0, [], ""))
            continue
        at_a, at_b = ({e: k for k, e in enumerate(x[1])} for x in ends)
        links, names, pa, pb = [], [], 0, 0
        for e in sorted(set(at_a) & set(at_b)):
            qa, qb = at_a[e] + 1, at_b[e] + 1
            names.append(",".join(map(str, ids_a[pa:qa])) + "|" + ",".join(map(str, ids_b[pb:qb])))
            links.append((ids_a[qa - 1], ids_b[qb - 1]))
            pa, pb = qa, qb
        count.update(links)
        found.append((id_, len(ids_a), len(ids_b), links, ";".join(names)))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted((i, na, nb, len(li), len(li), sum(count[x] == most[x[1]] for x in li), sum(count[x] for x in li), g) for i, na, nb, li, g in found)


ALPHABET = "ab 漢字é😀\U0001f9ff \t\n,.'s<|>e\xa0　İﬁ"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(k, "".join(rng.choices(ALPHABET + "▁" * (k % 9 == 0) + "\x00", k=rng.randint(0, 30)))) for k in range(1500)]
    return [*out, (7, "the same id"), (7, "the same id"), (2000, None), (2001, ""), (2002, " "), (2003, "a "), (2004, "   "), (2005, "<|endoftext|> <s> </s> <unk>"), (2006, "word " * 500), (2007, "x" * 900)]


def test_against_whole_texts(spark, rows):
    got = align(spark.createDataFrame(rows, SCHEMA).repartition(5), A, B)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_digest_null_ids_and_clashes(spark, rows):
    some = [(None if k % 50 == 0 else k, t, "x", 1) for k, t in rows[:300]]
    got = align(spark.createDataFrame(some, SCHEMA + ", groups string, n_a int"), A, B, digest=True).collect()
    want = brute([(-1 if k is None else k, t) for k, t, *_ in some])
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got)) == sorted((*w[:-1], digest(w[-1])) for w in want)
    assert got[0].asDict().keys() == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}


def test_no_rows(spark):
    assert align(spark.createDataFrame([], SCHEMA), A, B).count() == 0


def test_forgetting_changes_nothing(rows):
    al, small = Aligner(A, B), Aligner(A, B)
    texts = [t for _, t in rows if t]
    for t in texts:
        for x in (al, small):
            x.learn(list(set(x.chunks(t)).difference(x.known)))
        of = lambda x: [(x.groups[k], x.counts[k].tolist(), [x.pair_codes[p] for p in x.link_of[x.link_at[k] : x.link_at[k + 1]]]) for k in map(x.known.__getitem__, x.chunks(t))]  # noqa: B023, E731
        assert of(al) == of(small)
        small.forget(5)
        assert len(small.groups) <= 5


def test_refine():
    import numpy as np

    # three tokens share one character that ends at 4; the span of the first is right
    assert refine(np.array([1, 4, 4, 4, 6]), np.array([True, False, False, True, True]), np.array([1, 1, 1, 1, 2])).tolist() == [1, 2, 3, 4, 6]


def test_query(spark, small_folder):
    from __spark_entry__ import queries

    got = queries()["op13_alignment"](spark, small_folder).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_folder}/documents.parquet").collect() if len(r.text or "") < 1000]
    seen = {(r.doc_id, r.n_a, r.n_b, r.groups_sha256) for r in got}
    assert len(got) == len(rows) + 2
    for i, na, nb, *_, g in brute(rows):
        assert (i, na, nb, hashlib.sha256(g.encode()).hexdigest() if g else "") in seen
