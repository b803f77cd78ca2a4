import base64
import random


import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tokenizers import Tokenizer

from sequora.llm import bpe, packing, token_files
from sequora.llm.common import new_path

PIECES = ["a", "aa", "b", "é", " ", "  ", "\n", " \n", "\t", "ß", "中", "12", "'s", "!!", "   ", "\x1c", "😀", "x" * 40, "ab" * 20, "\r\n", "<|endoftext|>", ".", " word.", "﷐"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(400)]
    return [None, "", "word " * 5000, *out, *out[:20]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)


@pytest.fixture(scope="module")
def ids(texts):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def raw(x):
    return np.array(x, "<u4").tobytes()


def test_token_files(spark, docs, ids):
    folder = new_path(spark, "test-tokens")
    manifest = token_files.write_token_files(docs, folder, P.path("byte_bpe_50k.json"), length=64, docs_per_file=100).toPandas()
    rows = token_files.read_token_files(spark.createDataFrame(manifest)).orderBy("doc_id").collect()
    start = 0
    for r, want in zip(rows, ids, strict=True):
        assert (r["start"], r["n_tokens"], bytes(r["ids"])) == (start, len(want) + 1, raw([*want, 0]))
        start += len(want) + 1
    first = manifest.sort_values("part").iloc[0]
    f = token_files.SequenceFile(first["uri"] + ".arrow")
    flat = [t for w in ids for t in [*w, 0]]
    for k in (0, 1, 70):
        seq, mask = f[k]
        n = mask.true_count
        assert len(seq) == 64 and seq[:n].tolist() == flat[64 * k : 64 * k + n]
        assert not seq.flags.owndata  # a view of the mapped file


def test_token_files_empty(spark, docs):
    manifest = token_files.write_token_files(docs.limit(0), new_path(spark, "test-tokens"), P.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(spark.createDataFrame(manifest.toPandas(), manifest.schema)).count() == 0


def test_packing(docs, ids):
    rows = packing.pack(docs, P.path("byte_bpe_50k.json")).orderBy("doc_id", "start").collect()
    got = {}
    for r in rows:
        assert r["start"] == sum(map(len, got.get(r["doc_id"], []))) // 4
        assert r["length"] == len(r["ids"]) // 4 == r["bucket"] and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 and r["offset"] == 0
        got.setdefault(r["doc_id"], []).append(bytes(r["ids"]))
    assert {k: b"".join(v) for k, v in got.items()} == {k: raw([*w, 1]) for k, w in enumerate(ids)}
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert packing.pack(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 2047, 2048, 2049, 10_000])
def test_binary_lengths(n):
    parts = packing.binary_lengths(n, 2048)
    assert sum(parts) == n and parts == sorted(parts, reverse=True)
    assert len([p for p in parts if p < 2048]) == bin(n % 2048).count("1")


def test_bpe_equals_tiktoken_and_round_trips(docs, texts):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.decode(bpe.encode(docs, path, P.PATTERN), path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == t.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode() and r["n_tokens"] == len(r["ids"]) // 4


def test_merges_that_come_out_of_order(tmp_path):
    """A merge that makes a pair of a lower rank: that pair goes first, as word by word."""
    words = [bytes([b]) for b in range(256)] + [b"abc", b"ab", b"cab", b"aa", b"aaa", b"bc"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(w) + b" %d\n" % k for k, w in enumerate(words)))
    t = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks={w: k for k, w in enumerate(words)}, special_tokens={})
    m = bpe.Merges(str(path))
    rng = random.Random(1)
    some = sorted({"".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(500)})
    for w, got in zip(some, m.replay([w.encode() for w in some])):
        assert np.frombuffer(got, "<u4").tolist() == t.encode_ordinary(w)


def test_one_word_merges_in_order_of_rank_and_place(tmp_path):
    words = [bytes([b]) for b in range(256)] + [b"abc", b"ab", b"cab", b"aa", b"aaa", b"bc", b"abab", b"bca"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(w) + b" %d\n" % k for k, w in enumerate(words)))
    t = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks={w: k for k, w in enumerate(words)}, special_tokens={})
    m, rng = bpe.Merges(str(path)), random.Random(2)
    for n in [0, 1, 2, *rng.choices(range(3, 40), k=400)]:
        w = "".join(rng.choices("abc", k=n))
        if w.encode() not in m.ranks or n < 2:
            assert m.one_word(w.encode()) == t.encode_ordinary(w), w
    long = "".join(rng.choices("abc", k=60_000))
    assert m.one_word(long.encode()) == t.encode_ordinary(long)


def test_bpe_of_odd_rows_and_ids_that_there_are_not(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = [(None, "one two"), (7, None), (7, "one two"), (7, "one two")]
    coded = bpe.decode(bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), path, P.PATTERN), path)
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"])) for r in coded.collect()) == [(0, b"one two"), (7, b""), (7, b"one two"), (7, b"one two")]
    assert bpe.decode(bpe.encode(spark.createDataFrame([], "doc_id long, text string"), path, P.PATTERN), path).count() == 0
    with pytest.raises(ValueError):
        bpe.decode(coded, path)
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([(1, b"\xff\xff\xff\x7f")], "doc_id long, ids binary"), path).collect()
    assert bytes(bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), path).first()["decoded"]) == b""
