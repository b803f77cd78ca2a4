"""Every registered operator and the pipeline, through the entry, over small tables of odd rows and over empty ones."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from sequora.llm.packing import binary_lengths

N_DOCS, N_VECTORS, N_PAGES = 9, 8, 6
ROWS = {"op1_near_duplicates": N_VECTORS, "op2_token_files": N_DOCS, "op3_jaccard_join": N_DOCS, "op4_bpe": N_DOCS, "op5_language_model": N_DOCS, "op6_packing": None, "op7_line_dedup": N_DOCS, "op8_toxicity": N_DOCS, "op9_top_k": 2 * 4, "op10_html_text": N_PAGES}


@pytest.mark.parametrize("name", ROWS)
def test_query_over_odd_rows_and_none(spark, small_folder, empty_folder, duck, name):
    import __spark_entry__ as e

    df = e.queries()[name](spark, small_folder)
    got = df.collect()
    assert ROWS[name] in (None, len(got))
    if name in e.oracle_sql():
        result = duck.execute(e.oracle_sql()[name])
        columns = [d[0] for d in result.description]
        assert sorted(map(str, result.fetchall())) == sorted(str(tuple(r[c] for c in columns)) for r in got)
    assert e.queries()[name](spark, empty_folder).count() == 0


def without_later_passages(rows):
    """Texts without the windows of three filled lines that come before, by (id, md5 of the text, place)."""
    docs = sorted({(r[0], r[1] or "") for r in rows}, key=lambda d: (d[0] is not None, d[0], hashlib.md5(d[1].encode()).hexdigest()))
    seen, texts = set(), {}
    for d in docs:
        lines, gone = d[1].split("\n"), set()
        filled = [k for k, x in enumerate(lines) if x.strip(" \t\r")]
        for three in zip(filled, filled[1:], filled[2:]):
            window = tuple(lines[k] for k in three)
            if window in seen:
                gone.update(three)
            seen.add(window)
        texts[d] = "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else d[1]
    return [(r[0], None if r[1] is None else texts[r[0], r[1]]) for r in rows]


def one_of_each_group(rows):
    """Rows without those that are copies of, or reach by links of 0.8 between sets of five words, a text of a smaller id."""
    def shingles(text):
        w = (text or "").lower().split()
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    out = {}
    for k, r in enumerate(rows):
        key = group[k] if sets[k] else (k, "wordless")
        out[key] = min(out.get(key, r), r, key=lambda x: x[0])
    return list(out.values())


def test_pipeline_equals_brute_force(spark, small_folder, empty_folder):
    import __spark_entry__ as e
    import corpus_pipeline
    from tests.llm.conftest import TABLES

    # four labels are too few for a feature, so the first stage keeps everything
    rows = one_of_each_group(without_later_passages([(r[0], r[1]) for r in TABLES["documents"][1]]))
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in rows:
        ids, at = t.encode(text or "", add_special_tokens=False).ids + [1], 0
        for n in binary_lengths(len(ids), 2048):
            want.append((doc_id, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()), len(ids)))
            at += n
    got = e.queries()["pipeline"](spark, small_folder)
    assert sorted(tuple(r) for r in got.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()) == sorted(want)
    assert len({r[0] for r in rows}) == 7 and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "packing"]
    assert e.queries()["pipeline"](spark, empty_folder).count() == 0
