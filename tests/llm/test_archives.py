"""WARC archives: round trips, roles, dictionaries, damage."""

from __future__ import annotations

import base64
import hashlib
import os

import pytest

from sequora.llm.common import new_path
from sequora.llm.warc import DICTIONARY_FRAME, OP11_SQL, build_dictionary, frames, parse, read_record, read_warc, write_warc

SCHEMA = "page_id long, url string, html string"


def expected(rows, least=0):
    out, groups = [], {}
    for id_, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(id_)
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids = sorted(ids, key=lambda x: (x is not None, x or 0))
        for k, id_ in enumerate(ids):
            whole = len(payload) < least or k == len(ids) - 1
            out.append((id_, len(payload), digest, "response" if whole else "revisit", None if whole else ids[-1]))
    return sorted(out, key=repr)


def got(spark, rows, schema=SCHEMA, **more):
    manifest = write_warc(spark.createDataFrame(rows, schema), new_path(spark, "warc-test"), **more).cache()
    read = read_warc(manifest).collect()
    number = lambda x: None if x is None else int(x)
    return manifest.collect(), read, sorted([(number(r.id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in read], key=repr)


def pages(n):
    return [(k, f"http://example.org/{k}?a=ü b\r\nX: 1", f"<html><p>page {k % 40} " + "of some words that recur " * (k % 7) + "é</p>" * 20) for k in range(n)]


@pytest.mark.parametrize("least", [0, 300])
def test_roles_and_round_trip(spark, least):
    rows = [*pages(400), (1000, None, None), (1001, "", ""), (1001, "", ""), (None, "u", "x"), (None, "u", "x"), (None, None, "page alone"), (5, "again", pages(6)[5][2]), (2000, "long", "y" * 3_000_000)]
    manifest, read, found = got(spark, rows, min_bytes=least)
    assert found == expected(rows, least)
    assert sum(m.records for m in manifest) == len(rows)
    texts = {hashlib.sha256((html or "").encode()).hexdigest() for _, _, html in rows}
    assert {hashlib.sha256(bytes(r.payload)).hexdigest() for r in read if r.payload is not None} == texts
    assert len({r.record_id for r in read}) == len(rows)
    assert all(r.payload is None for r in read if r.record_type == "revisit")


def test_empty_table_and_extra_columns(spark):
    assert got(spark, [])[2] == []
    rows = [(1, "u", "a", "response"), (2, "u", "a", "x")]
    assert got(spark, rows, SCHEMA + ", record_type string")[2] == expected([r[:3] for r in rows])


def test_records_are_frames_behind_the_dictionary(spark):
    import zstandard

    manifest, read, _ = got(spark, pages(400))
    whole = [m for m in manifest if m.dictionary_bytes]
    assert whole
    for m in whole:
        raw = open(m.uri.removeprefix("file://"), "rb").read()
        assert int.from_bytes(raw[:4], "little") == DICTIONARY_FRAME and int.from_bytes(raw[4:8], "little") == m.dictionary_bytes
        dictionary = zstandard.ZstdCompressionDict(raw[8 : 8 + m.dictionary_bytes])
        assert zstandard.get_frame_parameters(raw[8 + m.dictionary_bytes :]).dict_id == dictionary.dict_id() != 0
        mine = sorted((r.offset, r.frame_bytes) for r in read if r.uri == m.uri)
        assert len(mine) == m.records and sum(mine[-1]) == len(raw) == m.bytes
        assert all(a[0] + a[1] == b[0] for a, b in zip(mine, mine[1:], strict=False))
    one = next(r for r in read if r.record_type == "response" and r.uri == whole[0].uri)
    fields, block = read_record(one.uri, one.offset, one.frame_bytes)
    assert fields["warc-record-id"] == f"<{one.record_id}>" and block.endswith(bytes(one.payload))


def test_dictionary_makes_archives_smaller():
    records = [f"WARC/1.1\r\nWARC-Type: response\r\nrecord {k} of many with a common frame\r\n\r\n{k * k}".encode() for k in range(3000)]
    import zstandard

    dictionary = zstandard.ZstdCompressionDict(build_dictionary(records, 112_640))
    size = lambda c: sum(len(c.compress(r)) for r in records)
    assert size(zstandard.ZstdCompressor(dict_data=dictionary)) + len(dictionary.as_bytes()) < size(zstandard.ZstdCompressor())
    assert build_dictionary([b"short"], 112_640) == b"" and build_dictionary([], 100) == b""


def test_damage_is_found(spark, tmp_path):
    manifest, _, _ = got(spark, pages(60))
    path = manifest[0].uri.removeprefix("file://")
    raw = open(path, "rb").read()
    for bad in (raw[:-3], raw[: len(raw) // 2], raw[:-40] + bytes([raw[-40] ^ 1]) + raw[-39:]):
        where = os.path.join(tmp_path, "bad.warc.zst")
        with open(where, "wb") as f:
            f.write(bad)
        with open(where, "rb") as f, pytest.raises(Exception, match="frame|archive|record"):
            for _, _, content in frames(f):
                parse(content)


def test_query_against_sql(spark, small_folder, duck):
    from __spark_entry__ import queries

    found = sorted(map(repr, map(tuple, queries()["op11_warc"](spark, small_folder).collect())))
    assert found == sorted(map(repr, duck.sql(OP11_SQL).fetchall()))
