import glob
import math
import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from sequora.operators import export
from sequora.operators.gates import GateError, require


@pytest.fixture
def good(spark):
    return spark.createDataFrame([("any", 0)], "check_name string, failure_count long")


def frame(spark):
    return spark.createDataFrame([("T1", 1.0, None, True, "a\"b"), ("T2", 1e8, 2.5, None, ""), ("T3", 0.1, 1e-7, False, None)], "id string, x double, y float, b boolean, s string")


def parts(path):
    return sorted(glob.glob(f"{path}/**/part-*", recursive=True))


def flip(path, at):
    os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))  # else the file system finds it first
    with open(path, "r+b") as f:
        f.seek(at)
        byte = f.read(1)
        f.seek(at)
        f.write(bytes([byte[0] ^ 1]))


def test_round_trip_and_faults(spark, good, tmp_path):
    folder = f"file://{tmp_path}/out"
    found = export.export({"one": frame(spark)}, folder, good, require)
    assert sum(r["rows"] for r in found.collect()) == 3
    lines = sorted(x for p in parts(f"{tmp_path}/out/one") for x in open(p).read().splitlines())
    assert lines == ['T1|1||true|a"b', "T2|100000000|2.5|false|", "T3|0.1|0.0000001|false|"]
    assert export.verify(spark, folder, ["one"]).count() == 0
    assert {r["fault"] for r in export.verify(spark, folder, ["one", "two"]).collect()} == {"missing from the manifest"}
    back = export.read_export(spark, folder)["one"]
    assert back.columns == [*frame(spark).columns, "_corrupt"] and back.where("_corrupt IS NOT NULL").count() == 0
    assert {tuple(r)[:5] for r in back.collect()} == {("T1", 1.0, None, True, 'a"b'), ("T2", 1e8, 2.5, False, ""), ("T3", 0.1, struct.unpack("f", struct.pack("f", 1e-7))[0], False, "")}
    flip(parts(f"{tmp_path}/out/one")[0], 0)
    assert {r["fault"] for r in export.verify(spark, folder, ["one"]).collect()} == {"other digest in chunk 0"}
    with pytest.raises(Exception, match="(?i)exists"):
        export.write_psv(frame(spark), f"{folder}/one")


def test_the_damaged_chunk_is_named(spark, good, tmp_path, monkeypatch):
    monkeypatch.setattr(export, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(export.files, "__defaults__", (1000,))
    folder = f"file://{tmp_path}/out"
    export.export({"one": spark.range(3000).selectExpr("concat('row ', id) id").coalesce(1)}, folder, good, require)
    path = parts(f"{tmp_path}/out/one")[0]
    r = spark.read.json(f"{folder}/manifest").first()
    assert len(r["chunks"]) == math.ceil(os.path.getsize(path) / 1000) and r["bytes"] == os.path.getsize(path)
    flip(path, 12_345)
    assert [r["fault"] for r in export.verify(spark, folder, ["one"]).collect()] == ["other digest in chunk 12"]
    os.truncate(path, 20_000)
    assert [r["fault"] for r in export.verify(spark, folder, ["one"]).collect()] == ["other size"]


def test_refusals(spark, good, tmp_path):
    folder = f"file://{tmp_path}/out"
    bad = spark.createDataFrame([("orphans", 3)], "check_name string, failure_count long")
    with pytest.raises(GateError, match="orphans: 3"):
        export.export({"one": frame(spark)}, folder, bad, require)
    with pytest.raises(export.ExportError, match="empty"):
        export.export({"none": frame(spark).limit(0)}, folder, good, require)
    with pytest.raises(export.ExportError, match="3 rows written, 4 audited"):
        export.export({"one": frame(spark)}, folder, good, require, {"one": 4})


def test_what_was_not_finished_is_refused(spark, good, tmp_path):
    """The third of four datasets fails as its rows are computed: two are written, none is published."""
    folder = f"file://{tmp_path}/out"
    broken = frame(spark).withColumn("x", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        export.export({"1": frame(spark), "2": frame(spark), "3": broken, "4": frame(spark)}, folder, good, require)
    assert os.path.isdir(f"{tmp_path}/out/2") and not os.path.exists(f"{tmp_path}/out/4")
    for reader in (lambda: export.verify(spark, folder, ["1", "2", "3", "4"]), lambda: export.read_export(spark, folder)):
        with pytest.raises(export.ExportError, match="not published"):
            reader()


def test_the_report_lies_beside_the_export(spark, good, tmp_path):
    folder, rows = f"file://{tmp_path}/out", [("audit", "any", 0), ("result", "passed", 1)]
    report = spark.createDataFrame(rows, "section string, item string, value long").selectExpr("value", "item", "section")
    export.export({"one": frame(spark)}, folder, good, require, report=report)
    assert sorted(tuple(r) for r in export.read_report(spark, folder).collect()) == rows
    assert export.verify(spark, folder, ["one"]).count() == 0
    flip(parts(f"{tmp_path}/out/report")[0], 30)
    assert [tuple(r) for r in export.verify(spark, folder, ["one"]).collect()] == [("", "report", "other report")]
    with pytest.raises(export.ExportError, match="not as it was stated"):
        export.read_report(spark, folder)
    os.rename(f"{tmp_path}/out/report", f"{tmp_path}/out/elsewhere")
    assert [r["fault"] for r in export.verify(spark, folder, ["one"]).collect()] == ["other report"]
    export.export({"one": frame(spark)}, f"{folder}2", good, require)
    with pytest.raises(export.ExportError, match="has no report"):
        export.read_report(spark, f"{folder}2")


def test_unaudited_dataset_is_refused(spark, good, tmp_path):
    with pytest.raises(export.ExportError, match="none audited"):
        export.export({"one": frame(spark)}, f"file://{tmp_path}/out", good, require, {"two": 3})


def test_an_empty_dataset_that_may_be(spark, good, tmp_path):
    folder = f"file://{tmp_path}/out"
    export.export({"none": frame(spark).limit(0), "one": frame(spark)}, folder, good, require, may_be_empty=("none",))
    assert export.verify(spark, folder, ["none", "one"]).count() == 0
    assert export.read_export(spark, folder)["none"].count() == 0


@pytest.mark.parametrize("lengths", ["1", "int(id % 50) * int(id % 7)", "case when id % 500 = 3 then 1990 else 20 end", "case when id % 100 = 7 then 400 + id % 100 else id % 30 end"])
def test_shards_fill_half_of_the_target(spark, tmp_path, lengths):
    rows = spark.range(6000).selectExpr(f"repeat('x', int({lengths})) s").repartition(3)
    target, bytes_ = 2000, sum(len(r.s) + 1 for r in rows.collect())
    seen = export.write_psv(rows, f"file://{tmp_path}/many", target_bytes=target)
    sizes = [os.path.getsize(p) for p in parts(f"{tmp_path}/many")]
    assert seen["rows"] == 6000 and seen["bytes"] == sum(sizes) == bytes_ and max(sizes) <= target
    lines = sorted(x for p in parts(f"{tmp_path}/many") for x in open(p).read().split("\n")[:-1])
    assert lines == sorted(r.s for r in rows.collect())
    # the last shard of a class in a range may be small
    ranges = -(-bytes_ // (4 * target))
    assert sum(x < target / 2 for x in sizes) <= 6 * ranges
    assert len(sizes) <= 2 * bytes_ / target + 6 * ranges
    with pytest.raises(export.ExportError, match="a line of"):
        export.write_psv(rows.selectExpr("repeat('y', 101) s"), f"file://{tmp_path}/narrow", target_bytes=100)
    assert not os.path.exists(f"{tmp_path}/narrow")


def test_one_long_line_does_not_make_small_files(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("case when id = 77 then repeat('x', 9000) else concat('line ', id) end s")
    export.write_psv(rows, f"file://{tmp_path}/one", target_bytes=10_000)
    sizes = sorted(os.path.getsize(p) for p in parts(f"{tmp_path}/one"))
    assert len(sizes) < 2 * sum(sizes) / 10_000 and sizes[1] > 4_000


def test_numbers_give_themselves_back(spark):
    rng = random.Random(2)
    doubles = [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(3000)] + [rng.uniform(-180, 180) for _ in range(500)] + [round(rng.uniform(0, 1e6), 2) for _ in range(500)]
    doubles = [x for x in doubles if math.isfinite(x)] + [0.0, -0.0, 1.5e25, 1e-13, 5e-324, 1.7976931348623157e308, 0.1234567890123456, 40.712812345678912, 1e7, 9999999.0, 1e-3, 123456789.125, -1e22, 100.0]
    floats = [struct.unpack("f", struct.pack("f", rng.uniform(-1e6, 1e6) * 10 ** rng.randint(-30, 25)))[0] for _ in range(len(doubles))]
    df = spark.createDataFrame(list(zip(doubles, floats)), "d double, f float")
    rows = df.select("d", "f", *[export.psv_text(c, df.schema[c].dataType).alias(f"t{c}") for c in "df"]).collect()
    for r in rows:
        for text in (r.td, r.tf):
            assert set(text) <= set("-0123456789.") and not text.endswith(".") and not (("." in text) and text.endswith("0"))
            assert not text.lstrip("-").startswith("0") or text.lstrip("-") == "0" or text.lstrip("-").startswith("0.")
        assert float(r.td) == r.d and struct.unpack("f", struct.pack("f", float(r.tf)))[0] == r.f
        assert abs(r.d) >= 1e16 or abs(r.d) < 1e-4 or len(r.td.removesuffix(".0")) <= len(repr(r.d)) + 1
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "d double")
    assert [r[0] for r in odd.select(export.psv_text("d", odd.schema["d"].dataType)).collect()] == ["NaN", "Infinity", "-Infinity", ""]


def test_bad_lines_are_kept_apart(spark, tmp_path):
    with open(tmp_path / "part-0", "w") as f:
        f.write("a|1|1.5\nb|x|2\nc|3\nd|4|5|6\n|||\n||\ne|99999999999999999999|1\n")
    rows = export.read_psv(spark, f"file://{tmp_path}", spark.createDataFrame([], "s string, n long, d double").schema).collect()
    assert {(r.s, r.n, r.d) for r in rows if r._corrupt is None} == {("", None, None), ("a", 1, 1.5)}
    assert sorted(r._corrupt for r in rows if r._corrupt is not None) == sorted(["b|x|2", "c|3", "d|4|5|6", "|||", "e|99999999999999999999|1"])
