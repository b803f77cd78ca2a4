"""Pipe-separated output: written in shards of bounded bytes, published as a whole, verified, read back."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequora.functions import any_of, boolean_text
from sequora.sources import staging

FORMAT_VERSION = 2
TARGET_BYTES, FILE_LIMIT = 90_000_000, 128_000_000
CHUNK_BYTES = 8 << 20
#: Datasets that are written beside each other.
AT_ONCE = 8
MAY_BE_EMPTY = ("23_transaction_used_device", "24_transaction_from_ip")
MANIFEST = "dataset string, file string, bytes long, rows long, sha256 string, chunks array<string>"
MARKER = "published"
REPORT, REPORT_FOLDER = "section string, item string, value long", "report"


def plain_number(text: Column) -> Column:
    """The text of a floating number without an exponent: its digits moved by it, no zeros at the end, no lone point.

    Digits are those Spark writes, the fewest (or nearly) that give the number back. NaN and Infinity stay.
    Each part stands few times in the expression, so that rows of many numbers still compile.
    """
    sign = F.when(text.startswith("-"), "-").otherwise("")
    # with an exponent there is one digit before the point
    digits, power = F.translate(F.substring_index(text, "E", 1), "-.", ""), F.substring_index(text, "E", -1).try_cast("int")
    zeros = lambda n: F.repeat(F.lit("0"), n)
    low = F.concat(F.lit("0."), zeros(-power - 1), F.rtrim(digits, F.lit("0")))
    whole = F.concat(digits, zeros(power + 1 - F.length(digits)))
    cut = F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits)))
    moved = F.when(power < 0, low).when(F.length(digits) <= power + 1, whole).otherwise(cut)
    return F.when(text.rlike(r"\A-?\d.*E"), F.concat(sign, moved)).otherwise(F.regexp_replace(text, r"\.0\z", ""))


def psv_text(c: str, kind: T.DataType) -> Column:
    """A value as it stands in a file: null is empty; numbers give the same number back, whole ones without a fraction."""
    x = F.col(c)
    if isinstance(kind, T.BooleanType):
        return boolean_text(x)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.coalesce(F.date_format(x, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(plain_number(x.cast("string")), F.lit(""))
    return F.coalesce(x.cast("string"), F.lit(""))


def psv_rows(df: DataFrame) -> DataFrame:
    """Each row as one line."""
    return df.select(F.concat_ws("|", *[psv_text(f.name, f.dataType) for f in df.schema]).alias("value"))


class ExportError(RuntimeError):
    pass


def sharded(lines: DataFrame, target: int, total: int) -> DataFrame:
    """Lines of a staged table (value, bytes) with the shard each goes to: none passes `target`, and nearly all fill half of it or more.

    Rows are dealt into ranges of about four shards by their place in the staged files. Within
    one, short lines (a sixteenth of the target at most) go by the sum of the bytes before them
    over equal shares of the range's total, which leave room for one more line. A longer line of
    over target / 2^(c+1) and up to target / 2^c bytes is one of 2^c in its shard. A range's last
    shard of each length class may be smaller. No window is wider than a range.
    """
    ranges = max(1, -(-total // (4 * target)))
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    rows = lines.select("value", "bytes", place[0].alias("file"), place[1].alias("row"))
    rows = rows.withColumn("range", F.pmod(F.xxhash64("file", F.floor(F.col("row") / 64)), F.lit(ranges)))
    short = F.col("bytes") * 16 <= target
    rows = rows.withColumn("class", F.when(short, -1).otherwise(F.floor(F.log2(F.lit(target) / F.col("bytes")))).cast("int"))
    room = target - target // 16
    shares = rows.where("class < 0").groupBy("range").agg(F.sum("bytes").alias("all")).select("range", F.ceil(F.col("all") / F.ceil(F.col("all") / room)).alias("share"))
    rows = rows.join(shares, "range", "left")
    order = Window.partitionBy("range", "class").orderBy("file", "row")
    before = F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    k = F.when(F.col("class") < 0, F.floor(before / F.col("share"))).otherwise(F.floor((F.row_number().over(order) - 1) / F.pow(F.lit(2), F.col("class"))))
    return rows.select("value", F.concat_ws("-", "range", F.col("class") + 1, k.cast("long")).alias("shard"))


class Lines:
    """The rows of a frame as staged lines (value, bytes), with the rows, bytes and longest line that were seen in that write."""

    def __init__(self, df: DataFrame):
        self.spark, seen = df.sparkSession, Observation()
        self.path = staging.folder(self.spark, "lines")
        width = (F.octet_length("value") + 1).cast("long")
        try:
            psv_rows(df).withColumn("bytes", width).observe(seen, F.count("*").alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.max("bytes"), F.lit(0)).alias("longest")).write.parquet(self.path)
        except BaseException:
            self.remove()
            raise
        self.found = {k: int(v) for k, v in seen.get.items()}

    def check(self, path: str, target_bytes: int, may_be_empty: bool) -> None:
        if not self.found["rows"] and not may_be_empty:
            raise ExportError(f"{path} is empty")
        if self.found["longest"] > target_bytes:
            raise ExportError(f"{path} has a line of {self.found['longest']} bytes")

    def write(self, path: str, target_bytes: int) -> None:
        held = self.spark.read.schema("value string, bytes long").parquet(self.path)
        # what fits one shard needs no numbering
        one = held.select("value", F.lit("0-0-0").alias("shard")).coalesce(1)
        out = one if self.found["bytes"] <= target_bytes else sharded(held, target_bytes, self.found["bytes"])
        # tasks put their files in place, and not the driver one after another; readers wait for the marker
        out.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("shard").text(path)

    def remove(self) -> None:
        staging.remove(self.spark, self.path)


def write_psv(df: DataFrame, path: str, target_bytes: int = TARGET_BYTES, may_be_empty: bool = True) -> dict[str, int]:
    """Shards of at most target_bytes, no header, rows never split; returns the rows, bytes and longest line that were seen in the write.

    `df` is computed once: its lines are staged, observed on the way, and dealt out to shards from
    there. A line over the bound, or no line where some are due, is an error before any shard is
    written; so is an existing path.
    """
    lines = Lines(df)
    try:
        lines.check(path, target_bytes, may_be_empty)
        lines.write(path, target_bytes)
    finally:
        lines.remove()
    return lines.found


def write_all(datasets: dict[str, DataFrame], folder: str, target_bytes: int, may_be_empty: tuple[str, ...], counts: dict[str, int] | None) -> dict[str, dict[str, int]]:
    """Write each dataset as write_psv does; returns what was seen of each.

    Jobs of several datasets run beside each other, as most are small. No dataset's shards are begun
    before the lines of it and of all before it have been seen and accepted.
    """
    frames, seen, writes = dict(datasets.items()), {}, []
    with ThreadPoolExecutor(AT_ONCE) as ahead, ThreadPoolExecutor(AT_ONCE) as behind:
        staged = {n: ahead.submit(Lines, df) for n, df in frames.items()}
        try:
            for name, due in staged.items():
                lines, path = due.result(), f"{folder}/{name}"
                lines.check(path, target_bytes, name in may_be_empty)
                if counts is not None and counts.get(name) != lines.found["rows"]:
                    raise ExportError(f"{name}: {lines.found['rows']} rows written, {counts.get(name, 'none')} audited")
                seen[name] = lines.found
                writes.append(behind.submit(lines.write, path, target_bytes))
            for x in writes:
                x.result()
        finally:
            for due in staged.values():
                due.cancel()
            wait(writes)
            for due in staged.values():
                if not due.cancelled() and due.exception() is None:
                    due.result().remove()
    return seen


def files(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each file under path with its bytes, lines and SHA-256, and the SHA-256 of each chunk_bytes of it in order.

    Files are listed by Spark and read in the tasks as streams, so a task holds a piece of a file and never the whole.
    """

    def task(batches):
        import hashlib
        import re

        import pyarrow as pa
        import pyarrow.fs as pafs

        for batch in batches:
            out = []
            for uri in batch.column(0).to_pylist():
                fs, where = pafs.FileSystem.from_uri(re.sub(r"\A(file):/(?!//)", r"\1:///", uri).replace("s3a://", "s3://"))
                whole, chunks, size, lines = hashlib.sha256(), [], 0, 0
                with fs.open_input_stream(where, compression=None) as f:
                    one, left = hashlib.sha256(), chunk_bytes
                    while piece := f.read(min(1 << 20, left)):
                        whole.update(piece)
                        one.update(piece)
                        size, lines, left = size + len(piece), lines + piece.count(b"\n"), left - len(piece)
                        if not left:
                            chunks.append(one.hexdigest())
                            one, left = hashlib.sha256(), chunk_bytes
                    if left < chunk_bytes:
                        chunks.append(one.hexdigest())
                out.append((uri, size, lines, whole.hexdigest(), chunks))
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]
            names = ["path", "bytes", "rows", "sha256", "chunks"]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path")
    read = listed.mapInArrow(task, "path string, bytes long, rows long, sha256 string, chunks array<string>")
    inside = F.regexp_extract("path", r"([^/]+/)?[^/]+\z", 0)
    return read.select(inside.alias("file"), "bytes", "rows", "sha256", "chunks")


def manifest_of(spark: SparkSession, folder: str, datasets: list[str]) -> DataFrame:
    parts = [files(spark, f"{folder}/{d}").select(F.lit(d).alias("dataset"), "*") for d in datasets]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def export(datasets: dict[str, DataFrame], folder: str, checked: DataFrame, require: Callable[[DataFrame], None], counts: dict[str, int] | None = None, may_be_empty: tuple[str, ...] = MAY_BE_EMPTY, target_bytes: int = TARGET_BYTES, report: DataFrame | None = None) -> DataFrame:
    """Write all datasets in their order, the manifest and the report beside them, and last the marker that publishes them; return the manifest's rows.

    Refuses if a gate of `checked` has failed, if a dataset is empty that may not be, or if the rows
    seen in its lines differ from the audited `counts`; each is known before shards of the next
    dataset are begun. Whatever ends it before the marker leaves a folder that no reader takes. `report` (section,
    item, value) is what decided on the export; the marker states its digest.
    """
    require(checked)
    spark = checked.sparkSession
    seen = write_all(datasets, folder, target_bytes, may_be_empty, counts)
    head = {name: {"rows": found["rows"], "bytes": found["bytes"], "schema": datasets[name].schema.jsonValue()} for name, found in seen.items()}
    manifest_of(spark, folder, list(datasets)).repartition(1).write.mode("errorifexists").json(f"{folder}/manifest")
    stated = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    totals = {r["dataset"]: r for r in stated.groupBy("dataset").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest")).collect()}
    for name, said in head.items():
        r = totals.get(name)
        if (r["rows"], r["bytes"]) != (said["rows"], said["bytes"]) if r else said["rows"]:
            raise ExportError(f"{name}: {said['rows']} rows of {said['bytes']} bytes written, {(r['rows'], r['bytes']) if r else 'none'} in the files")
        if r and r["largest"] >= FILE_LIMIT:
            raise ExportError(f"{name} has a file of {r['largest']} bytes")
    said = {"format_version": FORMAT_VERSION, "chunk_bytes": CHUNK_BYTES, "order": list(datasets), "datasets": head}
    if report is not None:
        report.select("section", "item", "value").coalesce(1).write.mode("errorifexists").json(f"{folder}/{REPORT_FOLDER}")
        said["report"] = digests_of(spark, f"{folder}/{REPORT_FOLDER}")
    text = json.dumps(said, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{folder}/{MARKER}")
    return stated


def published(spark: SparkSession, folder: str) -> dict:
    """What the marker of an export states; an export without one was not finished and is refused."""
    if not staging.exists(spark, f"{folder}/{MARKER}/_SUCCESS"):
        raise ExportError(f"{folder} is not published")
    return json.loads(spark.read.text(f"{folder}/{MARKER}").first()["value"])


def digests_of(spark: SparkSession, path: str) -> list[str]:
    """The digests of the files under a path that holds few."""
    return sorted(r["sha256"] for r in files(spark, path).select("sha256").collect())


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report that a published export was decided on; one that isn't there, or isn't as it was stated, is an error."""
    stated = published(spark, folder).get("report")
    if stated is None:
        raise ExportError(f"{folder} has no report")
    if not staging.exists(spark, f"{folder}/{REPORT_FOLDER}") or digests_of(spark, f"{folder}/{REPORT_FOLDER}") != stated:
        raise ExportError(f"the report of {folder} is not as it was stated")
    return spark.read.schema(REPORT).json(f"{folder}/{REPORT_FOLDER}")


def verify(spark: SparkSession, folder: str, datasets: list[str]) -> DataFrame:
    """Faults of an export, as rows (dataset, file, fault): a version, set, size, digest or total that is not as stated.

    A digest that differs names the first chunk that does. An export that is not published is an error.
    """
    head = published(spark, folder)
    stated = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    faults = []
    if head["format_version"] != FORMAT_VERSION:
        faults.append(("", "", f"format version {head['format_version']}"))
    faults += [(d, "", "missing from the manifest") for d in datasets if d not in head["datasets"]]
    faults += [(d, "", "not expected") for d in head["datasets"] if d not in datasets]
    if "report" in head and (not staging.exists(spark, f"{folder}/{REPORT_FOLDER}") or digests_of(spark, f"{folder}/{REPORT_FOLDER}") != head["report"]):
        faults.append(("", REPORT_FOLDER, "other report"))
    now = manifest_of(spark, folder, [d for d in datasets if d in head["datasets"]])
    both = stated.join(now.select("dataset", "file", *[F.col(c).alias(f"now_{c}") for c in ("bytes", "rows", "sha256", "chunks")]), ["dataset", "file"], "full")
    chunk = F.array_position(F.zip_with("chunks", "now_chunks", lambda a, b: a.eqNullSafe(b)), F.lit(False)) - 1
    differs = F.when(F.col("sha256").isNull(), "not in the manifest").when(F.col("now_sha256").isNull(), "file is missing").when(F.col("bytes") != F.col("now_bytes"), "other size").when(F.col("sha256") != F.col("now_sha256"), F.concat(F.lit("other digest in chunk "), chunk)).when(F.col("rows") != F.col("now_rows"), "other rows")
    wrong = both.select("dataset", "file", differs.alias("fault")).where("fault IS NOT NULL")
    totals = {r["dataset"]: r for r in stated.groupBy("dataset").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).collect()}
    for d, said in head["datasets"].items():
        r = totals.get(d)
        if (r["rows"], r["bytes"]) != (said["rows"], said["bytes"]) if r else said["rows"]:
            faults.append((d, "", "other totals"))
    return wrong.unionByName(spark.createDataFrame(faults, "dataset string, file string, fault string")) if faults else wrong


CORRUPT = "_corrupt"


def read_psv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines under path by this schema, with `_corrupt`: the line, where it has another number of fields or a value that its type can't hold.

    Empty fields are empty texts or null numbers. Nothing is inferred, and no line is dropped.
    """
    lines = spark.read.schema("value string").option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    # a generated column: a filter on what is made of the parts stays above it, so a line is split once and not for each field
    lines = lines.select("value", F.explode(F.array(F.split("value", r"\|", -1))).alias("_parts"))
    parts = F.col("_parts")
    fits = F.size(parts) == len(schema)
    at = {f.name: F.when(fits, F.get(parts, k)) for k, f in enumerate(schema)}
    typed = {f.name: at[f.name] if isinstance(f.dataType, T.StringType) else F.nullif(at[f.name], F.lit("")).try_cast(f.dataType) for f in schema}
    bad = any_of([~fits, *[F.coalesce((at[f.name] != "") & typed[f.name].isNull(), F.lit(False)) for f in schema if not isinstance(f.dataType, T.StringType)]])
    return lines.select(*[x.alias(n) for n, x in typed.items()], F.when(bad, F.col("value")).alias(CORRUPT))


def read_export(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every dataset of a published export, by the schemas that its marker states."""
    return {d: read_psv(spark, f"{folder}/{d}", T.StructType.fromJson(said["schema"])) for d, said in published(spark, folder)["datasets"].items()}
