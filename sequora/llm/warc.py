"""WARC archives with a Zstandard dictionary in front and every record in a frame of its own.

An archive begins with a skippable frame that holds a dictionary built from records of this
archive; then each record, first a warcinfo, is one frame compressed with it. So a reader
needs nothing but the archive, and any record can be read alone from its place.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.common import new_path, slices, stage, table

# fixed values of the formats
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 112_640
SAMPLE_BYTES = 2 << 20
MANIFEST = "part int, uri string, records long, bytes long, dictionary_bytes long"
RECORDS = "record_type string, id string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary, record_id string, uri string, offset long, frame_bytes long"


class ArchiveError(RuntimeError):
    pass


def build_dictionary(records: list[bytes], size: int) -> bytes:
    """A dictionary of at most `size` bytes from these records; b"" if they are too few to build one on.

    A sixteenth of the records at most, as it is stored with them; few long records are cut up.
    """
    import zstandard

    total = sum(map(len, records))
    size = min(size, total // 16)
    if size < 256:
        return b""
    parts = records if len(records) >= 64 else [r[at : at + max(64, total // 64)] for r in records for at in range(0, len(r), max(64, total // 64))]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:  # nothing recurs in them
        return b""


def record(kind: str, record_id: str, date: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", date), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def page_record(id_: str | None, url: str | None, sha1: bytes, n_bytes: int, payload: bytes | None, first: tuple[str | None, str | None] | None, record_id: str, refers_to: str | None, date: str) -> bytes:
    """A response with its payload, or a revisit of `first` (id, url) whose record is `refers_to`."""
    safe = lambda x: quote(x, safe="!#$%&'()*+,/:;=?@[]~")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    fields = [("WARC-Target-URI", safe(url) if url else "about:blank"), ("WARC-Payload-Digest", f"sha1:{base32(sha1)}")]
    fields += [("Source-Id", quote(id_, safe=""))] if id_ is not None else []
    block = http + (payload or b"")
    fields.append(("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    if first is None:
        return record("response", record_id, date, fields, block)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{refers_to}>"), ("WARC-Refers-To-Target-URI", safe(first[1]) if first[1] else "about:blank")]
    fields += [("Refers-To-Source-Id", quote(first[0], safe=""))] if first[0] is not None else []
    return record("revisit", record_id, date, fields, block)


def write_archive(sink, records: Iterator[bytes], info: bytes, dictionary_bytes: int, sample_bytes: int, level: int) -> tuple[int, int, int]:
    """Write one archive; returns records, bytes, and bytes of the dictionary.

    The records that come first, up to sample_bytes, are held until the dictionary is built from them.
    """
    import zstandard

    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r)
        if size >= sample_bytes:
            break
    dictionary = build_dictionary([r[:sample_bytes] for r in held], dictionary_bytes)
    written = 0
    if dictionary:
        written += sink.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        d = zstandard.ZstdCompressionDict(dictionary)
        d.precompute_compress(level=level)
        compress = zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=True).compress
    else:
        compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
    written += sink.write(compress(info))
    n = 0
    for source in (held, records):
        for r in source:
            written += sink.write(compress(r))
            n += 1
        held.clear()
    return n, written, len(dictionary)


def frames(source, step: int = 1 << 18) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and content of each record's frame in an archive; memory holds one record."""
    import zstandard

    head = source.read(8)
    held, at, dictionary = head, 0, None
    if len(head) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == DICTIONARY_FRAME:
            content = source.read(size)
            if len(content) < size:
                raise ArchiveError("the archive ends in its dictionary")
            if content[:4] == FRAME_MAGIC:
                content = zstandard.ZstdDecompressor().decompress(content)
            dictionary, held, at = zstandard.ZstdCompressionDict(content), b"", 8 + size
    context = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while held or (held := source.read(step)):
        one, out, taken = context.decompressobj(), [], 0
        while True:
            try:
                out.append(one.decompress(held))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"the frame at {at} can't be read: {e}") from e
            taken += len(held)
            if one.eof:
                break
            held = source.read(step)
            if not held:
                raise ArchiveError(f"the archive ends in the frame at {at}")
        held = one.unused_data
        taken -= len(held)
        yield at, taken, b"".join(out)
        at += taken


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ArchiveError("a frame holds no WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) != n + 4:
        raise ArchiveError("a record is not as long as it says")
    return fields, rest[:n]


def _http(block: bytes) -> tuple[int, bytes]:
    """Length that the HTTP head states, and the body."""
    head, _, body = block.partition(b"\r\n\r\n")
    for x in head.split(b"\r\n"):
        name, _, value = x.partition(b":")
        if name.lower() == b"content-length":
            return int(value), body
    return len(body), body


def _prepared(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.unhex(F.sha2(html, 256)).alias("sha"), F.sha1(html).alias("sha1"), F.octet_length(html).cast("long").alias("n_bytes"))


def roles(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """What is archived whole, and what revisits it.

    Payloads are compared by SHA-256. Both frames: id, url, sha, n_bytes, html (null in revisits),
    first (the response's id and url; null in responses), copy. Equal rows are summed up before
    they are dealt out, and a payload meets itself as one row, so a group of copies of any size
    ends in no single task. Ties of the largest id go to the largest url (null is the smallest);
    of rows equal in all of these one is the response.
    """
    rows = _prepared(pages, id_col, url_col, html_col)
    place = F.struct("id", "url")
    large = rows.where(F.col("n_bytes") >= min_bytes)
    whole = large.groupBy("sha").agg(F.max(place).alias("w"), F.any_value("n_bytes").alias("n_bytes"), F.any_value("html").alias("html"))
    responses = whole.select("w.id", "w.url", "sha", "n_bytes", "html", F.lit(0).cast("long").alias("copy"))
    if min_bytes > 0:
        small = rows.where(F.col("n_bytes") < min_bytes).groupBy("id", "url", "sha", "n_bytes").agg(F.any_value("html").alias("html"), F.count("*").alias("times"))
        responses = responses.unionByName(small.select("id", "url", "sha", "n_bytes", "html", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy")))
    light = stage(large.groupBy("sha", "id", "url", "n_bytes", "sha1").agg(F.count("*").alias("times")), "warc-rows")
    first = light.groupBy("sha").agg(F.max(place).alias("first"), F.sum("times").alias("all")).where(F.col("all") > 1).drop("all")
    met = light.join(first.hint("merge"), "sha")
    left = F.col("times") - F.when(place.eqNullSafe(F.col("first")), 1).otherwise(0)
    revisits = met.withColumn("left", left).where(F.col("left") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "left")))
    return responses, revisits.select("id", "url", "sha", "n_bytes", "sha1", "first", "copy")


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", dictionary_bytes: int = DICTIONARY_BYTES, sample_bytes: int = SAMPLE_BYTES, level: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record for each page into archives under `folder`, one for each task; return their manifest.

    Of pages with equal payloads (html in UTF-8) of min_bytes or more, the one with the largest id
    is a response and the others are revisits of it; smaller ones are responses all. A revisit
    has the HTTP head alone, which states the length of the whole payload. Record ids follow from
    payload, id, url and copy, so a repeated task writes the same archive; it writes under a name
    of its own and renames at the end. Ids stand in an extension field (Source-Id), quoted.

    The dictionary is built on records that come first in an archive, up to `sample_bytes`;
    responses lie by the hash of their payload, so these are a sample of the archive. An
    archive of some kilobytes, too few to build one on, has none, as the format allows.

    Manifest: part, uri, records, bytes, dictionary_bytes; tasks without rows write no archive.
    Null html is empty, a null or empty url is written as about:blank, null ids have no id field.
    Extra columns are ignored. No rows: an empty manifest.
    """
    responses, revisits = roles(pages, min_bytes, id_col, url_col, html_col)
    text = F.col("id").cast("string")
    flat = responses.select(text.alias("id"), "url", "html", "sha", F.lit(None).cast("string").alias("sha1"), "n_bytes", "copy", F.lit(None).cast("struct<id:string,url:string>").alias("first"))
    again = revisits.select(text.alias("id"), "url", F.lit(None).cast("string").alias("html"), "sha", "sha1", "n_bytes", "copy", F.struct(F.col("first.id").cast("string").alias("id"), F.col("first.url").alias("url")).alias("first"))

    def task(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        part = context.partitionId()

        def records():
            for batch in slices(batches, text=2):
                columns = [c.to_pylist() for c in batch.columns]
                for id_, url, html, sha, sha1, n, copy, first in zip(*columns, strict=True):
                    whole = first is None
                    own = uuid.UUID(bytes=sha[:16], version=5) if whole and copy == 0 else uuid.uuid5(uuid.UUID(bytes=sha[:16]), f"{id_!r} {url!r} {copy}")
                    payload = html.encode() if whole else None
                    digest = hashlib.sha1(payload).digest() if whole else bytes.fromhex(sha1)
                    yield page_record(id_, url, digest, n, payload, None if whole else (first["id"], first["url"]), str(own), None if whole else str(uuid.UUID(bytes=sha[:16], version=5)), date)

        found = records()
        one = next(found, None)
        if one is None:
            return

        def all_of():
            yield one
            yield from found

        name = f"part-{part:07d}.warc.zst"
        info = record("warcinfo", str(uuid.uuid5(uuid.NAMESPACE_URL, f"{folder}/{name}")), date, [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        fs, path = pafs.FileSystem.from_uri(f"{folder}/{name}")
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        own = f"{path}.attempt-{context.taskAttemptId()}"
        with fs.open_output_stream(own, compression=None) as f:
            n, written, dictionary = write_archive(f, all_of(), info, dictionary_bytes, sample_bytes, level)
        fs.move(own, path)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "uri": [f"{folder}/{name}"], "records": pa.array([n], pa.int64()), "bytes": pa.array([written], pa.int64()), "dictionary_bytes": pa.array([dictionary], pa.int64())})

    return flat.unionByName(again).mapInArrow(task, MANIFEST)


def read_warc(manifest: DataFrame) -> DataFrame:
    """The records of archives named by `uri`, in a task for each: type, id, url, payload and where the frame lies.

    Digests are taken anew from payloads and blocks: a record that differs from what it states is
    an error, and so are archives cut short. refers_to is the id of the page that a revisit stands
    for; payload is null in revisits, payload_bytes and payload_digest are those of the whole.
    warcinfo records are passed over.
    """

    def task(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(uri)
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as f:
                    for at, taken, content in frames(f):
                        fields, block = parse(content)
                        if fields["warc-type"] == "warcinfo":
                            continue
                        rows.append((*_read(fields, block), uri, at, taken))
                        size += len(content)
                        if size >= 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    uris = manifest.select("uri")
    n = int(uris.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return uris.repartition(n, "uri").mapInArrow(task, RECORDS)


def _read(fields: dict[str, str], block: bytes) -> tuple:
    stated, body = _http(block)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-block-digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ArchiveError(f"{fields['warc-record-id']}: the block is not what its digest states")
    whole = fields["warc-type"] == "response"
    if whole and (len(body) != stated or base32(hashlib.sha1(body).digest()) != digest):
        raise ArchiveError(f"{fields['warc-record-id']}: the payload is not what its digest states")
    plain = lambda k: unquote(fields[k]) if k in fields else None
    url = fields["warc-target-uri"]
    return fields["warc-type"], plain("source-id"), None if url == "about:blank" else url, stated, digest, plain("refers-to-source-id"), body if whole else None, fields["warc-record-id"].strip("<>")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_record(uri: str, offset: int, frame_bytes: int) -> tuple[dict[str, str], bytes]:
    """One record from its place: the dictionary and this frame are all that is read."""
    import zstandard

    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        magic, size = struct.unpack("<II", f.read(8))
        dictionary = f.read(size) if magic == DICTIONARY_FRAME else b""
        f.seek(offset)
        frame = f.read(frame_bytes)
    context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
    return parse(context.decompress(frame))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = stage(write_warc(pages, new_path(spark, "warc")), "warc-manifest")
    kind = pages.schema["page_id"].dataType
    return read_warc(manifest).select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


OP11_SQL = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place FROM pages),
largest AS (SELECT html, max(page_id) AS page FROM page GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1(html), ((i // 4) * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN largest.page END AS refers_to
FROM page JOIN largest USING (html)
"""
