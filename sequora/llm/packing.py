"""Packing by power-of-two decomposition: pieces of binary lengths, each a sequence of its own."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm import hf
from sequora.llm.common import slices, table, text_of


def binary_lengths(n: int, max_len: int) -> list[int]:
    """Lengths, longest first, of the pieces of n tokens: as many of max_len as fit, then n's bits."""
    out = [max_len] * (n // max_len)
    rest = n % max_len
    out += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return out


def pack(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Split each document's ids (and end_id) into pieces whose lengths are powers of two up to max_len.

    Every piece is one sequence, so no sequence crosses documents, none needs padding, and a
    batch takes sequences of one `bucket` (the piece's length). At most log2(max_len) + 1 pieces
    fall short of max_len in a document, however long. The plan has no shuffle: a trainer reads
    one bucket at a time by a filter on `bucket`.

    Returns id_col, start, length, ids (binary, little-endian unsigned 32 bit), doc_tokens,
    sequence_id, offset, bucket. Null and empty texts give one piece with end_id alone. Null and
    repeated ids are kept, each row packed by itself. Extra columns are ignored. No rows: no rows.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = pa_type(rows)
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "bucket"]
    schema = f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, bucket int"

    def task(batches):
        from pyspark import TaskContext

        encode, end = hf.encoder(tokenizer, "<u4"), end_id.to_bytes(4, "little")
        seq = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            at, start, length, ids, total = [], [], [], [], []
            for k, b in enumerate(encode(batch.column(1).to_pylist())):
                b += end
                n, pos = len(b) // 4, 0
                for w in binary_lengths(n, max_len):
                    at.append(k)
                    start.append(pos)
                    length.append(w)
                    ids.append(b[4 * pos : 4 * (pos + w)])
                    total.append(n)
                    pos += w
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())).cast(id_type), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array(range(seq, seq + m), pa.int64()), pa.array([0] * m, pa.int64()), pa.array(length, pa.int32())],
                names=names,
            )
            seq += m

    return rows.mapInArrow(task, schema).withColumnRenamed("id", id_col)


def pa_type(rows: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[0].dataType)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents"), default_tokenizer()))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that is left, as op6_packing returns them."""
    return digest(pack(docs, default_tokenizer()))
