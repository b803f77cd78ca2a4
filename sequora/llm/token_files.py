"""Token ids in Arrow files of fixed-size lists: equal-length sequences with masks, read without a copy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sequora.llm import hf
from sequora.llm.common import new_path, slices, stage, table, text_of
from sequora.llm.packing import default_tokenizer, pa_type

BATCH = 64  # sequences in a record batch


class SequenceWriter:
    """Lays a stream of ids into sequences of one length and writes them as Arrow record batches."""

    def __init__(self, sink, length: int, dtype: str):
        self.length, self.dtype = length, np.dtype(dtype)
        value = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(value, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(np.frombuffer(ids, self.dtype))
        self.held += len(self.waiting[-1])
        self.total += len(self.waiting[-1])
        if self.held >= self.length * BATCH:
            self._flush(self.held // (self.length * BATCH) * BATCH)

    def _flush(self, sequences: int) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype)
        take = min(len(flat), sequences * self.length)
        ids, mask = np.zeros(sequences * self.length, self.dtype), np.zeros(sequences * self.length, bool)
        ids[:take], mask[:take] = flat[:take], True
        for at in range(0, sequences, BATCH):
            part = slice(at * self.length, min(sequences, at + BATCH) * self.length)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[part]), self.length) for x in (ids, mask)]
            self.file.write_batch(pa.record_batch(columns, schema=self.schema))
        self.waiting, self.held = [flat[take:]], len(flat) - take

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length))
        self.file.close()


class SequenceFile:
    """Random access to the sequences of one file; ids are views of the mapped file where it is local."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(source)

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence k."""
        batch = self.file.get_batch(k // BATCH)
        return batch.column(0)[k % BATCH].values.to_numpy(zero_copy_only=True), batch.column(1)[k % BATCH].values

    def batches(self) -> Iterator[tuple[np.ndarray, int]]:
        """Ids of each batch in one flat view, and how many of them the mask marks as tokens."""
        for k in range(self.file.num_record_batches):
            batch = self.file.get_batch(k)
            yield batch.column(0).flatten().to_numpy(zero_copy_only=True), batch.column(1).flatten().true_count


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, length: int = 2048, end_id: int = 0, docs_per_file: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode documents in ascending id order into Arrow files under `folder`; return the manifest.

    One file for each range of ids: part-N.arrow has the ids (each document's, then end_id) laid
    end to end in sequences of `length`, with a mask that is false on the padding of the last one;
    part-N.index.arrow has id_col, start within the part and n_tokens of each document. Ids take 16
    bits where the vocabulary allows. A task writes to a name of its own and renames at the end, so
    a repeated task leaves the same files.

    Manifest: part, uri, documents, tokens. Null texts are empty; null ids come first, equal ids
    are ordered by their texts. Extra columns are ignored. No rows: one part without documents.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    parts = max(1, -(-docs.select(id_col).count() // docs_per_file))
    dtype = "<u2" if max(hf.vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else "<u4"
    id_type = pa_type(rows)

    def task(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        part, encode, end = context.partitionId(), hf.encoder(tokenizer, dtype), np.array([end_id], dtype).tobytes()
        uri = f"{folder}/part-{part:07d}"
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        own = f"{path}.attempt-{context.taskAttemptId()}"
        documents = 0
        index = pa.schema([(id_col, id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        with fs.open_output_stream(own) as f, fs.open_output_stream(f"{own}.index") as g, pa.ipc.new_file(g, index) as out:
            w = SequenceWriter(f, length, dtype)
            for batch in slices(batches):
                start, n = [], []
                for b in encode(batch.column(1).to_pylist()):
                    start.append(w.total)
                    w.add(b + end)
                    n.append(w.total - start[-1])
                documents += len(n)
                out.write_batch(pa.record_batch([batch.column(0).cast(id_type), pa.array(start, pa.int64()), pa.array(n, pa.int64())], schema=index))
            w.close()
        fs.move(own, f"{path}.arrow")
        fs.move(f"{own}.index", f"{path}.index.arrow")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "uri": [uri], "documents": pa.array([documents], pa.int64()), "tokens": pa.array([w.total], pa.int64())})

    ordered = rows.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    return ordered.mapInArrow(task, "part int, uri string, documents long, tokens long")


def read_token_files(manifest: DataFrame, id_type: str = "long", id_col: str = "doc_id") -> DataFrame:
    """Documents from the files of a manifest: id_col, start (tokens of all documents before), n_tokens, ids (binary, 32 bit)."""
    # one row for each file: a window over the manifest is small however many documents there are
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("before", before).select("part", "uri", "before")

    def task(batches):
        for batch in batches:
            for uri, before in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                index_fs, index_path = pafs.FileSystem.from_uri(f"{uri}.index.arrow")
                with index_fs.open_input_file(index_path) as f:
                    index = pa.ipc.open_file(f).read_all()
                stream = SequenceFile(f"{uri}.arrow").batches()
                held, at = np.zeros(0, "<u2"), 0  # ids not yet given out, and the place of the first
                for rows in index.to_batches(max_chunksize=500):
                    out = []
                    for start, n in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                        pieces = [held]
                        have = len(held) + at - start
                        while have < n:
                            ids, real = next(stream)
                            pieces.append(ids[:real])
                            have += real
                        flat = np.concatenate(pieces) if len(pieces) > 1 else held
                        flat = flat[start - at :]
                        out.append(flat[:n].astype("<u4").tobytes())
                        held, at = flat[n:], start + n
                    yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([before + x for x in rows.column(1).to_pylist()], pa.int64()), rows.column(2), pa.array(out, pa.binary())], names=[id_col, "start", "n_tokens", "ids"])

    parts = files.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return files.repartitionById(int(parts), (F.col("part") % int(parts)).cast("int")).mapInArrow(task, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = stage(write_token_files(docs, new_path(spark, "tokens"), default_tokenizer()), "tokens-manifest")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read_token_files(manifest, kind).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
