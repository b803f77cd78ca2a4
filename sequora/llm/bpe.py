"""Byte-level BPE by corpus-level merge replay.

The distinct words of a block of documents are laid end to end as one array of tokens. An
inverted index leads from a merge's rank to the positions where its pair stands. Merges are
applied in rank order, each to all positions of the corpus block at once, and only the pairs on
either side of a merged position are looked up anew.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.chunks import ChunkIds
from sequora.llm.common import gathered, slices, table, text_of
from sequora.llm.packing import pa_type

NONE = np.int32(2**31 - 1)  # the rank of a pair that doesn't merge


class Merges:
    """The ranks of a file of base64 tokens and ranks, and the pairs that make each token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a byte has no rank")
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = array("q"), array("i")
        for t, r in self.ranks.items():
            for k in range(1, len(t)):
                if (a := self.ranks.get(t[:k])) is not None and (b := self.ranks.get(t[k:])) is not None:
                    keys.append(a << 32 | b)
                    values.append(r)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order] if keys else np.array([-1])
        self.values = np.array(values, np.int32)[order] if keys else np.array([NONE])

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def one_word(self, word: bytes) -> list[int]:
        """Merge the leftmost pair of the lowest rank until none is left, by a heap of (rank, place)."""
        n = len(word)
        end, left = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a place
        rank_at = lambda i: self.ranks.get(word[i : end[end[i]]], NONE) if end[i] < n else NONE
        ranks = [rank_at(i) for i in range(n)]
        heap = [(r, i) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if ranks[i] != rank:  # the pair has changed, or its left part is gone
                continue
            gone = end[i]
            end[i], ranks[gone] = end[gone], NONE
            if end[i] < n:
                left[end[i]] = i
            for k in (left[i], i):
                if k >= 0:
                    ranks[k] = rank_at(k)
                    if ranks[k] != NONE:
                        heapq.heappush(heap, (ranks[k], k))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : end[i]]])
            i = end[i]
        return out

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        whole = [self.ranks.get(w) for w in words]
        open_words = [w for w, r in zip(words, whole, strict=True) if r is None]
        merged = iter(self._replay(open_words))
        return [next(merged) if r is None else r.to_bytes(4, "little") for r in whole]

    def _replay(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths)
        word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        token = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        right = np.arange(1, n + 1, dtype=np.int32)  # the next live position of the word, or -1
        left = np.arange(-1, n - 1, dtype=np.int32)
        nonempty = lengths > 0
        right[ends[nonempty] - 1] = -1
        left[(ends - lengths)[nonempty]] = -1
        rank = np.full(n, NONE, np.int32)  # of the pair that begins at a position
        inner = np.flatnonzero(right >= 0)
        rank[inner] = self.pair_ranks(token[inner], token[inner + 1])
        live = np.ones(n, bool)

        order = np.argsort(rank, kind="stable").astype(np.int32)
        order = order[: np.searchsorted(rank[order], NONE)]
        firsts, at = np.unique(rank[order], return_index=True)
        index: dict[int, list[np.ndarray]] = {r: [x] for r, x in zip(firsts.tolist(), np.split(order, at[1:]), strict=True)} if len(order) else {}
        queue = list(index)
        heapq.heapify(queue)
        out_of_order: set[int] = set()
        while queue:
            r = heapq.heappop(queue)
            lists = index.pop(r, None)
            if lists is None:
                continue
            pos = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            pos = pos[rank[pos] == r]
            if not len(pos):
                continue
            second = right[pos]
            if len(pos) > 1 and (rank[second] == r).any():  # pairs that overlap: the leftmost goes first
                keep, taken = [], -1
                for p, q in zip(pos.tolist(), second.tolist(), strict=True):
                    keep.append(p != taken)
                    taken = q if p != taken else -1
                pos, second = pos[keep], second[keep]
            after = right[second]
            token[pos], right[pos] = r, after
            has_after = after >= 0
            left[after[has_after]] = pos[has_after]
            live[second], rank[second] = False, NONE
            before = left[pos]
            changed = np.unique(np.concatenate([pos, before[before >= 0]]))
            follows = right[changed]
            fresh = np.full(len(changed), NONE, np.int32)
            some = follows >= 0
            fresh[some] = self.pair_ranks(token[changed[some]], token[follows[some]])
            rank[changed] = fresh
            some = fresh != NONE
            changed, fresh = changed[some], fresh[some]
            if not len(changed):
                continue
            early = fresh < r
            if early.any():  # such a word's next merge may come before this one's other places
                out_of_order.update(word_of[changed[early]].tolist())
            by = np.argsort(fresh, kind="stable")
            changed, fresh = changed[by], fresh[by]
            cut = np.flatnonzero(fresh[1:] != fresh[:-1]) + 1
            for k, x in zip(fresh[np.r_[0, cut]].tolist(), np.split(changed, cut), strict=True):
                if k in index:
                    index[k].append(x)
                else:
                    index[k] = [x]
                    heapq.heappush(queue, k)
        ids = token[live].astype("<u4").tobytes()
        stop = np.cumsum(np.bincount(word_of[live], minlength=len(words))) * 4
        out, at = [], 0
        for s in stop.tolist():
            out.append(ids[at:s])
            at = s
        for k in out_of_order:
            out[k] = np.array(self.one_word(words[k]), "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def _coder(path: str, pattern: str) -> tuple[Merges, ChunkIds]:
    merges, split = Merges(path), regex.compile(pattern)

    def many(chunks: list[str]) -> list[bytes]:
        pieces = [split.findall(c) for c in chunks]
        words = list({w for p in pieces for w in p})
        ids = dict(zip(words, merges.replay([w.encode("utf8") for w in words]), strict=True))
        return [b"".join([ids[w] for w in p]) for p in pieces]

    return merges, ChunkIds(many, keep=160_000)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """Ids of each text: id_col, n_tokens, ids (binary, little-endian unsigned 32 bit).

    `ranks` is a file of base64 tokens and ranks, `pattern` cuts texts into words, as the tiktoken
    library takes them; texts need the pattern's words to begin at spaces as sequora.llm.chunks
    says, which holds for public_tokenizers.PATTERN. Words are replayed together for blocks of
    about block_bytes of text. Each row is encoded by itself whatever else the table holds; null
    and empty texts have no ids; null and repeated id_col values are kept; extra columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = pa_type(rows)

    def task(batches):
        _, ids_of = _coder(ranks, pattern)
        for block in slices(gathered(batches, block_bytes), max_bytes=block_bytes):
            ids = ids_of(block.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([block.column(0).cast(id_type), pa.array([len(b) // 4 for b in ids], pa.int64()), pa.array(ids, pa.binary())], names=["id", "n_tokens", "ids"])

    return rows.mapInArrow(task, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """Adds `decoded`, the bytes that the ids of column `ids` stand for.

    Null ids give no bytes; an id that the file lacks is an error, as are ids cut within four bytes
    and a column `decoded` that is there already. Other columns and all rows are kept.
    """
    if "decoded" in encoded.columns:
        raise ValueError("there is a column decoded already")
    others = [c for c in encoded.columns if c != "ids"]
    schema = encoded.select(*others, "ids").withColumn("decoded", F.lit(b"")).schema

    def task(batches):
        tokens = _tokens(ranks)
        for b in slices(batches, len(others), 1 << 20):
            out = [b"".join([tokens[i] for i in np.frombuffer(x or b"", "<u4").tolist()]) for x in b.column(len(others)).to_pylist()]  # a KeyError names an id that there isn't
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])

    return encoded.select(*others, "ids").mapInArrow(task, schema)


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    with open(path, "rb") as f:
        return {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    coded = decode(encode(table(spark, sf_dir, "documents"), path, P.PATTERN), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
