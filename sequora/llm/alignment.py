"""Which tokens of two tokenizers cover the same bytes, in each document and over the corpus.

A byte-level BPE of the tokenizers library (A) and a sentencepiece model (B) encode the same
text. Character offsets of A and the proto spans of B are coarse cuts; where tokens share a
character, or a character falls back to bytes, the cuts are refined by the tokens' own bytes.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.common import gathered, limit_threads, slices, stage, table, text_of

BLOCK_BYTES = 4 << 20
KEEP = 300_000  # distinct chunks that a worker remembers
_SPACE = "▁"
_AFTER_BLANK = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printing ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Aligns texts in one Python worker; each distinct chunk of text is aligned once while it is kept.

    A text (a space put before it) is cut between what is no white space and a space. There both
    tokenizers cut anyway: A's pattern starts a match at such a space, and no piece of B holds a
    space after another character (checked against the vocabulary; if one does, texts stay whole).
    So the tokens of a text are those of its chunks, and both have a token that ends where a chunk ends.
    """

    def __init__(self, tokenizer: str, model: str):
        limit_threads()
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        table_ = byte_level()
        names = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.bytes_a = [b""] * (names[-1][1] + 1)
        for name, k in names:
            self.bytes_a[k] = name.encode() if name in added else bytes(table_[c] for c in name)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.cuts = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for k, p in enumerate(pieces) if not (self.b.is_byte(k) or self.b.is_control(k) or self.b.is_unknown(k)))
        self.known: dict[str, int] = {}
        self.groups: list[bytes | None] = []  # None: the bytes of the tokens aren't those of the chunk
        self.counts = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups
        self.pairs: dict[int, int] = {}
        self.pair_codes: list[int] = []
        self.link_of = np.zeros(0, np.int64)  # pairs of all chunks, one after the other
        self.link_at = np.zeros(1, np.int64)

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut; each chunk without its first character, which is a space."""
        if not self.cuts:
            return [text]
        if _AFTER_BLANK.search(" " + text):
            return [x[1:] for x in _CUT.split(" " + text)]
        return text.split(" ")

    def learn(self, new: list[str]) -> None:
        """Align chunks that aren't known: many as one text, so that each library is called once for them."""
        found: list = [None] * len(new)
        # a chunk that ends in white space would grow together with the next one
        joined = [k for k, c in enumerate(new) if c and not c[-1].isspace() and _SPACE not in c] if self.cuts else []
        alone = set(range(len(new))).difference(joined)
        for at in range(0, len(joined), 1024):
            some = joined[at : at + 1024]
            out = self.align([new[k] for k in some])
            if out is None:
                alone.update(some)
            else:
                for k, x in zip(some, out, strict=True):
                    found[k] = x
        for k in alone:
            # B gives nothing for an empty input: a space at a text's end is aligned behind a word
            found[k] = (self.align([new[k]]) or [None])[0] if new[k] else (self.align(["a", ""]) or [None])[-1]
        base = len(self.groups)
        self.known.update((c, base + k) for k, c in enumerate(new))
        links = []
        for x in found:
            self.groups.append(x and x[0])
            links.append([self._pair(p) for p in x[3]] if x else [])
        self.counts = np.concatenate([self.counts, np.array([[x[1], x[2], len(x[3])] if x else [0, 0, 0] for x in found], np.int64).reshape(-1, 3)])
        self.link_of = np.concatenate([self.link_of, np.fromiter(chain.from_iterable(links), np.int64)])
        self.link_at = np.concatenate([self.link_at, self.link_at[-1] + np.cumsum([len(x) for x in links], dtype=np.int64)])

    def _pair(self, code: int) -> int:
        k = self.pairs.setdefault(code, len(self.pair_codes))
        if k == len(self.pair_codes):
            self.pair_codes.append(code)
        return k

    def forget(self, keep: int) -> None:
        """Keep the chunks that came first, which are mostly the frequent ones."""
        if len(self.groups) <= keep:
            return
        self.known = {c: k for c, k in self.known.items() if k < keep}
        del self.groups[keep:]
        self.counts, self.link_at = self.counts[:keep], self.link_at[: keep + 1]
        self.link_of = self.link_of[: self.link_at[-1]]

    def align(self, chunks: list[str]) -> list[tuple] | None:
        """(groups, tokens of A, tokens of B, pair codes) of each chunk; None if bytes or chunk ends don't fit."""
        text = " " + " ".join(chunks)
        raw = text.encode()
        e = self.a.encode(text, add_special_tokens=False)
        proto = self.b.encode(text[1:], return_type="proto").pieces
        ids_a, ids_b = e.ids, [p.id for p in proto]
        if b"".join([self.bytes_a[k] for k in ids_a]) != raw or b"".join([self.bytes_b[k] for k in ids_b]) != raw:
            return None
        at_char = np.concatenate([[0], np.cumsum(_widths(text))])
        span_a = at_char[np.array(e.offsets, np.int64).reshape(-1, 2)]
        # A: a token that shares a character with the next one doesn't end where its span ends
        whole_a = np.append(span_a[1:, 0] >= span_a[:-1, 1], True)
        end_a = refine(span_a[:, 1], whole_a, self.len_a[ids_a])
        # B: its own first space is no part of the text; all but the last byte of a character have empty spans
        end_b = np.array([p.end for p in proto], np.int64) + 1
        end_b = refine(end_b, np.diff(end_b, prepend=0) > 0, self.len_b[ids_b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        stop = np.cumsum([1 + len(c.encode()) for c in chunks])
        upto = np.searchsorted(cuts, stop)
        if upto[-1] != len(cuts) - 1 or not np.array_equal(cuts[upto], stop):
            return None
        to_a, to_b = np.searchsorted(end_a, cuts) + 1, np.searchsorted(end_b, cuts) + 1
        name_a, name_b = list(map(str, ids_a)), list(map(str, ids_b))
        names, a0, b0 = [], 0, 0
        for a1, b1 in zip(to_a.tolist(), to_b.tolist(), strict=True):
            names.append(f"{name_a[a0] if a1 - a0 == 1 else ','.join(name_a[a0:a1])}|{name_b[b0] if b1 - b0 == 1 else ','.join(name_b[b0:b1])}")
            a0, b0 = a1, b1
        codes = (np.array(ids_a, np.int64)[to_a - 1] << 32 | np.array(ids_b, np.int64)[to_b - 1]).tolist()
        out, g0, a0, b0 = [], 0, 0, 0
        for g1 in (upto + 1).tolist():
            a1, b1 = int(to_a[g1 - 1]), int(to_b[g1 - 1])
            out.append((";".join(names[g0:g1]).encode(), a1 - a0, b1 - b0, codes[g0:g1]))
            g0, a0, b0 = g1, a1, b1
        return out


def refine(coarse: np.ndarray, whole: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ends in bytes: the coarse ones where a token ends with its span and its bytes bear that out, else on from the last such end by the tokens' lengths."""
    total = np.cumsum(lengths)
    sure = whole & (coarse == total)
    last = np.maximum.accumulate(np.where(sure, np.arange(len(coarse)), -1))
    before = np.where(last >= 0, coarse[last], 0)
    done = np.where(last >= 0, total[last], 0)
    return before + total - done


def _widths(text: str) -> np.ndarray:
    """UTF-8 bytes of each character."""
    if text.isascii():
        return np.ones(len(text), np.int64)
    c = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)


@lru_cache(maxsize=2)
def aligner(tokenizer: str, model: str) -> Aligner:
    return Aligner(tokenizer, model)


def _ragged(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ragged rows, one after the other, and which of `rows` each belongs to."""
    n = at[rows + 1] - at[rows]
    owner = np.repeat(np.arange(len(rows)), n)
    first = np.repeat(at[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(rows) else np.zeros(0, np.int64)
    return first + np.arange(len(owner)), owner


def _block(al: Aligner, ids: pa.Array, texts: list[str | None], digest: bool, block: int) -> pa.RecordBatch:
    cut = [al.chunks(x) if x else [] for x in texts]
    if new := list(set(chain.from_iterable(cut)).difference(al.known)):
        al.learn(new)
    total = sum(map(len, cut))
    used = np.fromiter(map(al.known.__getitem__, chain.from_iterable(cut)), np.int64, total)
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in cut])
    bad = np.zeros(len(texts), bool)
    lacking = np.array([g is None for g in al.groups], bool)
    bad[doc[lacking[used]]] = True
    right = ~bad[doc]
    used_, doc_ = used[right], doc[right]
    sums = np.stack([np.bincount(doc_, al.counts[used_, c], len(texts)).astype(np.int64) for c in range(3)], 1)
    groups, at = [], 0
    for k, x in enumerate(cut):
        names = b"" if bad[k] else b";".join([al.groups[c] for c in used[at : at + len(x)].tolist()])
        groups.append((hashlib.sha256(names).hexdigest() if names else "") if digest else names.decode())
        at += len(x)
    places, owner = _ragged(al.link_at, used_)
    pairs, local = np.unique(al.link_of[places], return_inverse=True)
    key, times = np.unique(doc_[owner] * max(1, len(pairs)) + local, return_counts=True)
    of_doc, of_pair = np.divmod(key, max(1, len(pairs)))
    upto = np.searchsorted(of_doc, np.arange(len(texts) + 1))
    codes = np.array(al.pair_codes, np.int64)[pairs]
    binary = lambda x: [x[a:b].astype("<u4").tobytes() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
    docs = pa.StructArray.from_arrays([ids, *[pa.array(sums[:, c]) for c in range(3)], pa.array(groups, pa.string()), pa.array(binary(of_pair), pa.binary()), pa.array(binary(times), pa.binary())], names=["id", "n_a", "n_b", "n_groups", "groups", "pair", "times"])
    links = np.bincount(local, minlength=len(pairs)).astype(np.int64)
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), one(docs), one(pa.array(codes >> 32)), one(pa.array(codes & 0xFFFFFFFF)), one(pa.array(links))], names=["block", "docs", "a", "b", "links"])


def align(docs: DataFrame, tokenizer: str, model: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Align the tokens of a byte-level BPE file (A, of a space and the text) and of a sentencepiece model (B, which puts the space itself).

    Returns id_col, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum and `groups`: ids of A,
    "|", ids of B for each group, groups joined by ";" – with digest=True `groups_sha256`, the hex
    SHA-256 of that, in its place. Groups end where tokens of both end; the two tokens that end
    there are a link. Over all rows of docs a pair of ids has as many links as hold it; n_best
    counts links whose pair has most of those of its id of B, ties included; count_sum adds up
    the links of the pairs, once for each link.

    Documents are dealt with in blocks of some megabytes. A block keeps its documents' pairs as
    numbers into its own list of distinct pairs; only these lists meet the counts of the whole
    corpus, so that no table of pairs is broadcast and no link is shuffled by itself.

    Null and empty texts, and those whose tokens' bytes aren't those of the text (such as texts with
    U+2581), have zeros and ''. Null and repeated ids are kept, each row counts. Extra columns are
    ignored. No rows: no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def task(batches):
        from pyspark import TaskContext

        al, block = aligner(tokenizer, model), TaskContext.get().partitionId() << 32
        for batch in gathered(slices(batches, max_bytes=BLOCK_BYTES // 4), BLOCK_BYTES):
            yield _block(al, batch.column(0), batch.column(1).to_pylist(), digest, block)
            block += 1
            al.forget(KEEP)

    blocks = stage(rows.mapInArrow(task, f"block long, docs array<struct<id:{kind},n_a:long,n_b:long,n_groups:long,groups:string,pair:binary,times:binary>>, a array<long>, b array<long>, links array<long>"), "alignment")
    listed = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "links")).alias("at", "x")).select("block", "at", "x.a", "x.b", "x.links")
    counts = stage(pair_counts(listed), "alignment-pairs")
    met = listed.select("block", "at", "a", "b").join(counts, ["a", "b"])
    told = met.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "n", "best"))).alias("told"))
    joined = blocks.select("block", "docs").join(told.hint("merge"), "block", "left").select("docs", F.col("told.n").alias("n"), F.col("told.best").alias("best"))

    def finish(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                d = batch.column(0).slice(k, 1).flatten()
                n, best = (np.asarray(batch.column(c).slice(k, 1).flatten().to_numpy(zero_copy_only=False)) for c in (1, 2))
                part = {f.name: d.field(i) for i, f in enumerate(d.type)}
                most, total = [], []
                for p, t in zip(part["pair"].to_pylist(), part["times"].to_pylist(), strict=True):
                    p, t = np.frombuffer(p, "<u4"), np.frombuffer(t, "<u4").astype(np.int64)
                    most.append(int(t[best[p]].sum()) if len(p) else 0)
                    total.append(int((t * n[p]).sum()) if len(p) else 0)
                yield pa.RecordBatch.from_arrays([part["id"], part["n_a"], part["n_b"], part["n_groups"], part["n_groups"], pa.array(most, pa.int64()), pa.array(total, pa.int64()), part["groups"]], names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    out = joined.mapInArrow(finish, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    return out.withColumnsRenamed({"id": id_col} | ({"groups": "groups_sha256"} if digest else {}))


def pair_counts(listed: DataFrame) -> DataFrame:
    """Links of each pair of ids over the corpus (a, b, n), and whether no other pair of its b has more (best)."""
    counts = listed.groupBy("a", "b").agg(F.sum("links").alias("n"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
