"""Language-model scores: exact counts over the corpus, and log-bilinear models trained by noise contrast.

Texts are cut into tokens block by block. A block's table of distinct tokens goes by buckets of
tokens through one shuffle, in which counts are added up over all blocks, and the sums go back to
the block. Frequent words are classes of their own; all other words of the training texts are dealt to
classes, and the words of a class to groups. A token's probability is that of its class, times that of
its group in the class, times that of the word in its group, each by a log-bilinear model of the words
before. Each model learns from all training texts: for frequent words, how often each class comes
after each of them is added up over all blocks, which makes a table of bounded size, and one model is
trained on it; what the word before these adds is learned in every part of the blocks beside the others
and averaged. Tokens after any other word go to the bucket of that word, and words within classes are
told apart in their own bucket. Every word thus has a vector as context and one as target, and
parameters of words that aren't frequent grow with the vocabulary without ever being in one place.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.common import gathered, new_path, partitions, slices, stage, table, text_of

NEVER, END, START, FIRST_WORD = 0, 1, 2, 3  # NEVER: all words that no training text has
MOST_IDS = 1 << 16
AFTER = 3  # numbers of a token after a word that isn't frequent: text, that word's rank, class
WITHIN = 3  # of a word that isn't frequent: text, rank, a hash of the word before
BESIDE = 4  # of a token after a frequent word, a new one or none: text, class before, class before that, class
SLICES = 16  # frequent words are dealt to so many tasks when counts are added up
SUM = np.dtype([("text", "<i4"), ("score", "<f4")])


def tokens(text: str) -> list[bytes]:
    """Words of a text in UTF-8: runs of bytes other than space, tab, LF, VT, FF, CR; A-Z in lower case."""
    return text.encode("utf8").lower().split()


def packed(columns) -> bytes:
    """Columns of one length with numbers from 0 to 2^24 - 1, the first in ascending order and without that bound: byte by byte, compressed."""
    first = np.diff(columns[0], prepend=0)
    steps = np.minimum(first, 255).astype(np.uint8)
    far = np.flatnonzero(first >= 255)
    planes = [steps, *((np.asarray(c) >> 8 * k).astype(np.uint8) for c in columns[1:] for k in range(3))]
    tail = np.r_[far, first[far]].astype("<i8").tobytes()
    data = b"".join([*(x.tobytes() for x in planes), tail])
    return len(steps).to_bytes(8, "little") + len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    n, size = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
    flat = np.frombuffer(pa.decompress(data[16:], size, "zstd", asbytes=True), np.uint8)
    planes = flat[: n * (3 * columns - 2)].reshape(-1, n).astype(np.int32)
    far = flat[planes.size :].view("<i8").reshape(2, -1)
    first = planes[0].astype(np.int64)
    first[far[0]] = far[1]
    return [np.cumsum(first), *(planes[k] | planes[k + 1] << 8 | planes[k + 2] << 16 for k in range(1, 3 * columns - 2, 3))]


def pressed(ids: np.ndarray) -> bytes:
    """Numbers of 32 bits, byte by byte, compressed."""
    data = ids.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True) if data else b""


def unpressed(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int32)
    planes = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4")[:, 0]


class Numbered(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        return n


@dataclass
class Counts:
    """Training totals: tokens, distinct tokens, texts (each ends with one end token), frequent words and classes."""

    n: int
    v: int
    ends: int
    words: dict[bytes, int]
    top: np.ndarray  # counts of the classes; for NEVER, of words that occur once
    own: np.ndarray  # frequent words in each bucket: the first of its ranks
    per: int  # classes of a bucket

    @property
    def first_class(self) -> int:
        return FIRST_WORD + len(self.words)

    def split(self, bucket: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and place in their bucket of words that aren't frequent, by their rank in it."""
        k = rank - self.own[bucket]
        return self.first_class + bucket * self.per + k % self.per, k


def _blocks(docs: DataFrame, held_out: Column, id_col: str, text_col: str, buckets: int, block_bytes: int) -> DataFrame:
    """Texts as ids of their block's own table of tokens, and that table cut into buckets.

    kind 0: id, held_out, a: ids of the text's words. kind 1: bucket, a: its tokens, one
    a line, b: their counts in the block's training texts. The table lists bucket after bucket, so
    the ids of a block follow from its buckets in order. All rows of a block come from one task and are
    written once.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    kind = rows.schema["id"].dataType.simpleString()

    def task(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for b in slices(gathered(batches, block_bytes), max_bytes=block_bytes):
            number = Numbered()
            coded = []
            for text in b.column(1).to_pylist():
                words = tokens(text)
                coded.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            names = list(number)
            bucket = np.array([zlib.crc32(w) % buckets for w in names], np.int64)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(names), np.int32)
            place[order] = np.arange(len(names), dtype=np.int32)
            held = b.column(2).to_pylist()
            coded = [place[c] for c in coded]
            train = [c for c, h in zip(coded, held, strict=True) if not h]
            count = np.bincount(np.concatenate(train), minlength=len(names)) if train else np.zeros(len(names), np.int64)
            n = len(coded)
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array([block] * n, pa.int64()), pa.array([None] * n, pa.int32()), b.column(0), b.column(2), pa.array([pressed(c) for c in coded], pa.binary()), pa.array([None] * n, pa.binary())], names=names_)
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            parts = [(k, s, e) for k, (s, e) in enumerate(zip(cut.tolist(), cut[1:].tolist())) if e > s]
            m = len(parts)
            a = [b"\n".join([names[i] for i in order[s:e].tolist()]) for _, s, e in parts]
            yield pa.RecordBatch.from_arrays([pa.array([1] * m, pa.int32()), pa.array([block] * m, pa.int64()), pa.array([k for k, _, _ in parts], pa.int32()), pa.nulls(m, b.column(0).type), pa.nulls(m, pa.bool_()), pa.array(a, pa.binary()), pa.array([count[s:e].astype("<i8").tobytes() for _, s, e in parts], pa.binary())], names=names_)
            block += 1

    names_ = ["kind", "block", "bucket", "id", "held_out", "a", "b"]
    schema = f"kind int, block long, bucket int, id {kind}, held_out boolean, a binary, b binary"
    made, path = rows.mapInArrow(task, schema), new_path(docs.sparkSession, "token-blocks")
    made.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def _add_up(rows: DataFrame, words: int) -> DataFrame:
    """Corpus counts of every block's tokens and their ranks (kind 2), totals and counts by rank of a bucket (kind 3), frequent words (kind 4).

    A bucket ranks the words of training texts by falling count; words of none have rank -1.
    """

    def merge(t):
        total: dict[bytes, int] = {}
        lines = [(block, x.split(b"\n"), np.frombuffer(c, "<i8")) for block, x, c in zip(t["block"].to_pylist(), t["a"].to_pylist(), t["b"].to_pylist(), strict=True)]
        for _, names, count in lines:
            for w, c in zip(names, count.tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        bucket = t["bucket"][0].as_py()
        ranked = sorted((-c, w) for w, c in total.items() if c)
        rank = dict.fromkeys(total, -1) | {w: k for k, (_, w) in enumerate(ranked)}
        out = [(2, block, np.fromiter(map(total.__getitem__, names), "<i8", len(names)).tobytes() + np.fromiter(map(rank.__getitem__, names), "<i4", len(names)).tobytes(), 0, 0) for block, names, _ in lines]
        out.append((3, -1, np.array([-c for c, _ in ranked], "<i8").tobytes(), sum(total.values()), len(ranked)))
        out += [(4, -1, w, -c, 0) for c, w in ranked[:words]]
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        columns = [pa.array([x[k] for x in out], kinds[k]) for k in range(5)]
        return pa.Table.from_arrays([*columns, pa.array([bucket] * len(out), pa.int32())], names=["kind", "block", "a", "n", "v", "bucket"])

    return rows.where("kind = 1").select("block", "bucket", "a", "b").groupBy("bucket").applyInArrow(merge, "kind int, block long, a binary, n long, v long, bucket int")


def narrow(index: np.ndarray, n: int) -> np.ndarray:
    """Indices below n in 16 bits if these hold them: numpy sorts such numbers by digits."""
    return index.astype(np.uint16 if n <= 1 << 16 else np.int64)


def sums_by_row(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sums of the values at each; values have an even number of float32 columns."""
    order = np.argsort(index, kind="stable")
    ordered = index[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    # two columns are added at a time
    sums = np.add.reduceat(values.take(order, 0).view(np.complex64), first).view(np.float32)
    return ordered[first].astype(np.int64), sums


def log_shares(hat: np.ndarray, q: np.ndarray, b: np.ndarray, which: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log10 of the share of exp(hat . q + b) that target has in row `which` of hat; b is at most 0."""
    logits = hat @ q.T
    logits += b
    chosen = logits[which, target]
    # no product beyond 60: neither does exp overflow, nor can a whole row vanish
    if np.einsum("ij,ij->i", hat, hat).max() * np.einsum("ij,ij->i", q, q).max() >= 3600:
        top = logits.max(1)
        chosen -= top[which]
        logits -= top[:, None]
    np.exp(logits, out=logits)
    return (chosen - np.log(logits.sum(1))[which]) / np.log(10)


class LogBilinear:
    """Scores a target by the inner product of its vector with the sum of the context words' vectors, one for each place.

    Targets begin with random vectors and the logarithm of their shares as bias, contexts with zero:
    what has never been seen as context predicts the shares. The first `unseen` targets never occur
    in training: they keep their bias.
    """

    def __init__(self, counts: np.ndarray, contexts: tuple[int, ...], dims: int, unseen: int = 0, seed: int = 7):
        rng, n, dims = np.random.default_rng(seed), len(counts), dims + dims % 2
        share = np.maximum(counts, 1e-9) / max(1e-9, counts.sum())
        self.b = np.log(share).astype(np.float32)
        noise = np.r_[np.zeros(unseen), share[unseen:]]
        self.noise = noise / noise.sum()
        self.q = (rng.standard_normal((n, dims)) * (2 / dims**0.5)).astype(np.float32)
        self.q[:unseen] = 0
        self.r = [np.zeros((m, dims), np.float32) for m in contexts]
        self.squares = {"q": np.full(n, 1.0, np.float32), **{j: np.full(m, 1e-3, np.float32) for j, m in enumerate(contexts)}}

    def train(self, context: list[np.ndarray], target: np.ndarray, batch: int = 2048, noise: int = 24, rate: float = 2.0, slow: float = 0.2, seed: int = 11, only: int | None = None) -> None:
        """One pass of noise-contrastive estimation; every batch shares its noise, every vector has its own Adagrad rate. With `only`, the vectors of that place alone are moved."""
        rng, edges = np.random.default_rng(seed), np.cumsum(self.noise)
        edges[-1] = 2.0
        last = int(np.flatnonzero(self.noise)[-1])
        order = rng.permutation(len(target))
        context, target = [narrow(x, len(self.r[j])) for j, x in enumerate(context)], narrow(target, len(self.q))
        bias = self.b - np.log(noise * np.maximum(self.noise, 1e-30)).astype(np.float32)
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            c, t = [x[pick] for x in context], target[pick]
            drawn = np.minimum(np.searchsorted(edges, rng.random(noise), side="right"), last)
            hat, q, fakes = self.predict(c), self.q.take(t, 0), self.q.take(drawn, 0)
            real = np.einsum("ij,ij->i", hat, q) + bias[t]
            fake = hat @ fakes.T + bias[drawn]
            g_real = 1 / (1 + np.exp(np.clip(real, -30, 30)))  # 1 - sigmoid
            g_fake = -1 / (1 + np.exp(-np.clip(fake, -30, 30)))
            g_hat = g_real[:, None] * q + g_fake @ fakes
            if only is None:
                self._move(self.q, "q", np.concatenate([t, drawn.astype(t.dtype)]), np.concatenate([g_real[:, None] * hat, g_fake.T @ hat]), slow)
            for j, x in enumerate(c):
                if only in (None, j):
                    self._move(self.r[j], j, x, g_hat, rate)

    def train_counts(self, table: np.ndarray, rounds: int = 60, noise: int = 24, rate: float = 1.0, slow: float = 0.2, rows: int = 128, seed: int = 11) -> None:
        """Noise-contrastive estimation from how often each target comes after each context: all of them, in every round, against the expected noise."""
        rng, often = np.random.default_rng(seed), table.sum(1)
        some = np.flatnonzero(often)
        bias = self.b - np.log(noise * np.maximum(self.noise, 1e-30)).astype(np.float32)
        squares = {k: np.zeros(len(x), np.float32) for k, x in (("q", self.q), ("r", self.r[0]))}

        def step(name, vectors, at, g, size):
            squares[name][at] += np.einsum("ij,ij->i", g, g)
            vectors[at] += g * (size / np.sqrt(np.maximum(squares[name][at], 1e-20)))[:, None]

        for _ in range(rounds):
            order = rng.permutation(some)
            for at in range(0, len(order), rows):
                c = order[at : at + rows]
                hat = self.r[0][c]
                s = hat @ self.q.T
                s += bias
                share = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
                real = table[c].astype(np.float32)
                g = real - share * (real + (noise * often[c])[:, None].astype(np.float32) * self.noise.astype(np.float32))
                step("q", self.q, slice(None), g.T @ hat, slow)
                step("r", self.r[0], c, g @ self.q, rate)

    def _move(self, vectors, name, index, gradient, rate) -> None:
        rows, g = sums_by_row(index, gradient)
        squares = self.squares[name]
        total = squares[rows] + np.einsum("ij,ij->i", g, g)
        squares[rows] = total
        g *= (rate / np.sqrt(total))[:, None]
        g += vectors.take(rows, 0)
        vectors[rows] = g

    def predict(self, context: list[np.ndarray]) -> np.ndarray:
        hat = self.r[0].take(context[0], 0)
        for r, x in zip(self.r[1:], context[1:], strict=True):
            hat += r.take(x, 0)
        return hat

    def log10(self, context: list[np.ndarray], target: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities: one product with all targets for each distinct context."""
        key = context[0].astype(np.int64)
        for j in range(1, len(context)):
            key = key * len(self.r[j]) + context[j]
        order = np.arange(len(key))
        for j in range(len(context) - 1, -1, -1):
            order = order[np.argsort(narrow(context[j], len(self.r[j]))[order], kind="stable")]
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        stop, out = np.r_[first[1:], len(key)], np.empty(len(key), np.float64)
        step = max(1, (1 << 17) // len(self.b))  # what stays in a core's cache
        for at in range(0, len(first), step):
            one = order[first[at : at + step]]
            rows = order[first[at] : stop[min(len(first), at + step) - 1]]
            which = np.repeat(np.arange(len(one)), stop[at : at + step] - first[at : at + step])
            out[rows] = log_shares(self.predict([x[one] for x in context]), self.q, self.b, which, target[rows])
        return out


class Within:
    """Words of one class: the probability of a word's group, times that of the word in its group."""

    def __init__(self, counts: np.ndarray, contexts: int, dims: int):
        self.groups = max(1, round(len(counts) ** 0.5))
        self.of = np.arange(len(counts)) % self.groups
        self.words = LogBilinear(counts, (contexts,), dims)
        self.group = LogBilinear(np.bincount(self.of, counts, self.groups), (contexts,), dims)

    def train(self, before: np.ndarray, word: np.ndarray) -> None:
        self.words.train([before], word)
        self.group.train([before], self.of[word], batch=4096)

    def log10(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = self.group.log10([before], self.of[word])
        order = np.argsort(narrow(self.of[word], self.groups), kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(self.of[word][order])) + 1):
            if len(part):
                g = self.of[word[part[0]]]
                q, b = np.ascontiguousarray(self.words.q[g :: self.groups]), self.words.b[g :: self.groups]
                for at in range(0, len(part), 1024):
                    rows = part[at : at + 1024]
                    out[rows] += log_shares(self.words.predict([before[rows]]), q, b, np.arange(len(rows)), word[rows] // self.groups)
        return out


def _totals(summed: DataFrame, blocks: DataFrame, words: int, buckets: int) -> Counts:
    n, v = summed.where("kind = 3").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    ends = blocks.where("kind = 0 AND NOT held_out").count()
    # `words` rows at most
    best = summed.where("kind = 4").orderBy(F.desc("n"), "a").limit(words).select("a", "n").collect()
    names = {bytes(r["a"]): k + FIRST_WORD for k, r in enumerate(best)}
    own = np.bincount([zlib.crc32(w) % buckets for w in names], minlength=buckets)
    per = max(1, min(round((v - len(names)) ** 0.5 / 4 / buckets), (MOST_IDS - FIRST_WORD - len(names)) // buckets))
    top = np.zeros(FIRST_WORD + len(names) + buckets * per, np.int64)
    top[END], top[FIRST_WORD : FIRST_WORD + len(names)] = ends, [r["n"] for r in best]
    counts = Counts(n + ends, v + (ends > 0), ends, names, top, own, per)

    def classes(batches):
        for b in batches:
            kept = [(k, np.frombuffer(a, "<i8")) for k, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            sums = [np.r_[np.bincount(np.arange(len(c) - own[k]) % per, c[own[k] :], per), (c == 1).sum()] for k, c in kept]
            yield pa.RecordBatch.from_pydict({"bucket": b.column(0), "a": pa.array([x.astype("<i8").tobytes() for x in sums], pa.binary())})

    # one row for each bucket, with the counts of its classes: MOST_IDS numbers at most
    for r in summed.where("kind = 3").select("bucket", "a").mapInArrow(classes, "bucket int, a binary").collect():
        at, sums = counts.first_class + r["bucket"] * per, np.frombuffer(r["a"], "<i8")
        top[at : at + per] = sums[:per]
        top[NEVER] += sums[per]  # a word is as likely to be new as words that occurred once were
    return counts


def _of_classes(counts: Counts, contexts: tuple[int, ...], dims: int) -> LogBilinear:
    """A model of classes by the words before."""
    top = np.maximum(counts.top, 1e-3)
    top[START] = 1e-12
    model = LogBilinear(top, contexts, dims)
    for k in (NEVER, START):
        model.noise[k], model.q[k] = 0, 0
    model.noise /= model.noise.sum()
    return model


def _by_text(text: np.ndarray, score: np.ndarray) -> bytes:
    no, inverse = np.unique(text, return_inverse=True)
    row = np.empty(len(no), SUM)
    row["text"], row["score"] = no, np.bincount(inverse, score)
    return row.tobytes()


def _coded(blocks: DataFrame, summed: DataFrame, counts: Counts) -> DataFrame:
    """Each text with its base score (kind 0), a block's tokens after frequent words (kind 3), and by bucket the other tokens (kind 1) and words within classes (kind 2)."""
    kind = blocks.schema["id"].dataType.simpleString()

    def places(batches):
        """Where a bucket's table has frequent words."""
        for b in batches:
            found = [[(k, counts.words[w]) for k, w in enumerate(x.split(b"\n")) if w in counts.words] for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([np.array(f, "<i4").tobytes() for f in found], pa.binary())], names=["block", "bucket", "a"])

    known = blocks.where("kind = 1").select("block", "bucket", "a").mapInArrow(places, "block long, bucket int, a binary")
    part = lambda df, k, *cols: df.select("block", F.lit(k).alias("kind"), *[c if c in cols else F.lit(None).cast(t).alias(c) for c, t in (("bucket", "int"), ("id", kind), ("held_out", "boolean"), ("a", "binary"))])
    together = part(blocks.where("kind = 0"), 0, "id", "held_out", "a").unionByName(part(known, 1, "bucket", "a")).unionByName(part(summed.where("kind = 2"), 2, "bucket", "a"))
    scale = counts.n + counts.v + 1

    def describe(t):
        t = t.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        what, data, bucket = t["kind"].to_numpy(), t["a"].to_pylist(), t["bucket"].to_pylist()
        texts, marks, sums = (np.flatnonzero(what == k).tolist() for k in range(3))
        of_bucket = {bucket[k]: np.frombuffer(data[k], "<i4").reshape(-1, 2) for k in marks}
        total, to_class, to_place, to_bucket = ([np.zeros(0, d)] for d in (np.int64, np.uint16, np.int32, np.int32))
        for k in sums:
            m = len(data[k]) // 12
            rank = np.frombuffer(data[k], "<i4", m, 8 * m)
            ids, place = counts.split(bucket[k], rank)
            own = of_bucket[bucket[k]]
            place = np.where(rank < 0, -1, place)
            ids = np.where(rank < 0, NEVER, ids)
            ids[own[:, 0]], place[own[:, 0]] = own[:, 1], -1
            for column, x in ((total, np.frombuffer(data[k], "<i8", m)), (to_class, ids.astype(np.uint16)), (to_place, place.astype(np.int32)), (to_bucket, np.full(m, bucket[k], np.int32))):
                column.append(x)
        total, to_class, to_place, to_bucket = map(np.concatenate, (total, to_class, to_place, to_bucket))
        base = np.r_[np.log10((total + 1) / scale), np.log10((counts.ends + 1) / scale)]
        # the end as a token of its own
        total, to_class, to_place, to_bucket = np.r_[total, counts.ends], np.r_[to_class, np.uint16(END)], np.r_[to_place, np.int32(-1)], np.r_[to_bucket, np.int32(-1)]
        coded = [unpressed(data[k]) for k in texts]
        length = np.array([len(x) + 1 for x in coded], np.int64)
        ids = np.concatenate([y for x in coded for y in (x, [len(total) - 1])]) if coded else np.zeros(0, np.int64)
        begin = np.cumsum(length) - length
        held = np.array([t["held_out"][k].as_py() for k in texts], bool)
        text = np.repeat(np.arange(len(coded), dtype=np.int32), length)
        before = np.r_[0, ids[:-1]]
        starts = np.zeros(len(ids), bool)
        starts[begin] = True
        cls = to_class[ids]
        first = np.where(starts, START, to_class[before]).astype(np.uint16)
        second = np.r_[START, first[:-1]].astype(np.uint16) if len(ids) else first
        second[starts] = START
        rare = ~starts & (to_place[before] >= 0)  # after a word that isn't frequent
        stay = np.flatnonzero(~rare)
        per_text = lambda x: np.bincount(text, x, len(coded))
        known, base_sum = per_text(total[ids] > 0), per_text(base[ids])
        block, out = t["block"][0].as_py(), []
        for no, k in enumerate(texts):
            out.append((0, block, no, None, int(length[no]), int(known[no]), float(base_sum[no]), None))
        mark = text * 2 + held[text]
        out.append((3, block, None, None, None, None, None, packed((mark[stay], first[stay], second[stay], cls[stay]))))
        inner = np.flatnonzero(to_place[ids] >= 0)
        # which word is before, by 24 bits: words of one class after it share what they learn if these are equal
        beside = np.where(rare, (to_bucket[before] * np.int32(-1640531527) + to_place[before] * np.int32(-2048144789)) & 0xFFFFFF, first.astype(np.int32))
        for k, rows, where, columns in (
            (1, np.flatnonzero(rare), to_bucket[before], lambda x: (mark[x], to_place[before[x]], cls[x])),
            (2, inner, to_bucket[ids], lambda x: (mark[x], to_place[ids[x]], beside[x])),
        ):
            order = rows[np.argsort(narrow(where[rows], len(counts.own)), kind="stable")]
            cut = np.flatnonzero(np.diff(where[order])) + 1
            out += [(k, block, None, int(where[x[0]]), None, None, None, packed(columns(x))) for x in np.split(order, cut) if len(x)]
        pick = pa.array([*texts, *[None] * (len(out) - len(texts))], pa.int64())
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary())
        return pa.Table.from_arrays([t["id"].take(pick), t["held_out"].take(pick), *[pa.array([x[k] for x in out], kinds[k]) for k in range(8)]], names=["id", "held_out", "kind", "block", "no", "bucket", "n_tokens", "n_known", "base_score", "a"])

    made = together.groupBy("block").applyInArrow(describe, f"id {kind}, held_out boolean, kind int, block long, no int, bucket int, n_tokens long, n_known long, base_score double, a binary")
    path = new_path(blocks.sparkSession, "texts-coded")
    made.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    return blocks.sparkSession.read.schema(made.schema).parquet(path)


def _pieces(t: pa.Table, numbers: int) -> tuple[list[int], list[int], list[np.ndarray]]:
    """Blocks in order, the length of each one's tokens, and the columns of all."""
    rows = sorted(zip(t["block"].to_pylist(), t["a"].to_pylist(), strict=True))
    columns = [unpacked(a, numbers) for _, a in rows]
    return [k for k, _ in rows], [len(c[0]) for c in columns], [np.concatenate(x) for x in zip(*columns, strict=True)]


def _sums(blocks: list[int], lengths: list[int], mark: np.ndarray, score: np.ndarray) -> pa.Table:
    cut = np.cumsum(lengths)[:-1]
    return pa.table({"block": pa.array(blocks, pa.int64()), "a": pa.array([_by_text(m >> 1, s) for m, s in zip(np.split(mark, cut), np.split(score, cut), strict=True)], pa.binary())})


def _beside(coded: DataFrame, counts: Counts, dims: int) -> LogBilinear:
    """The model of classes after frequent words, one for all training texts.

    What comes after each frequent word is counted over all blocks, and targets and the first place
    learn from these counts. The second place then learns from the tokens, in every partition of
    blocks beside the others, and its vectors are averaged, each by how often its class was there.
    """
    n, m = len(counts.top), counts.first_class
    tokens_of = coded.where("kind = 3").select("a")
    row = lambda part, a, b: pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["part", "a", "b"])
    schema = "part int, a binary, b binary"

    def trained(batches):
        """The training tokens of each block: class before, class before that, class."""
        for x in (x for b in batches for x in b.column(0).to_pylist()):
            mark, first, second, cls = unpacked(x, BESIDE)
            train = mark & 1 == 0
            yield first[train], second[train], cls[train].astype(np.int64)

    def sums(keys, much):
        keys, inverse = np.unique(keys, return_inverse=True)
        return keys, np.bincount(inverse, much, len(keys)).astype(np.int64)

    def count(batches):
        keys, much = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for first, _, cls in trained(batches):
            k, c = np.unique(first.astype(np.int64) * n + cls, return_counts=True)
            keys, much = sums(np.r_[keys, k], np.r_[much, c])
        of = keys // n % SLICES
        for part in np.unique(of).tolist():
            yield row([part], [keys[of == part].tobytes()], [much[of == part].tobytes()])

    def joined(t):
        return [np.concatenate([np.frombuffer(x, np.int64) for x in t[c].to_pylist()]) for c in ("a", "b")]

    def add_up(t):
        keys, much = sums(*joined(t))
        return pa.Table.from_batches([row([0], [keys.tobytes()], [much.tobytes()])])

    def learn(t):
        keys, much = joined(t)
        table = np.zeros(m * n, np.float32)
        table[keys] = much
        model = _of_classes(counts, (m,), dims)
        model.train_counts(table.reshape(m, n))
        return pa.Table.from_batches([row([0], [model.q.tobytes()], [model.r[0].tobytes()])])

    found = tokens_of.mapInArrow(count, schema).groupBy("part").applyInArrow(add_up, schema).groupBy("part").applyInArrow(learn, schema).collect()
    model = _of_classes(counts, (m, n), dims)
    for r in found:  # one row, or none without training texts
        model.q, model.r[0] = (np.frombuffer(r[c], np.float32).reshape(-1, model.q.shape[1]).copy() for c in ("a", "b"))

    def learn_second(batches):
        much = np.zeros(n, np.int64)
        for first, second, cls in trained(batches):
            model.train([first, second], cls, only=1)
            much += np.bincount(second, minlength=n)
        if much.any():
            parts = np.array_split(np.arange(n), min(SLICES, n))
            yield row(list(range(len(parts))), [(model.r[1][k] * much[k][:, None]).astype(np.float32).tobytes() for k in parts], [much[k].tobytes() for k in parts])

    def average(t):
        much = np.sum([np.frombuffer(x, np.int64) for x in t["b"].to_pylist()], 0)
        total = np.sum([np.frombuffer(x, np.float32) for x in t["a"].to_pylist()], 0, np.float64).reshape(len(much), -1)
        return pa.Table.from_batches([row([t["part"][0].as_py()], [(total / np.maximum(much, 1)[:, None]).astype(np.float32).tobytes()], [b""])])

    # a vector for each class: MOST_IDS at most
    found = tokens_of.mapInArrow(learn_second, schema).groupBy("part").applyInArrow(average, schema).collect()
    if found:
        model.r[1] = np.concatenate([np.frombuffer(r["a"], np.float32) for r in sorted(found, key=lambda r: r["part"])]).reshape(n, -1).copy()
    return model


def _stayed(coded: DataFrame, model: LogBilinear) -> DataFrame:
    """What the classes of tokens after frequent words add to the texts' scores."""

    def task(batches):
        for b in batches:
            for block, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                mark, first, second, cls = unpacked(a, BESIDE)
                yield _sums([block], [len(mark)], mark, model.log10([first, second], cls.astype(np.int64))).to_batches()[0]

    return coded.where("kind = 3").select("block", "a").mapInArrow(task, "block long, a binary")


def _after(coded: DataFrame, counts: Counts, q: np.ndarray) -> DataFrame:
    """What the classes of tokens after words that aren't frequent add to the texts' scores; tokens go to the bucket of the word before.

    Vectors of classes begin with `q`, those that were learned after frequent words.
    """

    def task(t):
        blocks, lengths, (mark, word, cls) = _pieces(t, AFTER)
        held, cls = mark & 1 > 0, cls.astype(np.int64)
        distinct, word = np.unique(word, return_inverse=True)
        model = _of_classes(counts, (len(distinct),), q.shape[1])
        model.q[:] = q
        model.train([word[~held]], cls[~held])
        return _sums(blocks, lengths, mark, model.log10([word], cls))

    return coded.where("kind = 1").select("block", "bucket", "a").groupBy("bucket").applyInArrow(task, "block long, a binary")


def _within(coded: DataFrame, summed: DataFrame, counts: Counts, dims: int) -> DataFrame:
    """What the words within classes add to the texts' scores; tokens go to their own bucket."""

    def task(t):
        bucket = t["bucket"][0].as_py()
        ranked = t.filter(pc.less(t["block"], 0))["a"].to_pylist()
        t = t.filter(pc.greater_equal(t["block"], 0))
        if not len(t):
            return pa.table({"block": pa.array([], pa.int64()), "a": pa.array([], pa.binary())})
        ranked = np.frombuffer(ranked[0], "<i8")[counts.own[bucket] :]
        blocks, lengths, (mark, place, before) = _pieces(t, WITHIN)
        held, score = mark & 1 > 0, np.zeros(len(mark))
        order = np.argsort(narrow(place % counts.per, counts.per), kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(place[order] % counts.per)) + 1):
            c = place[part[0]] % counts.per
            seen = np.unique(before[part][~held[part]])  # other words say nothing here: the last place stays zero
            at = np.minimum(np.searchsorted(seen, before[part]), max(0, len(seen) - 1))
            context = np.where(seen[at] == before[part], at, len(seen)) if len(seen) else np.zeros(len(part), np.int64)
            model, word = Within(ranked[c :: counts.per].astype(np.float64), len(seen) + 1, dims), place[part] // counts.per
            model.train(context[~held[part]], word[~held[part]])
            score[part] = model.log10(context, word)
        return _sums(blocks, lengths, mark, score)

    tokens_of = coded.where("kind = 2").select("block", "bucket", "a")
    return tokens_of.unionByName(summed.where("kind = 3").select("block", "bucket", "a")).groupBy("bucket").applyInArrow(task, "block long, a binary")


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", words: int = 509, dims: int = 32, block_bytes: int = 16 << 20, bucket_bytes: int = 128 << 20) -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every text.

    Counts cover all texts for which held_out is false (null counts as false), and the models are
    trained on each of them once. base_score is the add-one unigram score; score is the models'
    normalised log-probability of the whole text and its end. The `words` most frequent words are
    classes of their own; other words are dealt to classes, about a quarter of the square root of their
    number. P(class) is given the word before (after a frequent word also the class of the one before
    that); P(group in class) and P(word in group) are given the word before. Tokens after frequent words
    have one model, learned from all training texts; all other models are trained for each bucket of
    words, of which there are more the more text there is (bucket_bytes), on all tokens of these words. All words that no training text has are one
    class, as likely as words that occur once.

    Null texts are empty: one end token. Null and repeated ids are kept, each row scored by itself.
    Long texts are read whole. Without training texts all counts are 0. Extra columns are ignored; no
    row is dropped. Columns of docs named as results do no harm, but id_col must not be one of these names.
    """
    if id_col in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"):
        raise ValueError(f"{id_col} is a result's name")
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_of(text_col))), F.lit(0))).first()[0]
    buckets = min(max(partitions(spark), size // bucket_bytes), (MOST_IDS - FIRST_WORD - words) // 2)
    blocks = _blocks(docs, held_out, id_col, text_col, buckets, block_bytes)
    summed = stage(_add_up(blocks, words), "token-counts")
    counts = _totals(summed, blocks, words, buckets)
    coded = _coded(blocks, summed, counts)
    model = _beside(coded, counts, dims)
    kind = coded.schema["id"].dataType.simpleString()

    def task(t):
        texts, sums = t.filter(pc.is_valid(t["no"])).sort_by("no"), t.filter(pc.is_null(t["no"]))
        each = np.zeros(len(texts))
        for x in sums["a"].to_pylist():
            inner = np.frombuffer(x, SUM)
            each[inner["text"]] += inner["score"]
        return texts.select(["id", "held_out", "n_tokens", "n_known", "base_score"]).append_column("score", pa.array(each, pa.float64()))

    texts = coded.where("kind = 0").select("block", "no", "id", "held_out", "n_tokens", "n_known", "base_score")
    together = texts.unionByName(_stayed(coded, model).unionByName(_after(coded, counts, model.q)).unionByName(_within(coded, summed, counts, dims)), allowMissingColumns=True)
    scored = together.groupBy("block").applyInArrow(task, f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(counts.n).cast("long").alias("train_tokens"), "base_score", "score")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
