"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are phrases of three words, edges phrases of four, weighted by how often they occur. What
is shorter is not counted by itself: a phrase occurs as often as edges (or phrases one word longer)
lead on from it, and once more for each place where none leads on: the end of a piece, or of what
can be frequent.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from sequora.llm.common import gathered, slices, stage, table, text_of

LONGEST = 4
SKETCH_BITS = 28
_SLICE = 32768  # bits of one of Spark's bitmaps
_BREAKS = b".,;:!?\n\x0b\x0c\r"


def _classes() -> np.ndarray:
    """0 for bytes of words, 1 between words, 2 where a piece ends."""
    out = np.zeros(256, np.uint8)
    out[list(b" \t")] = 1
    out[list(_BREAKS)] = 2
    return out


_CLASS = _classes()
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _tables(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, (2, 64, 256), dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)


class Words:
    """Words of a batch of texts: two 64-bit hashes of each (with the language), its place, and whether it begins a piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array, tables: np.ndarray):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.raw = _FOLD[raw]
        inside = _CLASS[self.raw] == 0
        first = np.zeros(len(raw) + 1, bool)
        first[offsets] = True  # of texts
        start = np.flatnonzero(inside & (first[:-1] | np.concatenate([[True], ~inside[:-1]]))) if len(raw) else np.zeros(0, np.int64)
        stop = np.flatnonzero(inside & (first[1:] | np.concatenate([~inside[1:], [True]]))) + 1 if len(raw) else start
        self.start, self.length = start, stop - start
        self.doc = np.searchsorted(offsets, start, side="right") - 1
        broken = np.cumsum(_CLASS[self.raw] == 2)
        at = broken[start] if len(raw) else start
        self.begins = np.ones(len(start), bool)
        self.begins[1:] = (at[1:] != at[:-1]) | (self.doc[1:] != self.doc[:-1])
        place = np.flatnonzero(inside)
        k = place - np.repeat(start, self.length)
        names = langs.dictionary_encode()
        self.langs, self.lang = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.doc] if len(start) else np.zeros(0, np.int64)
        self.h = []
        bound = np.concatenate([[0], np.cumsum(self.length)])
        for t in tables:
            v = t[k & 63, self.raw[place]] * (np.uint64(2) * (k >> 6).astype(np.uint64) + np.uint64(1))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v)])
            h = total[bound[1:]] - total[bound[:-1]]
            of_lang = np.array([_of_text(x, t) for x in self.langs], np.uint64)
            self.h.append(_mix(h * _ODD + (of_lang[self.lang] if len(start) else h)))

    def word(self, k: int) -> bytes:
        return self.raw[self.start[k] : self.start[k] + self.length[k]].tobytes()


def _of_text(x: str, t: np.ndarray) -> int:
    b = np.frombuffer(x.encode(), np.uint8)
    k = np.arange(len(b))
    return int((t[k & 63, b] * (np.uint64(2) * (k >> 6).astype(np.uint64) + np.uint64(3))).sum() ^ _ODD)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _buckets(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word with the next one, and with the next two; -1 where these don't belong to its piece."""
    shift, h = np.uint64(64 - bits), w.h[0]
    two, three = np.full(len(h), -1, np.int64), np.full(len(h), -1, np.int64)
    if len(h) > 1:
        pair = h[:-1] * _ODD + h[1:]
        two[:-1] = np.where(w.begins[1:], -1, (_mix(pair) >> shift).astype(np.int64))
        three[:-2] = np.where(w.begins[1:-1] | w.begins[2:], -1, (_mix(pair[:-1] * _ODD + h[2:]) >> shift).astype(np.int64))
    return two, three


def frequent_buckets(docs: DataFrame, least: int, bits: int, tables: np.ndarray) -> DataFrame:
    """Of the buckets into which phrases of two and three words are hashed, those that hold `least` occurrences or more, as bitmaps of 4 KB (slice, bits).

    What occurs so often is in such a bucket; what else is in one does no harm. There are at most
    2**bits buckets, however large the corpus.
    """

    def task(batches):
        held, size = [], 0

        def out():
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([c for _, c in held])[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, n = keys[first], np.add.reduceat(n, first)
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000]), pa.array(n[at : at + 100_000].astype(np.int64))], names=["bucket", "n"])

        for batch in gathered(slices(batches, max_bytes=1 << 20), 1 << 20):
            keys = np.concatenate(_buckets(Words(batch.column(0), batch.column(1), tables[:1]), bits))
            keys, n = np.unique(keys[keys >= 0], return_counts=True)
            held.append((keys, n.astype(np.int32)))
            size += len(keys)
            if size > 1 << 20:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    counts = docs.select("lang", "text").mapInArrow(task, "bucket long, n long")
    often = counts.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return often.groupBy(F.shiftright("bucket", 15).cast("int").alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bucket") + 1)).alias("bits"))


_sketches: dict[str, np.ndarray] = {}


def _packed(bitmaps: list[tuple[int, bytes]]) -> tuple[list[int], bytes]:
    return [k for k, _ in bitmaps], zlib.compress(b"".join(b for _, b in bitmaps), 1)


def _sketch(name: str, shared, bits: int) -> np.ndarray:
    """The packed bitmaps of a broadcast as one; kept by the Python worker while it works on this one."""
    if name not in _sketches:
        _sketches.clear()
        places, packed = shared.value
        out = np.zeros(max((1 << bits) // 8, _SLICE // 8), np.uint8)
        if places:
            out.reshape(-1, _SLICE // 8)[places] = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(-1, _SLICE // 8)
        _sketches[name] = out
    return _sketches[name]


def _has(sketch: np.ndarray, k: np.ndarray) -> np.ndarray:
    return (k >= 0) & (sketch[k >> 3] >> (k & 7).astype(np.uint8) & 1).astype(bool)


class Strands:
    """Words of many batches, and from them edges and the phrases at which edges end, with their weights.

    Each place of a word counts once: for the edge of LONGEST words that begins there, or for as many
    of its words as a frequent phrase can have, if the piece or what is frequent ends before.
    """

    def __init__(self, by: int = 0):
        self.by, self.parts, self.tokens = by, [], 0
        self.keys, self.checks, self.langs, self.words = np.zeros(0, np.uint64), np.zeros(0, np.uint64), [], []

    def add(self, w: Words, two: np.ndarray, three: np.ndarray, sketch: np.ndarray) -> None:
        """Take a batch in, or raise Clash and take nothing in that would be counted."""
        h, check = w.h[self.by], w.h[1 - self.by]
        distinct, first = np.unique(h, return_index=True)
        if (check != check[first][np.searchsorted(distinct, h)]).any():
            raise Clash
        at = np.searchsorted(self.keys, distinct)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        if (self.checks[at[known]] != check[first[known]]).any():
            raise Clash
        fresh = first[~known]
        names = self.names_of(w, fresh)
        self.keys, self.checks = np.concatenate([self.keys, h[fresh]]), np.concatenate([self.checks, check[fresh]])
        order = np.argsort(self.keys)
        self.keys, self.checks = self.keys[order], self.checks[order]
        both = [pa.concat_arrays([*x, y]) for x, y in zip((self.langs, self.words), names, strict=True)]
        self.langs, self.words = ([x.take(pa.array(order))] for x in both)
        goes2 = _has(sketch, two)
        goes3 = goes2 & _has(sketch, three)
        goes4 = goes3 & np.append(goes3[1:], False)[: len(goes3)]
        self.parts.append((h, 1 + goes2.astype(np.int8) + goes3 + goes4))
        self.tokens += len(h)

    @staticmethod
    def names_of(w: Words, at: np.ndarray) -> tuple[pa.Array, pa.Array]:
        return pa.array(w.langs, pa.string()).take(pa.array(w.lang[at])), pa.array([w.word(k) for k in at.tolist()], pa.binary())

    def rows(self):
        """(lang, phrase, words, n)."""
        if not self.tokens:
            return
        ids = np.searchsorted(self.keys, np.concatenate([h for h, _ in self.parts])).astype(np.int32)
        long = np.concatenate([n for _, n in self.parts])
        self.parts = []
        for n in range(1, LONGEST + 1):
            yield from _gram_rows(ids, np.flatnonzero(long == n), n, self.langs[0], self.words[0])


class Clash(RuntimeError):
    """Two words of one hash in a task; they are told apart by the other hash then."""


def _gram_rows(ids: np.ndarray, at: np.ndarray, n: int, langs: pa.Array, words: pa.Array):
    """Distinct phrases of n words that begin at these places, with their counts."""
    base = ids[at].astype(np.int64)
    for k in range(1, n):
        # a pair of what is numbered so far and the next word, numbered anew so that numbers stay small
        base = np.unique(base * np.int64(len(words)) + ids[at + k], return_inverse=True)[1]
    distinct, first, count = np.unique(base, return_index=True, return_counts=True)
    place = at[first]
    for b in range(0, len(place), 50_000):
        p = place[b : b + 50_000]
        parts = [words.take(pa.array(ids[p + k])).cast(pa.string()) for k in range(n)]
        phrase = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(ids[p])), phrase, pa.array(np.full(len(p), n, np.int32)), pa.array(count[b : b + 50_000])], names=["lang", "phrase", "words", "n"])


def edges_and_ends(docs: DataFrame, bitmaps: list, bits: int, tables: np.ndarray) -> DataFrame:
    """Summed weights (lang, phrase, words, n) of edges of four words, and of phrases of one to three words at which edges end.

    An edge ends where its piece does, and where two or three of its words are in no frequent bucket: no
    phrase that counts goes on there.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(_packed(bitmaps)), uuid.uuid4().hex

    def task(batches):
        sketch, s = _sketch(name, shared, bits), Strands()
        for batch in gathered(slices(batches, max_bytes=1 << 20), 1 << 20):
            w = Words(batch.column(0), batch.column(1), tables)
            found = _buckets(w, bits)
            try:
                s.add(w, *found, sketch)
            except Clash:
                yield from s.rows()
                s = Strands(by=1 - s.by)
                s.add(w, *found, sketch)
            if s.tokens > 1 << 20:
                yield from s.rows()
                s = Strands()
        yield from s.rows()

    return docs.select("lang", "text").mapInArrow(task, "lang string, phrase string, words int, n long").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def unary_paths(edges: DataFrame) -> DataFrame:
    """Edges (lang, phrase, n) joined where a node has one way in and one way out: lang, words, weights.

    A path's words are those of its first edge and the last one of each further edge; weights are
    those of the edges in order. By doubling of pointers: a round for each power of two in the
    longest path. Edges of a ring without any branch, which has no first one, stay alone.
    """
    before, after = F.substring_index("phrase", " ", LONGEST - 1), F.substring_index("phrase", " ", 1 - LONGEST)
    ways = edges.select("lang", F.explode(F.array(F.struct(before.alias("node"), F.lit(None).cast("string").alias("come"), F.col("phrase").alias("go")), F.struct(after.alias("node"), F.col("phrase").alias("come"), F.lit(None).cast("string").alias("go")))).alias("w")).select("lang", "w.*")
    nodes = ways.groupBy("lang", "node").agg(F.count("come").alias("in"), F.count("go").alias("out"), F.max("come").alias("come"), F.max("go").alias("go"))
    links = nodes.where((F.col("in") == 1) & (F.col("out") == 1) & (F.col("come") != F.col("go"))).select("lang", F.col("go").alias("phrase"), F.col("come").alias("to"), F.lit(1).cast("long").alias("far"))
    # a link leads from an edge to one before it, open while that may have a link itself
    links = stage(links.withColumn("open", F.lit(True)), "paths-links")
    left, now = -1, links.count()
    while now and now != left:
        left = now
        on = links.select("lang", F.col("phrase").alias("to"), F.col("to").alias("to2"), F.col("far").alias("far2"))
        jumped = links.where("open").join(on.hint("merge"), ["lang", "to"], "left")
        jumped = jumped.select("lang", "phrase", F.coalesce("to2", "to").alias("to"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far"), F.col("to2").isNotNull().alias("open"))
        links = stage(jumped.unionByName(links.where("NOT open")), "paths-links")
        now = links.where("open").count()  # those of paths dwindle in each round, those of rings stay
    done = links.where("NOT open").select("lang", "phrase", F.col("to").alias("head"), "far")
    placed = edges.join(done.hint("merge"), ["lang", "phrase"], "left").select("lang", "phrase", "n", F.coalesce("head", "phrase").alias("head"), F.coalesce("far", F.lit(0)).alias("far"))
    paths = placed.groupBy("lang", "head").agg(F.array_sort(F.collect_list(F.struct("far", "phrase", "n"))).alias("e"))
    more = F.transform(F.slice("e", 2, F.size("e")), lambda x: F.substring_index(x["phrase"], " ", -1))
    return paths.select("lang", F.concat(F.split("head", " "), more).alias("words"), F.col("e.n").alias("weights"))


def phrase_counts(grams: DataFrame, paths: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, phrase, words, n) of all phrases of one to LONGEST words that occur `least` times or more, and all words (lang, n).

    grams: edges_and_ends; paths: the unary paths of its edges of `least` or more. The flow out of a
    node is the weight of what leads on from it; to that come the ends that stop at it.
    """
    edge = paths.select("lang", "words", F.posexplode("weights").alias("at", "n"))
    heavy = edge.select("lang", F.array_join(F.slice("words", F.col("at") + 1, LONGEST), " ").alias("phrase"), "n")
    flow = heavy.unionByName(grams.where((F.col("words") == LONGEST) & (F.col("n") < least)).select("lang", "phrase", "n"))
    found = [heavy.withColumn("words", F.lit(LONGEST))]
    for k in range(LONGEST - 1, 0, -1):
        ends = grams.where(F.col("words") == k).select("lang", "phrase", "n")
        node = flow.select("lang", F.substring_index("phrase", " ", k).alias("phrase"), "n")
        flow = stage(node.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrases")
        found.append(flow.where(F.col("n") >= least).withColumn("words", F.lit(k)))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out, flow.groupBy("lang").agg(F.sum("n").alias("n"))


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with their weakest cut: lang, phrase, words, a, l, r, score.

    A cut's score is floor(2,000,000 a / (l + r)); the lowest counts, of equal ones that after fewest words.
    """
    of = lambda name: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(f"n_{name}"))
    cuts = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    cuts = cuts.join(of("first"), ["lang", "first"]).join(of("rest"), ["lang", "rest"])
    score = F.expr("cast(a AS decimal(20,0)) * 2000000 div (cast(n_first AS decimal(20,0)) + cast(n_rest AS decimal(20,0)))")
    weakest = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", F.col("n_first").alias("l"), F.col("n_rest").alias("r"))).alias("c"))
    return weakest.select("lang", "phrase", "words", "a", "c.l", "c.r", "c.score")


def inside(counts: DataFrame) -> DataFrame:
    """How often the most frequent longer phrase around a phrase of two words and more occurs: lang, phrase, around."""
    parts = [F.expr(f"CASE WHEN words > {n} THEN transform(sequence(0, words - {n}), i -> array_join(slice(split(phrase, ' '), i + 1, {n}), ' ')) ELSE array() END") for n in range(2, LONGEST)]
    longer = counts.where("words > 2").select("lang", F.explode(F.array_distinct(F.concat(*parts))).alias("phrase"), "n")
    return longer.groupBy("lang", "phrase").agg(F.max("n").alias("around"))


def mine(docs: DataFrame, least: int = 30, share: int = 80, top: int | None = 2000, bits: int = SKETCH_BITS, seed: int = 7, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Phrases of two to four words that hold together, by language.

    A-Z are folded; pieces end at . , ; : ! ? and line ends, words at spaces and tabs. Everything is
    counted by language (null: und), overlaps included, over all texts. Candidates occur `least`
    times or more. Those whose words lie inside a longer candidate that occurs `share` percent as
    often or more are dropped. Returns lang, rank, phrase, a, l, r, n, score: the first `top` of each
    language (None: all) by score and a descending, then phrase in order of bytes; n are all words
    of the language.

    Phrases of two and three words are first counted in 2**bits buckets; what is in no bucket of `least`
    can be in no candidate, so edges end there. The sketch is one bitmap of 2**bits bits at most,
    which every worker holds. Beyond some billions of words nearly every bucket is full and edges are
    cut no more: results stay the same, and shuffled rows then grow to the distinct phrases of four words
    of the tasks. Null and empty texts have no words. Extra columns are ignored. No words: no rows.
    """
    if least < 1:
        raise ValueError("least must be 1 or more")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    tables = _tables(seed)
    bitmaps = [(r["slice"], bytes(r["bits"])) for r in frequent_buckets(rows, least, bits, tables).collect()]
    grams = stage(edges_and_ends(rows, bitmaps, bits, tables), "grams")
    paths = stage(unary_paths(grams.where((F.col("words") == LONGEST) & (F.col("n") >= least)).select("lang", "phrase", "n")), "paths")
    counts, total = phrase_counts(grams, paths, least)
    counts = stage(counts, "phrase-counts")
    kept = scored(counts).join(inside(counts).hint("merge"), ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * share))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked.where(F.col("rank") <= top) if top is not None else ranked
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
ws AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM ws GROUP BY lang),
gram AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase FROM ws, range(1, 5) r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS n FROM gram GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT f.lang, f.k, f.phrase, f.n AS a, c, array_to_string(string_split(phrase, ' ')[: c], ' ') AS p, array_to_string(string_split(phrase, ' ')[c + 1 :], ' ') AS q FROM f, range(1, 4) r(c) WHERE c < f.k),
score AS (SELECT cut.*, x.n AS l, y.n AS r, (2000000::HUGEINT * a // (x.n + y.n))::BIGINT AS score FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p JOIN f y ON y.lang = cut.lang AND y.phrase = q),
weak AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
part AS (SELECT lang, n, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' '))) AS phrase FROM f, range(2, 4) r(m) WHERE m < k),
around AS (SELECT lang, phrase, max(n) AS around FROM part GROUP BY ALL),
kept AS (SELECT weak.*, around FROM weak LEFT JOIN around USING (lang, phrase) WHERE around IS NULL OR 100 * around < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""
