"""N-gram Jaccard join by chosen paths: sets are split on sampled shared shingles, small buckets are compared."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequora.llm.common import gathered, new_path, partitions, slices, stage, table, text_of
from sequora.llm.components import connected_components

SKETCH_BITS = 128
MIX = np.uint64(0x9E3779B97F4A7C15)
SAMPLE = 64  # shingles of a set that its paths below the first are taken from, on average


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of each 64-bit number spread over all of it."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, kind: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * MIX + np.uint64(kind)) | np.uint64(1)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of `width` words (lower case, cut at white space).

    A text of fewer words has one shingle of all of them, a text without words none.
    """
    words = [x.lower().split() for x in texts]
    distinct = list(set().union(*words))
    number = dict(zip(distinct, (xxhash.xxh3_64_intdigest(w) for w in distinct), strict=True))
    out = []
    for w in words:
        h = np.fromiter(map(number.__getitem__, w), np.uint64, len(w))
        n = max(1, len(w) - width + 1)
        s = np.full(n if len(w) else 0, len(w) if len(w) < width else width, np.uint64)
        for k in range(min(width, len(w))):
            s = mix(s * MIX + h[k : k + n])
        out.append(np.unique(s))
    return out


def survival(spread: float) -> float:
    """Chance that a branching process with Poisson(spread) children never dies out."""
    s = 1.0
    for _ in range(200):
        s = 1 - math.exp(-spread * s)
    return s


def runs_needed(recall: float, spread: float) -> int:
    """Runs after which a pair at the threshold has met in a small bucket with this probability, however deep that lies.

    A run's first level gives such a pair one shared path on average, every further level `spread`.
    """
    p = 1 - math.exp(-survival(spread))
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def sampled(s: np.ndarray) -> np.ndarray:
    """The shingles whose hash lies below SAMPLE/size (all of a small set): sets of like size and content have like samples."""
    return s[mix(s + MIX) < np.uint64(min(2**64 - 1, int(2**64 * SAMPLE / max(1, len(s)))))]


def chosen_paths(s: np.ndarray, nodes: np.ndarray, share: float, size: int) -> np.ndarray:
    """The paths on which a set goes on below any of `nodes`.

    A shingle is taken if its hash in the node lies below 1/(share * size), where size is that of the
    set, or SAMPLE for the sample of a larger set: of two sets that have this share of their
    shingles in common, one common shingle is expected to be taken.
    """
    limit = np.uint64(min(2**64 - 1, int(2**64 / (share * max(1, size)))))
    found, mixed = [nodes[:0]], mix(s)
    step = max(1, (1 << 22) // max(1, len(s)))
    for at in range(0, len(nodes), step):
        part = nodes[at : at + step]
        k, j = np.nonzero(mixed[None, :] * (part | np.uint64(1))[:, None] < limit)  # multiply-shift: the upper bits decide
        found.append(mix(part[k] ^ s[j] * MIX))
    return np.concatenate(found)


def sketch(s: np.ndarray) -> np.ndarray:
    """One bit of the least hash under each of SKETCH_BITS functions; two bits agree as often as (1 + Jaccard) / 2."""
    bits = np.zeros(SKETCH_BITS, np.uint8)
    functions, step = seeds(SKETCH_BITS, 2), max(1, (1 << 20) // max(1, len(s)))
    if len(s):
        m = mix(s ^ MIX)
        for at in range(0, SKETCH_BITS, step):
            bits[at : at + step] = mix((m[None, :] * functions[at : at + step, None]).min(1)).astype(np.uint64) & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distances of sketches, whose words lie in the last axis."""
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(-1, dtype=np.int32)  # of a signed word the sign would not count


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n points the least point that the edges (a, b) connect it with."""
    label = np.arange(n)
    while len(a):
        low, before = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


COLD, HOT, LEADERS = 0, 1, 2  # rows of buckets
EDGE, ON = 0, 1  # what buckets give: an edge (a, b) of nodes, or a path a below which node b goes on (c: what it is connected with)
BUCKET_ROW = "kind int, path long, salt int, node long, b0 long, b1 long, packed binary"
PACKED = np.dtype([("node", "<i8"), ("bits", "<i8", (2,))])
GATHER = 1 << 20
FOREST = 1 << 20  # edges that a task holds
HOT_ROWS = 1 << 14  # rows of hot parts that a task is dealt, about
WHOLE, WHOLE_BUCKET = 1 << 10, 1 << 14  # buckets below the first level are compared in full if a set meets so many others on average, and none more than that


@dataclass(frozen=True)
class Rules:
    """limit: sets of a cold part; near: distance of candidates; absorb: distance at which a leader stands for a set."""

    limit: int
    leaders: int
    near: int
    absorb: int
    last: bool

    @property
    def reach(self) -> int:
        return self.near if self.last else self.near + self.absorb


class Sift:
    """Tells hot parts of buckets from cold ones, in rows sorted by path, salt and node, a batch at a time.

    A part is what a bucket (path) has of one salt. It is hot if it has more than `limit` sets; some
    of its sets, none within `absorb` of another, are then packed as leaders. On the last level all
    sets of a hot part are leaders. A hot part's rows are passed on as they come.
    """

    def __init__(self, rules: Rules):
        self.rules, self.held, self.open = rules, None, None  # open: path, salt and last node of a hot part

    def batch(self, path, salt, node, bits):
        if self.held is not None:
            path, salt, node, bits = (np.concatenate(x) for x in zip(self.held, (path, salt, node, bits), strict=True))
        before = self.open or (None, None, None)
        same = np.r_[before == (path[0], salt[0], node[0]), (path[1:] == path[:-1]) & (salt[1:] == salt[:-1]) & (node[1:] == node[:-1])]
        path, salt, node, bits = path[~same], salt[~same], node[~same], bits[~same]  # copies have the same node
        if not len(path):
            self.held = None
            return None
        first = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (salt[1:] != salt[:-1])])
        size = np.diff(np.r_[first, len(path)])
        hot = size > self.rules.limit
        goes_on = before[:2] == (path[0], salt[0])
        hot[0] |= goes_on
        new = np.flatnonzero(hot)
        if goes_on and not self.rules.last:
            new = new[new > 0]
        packed = [(path[f], salt[f], self._pack(node[f : f + n], bits[f : f + n])) for f, n in zip(first[new].tolist(), size[new].tolist(), strict=True)]
        cut = len(path)
        self.open = (path[-1], salt[-1], node[-1]) if hot[-1] else None
        self.held = None
        if not hot[-1]:
            cut = first[-1]
            self.held = (path[cut:], salt[cut:], node[cut:], bits[cut:])
        kind = np.where(np.repeat(hot, size), HOT, COLD)[:cut]
        return self._rows(kind, path[:cut], salt[:cut], node[:cut], bits[:cut], packed)

    def end(self):
        return self._rows(np.full(len(self.held[0]), COLD), *self.held, []) if self.held is not None else None

    def _pack(self, node, bits) -> bytes:
        if not self.rules.last:
            chosen = []
            for k in range(min(len(node), 256)):
                if len(chosen) < self.rules.leaders and (far(bits[chosen], bits[k]) > self.rules.absorb).all():
                    chosen.append(k)
            node, bits = node[chosen], bits[chosen]
        out = np.empty(len(node), PACKED)
        out["node"], out["bits"] = node, bits
        return out.tobytes()

    @staticmethod
    def _rows(kind, path, salt, node, bits, packed) -> pa.RecordBatch:
        m = len(packed)
        ints = lambda x, more, t: pa.array(np.r_[x, np.array(more, x.dtype)], t)
        zero = [0] * m
        return pa.RecordBatch.from_arrays(
            [ints(kind, [LEADERS] * m, pa.int32()), ints(path, [p[0] for p in packed], pa.int64()), ints(salt, [p[1] for p in packed], pa.int32()), ints(node, zero, pa.int64()), ints(bits[:, 0], zero, pa.int64()), ints(bits[:, 1], zero, pa.int64()), pa.concat_arrays([pa.nulls(len(kind), pa.binary()), pa.array([p[2] for p in packed], pa.binary())])],
            names=["kind", "path", "salt", "node", "b0", "b1", "packed"],
        )


def columns_of(b: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def bits_of(b: pa.RecordBatch) -> np.ndarray:
    return np.stack(columns_of(b, "b0", "b1"), 1)


def found_rows(kind: int, a, b, c=None) -> pa.RecordBatch:
    c = pa.nulls(len(a), pa.int64()) if c is None else pa.array(c, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), c], names=["kind", "a", "b", "c"])


def compare_cold(b: pa.RecordBatch, rules: Rules):
    """Compare the sets of each bucket in full; in buckets with hot parts also with the leaders, and send them on."""
    kind, path, node = columns_of(b, "kind", "path", "node")
    bits = bits_of(b)
    leading = np.flatnonzero(kind == LEADERS)
    packed = b.column(b.schema.get_field_index("packed"))
    for p in np.unique(path[leading]).tolist():
        leaders = [np.frombuffer(packed[k].as_py(), PACKED) for k in leading[path[leading] == p].tolist()]
        own = np.flatnonzero((path == p) & (kind == COLD))
        if len(own):
            yield from compare_with_leaders(p, node[own], bits[own], Leaders(leaders, rules), rules, cold=True)
    cold = kind == COLD
    path, node, bits = path[cold], node[cold], bits[cold]
    left, right, d = [], [], 1
    while len(same := np.flatnonzero(path[d:] == path[:-d])):
        same = same[far(bits[same], bits[same + d]) <= rules.near]
        left.append(same)
        right.append(same + d)
        d += 1
    if left:
        label = least_labels(len(path), np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(label != np.arange(len(label)))
        yield found_rows(EDGE, node[moved], node[label[moved]])


class Leaders:
    """The leaders of a bucket in one order for all of its parts, and which of them are connected.

    Leaders within reach of each other are connected from the start; one part of the bucket says so.
    """

    def __init__(self, parts: list[np.ndarray], rules: Rules):
        every = np.sort(np.concatenate(parts), order="node")
        self.node, self.bits, self.label = every["node"], every["bits"], np.arange(len(every))
        if not rules.last:
            self.label = least_labels(len(every), *np.nonzero(far(self.bits[:, None, :], self.bits[None, :, :]) <= rules.reach))
        self.group = self.node[self.label]  # the same in every part

    def stand_in(self, node: np.ndarray) -> np.ndarray:
        """Leaders replaced by the least that they are connected with from the start; other nodes as they are."""
        at = np.minimum(np.searchsorted(self.node, node), len(self.node) - 1)
        return np.where(self.node[at] == node, self.group[at], node)

    def connected(self) -> pa.RecordBatch:
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return found_rows(EDGE, self.node[moved], self.node[self.label[moved]])


def compare_with_leaders(path: int, node, bits, leaders: Leaders, rules: Rules, cold: bool = False):
    """Edges to the leaders within reach; sets that no leader stands for go on.

    If x is within `absorb` of a leader and y within `near` of x, the leader is within `reach` of y: so
    x needs no further comparison. Sets that go on are given with the least leader that they are
    connected with, or else themselves. On the last level two sets of hot parts meet once, where the
    greater is compared; `cold` sets aren't leaders and meet all.
    """
    step = max(1, (1 << 20) // len(leaders.node))
    for at in range(0, len(node), step):
        n, b = node[at : at + step], bits[at : at + step]
        distance = far(b[:, None, :], leaders.bits[None, :, :])
        apart = n[:, None] > leaders.node[None, :] if rules.last and not cold else n[:, None] != leaders.node[None, :]
        close = (distance <= rules.reach) & apart
        row, column = np.nonzero(close)
        if len(row):
            some = np.r_[True, row[1:] != row[:-1]]
            yield found_rows(EDGE, n[row[some]], leaders.node[column[some]])
            met = np.unique(column[some][np.cumsum(some) - 1] * len(leaders.node) + column)
            a, c = np.r_[met // len(leaders.node), np.arange(len(leaders.label))], np.r_[met % len(leaders.node), leaders.label]
            label = least_labels(len(leaders.label), a, c)
            moved = np.flatnonzero(label != leaders.label)
            leaders.label = label
            yield found_rows(EDGE, leaders.node[moved], leaders.node[label[moved]])
        if not rules.last:
            stay = np.flatnonzero(distance.min(1) > rules.absorb)
            c = np.where(close[stay].any(1), leaders.group[close[stay].argmax(1)], n[stay])
            yield found_rows(ON, np.full(len(stay), path), n[stay], c)


class Forest:
    """Edges of a task of which only those are given on that connect what the task's others don't: one for each node but one of a component, at most."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, a, b):
        """Take edges in; what is held is given on when it grows large."""
        self.held.append(np.stack([a, b]))
        self.size += len(a)
        if self.size >= FOREST:
            yield from self.end()

    def end(self):
        if self.size:
            node, at = np.unique(np.concatenate(self.held, 1), return_inverse=True)
            label = least_labels(len(node), *at.reshape(2, -1))
            moved = np.flatnonzero(label != np.arange(len(label)))
            yield found_rows(EDGE, node[moved], node[label[moved]])
        self.held, self.size = [], 0


def compare_hot(batches, rules: Rules, salts: int):
    """Rows sorted by path, salt and falling kind: compare each hot part's sets with all leaders of the bucket.

    A set that is near the leaders of many buckets of the task has one edge and not one for each
    bucket. Leaders that are connected from the start stand as the least of them; the part of
    the bucket's own salt says that they are connected, whether or not it has sets to compare.
    """
    of, parts, leaders, forest = None, [], None, Forest()

    def known():
        return leaders.connected() if of[1] == of[0] % salts else None

    for b in gathered(batches, GATHER):
        kind, path, salt, node = columns_of(b, "kind", "path", "salt", "node")
        bits, packed = bits_of(b), b.column(b.schema.get_field_index("packed"))
        first = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (salt[1:] != salt[:-1])])
        for f, e in zip(first.tolist(), np.r_[first[1:], len(path)].tolist(), strict=True):
            if of != (path[f], salt[f]):
                if parts and leaders is None:
                    leaders = Leaders(parts, rules)
                    if (rows := known()) is not None:
                        yield rows
                of, parts, leaders = (path[f], salt[f]), [], None
            h = f + int((kind[f:e] == LEADERS).sum())
            parts += [np.frombuffer(packed[k].as_py(), PACKED) for k in range(f, h)]
            if h < e:
                if leaders is None:
                    leaders = Leaders(parts, rules)
                    if (rows := known()) is not None:
                        yield rows
                for rows in compare_with_leaders(int(path[f]), node[h:e], bits[h:e], leaders, rules):
                    if rows.num_rows and rows.column(0)[0].as_py() == EDGE:
                        yield from forest.add(*(leaders.stand_in(x) for x in columns_of(rows, "a", "b")))
                    else:
                        yield rows
    if parts and leaders is None:
        leaders = Leaders(parts, rules)
        if (rows := known()) is not None:
            yield rows
    yield from forest.end()


def whole_buckets(batches):
    """Record batches of about GATHER bytes at least that don't cut a bucket; rows are sorted by path."""
    held = None
    for b in gathered(batches, GATHER):
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        path = b.column(b.schema.get_field_index("path")).to_numpy()
        cut = len(path) - int((path == path[-1]).sum())
        held = b.slice(cut)
        if cut:
            yield b.slice(0, cut)
    if held is not None:
        yield held


def _describe(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: float, runs: int) -> DataFrame:
    """For each row with an id: id, mark (md5 of the text), key and node (of the set; key null if it is empty), and the set's size, sample, sketch and first paths.

    Copies have the same set; a task gives these with the first copy that it meets, and size 0 with others.
    """
    text = text_of(text_col)
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.md5(text).alias("mark"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def task(batches):
        met: set[bytes] = set()
        roots = seeds(runs, 1)
        for b in slices(batches, 2):
            keys, nodes, sizes, samples, bits, paths = [], [], [], [], [], []
            for s in shingle_sets(b.column(2).to_pylist(), width):
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                keys.append(digest.hex() if len(s) else None)
                nodes.append(int.from_bytes(digest[:8], "little", signed=True))
                first = len(s) > 0 and digest not in met
                met.add(digest)
                sizes.append(len(s) if first else 0)
                samples.append(sampled(s).tobytes() if first else None)
                bits.append(sketch(s) if first else (0, 0))
                paths.append(chosen_paths(s, roots, threshold, len(s)).view(np.int64) if first else np.zeros(0, np.int64))
            bits = np.array(bits, np.int64).reshape(-1, 2)
            offsets = pa.array(np.cumsum([0, *map(len, paths)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(keys, pa.string()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(samples, pa.binary()), pa.array(bits[:, 0]), pa.array(bits[:, 1]), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(paths)))],
                names=["id", "mark", "key", "node", "size", "sample", "b0", "b1", "paths"],
            )

    return rows.mapInArrow(task, f"id {kind}, mark string, key string, node long, size int, sample binary, b0 long, b1 long, paths array<long>")


def _buckets(rows: DataFrame, rules: Rules, salts: int) -> DataFrame:
    """What the buckets of rows (path, node, b0, b1) give, staged: kind, a, b.

    Buckets are dealt to tasks by path and salt first. What is left in parts of up to `limit` sets meets
    by path; hot parts stay apart, and the leaders of the whole bucket come to each of them. They are
    dealt by salt and as few groups of paths as their rows ask for, so that a task sees a set in many of
    its buckets.
    """
    spark, n = rows.sparkSession, partitions(rows.sparkSession)

    def sift(batches):
        own = Sift(rules)
        for b in gathered(batches, GATHER):
            out = own.batch(*columns_of(b, "path", "salt", "node"), bits_of(b))
            if out is not None:
                yield out
        if (out := own.end()) is not None:
            yield out

    def cold(batches):
        for b in whole_buckets(batches):
            yield from compare_cold(b, rules)

    def hot(batches):
        yield from compare_hot(batches, rules, salts)

    dealt = rows.select("path", F.pmod("node", F.lit(salts)).cast("int").alias("salt"), "node", "b0", "b1").repartition(n, "path", "salt").sortWithinPartitions("path", "salt", "node")
    sifted, path = dealt.mapInArrow(sift, BUCKET_ROW), new_path(spark, "buckets")
    sifted.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    sifted = spark.read.schema(sifted.schema).parquet(path)
    leaders = sifted.where(f"kind = {LEADERS}")
    everywhere = leaders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    results = "kind int, a long, b long, c long"
    groups = max(1, -(-sifted.where(f"kind = {HOT}").count() // (salts * HOT_ROWS)))
    deal = F.pmod(F.xxhash64("path"), F.lit(groups))
    of_hot = sifted.where(f"kind = {HOT}").unionByName(everywhere).repartition(n, "salt", deal).sortWithinPartitions("path", "salt", F.desc("kind")).mapInArrow(hot, results)
    of_cold = sifted.where(f"kind = {COLD}").unionByName(leaders).repartition(n, "path").sortWithinPartitions("path").mapInArrow(cold, results)
    return stage(of_cold.union(of_hot), "candidates")


def _candidates(described: DataFrame, threshold: float, near: int, depth: int, salts: int, limit: int, leaders: int, absorb: int, spread: float) -> DataFrame:
    """Edges between nodes whose sets may reach the threshold, from all runs' buckets.

    A level whose buckets can be compared in full at a cost that is bounded for each set is the last.
    """
    sets = described.where("size > 0").select("node", "b0", "b1", F.least("size", F.lit(SAMPLE)).alias("size"), "sample")
    rows = described.where("size > 0").select(F.explode("paths").alias("path"), "node", "b0", "b1")
    edges, last = None, depth == 1
    for level in range(depth):
        found = _buckets(rows, Rules(limit, leaders, near, absorb, last), salts)
        e = found.where(f"kind = {EDGE}").select("a", "b")
        edges = e if edges is None else edges.union(e)
        if last:
            break
        on = found.where(f"kind = {ON}").select(F.col("a").alias("path"), F.col("b").alias("node"), F.col("c").alias("group"), F.pmod("b", F.lit(salts)).alias("salt"))
        # where all that goes on is connected, no pair is left to be found
        live = stage(on.groupBy("path").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("path"), "paths-open")
        if live.isEmpty():
            break
        open_parts = live.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        # one row for each set, with the paths of its runs that are still open
        on = on.join(open_parts, ["path", "salt"], "left_semi").groupBy("node").agg(F.collect_set("path").alias("nodes"))

        def further(batches):
            for b in batches:
                out = [chosen_paths(np.frombuffer(s, np.uint64), np.array(x, np.int64).view(np.uint64), threshold / spread, n).view(np.int64) for n, s, x in zip(*(c.to_pylist() for c in b.columns[3:]), strict=True)]
                each = np.repeat(np.arange(len(out)), [len(x) for x in out])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*out, np.zeros(0, np.int64)])), *[c.take(pa.array(each)) for c in b.columns[:3]]], names=["path", "node", "b0", "b1"])

        own = stage(sets.join(on, "node").dropDuplicates(["node"]).select("node", "b0", "b1", "size", "sample", "nodes"), "sets-further")
        rows, sets = stage(own.mapInArrow(further, "path long, node long, b0 long, b1 long"), "paths-further"), own.drop("nodes")
        size = F.col("count")
        met = rows.groupBy("path").count().agg(F.sum(size).alias("rows"), F.sum(size * size).alias("pairs"), F.max(size).alias("most")).first()
        last = level + 2 >= depth or not met["rows"] or (met["most"] <= WHOLE_BUCKET and met["pairs"] <= WHOLE * met["rows"])
    return edges


def links_of(sets: list[np.ndarray], ids: list, weights: np.ndarray, threshold: float, split: int | None = None):
    """Weighted links of each set, and edges that connect linked sets; with `split`, only links across that place.

    Shingles that one set alone has add nothing to an intersection and are left out; the others are
    columns of a 0/1 matrix whose product with itself counts what sets share.
    """
    n, size = len(sets), np.array([len(s) for s in sets], np.float64)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    row, column = row[use], number[column[use]]
    total, width = int(shared.sum()), 8192
    common = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, total, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        m = np.zeros((n, min(width, total - at)), np.float32)
        m[row[lo:hi], column[lo:hi] - at] = 1
        common += m @ m.T
    union = size[:, None] + size[None, :] - common
    linked = common / np.maximum(union, 1) >= threshold
    np.fill_diagonal(linked, False)
    if split is not None:
        linked[:split, :split] = False
        linked[split:, split:] = False
    a, b = np.nonzero(np.triu(linked))
    label = least_labels(n, a, b)
    moved = np.flatnonzero(label != np.arange(n))
    return (linked @ weights).astype(np.int64), [(ids[k], ids[label[k]]) for k in moved.tolist()]


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: float, target_recall: float, depth: int, block: int, salts: int, limit: int, leaders: int, spread: float) -> tuple[DataFrame, DataFrame]:
    """described (id, mark, key) of each row with an id, and for each key its least (id, mark), copies, links, and the least (id, key) of its class if it has links."""
    spark = docs.sparkSession
    runs = runs_needed(target_recall, spread)
    agree = (1 + threshold) / 2
    deviation = math.sqrt(SKETCH_BITS * agree * (1 - agree))
    near, absorb = math.floor(SKETCH_BITS * (1 - agree) + 4.5 * deviation), round(SKETCH_BITS * (1 - agree))
    described = stage(_describe(docs, id_col, text_col, width, threshold, runs), "shingles")
    sets = stage(described.where("key IS NOT NULL").groupBy("key", "node").agg(F.min(F.struct("id", "mark")).alias("least"), F.count("*").alias("copies")), "sets")
    near_nodes = stage(connected_components(_candidates(described, threshold, near, depth, salts, limit, leaders, absorb, spread)), "candidates")

    members = sets.join(near_nodes, "node").select(F.col("least.id").alias("rep"), F.col("least.mark").alias("mark"), "key", "copies", "component")
    sizes = members.groupBy("component").agg(F.count("*").alias("m")).where("m > 1")
    members = stage(members.join(sizes, "component").withColumn("blocks", F.ceil(F.col("m") / block).cast("int")), "candidates-members")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")))
    # each member's text once by its id and mark, then to the tasks of its component
    text = text_of(text_col)
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("rep"), F.md5(text).alias("mark"), text.alias("text"))
    rows = members.withColumn("own", own).hint("merge").join(texts, ["rep", "mark"]).select("component", "own", "rep", "key", "copies", "text", F.explode(others).alias("p")).select("component", "p.i", "p.j", "own", "rep", "key", "copies", "text")
    kind = members.schema["rep"].dataType.simpleString()

    def verify(batches):
        held, of = [], None

        def close():
            first = {}
            for i, j, own, rep, key, copies, text in held:
                first.setdefault((own != i, rep, key), (copies, text))  # rows that share id and text come more than once
            if len(first) < 2:
                return [], []
            names = sorted(first)
            chosen = shingle_sets([first[k][1] for k in names], width)
            split = sum(not n[0] for n in names) if held[0][0] != held[0][1] else None
            links, edges = links_of(chosen, [n[1:] for n in names], np.array([first[n][0] for n in names], np.int64), threshold, split)
            return [(*n[1:], int(x)) for n, x in zip(names, links, strict=True) if x], edges

        def out(found):
            links, edges = found
            return pa.RecordBatch.from_pydict({
                "rep": pa.array([x[0] for x in links] + [a[0] for a, _ in edges], id_type),
                "key": pa.array([x[1] for x in links] + [a[1] for a, _ in edges], pa.string()),
                "links": pa.array([x[2] for x in links] + [None] * len(edges), pa.int64()),
                "other_rep": pa.array([None] * len(links) + [b[0] for _, b in edges], id_type),
                "other_key": pa.array([None] * len(links) + [b[1] for _, b in edges], pa.string()),
            })

        for b in batches:
            id_type = b.column(4).type
            columns = [c.to_pylist() for c in b.columns]
            for component, i, j, *rest in zip(*columns, strict=True):
                if (component, i, j) != of:
                    if held:
                        yield out(close())
                    held, of = [], (component, i, j)
                held.append((i, j, *rest))
        if held:
            yield out(close())

    n = partitions(spark)
    found = stage(rows.repartition(n, "component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(verify, f"rep {kind}, key string, links long, other_rep {kind}, other_key string"), "links")
    links = found.where("links IS NOT NULL").groupBy("key").agg(F.sum("links").alias("links"))
    edges = found.where("links IS NULL").select(F.struct(F.col("rep").alias("id"), "key").alias("a"), F.struct(F.col("other_rep").alias("id"), F.col("other_key").alias("key")).alias("b"))
    classes = connected_components(edges).select(F.col("node.key").alias("key"), F.col("component").alias("class"))
    return described.select("id", "mark", "key"), sets.join(links, "key", "left").join(classes, "key", "left").select("key", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), "class")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, target_recall: float = 0.9999, depth: int = 6, block: int = 1000, salts: int = 16, limit: int = 16, leaders: int = 4, spread: float = 1.4) -> DataFrame:
    """id_col, class_id (least id of the documents reachable by links) and n_links of every row.

    Two documents are linked if the Jaccard similarity of their sets of `width`-word shingles is at
    least `threshold`; n_links counts the other rows linked to a row, copies among them. Candidates
    come from chosen paths: in each of the runs that target_recall asks for (of a pair exactly at the
    threshold, whatever the depth), sets go to the buckets of the shingles sampled from them. A bucket
    is dealt to tasks in `salts` parts. If no part has more than `limit` sets, all of them are compared
    by sketches whose cut lies 4.5 standard deviations below the threshold. Otherwise every set is
    compared with up to `leaders` sets of each part; sets like a leader (at the threshold, as
    sketches tell) are done with, as all that is near them has an edge to that leader, and the rest
    is split by further shingles. Buckets of the last level are compared in full, part by part; that is
    the level at which it costs a set about a thousand comparisons, or the last of `depth`.
    Connected candidates then meet in one task (or, if more than `block`, in tasks for each pair of
    blocks) and are compared exactly on their whole sets, so no link is reported below the threshold.

    Sets that are equal are one until the end, so copies cost nothing. Texts without words (null,
    empty) link with nothing and are classes of their own; texts of fewer than `width` words are one
    shingle. Null ids take no part: class null, no links. Rows that share an id but not their set
    have classes and links of their own. Extra columns are ignored.
    """
    described, by_key = _classes(docs, id_col, text_col, width, threshold, target_recall, depth, block, salts, limit, leaders, spread)
    by_key = stage(by_key.select("key", "least.id", "copies", F.coalesce("class.id", "least.id").alias("class_id"), (F.col("copies") - 1 + F.col("links")).cast("long").alias("n_links")), "sets-joined")
    total = by_key.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # sets with a thousandth of all rows are a thousand at most; those without copies need no join
    frequent = F.broadcast(by_key.where(F.col("copies") * 1000 > total).where("copies > 1"))
    others = by_key.where((F.col("copies") * 1000 <= total) & (F.col("copies") > 1))
    rows, out = described.select("id", "key"), [F.col("id").alias(id_col), "class_id", "n_links"]
    single = by_key.where("copies = 1").select(*out)
    known = single.unionByName(rows.join(frequent.drop("id"), "key").select(*out)).unionByName(rows.join(others.drop("id"), "key").select(*out))
    known = known.unionByName(rows.where("key IS NULL").select(F.col("id").alias(id_col), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    kind = described.schema["id"].dataType
    without = docs.where(F.col(id_col).isNull()).select(F.col(id_col), F.lit(None).cast(kind).alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return known.unionByName(without)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, target_recall: float = 0.9999, depth: int = 6, block: int = 1000, salts: int = 16, limit: int = 16, leaders: int = 4, spread: float = 1.4) -> DataFrame:
    """docs with one row of each class of near-duplicates: that with the least id (then set, then md5 of the text).

    Classes are those of jaccard_join. A row goes only if its own text is in a class of which another
    text or row stays, so rows that share an id but are unlike stay. Of rows with equal id and text one
    stays. Texts without words and rows without an id all stay. Columns are those of docs, whatever
    their names.
    """
    described, by_key = _classes(docs, id_col, text_col, width, threshold, target_recall, depth, block, salts, limit, leaders, spread)
    first = by_key.where(F.col("class").isNull() | (F.col("class.key") == F.col("key"))).select(F.col("least.id").alias("kept id"), F.col("least.mark").alias("kept mark"), F.lit(True).alias("one is kept"))
    wordless = described.where("key IS NULL").select(F.col("id").alias("kept id"), F.col("mark").alias("kept mark"), F.lit(False).alias("one is kept")).distinct()
    joined = docs.withColumn("mark of text", F.md5(text_of(text_col))).join(first.union(wordless), (F.col(id_col) == F.col("kept id")) & (F.col("mark of text") == F.col("kept mark")), "left")
    kept = joined.where(F.col(id_col).isNull() | F.col("kept id").isNotNull()).withColumn("row of its own", F.when(~F.col("one is kept") | F.col("one is kept").isNull(), F.monotonically_increasing_id()))
    return kept.dropDuplicates([id_col, "mark of text", "row of its own"]).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)
