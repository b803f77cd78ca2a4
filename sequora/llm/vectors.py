"""Exact near-duplicates and exact top-k search over vectors, by cover trees of blocks that meet pairwise."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sequora.llm import covertree
from sequora.llm.common import partitions, stage, table
from sequora.llm.components import connected_components

WHOLE = 0.5  # whole scores that differ are further apart than this
EXACT = 1e-7  # radii are this exact beside the lengths of the vectors
SLACK = 1e-6  # distances of unit vectors are this exact in double precision, with much to spare
NODES = "node int, parent int, point int, radius double, first int, last int, rep {id}, weight long, x {x}"


def finite(vector: Column) -> Column:
    """Whether a vector has components and all are numbers."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, number), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1."""
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows, their sums taken component by component, as SQL takes them."""
    xy, xx, yy = np.zeros((3, len(x)))
    for k in range(x.shape[1]):
        u, v = x[:, k], y[:, k]
        xy += u * v
        xx += u * u
        yy += v * v
    return xy / (np.sqrt(xx) * np.sqrt(yy))


def _packed_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """id and v, the bytes of a vector or null where it can't be compared, and the type of its components.

    Floats stay what they are, all else are doubles; these are scaled by a power of two, so that no
    product leaves the range of doubles and no digit is lost.
    """
    kind, column = vectors.schema[id_col].dataType.simpleString(), vectors.schema[vector_col].dataType.simpleString()
    real = "float" if column == "array<float>" else "double"

    def task(batches):
        for b in batches:
            x = b.column(1)
            length = pa.compute.fill_null(pa.compute.list_value_length(x), 0).to_numpy()
            flat, some = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64), length > 0
            start = (np.cumsum(length) - length)[some]
            good, most = np.zeros(len(x), bool), np.zeros(len(x))
            if len(start):
                most[some] = np.maximum.reduceat(np.abs(flat), start)  # not a number if one component isn't
            good = (most > 0) & np.isfinite(most) & b.column(0).is_valid().to_numpy(zero_copy_only=False)
            flat, size = flat[np.repeat(good, length)] + 0.0, np.where(good, length, 0)  # no zero below zero
            if real == "double":
                flat = np.ldexp(flat, np.repeat(1 - np.frexp(most)[1][good], size[good]))
            data = flat.astype(np.float32 if real == "float" else np.float64)
            ends = np.r_[0, np.cumsum(size * data.itemsize)].astype(np.int32)
            buffers = [pa.array(good.tolist(), pa.bool_()).buffers()[1], pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.Array.from_buffers(pa.binary(), len(x), buffers)], names=["id", "v"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{real}>").alias("v"))
    return rows.mapInArrow(task, f"id {kind}, v binary"), real


def _unpacked_vectors(points: DataFrame, real: str) -> DataFrame:
    """rep, weight and x, the components of v."""
    kind = points.schema["rep"].dataType.simpleString()

    def task(batches):
        dtype = np.dtype(np.float32 if real == "float" else np.float64)
        for b in batches:
            ends = np.r_[0, np.cumsum(pa.compute.binary_length(b.column(2)).to_numpy())] // dtype.itemsize
            flat = pa.array(np.frombuffer(b"".join(b.column(2).to_pylist()), dtype))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["rep", "weight", "x"])

    return points.select("rep", "weight", "v").mapInArrow(task, f"rep {kind}, weight long, x array<{real}>")


Pivots = dict[int, tuple[np.ndarray, np.ndarray]]  # by dimensions: numbers of cells, and their points


def _pivots(points: DataFrame, block: int, far: bool = False, view=np.asarray) -> Pivots:
    """The points with the least hashes: one for every block/2 points and 512 at most.

    With `far`, half of them are, one after another, that of the 4,096 with the least hashes which is
    furthest from all taken, so that a cluster without a pivot isn't strewn over the others' cells. A bounded sample: it decides where points meet, not which are compared.
    """
    pivots = max(1, min(512, 2 * points.count() // block))
    picked = points.orderBy(F.xxhash64("rep", "x"), "rep").limit(4096 if far else pivots).select("x").collect()
    by_dims: dict[int, list] = {}
    for r in picked:
        by_dims.setdefault(len(r["x"]), []).append(r["x"])
    if not far:
        return {d: (np.arange(len(v)), view(np.array(v))) for d, v in by_dims.items()}
    out = {}
    for d, v in by_dims.items():
        x, n = np.array(v), max(1, pivots * len(v) // len(picked))
        taken = list(range((n + 1) // 2))
        apart = covertree.squared(x, x[taken]).min(1)
        while len(taken) < n and apart.max() > 0:
            taken.append(int(apart.argmax()))
            apart = np.minimum(apart, covertree.squared(x, x[taken[-1:]])[:, 0])
        out[d] = (np.arange(len(taken)), x[taken])
    return out


def _with_points(pivots: Pivots, grown: DataFrame, least: int) -> Pivots:
    """Pivots without those whose cells hold fewer than `least` points, where others hold more."""
    cell = F.split("block", "-")[1].cast("int")
    # a row for each pivot
    wide = {(r["dims"], r["cell"]) for r in grown.where("x IS NOT NULL").groupBy("dims", cell.alias("cell")).count().where(F.col("count") >= least).collect()}
    out = {}
    for d, (cells, points) in pivots.items():
        some = np.array([(d, c) in wide for c in cells.tolist()])
        out[d] = (cells[some], points[some]) if some.any() else (cells, points)
    return out


def _cells(points: DataFrame, block: int, by_dims: Pivots, view=np.asarray) -> DataFrame:
    """Adds `block`: dimensions, nearest pivot and cut; cells of more than `block` points are cut by a hash."""

    def task(batches):
        for b in batches:
            x = b.column(b.schema.get_field_index("x"))
            dims = np.diff(x.offsets.to_numpy()) if len(x) else np.zeros(0, int)
            cell = np.zeros(len(x), np.int32)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                if d in by_dims:
                    cells, pivots = by_dims[d]
                    cell[at] = cells[covertree.squared(view(matrix(x.take(pa.array(at)))), pivots).argmin(1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims, pa.int32()), pa.array(cell, pa.int32())], names=[*b.schema.names, "dims", "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    celled = stage(points.mapInArrow(task, f"{schema}, dims int, cell int"), "vector-cells")
    sizes = celled.groupBy("dims", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("cuts"))
    cut = F.pmod(F.xxhash64("rep", "x"), F.col("cuts"))
    return celled.join(sizes, ["dims", "cell"]).withColumn("block", F.concat_ws("-", "dims", "cell", cut)).drop("cell", "cuts")


def trees(points: DataFrame, block: int, pivots: Pivots | None = None, view=np.asarray) -> DataFrame:
    """Cover trees of (rep, weight, x): one row for each node, with `block`, `dims` and what NODES names.

    Blocks lie around `pivots`, or around some of the points. Trees are those of what `view` makes of
    the points; rows keep the points as given.
    """
    pivots = _pivots(points, block, view=view) if pivots is None else pivots
    kind, column = (points.schema[c].dataType.simpleString() for c in ("rep", "x"))

    def grow(t):
        t = t.sort_by("rep")
        order, tree = covertree.build(view(matrix(t["x"])))
        n, m = len(order), len(tree.parent)
        take = pa.array(np.r_[order, np.zeros(m - n, np.int64)], mask=np.arange(m) >= n)
        ints = [pa.array(v, pa.int32()) for v in (np.arange(m), tree.parent, tree.point)]
        ends = [pa.array(v, pa.int32()) for v in (tree.begin, tree.end)]
        return pa.Table.from_arrays([pa.array([t["block"][0].as_py()] * m), pa.array([t["dims"][0].as_py()] * m, pa.int32()), *ints, pa.array(tree.radius), *ends, *[t[c].combine_chunks().take(take) for c in ("rep", "weight", "x")]], names=["block", "dims", "node", "parent", "point", "radius", "first", "last", "rep", "weight", "x"])

    return _cells(points, block, pivots, view).groupBy("block").applyInArrow(grow, f"block string, dims int, {NODES.format(id=kind, x=column)}")


def read_tree(t: pa.Table, view=np.asarray) -> tuple[covertree.Tree, list, np.ndarray]:
    t = t.sort_by("node")
    get = lambda c: t[c].to_numpy()
    n = len(t) - t["x"].null_count
    leaves = t.slice(0, n)
    x = matrix(leaves["x"])
    tree = covertree.Tree(view(x), get("parent"), get("point"), get("radius"), get("first"), get("last"), x)
    return tree, leaves["rep"].to_pylist(), leaves["weight"].to_numpy()


def _dot(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda u, v: u * v), F.lit(0.0), lambda t, u: t + u)


def _heads(grown: DataFrame, view=np.asarray) -> DataFrame:
    """For each tree its block and dims, and its root's radius and point."""

    def seen(batches):
        for b in batches:
            x = [view(np.array([v], np.float64))[0].tolist() for v in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(x, pa.list_(pa.float64()))], names=b.schema.names)

    roots = grown.where("parent < 0").select("block", "radius", "point")
    heads = roots.join(grown.where("x IS NOT NULL").select("block", F.col("node").alias("point"), "dims", "x"), ["block", "point"])
    return stage(heads.select("block", "radius", "dims", "x").mapInArrow(seen, "block string, radius double, dims int, x array<double>"), "tree-roots")


def _heads_met(heads: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs of heads of equal dimensions, columns a_* and b_*; heads are dealt to salts, so no task gets all pairs."""
    salts = partitions(heads.sparkSession)
    left = heads.select([F.col(c).alias(f"a_{c}") for c in heads.columns]).withColumn("salt", F.pmod(F.xxhash64("a_block"), F.lit(salts)))
    right = others.select([F.col(c).alias(f"b_{c}") for c in others.columns]).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, (left["salt"] == right["salt"]) & (left["a_dims"] == right["b_dims"])).drop("salt")


def _pairs(heads: DataFrame, others: DataFrame, near: Column) -> DataFrame:
    """Pairs of blocks of equal dimensions for which `near` holds."""
    return _heads_met(heads, others).where(near).select(F.col("a_block").alias("a"), F.col("b_block").alias("b"))


def _meet(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """The nodes of both blocks of each pair: (a, b, side, node columns)."""
    pairs = stage(pairs, "block-pairs")
    one = left.join(pairs, F.col("block") == F.col("a")).withColumn("side", F.lit(0))
    two = right.join(pairs, F.col("block") == F.col("b")).withColumn("side", F.lit(1))
    return one.unionByName(two).drop("block", "dims")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, block: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id_col, n_links, component_id and kept for every row: pairs whose cosine reaches the threshold are linked.

    Equal vectors are one point with a weight. Points, scaled to length 1, lie in blocks around
    pivots (of `block` points at most: an eighth of all, from 8,192 to 65,536, unless given); each block has a cover tree. Blocks whose root balls come near enough meet in a task of
    their own, where both trees are walked together: a pair of nodes is dropped if its balls are too
    far apart, counted whole if they lie near enough, and points left over are compared by their product; what is
    within rounding of the threshold, by the cosine of the vectors as given. Before points are multiplied, a bound on their product is
    taken from the directions that hold most of both blocks. Links are counted, not listed; each task passes on
    a forest that connects what it linked, and components come from these.

    Null vectors, empty, all-zero ones and those with null or non-finite components link with
    nothing; vectors of different lengths don't link. Rows that share an id share a component. Null
    ids link with nothing and are kept. Extra columns are ignored; no row is dropped.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows, real = _packed_vectors(vectors, id_col, vector_col)
    rows = stage(rows, "vectors")
    points = stage(rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "vectors-distinct")
    block = block or min(65536, max(8192, points.count() // 8))
    grown = stage(trees(_unpacked_vectors(points, real), block, view=unit), "trees")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    heads = _heads(grown, unit)
    apart = F.sqrt(F.aggregate(F.zip_with("a_x", "b_x", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x))
    near = (F.col("a_block") <= F.col("b_block")) & (apart <= F.col("a_radius") + F.col("b_radius") + reach + SLACK)

    def link(key, t):
        same = key[0].as_py() == key[1].as_py()
        a, a_rep, a_weight = read_tree(t.filter(pa.compute.equal(t["side"], 0)), unit)
        b, b_rep, b_weight = (a, a_rep, a_weight) if same else read_tree(t.filter(pa.compute.equal(t["side"], 1)), unit)
        covertree.shorten(a, b)
        links, edges = cosine_links(a, b, a_weight, b_weight, threshold, reach, same)
        reps = a_rep if same else a_rep + b_rep
        some = np.flatnonzero(links)
        id_type = t.schema.field("rep").type
        return pa.table({"rep": pa.array([reps[k] for k in some.tolist()] + [reps[k] for k, _ in edges], id_type), "links": pa.array(links[some].tolist() + [None] * len(edges), pa.int64()), "other": pa.array([None] * len(some) + [reps[k] for _, k in edges], id_type)})

    met = _meet(grown, grown, _pairs(heads, heads, near))
    found = stage(met.groupBy("a", "b").applyInArrow(link, f"rep {kind}, links long, other {kind}"), "vector-links")
    links = found.where("links IS NOT NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(found.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    by_vector = points.join(links, "rep", "left").join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
    by_vector = by_vector.select("v", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"))
    out = rows.join(by_vector, "v", "left")
    component = F.coalesce("c", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def cosine_links(a, b, a_weight, b_weight, threshold: float, reach: float, same: bool):
    """Weighted links of the points of a (then b's, unless they are the same tree), and a forest over them."""
    n, m = len(a.x), 0 if same else len(b.x)
    a_sum, b_sum = np.r_[0, np.cumsum(a_weight)], np.r_[0, np.cumsum(b_weight)]
    change = np.zeros(n + m + 1, np.int64)
    label = np.arange(n + m)  # the least point that each is connected with

    def least(i, j, by_a):
        r = a.radius[i] + b.radius[j].max() if by_a else b.radius[j] + a.radius[i].max()
        return 1 - (reach + SLACK + r) ** 2 / 2 - SLACK

    def decide(i, j, dots):
        apart = np.sqrt(np.maximum(2 - 2 * dots, 0))
        both = a.radius[i] + b.radius[j]
        points = (a.n_kids[i] == 0) & (b.n_kids[j] == 0)
        whole = ~points & (apart + both <= reach - SLACK)
        k = np.flatnonzero(points & (dots >= threshold - SLACK))
        if len(k):
            linked = np.ones(len(k), bool)
            near = dots[k] <= threshold + SLACK
            linked[near] = cosine((a.x if a.given is None else a.given)[i[k[near]]], (b.x if b.given is None else b.given)[j[k[near]]]) >= threshold
            if same:
                linked &= i[k] != j[k]
            whole[k] = linked
        if whole.any():
            p, q = i[whole], j[whole]
            w = b_sum[b.end[q]] - b_sum[b.begin[q]]
            np.add.at(change, a.begin[p], w)
            np.add.at(change, a.end[p], -w)
            if same:  # of nested nodes the smaller meets itself: a point's own weight isn't a link
                low, high = np.maximum(a.begin[p], a.begin[q]), np.minimum(a.end[p], a.end[q])
                for s, e in zip(low[high > low].tolist(), high[high > low].tolist(), strict=True):
                    change[s:e] -= a_weight[s:e]
                    change[s + 1 : e + 1] += a_weight[s:e]
            if not same:
                w = a_sum[a.end[p]] - a_sum[a.begin[p]]
                np.add.at(change, n + b.begin[q], w)
                np.add.at(change, n + b.end[q], -w)
            shift = 0 if same else n
            _connect(label, a.begin[p], a.end[p], b.begin[q] + shift, b.end[q] + shift)
        return ~whole & ~points & (apart <= reach + both + SLACK)

    covertree.dual(a, b, decide, least)
    if not same and n:  # the two ranges are counted apart
        links = np.r_[np.cumsum(change[:n]), np.cumsum(np.r_[change[n] - _overrun(change, n), change[n + 1 : n + m]])]
    else:
        links = np.cumsum(change[:n])
    moved = np.flatnonzero(label != np.arange(n + m))
    return links, list(zip(moved.tolist(), label[moved].tolist(), strict=True))


def _overrun(change: np.ndarray, n: int) -> int:
    """What ends of a's ranges at place n have put there: minus the sum of the changes before."""
    return -int(change[:n].sum())


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    n = high - low
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def _connect(label: np.ndarray, a0, a1, b0, b1, most: int = 1 << 19) -> None:
    """Lower labels by pairs of ranges whose points are all linked; nothing of the pairs is kept."""
    ends = np.cumsum(a1 - a0 + b1 - b0)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most)))
        part = slice(at, to)
        u = np.concatenate([_spread(a0[part], a1[part]), _spread(b0[part], b1[part])])
        v = np.concatenate([np.repeat(b0[part], (a1 - a0)[part]), np.repeat(a0[part], (b1 - b0)[part])])
        u, v = label[u], label[v]
        u, v = u[u != v], v[u != v]
        while len(u):
            low = np.minimum(label[u], label[v])
            before = label.copy()
            np.minimum.at(label, u, low)
            np.minimum.at(label, v, low)
            label[:] = label[label]
            if (label == before).all():
                break
        at = to


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, block: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows with the highest integer inner products for each query row: query_id, rank, id_col, score.

    A component x counts as floor(scale * x). `queries` marks the query rows; every other row with a
    usable vector of the same length is a candidate; ties go to the smaller id. Data and queries lie
    in blocks with a cover tree each. A pair of nodes is dropped if its greatest possible product, by
    the covering radii, is below the worst k-th score of the query node's points. This holds between
    blocks too: queries first meet the data around their own pivot, which gives each a k-th score, and
    then a block of queries meets those blocks of data alone whose greatest possible product with one of
    the nodes below its root reaches the worst of these below that node. Blocks that meet have a task of their own, where both trees are walked together,
    from the scores known by then.

    Null vectors, empty ones and those with null or non-finite components take no part, nor do null
    ids. Rows that share an id are separate candidates, but none for a query of that id. Vectors too
    large for exact doubles are scored as whole numbers, and scores beyond a long are held at its ends.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    v = F.col(vector_col).cast("array<double>")
    usable = vectors.where(F.col(id_col).isNotNull() & finite(v))
    rows = stage(usable.select(F.col(id_col).alias("rep"), F.lit(1).cast("long").alias("weight"), F.transform(v, lambda x: _floor(x, scale)).alias("x"), F.coalesce(queries, F.lit(False)).alias("asks")), "whole-vectors")
    points, size = rows.select("rep", "weight", "x"), max(256, block // 4)
    pivots = _pivots(points, block, far=True)
    data = stage(trees(points, block, pivots), "data-trees").withColumn("floor", F.lit(None).cast("double"))
    points = rows.where("asks").select("rep", "weight", "x")

    def search(key, t):
        side = t.filter(pa.compute.equal(t["side"], 0)).sort_by("node")
        q, q_rep, _ = read_tree(side)
        known = side["floor"].fill_null(-np.inf).to_numpy()[: len(q_rep)]
        d, d_rep, _ = read_tree(t.filter(pa.compute.equal(t["side"], 1)))
        id_type = t.schema.field("rep").type
        best = best_scores(q, d, q_rep, d_rep, k, known)
        return pa.table({"query_id": pa.array([x[0] for x in best], id_type), "id": pa.array([x[1] for x in best], id_type), "score": pa.array([x[2] for x in best], pa.int64())})

    def searched(asked: DataFrame, pairs: DataFrame) -> DataFrame:
        return _meet(asked, data, pairs).groupBy("a", "b").applyInArrow(search, f"query_id {kind}, id {kind}, score long")

    around = stage(trees(points, size, _with_points(pivots, data, 4 * k)), "query-trees-around").withColumn("floor", F.lit(None).cast("double"))
    own = F.regexp_replace("block", "[0-9]+$", "0")  # the first cut of the cell of the same pivot
    begun = searched(around, around.select(F.col("block").alias("a"), own.alias("b")).distinct())
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    known = begun.withColumn("nth", nth).where(F.col("nth") == k).select(F.col("query_id").alias("rep"), F.col("score").cast("double").alias("floor"))
    asked = stage(trees(points, size, _pivots(points, size, far=True)).join(stage(known, "scores-known"), "rep", "left"), "query-trees")
    found = searched(asked, _open_pairs(_groups(asked), _heads(data)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def _groups(asked: DataFrame) -> DataFrame:
    """The nodes below the root of each tree of queries: block, dims, radius, x of the point, floor (the worst below the node)."""

    def below(t):
        t = t.sort_by("node")
        tree, reps, _ = read_tree(t)
        known = t["floor"].fill_null(-np.inf).to_numpy()[: len(reps)]
        kids = tree.kids[tree.first[tree.root] : tree.first[tree.root] + tree.n_kids[tree.root]]
        kids = kids[np.argsort(tree.begin[kids])] if len(kids) else np.array([tree.root])
        floor = np.minimum.reduceat(known, tree.begin[kids])
        same = lambda c: t[c].combine_chunks().take(pa.array(np.zeros(len(kids), np.int64)))
        return pa.Table.from_arrays([same("block"), same("dims"), pa.array(tree.radius[kids]), pa.array(tree.x[tree.point[kids]].tolist(), pa.list_(pa.float64())), pa.array(floor)], names=["block", "dims", "radius", "x", "floor"])

    return stage(asked.groupBy("block").applyInArrow(below, "block string, dims int, radius double, x array<double>, floor double"), "query-groups")


def _open_pairs(groups: DataFrame, data: DataFrame) -> DataFrame:
    """Pairs of blocks for which the greatest possible product of a group of queries reaches the group's floor."""
    norm = lambda x: F.sqrt(_dot(x, x))
    size, reach = norm("a_x") * norm("b_x"), norm("a_x") * F.col("b_radius") + norm("b_x") * F.col("a_radius") + F.col("a_radius") * F.col("b_radius")
    # products beyond doubles can't be told and stay open; scores end where longs do
    most = F.greatest(_dot("a_x", "b_x") + reach + WHOLE + EXACT * (size + reach), F.lit(-(2.0**63)))
    return _pairs(groups, data, F.isnan(most) | (most >= F.col("a_floor"))).distinct()


def _floor(x: Column, scale: int) -> Column:
    """floor(scale * x) as a double; beyond 2^52 a double is whole already."""
    y = x * scale
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)


def _levels(tree) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """From the deepest level up: inner nodes, their children one node after another, and where each node's begin."""
    out, nodes = [], np.array([tree.root])
    while len(nodes := nodes[tree.n_kids[nodes] > 0]):
        first, n = tree.first[nodes], tree.n_kids[nodes]
        kids = tree.kids[_spread(first, first + n)]
        out.append((nodes, kids, np.cumsum(n) - n))
        nodes = kids
    return out[::-1]


def best_scores(q, d, q_ids: list, d_ids: list, k: int, known: np.ndarray | None = None) -> list[tuple]:
    """(query id, id, score) of each query's k best in this block; what is below its score in `known` may lack."""
    largest = max(np.abs(q.x).max(), np.abs(d.x).max(), 1.0)
    if largest * largest * q.x.shape[1] >= 2.0**52:
        return _best_of_large(q, d, q_ids, d_ids, k)
    nq, nd = len(q.x), len(d.x)
    number = {v: r for r, v in enumerate(sorted(set(q_ids) | set(d_ids)))}
    q_no, d_no = np.array([number[v] for v in q_ids]), np.array([number[v] for v in d_ids])
    score = np.full((nq, k), -np.inf)  # each query's best so far, in descending order
    place = np.full((nq, k), -1)
    known = np.full(nq, -np.inf) if known is None else known
    floor = np.full(len(q.parent), -np.inf)  # the worst k-th score below a query node
    q_norm, d_norm = np.sqrt(q.norm), np.sqrt(d.norm)
    slack = WHOLE + EXACT * q_norm.max() * d_norm.max()
    levels = _levels(q)

    def raise_floors():
        floor[:nq] = np.maximum(known, score[:, k - 1])
        for nodes, kids, starts in levels:
            floor[nodes] = np.minimum.reduceat(floor[kids], starts)

    def offer(i, j, s):
        """Put candidates j with scores s to queries i; then raise the floors."""
        rows = np.unique(i)
        number_of = np.searchsorted(rows, i)
        held = place[rows] >= 0
        r, c = np.nonzero(held)
        i2, j2, s2 = np.r_[number_of, r], np.r_[j, place[rows][r, c]], np.r_[s, score[rows][r, c]]
        order = np.lexsort((j2, d_no[j2], -s2, i2))
        i2, j2, s2 = i2[order], j2[order], s2[order]
        fresh = np.r_[True, (i2[1:] != i2[:-1]) | (j2[1:] != j2[:-1])]
        i2, j2, s2 = i2[fresh], j2[fresh], s2[fresh]
        nth = np.arange(len(i2)) - np.searchsorted(i2, i2)
        top = nth < k
        score[rows], place[rows] = -np.inf, -1
        score[rows[i2[top]], nth[top]], place[rows[i2[top]], nth[top]] = s2[top], j2[top]
        raise_floors()

    def bound(i, j, dots):
        rq, rd = q.radius[i], d.radius[j]
        return dots + q_norm[q.point[i]] * rd + d_norm[d.point[j]] * rq + rq * rd

    def least(i, j, by_a):
        one, two, flip = (q, d, False) if by_a else (d, q, True)
        a, b = (i, j) if by_a else (j, i)
        norm_a, norm_b = (d_norm, q_norm) if flip else (q_norm, d_norm)
        r = two.radius[b].max()
        room = norm_a[one.point[a]] * r + norm_b[two.point[b]].max() * one.radius[a] + one.radius[a] * r
        return (floor[b].min() if flip else floor[a]) - room - slack

    def decide(i, j, dots):
        open_ = bound(i, j, dots) >= floor[i] - slack
        points = (q.n_kids[i] == 0) & (d.n_kids[j] == 0)
        hit = np.flatnonzero(points & open_ & (q_no[np.minimum(i, nq - 1)] != d_no[np.minimum(j, nd - 1)]))
        if len(hit):
            s = np.rint(np.einsum("ij,ij->i", q.x[i[hit]], d.x[j[hit]]))
            better = s >= floor[i[hit]]
            if better.any():
                offer(i[hit][better], j[hit][better], s[better])
        return open_ & ~points

    # a first score for every query, against points spread over the block, so that floors are not empty
    some = np.unique(np.linspace(0, nd - 1, min(nd, 64)).astype(int))
    first = q.x @ d.x[some].T
    i, j = np.nonzero(q_no[:, None] != d_no[some][None, :])
    if len(i) and not np.isfinite(known).all():
        offer(i, some[j], first[i, j])
    raise_floors()
    covertree.dual(q, d, decide, least)
    r, c = np.nonzero(place >= 0)
    return [(q_ids[a], d_ids[place[a, b]], int(score[a, b])) for a, b in zip(r.tolist(), c.tolist(), strict=True)]


def _best_of_large(q, d, q_ids, d_ids, k):
    out, end = [], 2**63 - 1
    whole = [[int(y) for y in x] for x in d.x.tolist()]
    for q_id, x in zip(q_ids, q.x.tolist(), strict=True):
        x = [int(y) for y in x]
        scores = [(-max(-end - 1, min(end, sum(a * b for a, b in zip(x, y, strict=True)))), d_id) for d_id, y in zip(d_ids, whole, strict=True) if d_id != q_id]
        out += [(q_id, d_id, -s) for s, d_id in sorted(scores)[:k]]
    return out


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


USABLE_SQL = "vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
DOT_SQL = "list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i]))"
OP1_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {USABLE_SQL})),
link AS MATERIALIZED (SELECT a.vec_id AS one, b.vec_id AS two FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND a.n > 0 AND b.n > 0 WHERE {DOT_SQL} / (a.n * b.n) >= 0.95),
reach(one, two) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.one, l.two FROM reach r JOIN link l ON r.two = l.one)
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM (
  SELECT t.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(r.least, t.vec_id) AS component_id FROM embeddings t
  LEFT JOIN (SELECT one, count(*) AS n FROM link GROUP BY 1) c ON c.one = t.vec_id LEFT JOIN (SELECT one, min(two) AS least FROM reach GROUP BY 1) r ON r.one = t.vec_id)
"""
OP9_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings WHERE {USABLE_SQL}),
s AS (SELECT a.vec_id AS query_id, b.vec_id, {DOT_SQL}::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.e) = len(b.e))
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
