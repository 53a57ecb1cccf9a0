"""Embedding near-duplicates by an epsilon grid order join: intervals of a sorted sequence, joined recursively."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.components import components
from duelframe.llm.text import released, stored
from duelframe.operators.ordering import dense_index

#: Cosine from which two vectors are linked.
COSINE = 0.98
#: Leading principal dimensions of the grid.
GRID_DIMS = 8
#: Vectors of an interval at the bottom of the recursion.
INTERVAL = 512
#: What rounding may add to a distance of projected coordinates.
SLACK = 1e-6
#: Cosines this near to the threshold are computed again with exact sums.
DOUBT = 1e-12


def _usable(v: Column) -> Column:
    """Neither null nor empty nor zero, and no component null or not finite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _units(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of unit length, in double precision; scaled first, so that no square overflows."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers of the vectors of each length."""
    sizes = np.diff(column.offsets.to_numpy())
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        column = batch.column("embedding")
        for rows in _by_length(column):
            x = _units(column.take(pa.array(rows)))
            x = np.hstack((x, np.ones((len(x), 1))))
            sums[x.shape[1] - 1] = sums.get(x.shape[1] - 1, 0) + x.T @ x
    for size, m in sums.items():
        i, j = np.triu_indices(size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), size)), pa.array(i), pa.array(j), pa.array(m[i, j])], names=["size", "i", "j", "s"])


def principal_axes(vectors: DataFrame, dims: int = GRID_DIMS) -> tuple[int, np.ndarray]:
    """Length and leading principal axes of the unit vectors of the most common length.

    All rows are read; every task hands on the sums of products of its rows, ``length ** 2 / 2`` numbers whatever the
    number of rows, of which only the added-up ones of one length reach the driver. Axes are orthonormal, so projected
    vectors are never farther apart than the vectors.
    """
    sums = vectors.mapInArrow(_moments, "size bigint, i bigint, j bigint, s double").groupBy("size", "i", "j").agg(F.sum("s").alias("s"))
    sums = stored(sums, "moments")
    most = sums.where("i = size and j = size").orderBy(F.desc("s"), "size").first()
    if most is None:
        released(sums)
        return 0, np.zeros((0, 0))
    size, n = most["size"], most["s"]
    m = np.zeros((size + 1, size + 1))
    for r in sums.where(F.col("size") == size).collect():
        m[r.i, r.j] = m[r.j, r.i] = r.s
    released(sums)
    mean = m[:size, size] / n
    _, axes = np.linalg.eigh(m[:size, :size] / n - np.outer(mean, mean))
    return size, np.ascontiguousarray(axes[:, ::-1][:, :dims])


def _projected(size: int, axes: np.ndarray, dims: int):
    """Coordinates on the axes; vectors of other lengths have their first components as coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, out = batch.column("embedding"), np.zeros((batch.num_rows, dims))
            for rows in _by_length(column):
                x = _units(column.take(pa.array(rows)))
                x = x @ axes if x.shape[1] == size else x[:, :dims]
                out[rows, : x.shape[1]] = x
            place = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, dims, dtype=np.int32)), pa.array(out.ravel()))
            yield batch.append_column("place", place)

    return run


def _apart(reach: float) -> Column:
    """True if the boxes of two intervals are provably farther apart than ``reach``, or hold no common group."""
    gap = F.zip_with(
        F.zip_with("low_a", "high_b", lambda x, y: x - y),
        F.zip_with("low_b", "high_a", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    far = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) > (reach + SLACK) ** 2
    return far | (F.col("first_a") > F.col("last_b")) | (F.col("first_b") > F.col("last_a"))


def _interval_pairs(boxes: DataFrame, reach: float, dims: int) -> DataFrame:
    """Pairs ``(a, b)``, a <= b, of bottom intervals that may hold near vectors.

    ``boxes(interval, low, high, first, last)`` bound the bottom intervals. Intervals of the levels above are pairs of
    them; the recursion starts with the whole sequence against itself, halves both sides, and skips what ``_apart``
    tells. A level is a join of the frontier with the boxes of that level.
    """
    n = boxes.agg(F.max("interval")).first()[0]
    levels = [boxes]
    for _ in range(int(n).bit_length()):
        below = levels[-1].withColumn("interval", F.shiftright("interval", 1))
        levels.append(
            below.groupBy("interval").agg(
                F.array(*(F.min(F.get("low", F.lit(d))) for d in range(dims))).alias("low"),
                F.array(*(F.max(F.get("high", F.lit(d))) for d in range(dims))).alias("high"),
                F.min("first").alias("first"),
                F.max("last").alias("last"),
            )
        )
    pairs = boxes.sparkSession.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    before = None
    for level in reversed(levels[:-1]):
        halves = F.array(*(F.struct((2 * F.col("a") + x).alias("a"), (2 * F.col("b") + y).alias("b")) for x in (0, 1) for y in (0, 1)))
        pairs = pairs.select(F.explode(halves).alias("p")).select("p.*").where("a <= b")
        for side in "ab":
            pairs = pairs.join(level.select(*(F.col(c).alias(f"{c}_{side}" if c != "interval" else side) for c in level.columns)), side)
        pairs = stored(pairs.where(~_apart(reach)).select("a", "b"), "intervals")
        if before is not None:
            released(before)
        before = pairs
    return pairs


def _cosines(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``x`` and ``y`` (unit length) reach the cosine; doubtful ones by exactly rounded sums."""
    c = x @ y.T
    hit = c >= cosine
    for i, j in zip(*np.nonzero(np.abs(c - cosine) < DOUBT)):
        hit[i, j] = math.fsum(x[i] * y[j]) >= cosine
    return hit


def _joined(cosine: float):
    """Links of two intervals: for each vector how many links, and edges that connect what the links connect.

    Matrices of ``INTERVAL ** 2`` are all that a pair needs; no list of linked pairs is made.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = batch.column("a")[k].as_py(), batch.column("b")[k].as_py()
                sides = [batch.column(f"rows_{s}").slice(k, 1).flatten() for s in "ab"]
                ids, groups, counts, vectors = zip(*((s.field("node").to_numpy(), s.field("part").to_numpy(), s.field("n").to_numpy(), s.field("embedding")) for s in sides))
                node, links, root = [], [], []
                for group in np.intersect1d(*groups):
                    at = [np.flatnonzero(g == group) for g in groups]
                    x, y = (_units(v.take(pa.array(p))) for v, p in zip(vectors, at))
                    (i, j), (n, m) = ([v[p] for v, p in zip(what, at)] for what in (ids, counts))
                    if a == b:
                        hit = _cosines(x, x, cosine)
                        np.fill_diagonal(hit, False)
                        hit |= hit.T
                        node += [i]
                        links += [hit @ n]
                    else:
                        hit = _cosines(x, y, cosine)
                        node += [i, j]
                        links += [hit @ m, n @ hit]
                    root += _roots(i, j, hit) if a != b else [_roots(i, i, hit)[0]]
                if node:
                    node, links, root = np.concatenate(node), np.concatenate(links), np.concatenate(root)
                    some = links > 0
                    yield pa.RecordBatch.from_arrays([pa.array(v[some]) for v in (node, links, root)], names=["node", "links", "root"])

    return run


def _roots(i: np.ndarray, j: np.ndarray, hit: np.ndarray) -> list[np.ndarray]:
    """The smallest node that each row and each column of a matrix of links reaches within it."""
    x, y, none = i.copy(), j.copy(), np.iinfo(np.int64).max
    while True:
        down = np.minimum(y, np.where(hit, x[:, None], none).min(axis=0, initial=none))
        right = np.minimum(x, np.where(hit, down[None, :], none).min(axis=1, initial=none))
        if (down == y).all() and (right == x).all():
            return [x, y]
        x, y = right, down


def near_vectors(table: DataFrame, group: str = "label", vector: str = "embedding", id_column: str = "vec_id", cosine: float = COSINE, dims: int = GRID_DIMS, interval: int = INTERVAL) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row: vectors of one group with a cosine of ``cosine`` or more are linked.

    Equal vectors of a group become one representative with a count before anything is compared, so a hot vector is
    one row; its copies are links of each other and share all others. Representatives are sorted by group, then by
    grid cells as wide as the distance of unit vectors at that cosine, on leading principal dimensions; intervals of
    the sequence are joined recursively, and blocks of vectors meet only where their boxes come within that distance.
    No link is lost: projection never lengthens a distance. Links are counted and connected inside a block, never
    listed.

    Null, empty and zero vectors, those with null or non-finite components, and rows without a group link with
    nothing: no links, their own id as component, kept. Vectors of different lengths are never linked. Repeated ids
    are rows of their own, and a row without an id takes part with its vector; a component's id is the smallest id
    in it, null if it has none, and such a row is not kept. Other columns are not read. An empty table gives none.
    """
    rows = table.select(F.col(id_column).alias("_id"), F.col(group).alias("_group"), F.col(vector).alias("embedding"))
    able = _usable(F.col("embedding")) & F.col("_group").isNotNull()
    # Numbers are written so that they can be read back, so equal digests are equal vectors; -0 is 0.
    zeros = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0).cast("float")).otherwise(x))
    key = F.sha2(F.concat_ws("|", F.col("_group").cast("string"), zeros.cast("string")).cast("binary"), 256)
    rows = stored(rows.withColumn("able", able).withColumn("key", F.when(F.col("able"), key)), "vectors")
    single = rows.where("not able").select(F.col("_id").alias(id_column), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"), F.col("_id").isNotNull().alias("kept"))
    classes = rows.where("able").groupBy("key").agg(F.first("_group").alias("group"), F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("_id").alias("least"))
    classes = stored(classes, "classes")
    size, axes = principal_axes(classes.select("embedding"), dims)
    if not size:
        return single
    reach = math.sqrt(2 - 2 * cosine)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    placed = classes.mapInArrow(_projected(size, axes, dims), f"{schema}, place array<double>")
    cells = F.transform("place", lambda x: F.floor(x / reach))
    ordered = dense_index(placed, ["group", F.size("embedding"), cells, "key"], "node").withColumn("interval", F.floor((F.col("node") - 1) / interval))
    part = F.xxhash64("group", F.size("embedding"))
    blocks = ordered.groupBy("interval").agg(
        F.sort_array(F.collect_list(F.struct("node", part.alias("part"), "n", "embedding"))).alias("rows"),
        F.array(*(F.min(F.get("place", F.lit(d))) for d in range(dims))).alias("low"),
        F.array(*(F.max(F.get("place", F.lit(d))) for d in range(dims))).alias("high"),
        F.min(F.struct("group", F.size("embedding"))).alias("first"),
        F.max(F.struct("group", F.size("embedding"))).alias("last"),
    )
    ids = stored(ordered.select("key", "node", "n", "least"), "nodes")
    blocks = stored(blocks, "blocks")
    pairs = _interval_pairs(blocks.drop("rows"), reach, dims)
    sides = [blocks.select(F.col("interval").alias(s), F.col("rows").alias(f"rows_{s}")) for s in "ab"]
    met = pairs.join(sides[0], "a").join(sides[1], "b")
    links = stored(met.mapInArrow(_joined(cosine), "node bigint, links bigint, root bigint"), "links")
    groups = components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = ids.join(counts, "node", "left").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    after = stored(nodes, "nodes")
    released(ids, blocks, classes, links)
    nodes = after
    smallest = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    found = nodes.join(smallest, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id")
    out = rows.where("able").join(found, "key").select(F.col("_id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return out.unionByName(single)


def op12_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links within labels at a cosine of 0.98 or more, and components, over all embeddings."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: Links by comparing all vectors of a label, components by following links until nothing new is reached.
OP12_SQL = """
with recursive able as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
  where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit as materialized (select vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as u from able),
links as materialized (
  select a.vec_id as a, b.vec_id as b from unit a join unit b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.u) = len(b.u) and list_dot_product(a.u, b.u) >= 0.98e0),
reach(a, b) as (select a, b from links union select reach.a, links.b from reach join links on links.a = reach.b),
least as (select a as vec_id, min(b) as low from reach group by a),
degree as (select a as vec_id, count(*) as n from links group by a)
select e.vec_id, cast(coalesce(n, 0) as bigint) as n_links, least(e.vec_id, coalesce(low, e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) as kept
from embeddings e left join degree using (vec_id) left join least using (vec_id)
"""
