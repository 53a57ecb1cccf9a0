"""Nearest neighbours by inner product: stable projections in a kd-tree, verified until a chi-square test holds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the vectors that place the cells of the tree; every vector is indexed."""

    neighbours: int = 20
    projections: int = 8  # even, so that the chi-square distribution has a closed form
    certainty: float = 0.96
    sample_rows: int = 4096
    cell_rows: int = 8192
    query_rows: int = 1024
    leaf_rows: int = 64
    seed: int = 5


def chi_square(x: np.ndarray | float, degrees: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, float) / 2
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


def reach(settings: Settings) -> float:
    """``x`` at which the distribution function reaches ``certainty``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, settings.projections) < settings.certainty else (low, mid)
    return high


@dataclass(frozen=True)
class Space:
    """Vectors lifted to one length: a search by distance among them is one by inner product, for any query.

    A vector ``x`` gets the coordinate ``sqrt(longest - |x|^2)``, a query is scaled to that length and gets 0.
    """

    longest: float
    directions: np.ndarray

    def vectors(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.longest - np.einsum("ij,ij->i", x, x), 0))
        return x @ self.directions[:-1] + np.outer(lift, self.directions[-1])

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q * (math.sqrt(self.longest) / np.linalg.norm(q, axis=1))[:, None] @ self.directions[:-1]


@dataclass(frozen=True)
class Cells:
    """The upper kd-tree: at depth ``d`` coordinate ``d % m`` is cut at a median of the sample's points."""

    cuts: list[np.ndarray]

    def of(self, points: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(points), np.int64)
        for depth, cut in enumerate(self.cuts):
            cell = 2 * cell + (points[:, depth % points.shape[1]] > cut[cell])
        return cell

    def boxes(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.full((1, m), -np.inf), np.full((1, m), np.inf)
        for depth, cut in enumerate(self.cuts):
            k = depth % m
            low, high = np.repeat(low, 2, 0), np.repeat(high, 2, 0)
            high[0::2, k] = np.minimum(high[0::2, k], cut)
            low[1::2, k] = np.maximum(low[1::2, k], cut)
        return low, high


def _cells(points: np.ndarray, depth: int) -> Cells:
    cuts, groups = [], [points]
    for d in range(depth):
        k = d % points.shape[1]
        cut = np.array([np.median(g[:, k]) if len(g) else 0.0 for g in groups])
        cuts.append(cut)
        groups = [half for g, c in zip(groups, cut) for half in (g[g[:, k] <= c], g[g[:, k] > c])]
    return Cells(cuts)


def _gap(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from each point to each box."""
    out = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        side = np.maximum(np.maximum(low[None, :, k] - points[:, k, None], points[:, k, None] - high[None, :, k]), 0)
        out += side * side
    return out


def _leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows of a kd-tree's leaves: the widest coordinate is halved until ``size`` rows are left."""
    todo, done = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= size:
            done.append(own)
            continue
        part = points[own]
        k = int(np.argmax(part.max(0) - part.min(0)))
        order = own[np.argpartition(part[:, k], len(own) // 2)]
        todo += [order[: len(own) // 2], order[len(own) // 2 :]]
    return done


def _search(ids, x, points, query_ids, q, q_points, known, space: Space, settings: Settings) -> list[tuple]:
    """Best candidates of one block for each query; leaves by projected distance until the test holds.

    A vector at the true distance of the worst of the neighbours found so far, or nearer, has a projection whose
    squared distance is that distance squared times a chi-square variable. Once the next leaf is so far off that
    this variable would be larger than its ``certainty`` quantile, the search ends.
    """
    leaves = _leaves(points, settings.leaf_rows)
    low = np.array([points[own].min(0) for own in leaves])
    high = np.array([points[own].max(0) for own in leaves])
    limit, rows, k = reach(settings), [], settings.neighbours
    length = math.sqrt(space.longest)
    for query, v, gaps, least in zip(query_ids, q, _gap(q_points, low, high), known):
        scale = length / np.linalg.norm(v)
        order = np.argsort(gaps, kind="stable")
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        i, step = 0, 4
        while i < len(order):
            worst = max(least, best[-1] if len(best) == k else -np.inf)
            if worst > -np.inf:
                apart = max(2 * space.longest - 2 * worst * scale, 0.0)
                if gaps[order[i]] > limit * apart + 1e-12:
                    break
            own = np.concatenate([leaves[leaf] for leaf in order[i : i + step]])
            own = own[ids[own] != query]
            best_ids = np.concatenate((best_ids, ids[own]))
            best = np.concatenate((best, x[own] @ v))
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            i, step = i + step, 16
        rows += [(query, n, s) for n, s in zip(best_ids.tolist(), best.tolist())]
    return rows


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: vectors that are not null, not zero and finite in every component, in double precision."""
    v = F.col("embedding").cast("array<double>")
    fine = F.col("vec_id").isNotNull() & F.coalesce(F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))), F.lit(False)) & F.exists(v, lambda x: x != 0)
    return vectors.where(fine).select(F.col("vec_id").cast("long"), v.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(vectors: DataFrame, is_query, settings: Settings = Settings()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest found of each query row of ``vectors(vec_id, embedding)``.

    The largest inner product is nearest, ties go to the smaller ``vec_id``; a query has all candidates if they
    are fewer than asked for. Vectors that are null, zero or hold null or non-finite components take no part, nor do
    those of another length than most have. A ``vec_id`` that stands twice is no candidate for itself; of repeated
    candidates each row counts. The cells of the upper tree come from a bounded sample; a cell of many rows, such
    as one very common vector, is dealt over several blocks. A query is first searched in its own cell, and then
    in those other cells that the chi-square test cannot rule out with what it has found.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("longest"))
    top = sizes.orderBy(F.desc("n"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if top is None:
        return spark.createDataFrame([], schema)
    dim, total, m = top["dim"], top["n"], settings.projections
    rows = rows.where(F.size("v") == dim)
    rng = np.random.default_rng(settings.seed)
    space = Space(top["longest"], rng.standard_normal((dim + 1, m)))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample_rows).select("v").collect()  # at most sample_rows
    depth = min(max(math.ceil(math.log2(total / settings.cell_rows)), 0), int(math.log2(settings.sample_rows)) - 4)
    cells = _cells(space.vectors(np.array([r[0] for r in sample])), depth)
    low, high = cells.boxes(m)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells.of(space.vectors(_matrix(batch.column(1), dim)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell)], names=["vec_id", "v", "cell"])

    index = rows.mapInArrow(placed, "vec_id long, v array<double>, cell long")
    counts = index.groupBy("cell").count().collect()  # one row a cell, of which the sample bounds the number
    parts = F.create_map(*[F.lit(x) for r in counts for x in (r["cell"], math.ceil(r["count"] / settings.cell_rows))])
    index = index.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts[F.col("cell")]).cast("long"))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = cells.of(space.queries(_matrix(batch.column(1), dim)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own), pa.array(np.full(len(own), -np.inf))], names=["vec_id", "v", "cell", "least"])

    limit = reach(settings)

    def onwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column(1), dim)
            points, least = space.queries(q), batch.column(2).to_numpy(zero_copy_only=False)
            apart = np.maximum(2 * space.longest - 2 * least * math.sqrt(space.longest) / np.linalg.norm(q, axis=1), 0)
            near = _gap(points, low, high) <= (limit * np.where(np.isfinite(apart), apart, np.inf) + 1e-12)[:, None]
            near[np.arange(len(q)), cells.of(points)] = False
            who, cell = np.nonzero(near)
            pick = pa.array(who)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(1).take(pick), pa.array(cell), batch.column(2).take(pick)], names=["vec_id", "v", "cell", "least"])

    queries = rows.where(is_query)
    wanted = "vec_id long, v array<double>, cell long, least double"
    first = _blocks(index, queries.mapInArrow(routed, wanted), parts, space, settings)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = first.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= settings.neighbours).drop("r")
    bound = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    known = queries.join(bound, queries["vec_id"] == bound["query_id"], "left")
    known = known.select("vec_id", "v", F.when(F.col("n") >= settings.neighbours, F.col("least")).otherwise(float("-inf")).alias("least"))
    second = _blocks(index, known.mapInArrow(onwards, wanted), parts, space, settings)
    both = first.unionByName(second).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= settings.neighbours)
    return both.select("query_id", "rank", "vec_id", "score")


def _blocks(index: DataFrame, queries: DataFrame, parts, space: Space, settings: Settings) -> DataFrame:
    """Search every block of a query's cell; a group holds one block of vectors and one of queries, both bounded."""
    asked = queries.groupBy("cell").count().collect()  # one row a cell
    if not asked:
        return index.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    turns = F.create_map(*[F.lit(x) for r in asked for x in (r["cell"], math.ceil(r["count"] / settings.query_rows))])
    queries = queries.where(parts[F.col("cell")].isNotNull())
    queries = queries.withColumn("turn", F.pmod(F.xxhash64("vec_id"), turns[F.col("cell")]).cast("long"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (parts[F.col("cell")] - 1).cast("long"))))
    vectors = index.where(turns[F.col("cell")].isNotNull())
    vectors = vectors.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), (turns[F.col("cell")] - 1).cast("long"))))

    def found(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asking):
            rows = []
        else:
            x, q = np.stack(own["v"].to_numpy()), np.stack(asking["v"].to_numpy())
            rows = _search(own["vec_id"].to_numpy(), x, space.vectors(x), asking["vec_id"].tolist(), q, space.queries(q), asking["least"].to_numpy(), space, settings)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    keys = ["cell", "part", "turn"]
    return vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(found, "query_id long, vec_id long, score double")


def op5_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
