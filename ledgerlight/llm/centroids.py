"""Centroid clustering of integer vectors with annulus search.

Components are scaled and floored to integers, so that distances, sums and new centroids are exact and every run gives the
same clusters. Centroids, `clusters` vectors of `dim` integers, are the only thing that is broadcast; they are sorted by norm. A
vector whose distance to its centroid of the round before (in the first round: to the one of the nearest norm) is u
can only be nearer to centroids whose norm is within u of its own, by the triangle inequality. A binary search in the
sorted norms finds this annulus, which is widened a little against rounding and holds ties at its edges, and the
integer distances to all centroids in it are compared; ties go to the smaller number.

A round is one pass that carries each vector's cluster along; sums are made within each task first, so that a cluster that a
third of all vectors are in is one row for each task. Rounds are kept by persist(), two at a time: what an executor loses is
computed again from the table, through narrow steps only. The last assignment is a checkpoint.

Edge cases: vectors that are null, have another number of components, or hold null or non-finite components take no part; nor do
those with a scaled component beyond 2 ** 27, whose squared distances would not fit a long (with 64 components). A null vec_id takes
part and is the last to be a seed. Rows that are repeated count each, and of equal hashes the smaller vector is the
earlier seed; with fewer vectors than clusters there are as many clusters as vectors; a cluster without vectors keeps its centroid; an
empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import _bytes as B
from ledgerlight.session import cut

LARGEST = 1 << 27
#: Differences of vectors and centroids that are held at once.
PAIRS = 1 << 15


def usable(vector: Column, dim: int, scale: float) -> Column:
    """Of `dim` finite components, none too large."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST)
    return vector.isNotNull() & (F.size(vector) == dim) & F.coalesce(F.forall(vector, fits), F.lit(False))


class Centroids:
    """Centroids by number, and by norm for the annulus search."""

    def __init__(self, rows: list[list[int]]):
        self.rows = np.array(rows, np.int64).reshape(len(rows), -1)
        norms = np.sqrt((self.rows * self.rows).sum(1).astype(np.float64))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]

    def distances(self, x: np.ndarray, number: np.ndarray) -> np.ndarray:
        d = x - self.rows[number]
        return (d * d).sum(1)

    def by_norm(self, norms: np.ndarray) -> np.ndarray:
        """The number of the centroid of the nearest norm."""
        right = np.clip(np.searchsorted(self.norms, norms), 0, len(self.norms) - 1)
        left = np.maximum(right - 1, 0)
        nearer = np.abs(self.norms[left] - norms) <= np.abs(self.norms[right] - norms)
        return self.order[np.where(nearer, left, right)]

    def nearest(self, x: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each vector and its squared distance, given some centroid each; how many were compared."""
        norms = np.sqrt((x * x).sum(1).astype(np.float64))
        before = np.where(before < 0, self.by_norm(norms), before)
        bound = self.distances(x, before)
        reach = np.sqrt(bound.astype(np.float64))
        slack = 1e-9 * (norms + reach) + 1e-6
        low = np.searchsorted(self.norms, norms - reach - slack, "left")
        high = np.searchsorted(self.norms, norms + reach + slack, "right")
        count = high - low
        best, number = bound.copy(), before.astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(count)])
        a = 0
        while a < len(x):
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + PAIRS, "right")) - 1)
            row = np.repeat(np.arange(a, b), count[a:b])
            place = np.arange(upto[a], upto[b]) - np.repeat(upto[a:b], count[a:b]) + low[row]
            found = self.order[place]
            d = self.distances(x[row], found)
            rank = np.lexsort((found, d, row))
            first = rank[np.searchsorted(row, np.arange(a, b))]  # each annulus holds at least the centroid before
            number[a:b], best[a:b] = found[first], d[first]
            a = b
        return number, best, int(upto[-1])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.int64)


def assign(points: DataFrame, centroids, dim: int) -> DataFrame:
    """points with the nearest centroid as cluster, its squared distance, and how many centroids were looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            number, distance, looked = centroids.value.nearest(_matrix(batch.column(1), dim), batch.column(2).to_numpy())
            share = np.zeros(len(batch), np.int64)
            share[0] = looked
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(number.astype(np.int32)), pa.array(distance), pa.array(share)], ["id", "point", "cluster", "distance", "looked"])

    return points.select("id", "point", "cluster").mapInArrow(run, "id long, point array<int>, cluster int, distance long, looked long")


def sums(assigned: DataFrame, dim: int) -> DataFrame:
    """(cluster, at, total, n): componentwise sums of the clusters' vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            cluster, x = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            order = np.argsort(cluster, kind="stable")
            first, count = B.runs(cluster[order])
            if not len(first):
                continue
            added = np.add.reduceat(x[order], first, axis=0)
            for c, row, n in zip(cluster[order][first].tolist(), added, count.tolist(), strict=True):
                held[c] = held.get(c, 0) + np.append(row, n)
        if held:
            rows = list(held.values())
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))], ["cluster", "totals"])

    partial = assigned.select("cluster", "point").mapInArrow(run, "cluster int, totals array<long>")
    return partial.select("cluster", F.posexplode("totals").alias("at", "total")).groupBy("cluster", "at").agg(F.sum("total").alias("total"))


def cluster_vectors(
    vectors: DataFrame,
    *,
    clusters: int = 16,
    rounds: int = 3,
    dim: int = 64,
    scale: float = 64.0,
    salt: str = "1:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, Centroids]:
    """(id, cluster, distance, looked) of every usable vector, and the final centroids.

    Seeds are the vectors whose sha256 of salt and id is smallest. looked: on one row of each batch how many centroids the
    last search compared, over the batch.
    """
    spark = vectors.sparkSession
    B.workers_import(spark)
    rows = vectors.where(usable(F.col(vector_col), dim, scale))
    point = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("int"))
    points = rows.select(F.col(id_col).cast("long").alias("id"), point.alias("point"), F.lit(-1).alias("cluster"))
    seeded = points.select("point", F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256).alias("hash"))
    seeds = [r["point"] for r in seeded.orderBy(F.col("hash").asc_nulls_last(), "point").limit(clusters).collect()]
    found = Centroids(seeds or [[0] * dim])
    state = points
    for _ in range(rounds):
        before, state = state, assign(state, spark.sparkContext.broadcast(found), dim).persist()
        centres = found.rows.tolist()
        grown: dict[int, dict[int, int]] = {}
        for r in sums(state, dim).collect():  # clusters * (dim + 1) numbers
            grown.setdefault(r["cluster"], {})[r["at"]] = r["total"]
        for c, total in grown.items():
            centres[c] = [total[i] // total[dim] for i in range(dim)]
        found = Centroids(centres)
        before.unpersist()
    assigned = cut(assign(state, spark.sparkContext.broadcast(found), dim).drop("point"))
    state.unpersist()
    return assigned, found


def clustering(vectors: DataFrame, *, id_col: str = "vec_id", **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid): one row for each usable vector."""
    spark = vectors.sparkSession
    assigned, found = cluster_vectors(vectors, id_col=id_col, **options)
    inertia = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # a number a cluster
    rows = [(c, inertia.get(c, 0), sum(inertia.values()), row) for c, row in enumerate(found.rows.tolist())]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    told = assigned.join(F.broadcast(facts), "cluster")  # as many rows as clusters
    return told.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
