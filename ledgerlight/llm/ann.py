"""Approximate nearest neighbours by inner product: shifted Hilbert orderings, neighbouring key windows, exact rerank.

Vectors are projected to a few dimensions by seeded random rotations, shifted, and put on a Hilbert curve; each
rotation with its shift is one ordering. An ordering's keys are cut into blocks of about `block_rows` vectors at
quantiles of a bounded sample of keys (equal keys are told apart by the vector's hash, so no key makes a large block).
A query looks into the blocks whose distance from its own block is at most `reach` of the ordering, in every ordering;
candidates are reranked by their exact inner products in double precision and merged. So that nearness on the curve
means a large inner product whatever the norms, vectors get a further component sqrt(max norm^2 - norm^2), queries 0.

`reach` is a share of the vectors, not a number, as data without any structure (the test vectors are nearly isotropic in
64 dimensions) needs that at every size: a share v looked into by all orderings together gives a recall of somewhat
more than v. For structured data a smaller reach does.

Equal vectors are one vector with its `k + 1` smallest ids, gathered through partial lists; that is all that a result
can need, since ties go to the smaller id. Queries with equal vectors are searched once.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, as queries or as
candidates, nor do those of another length than most have (of equally frequent lengths the largest counts), as inner products need equal lengths; rows that share a vec_id but not the vector are candidates each; null
vec_id takes no part; with fewer than k candidates all are returned; empty tables give empty results; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import _bytes as B
from ledgerlight.session import cut, shuffle_width

DIMS, BITS = 8, 6


def hilbert_keys(coords: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows) with `bits` bits a coordinate; dims * bits <= 63."""
    x = coords.T.astype(np.uint64)
    dims = len(x)
    step = 1 << (bits - 1)
    while step > 1:  # undo the rotations and reflections of the sub-cubes, from the largest on
        low, bit = np.uint64(step - 1), np.uint64(step)
        for i in range(dims):
            mirrored = (x[i] & bit) > 0
            swap = np.where(mirrored, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(mirrored, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        step >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    step = 1 << (bits - 1)
    while step > 1:
        flip = np.where((x[-1] & np.uint64(step)) > 0, flip ^ np.uint64(step - 1), flip)
        step >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


class Orderings:
    """The rotations, shifts and scale; keys of vectors under each of them."""

    def __init__(self, dim: int, count: int, scale: float, norm: float, seed: int):
        rng = np.random.default_rng(seed)
        wide = max(dim + 1, DIMS)
        self.turns = [np.linalg.qr(rng.normal(size=(wide, wide)))[0][: dim + 1, :DIMS] for _ in range(count)]
        self.shifts = rng.random((count, DIMS))
        self.scale, self.norm = max(scale, 1e-300), norm

    def keys(self, x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.norm**2 - (x * x).sum(1)))
        out = np.empty((len(self.turns), len(x)), np.int64)
        for i, (turn, shift) in enumerate(zip(self.turns, self.shifts, strict=True)):
            cells = (np.hstack([x, extra[:, None]]) @ turn / self.scale + 3 + shift) / 7 * (1 << BITS)
            out[i] = hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1).astype(np.int64), BITS)
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long packed float64 vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _packed(column: pa.ListArray) -> list[bytes]:
    """Equally long vectors as bytes; -0.0 becomes 0.0."""
    raw = (column.flatten().to_numpy(zero_copy_only=False) + 0.0).tobytes()
    width = len(raw) // len(column) if len(column) else 0
    return [raw[i * width : (i + 1) * width] for i in range(len(column))]


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite numbers."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, ok) & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(key, vector, ids): distinct vectors, packed, with their `keep` smallest ids."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column(0).to_pylist(), _packed(batch.column(1)), strict=True):
                found.setdefault(v, []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([sorted(x)[:keep] for x in found.values()], pa.list_(pa.int64()))], ["vector", "ids"])

    some = rows.mapInArrow(partial, "vector binary, ids array<long>").withColumn("key", F.xxhash64("vector"))
    # twice, so that the lists of one vector don't all meet in one place at once
    for salt in (F.pmod(F.xxhash64(F.element_at("ids", 1)), F.lit(32)), F.lit(0)):
        some = some.groupBy("key", "vector", salt.alias("salt")).agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids")).drop("salt")
    return some


def _placed(vectors: DataFrame, plan, query: bool) -> DataFrame:
    """(ordering, block, key, vector): a vector in its block of each ordering; queries in all blocks that they look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orderings, bounds, blocks, near = plan.value
        for batch in batches:
            x, own = _matrix(batch.column(1)), batch.column(0).to_numpy()
            if not len(x):
                continue
            for o, keys in enumerate(orderings.keys(x, query)):
                pairs = np.rec.fromarrays([keys, own], dtype=bounds[o].dtype)
                block = np.searchsorted(bounds[o], pairs)
                if query:
                    shift = np.arange(-near, near + 1)
                    # at an end of the curve the window is moved inwards, so that it is as large as elsewhere
                    middle = np.clip(block, near, max(near, blocks - 1 - near))
                    look = middle[:, None] + shift
                    row, col = np.nonzero((look >= 0) & (look < blocks))
                    block, rows = look[row, col], row
                else:
                    rows = np.arange(len(x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), o), pa.int32()), pa.array(block.astype(np.int32)), batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))],
                    ["ordering", "block", "key", "vector"],
                )

    return vectors.select("key", "vector").mapInArrow(run, "ordering int, block int, key long, vector binary")


def nearest_in(q: np.ndarray, x: np.ndarray, order: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows of x with the k largest inner products (ties: all at the edge), and these products.

    A matrix product only picks; the products are then made row by row, so that equal vectors have equal products.
    """
    out = []
    for a in range(0, len(q), 256):
        rough = q[a : a + 256] @ x.T
        edge = np.partition(rough, max(0, x.shape[0] - k), axis=1)[:, max(0, x.shape[0] - k)]
        for i in range(len(rough)):
            rows = np.flatnonzero(rough[i] >= edge[i] - 1e-9 * max(1.0, abs(edge[i])))
            exact = (q[a + i] * x[rows]).sum(1)
            best = np.lexsort((order[rows], -exact))[:k]
            out.append((rows[best], exact[best]))
    return out


def search(
    vectors: DataFrame,
    queries: Column,
    *,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    orderings: int = 10,
    reach: float = 0.06,
    block_rows: int = 2000,
    sample: int = 20_000,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which `queries` is true."""
    spark = vectors.sparkSession
    B.workers_import(spark)
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), queries.alias("asked"))
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = lengths[0]["dim"] if lengths else 0
    rows = rows.where(F.size("vector") == dim)
    base = cut(distinct_vectors(rows.select("id", "vector"), k + 1))
    n = base.count()
    norms = rows.select(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x).alias("n2")).agg(F.max("n2"), F.avg("n2")).first()
    top, mean = norms[0] or 1.0, norms[1] or 1.0
    turned = Orderings(dim, orderings, float(np.sqrt(mean / max(1, dim))), float(np.sqrt(top)), seed)
    blocks = max(1, min(max(40, -(-n // block_rows)), n // 32))
    # block boundaries from a bounded sample of keys: the smallest hashes, about `sample` of them
    picked = base.where(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 20)) < int(min(1.0, sample / max(1, n)) * (1 << 20)))
    got = picked.select("key", "vector").toArrow()
    x = _matrix(got["vector"].combine_chunks()) if got.num_rows else np.zeros((0, dim))
    kind = np.dtype([("at", np.int64), ("key", np.int64)])
    bounds = []
    for keys in turned.keys(x, False) if len(x) else np.zeros((orderings, 0), np.int64):
        pairs = np.sort(np.rec.fromarrays([keys, got["key"].to_numpy()], dtype=kind)) if len(keys) else np.zeros(0, kind)
        bounds.append(pairs[(np.arange(1, blocks) * len(pairs)) // blocks] if len(pairs) else np.zeros(0, kind))
    plan = spark.sparkContext.broadcast((turned, bounds, blocks, max(1, math.ceil(reach * blocks - 1e-9))))
    asked = rows.where("asked").select(F.col("id").alias("query_id"), "vector")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_packed(batch.column(1)), pa.binary())], ["query_id", "vector"])

    asked = cut(asked.mapInArrow(packed, "query_id long, vector binary").withColumn("key", F.xxhash64("vector")))
    targets = _placed(base, plan, False)
    probes = _placed(asked.select("key", "vector").dropDuplicates(["key", "vector"]), plan, True)

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        q_key, key, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if left.num_rows and right.num_rows:
            q, x = (_matrix(t["vector"].combine_chunks()) for t in (left, right))
            qk, xk = left["key"].to_numpy(), right["key"].to_numpy()
            for own, (at, s) in zip(qk, nearest_in(q, x, xk, k + 1), strict=True):
                q_key.append(np.full(len(at), own))
                key.append(xk[at])
                score.append(s)
        return pa.table([pa.array(np.concatenate(c)) for c in (q_key, key, score)], ["q_key", "key", "score"])

    found = probes.groupBy("ordering", "block").cogroup(targets.groupBy("ordering", "block")).applyInArrow(rerank, "q_key long, key long, score double")

    def merge(table: pa.Table) -> pa.Table:
        qk, key, score = (table[c].to_numpy() for c in ("q_key", "key", "score"))
        order = np.lexsort((key, -score, qk))
        qk, key, score = qk[order], key[order], score[order]
        fresh = np.ones(len(qk), bool)
        fresh[1:] = (qk[1:] != qk[:-1]) | (key[1:] != key[:-1])
        qk, key, score = qk[fresh], key[fresh], score[fresh]
        first, size = B.runs(qk)
        # those that tie with the last of the first k + 1 stay, as their ids decide
        last = np.repeat(score[first + np.minimum(size, k + 1) - 1], size)
        keep = score >= last
        return pa.table([pa.array(qk[keep]), pa.array(key[keep]), pa.array(score[keep])], ["q_key", "key", "score"])

    slots = 4 * shuffle_width(spark)
    best = found.groupBy(F.pmod(F.xxhash64("q_key"), F.lit(slots))).applyInArrow(merge, "q_key long, key long, score double")
    named = best.join(base.select("key", "ids"), "key").select("q_key", F.explode("ids").alias("vec_id"), "score")
    lists = named.groupBy("q_key").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k + 1).alias("near"))
    result = asked.join(lists, F.col("key") == F.col("q_key"))
    own = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    ranked = result.select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))
