"""Exact top-k search by inner product: bounds from segment means and deviations, coarse to fine, then exact products for what survives."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K, SCALE, EVERY = 5, 256, 50
#: Queries that are broadcast at once (a few MB), rows of a chunk, and segments of each level.
BLOCK, CHUNK, LEVELS = 16384, 4096, (1, 4, 16)
#: Below this part of survivors their products are computed one by one, above as one matrix product.
SPARSE = 0.02


def _stats(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means and root sums of squared deviations of each row's segments, and the segments' lengths."""
    cuts = np.unique(np.linspace(0, x.shape[1], min(segments, max(1, x.shape[1])) + 1).astype(int))
    size = np.diff(cuts)
    if not len(size):
        return np.zeros((len(x), 0)), np.zeros((len(x), 0)), size
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
    square = np.add.reduceat(x * x, cuts[:-1], axis=1) - size * mean * mean
    return mean, np.sqrt(np.maximum(square, 0)), size


def _bound(q: tuple, v: tuple, i=None, j=None) -> np.ndarray:
    """An upper bound of the inner product (so a lower bound of the distance): in each segment the means' part, and Cauchy-Schwarz for the rest."""
    a, b = np.hstack([q[0] * q[2], q[1]]), np.hstack([v[0], v[1]])
    x = a @ b.T if i is None else np.einsum("ij,ij->i", a[i], b[j])
    return x + 1e-9 * np.abs(x) + 1e-3


def _exact(q: np.ndarray, v: np.ndarray, pairs=None) -> np.ndarray:
    """Inner products of whole numbers: as doubles where no sum can pass 2**53, else as Python's integers, cut to 64 bits."""
    if q.size == 0 or v.size == 0 or q.shape[1] * np.abs(q).max() * np.abs(v).max() < 2.0**53:
        out = q @ v.T if pairs is None else np.einsum("ij,ij->i", q[pairs[0]], v[pairs[1]])
        return out.astype(np.int64)
    big = [[[int(x) for x in r] for r in m] for m in (q, v)]
    one = lambda a, b: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
    if pairs is None:
        return np.array([[one(a, b) for b in big[1]] for a in big[0]], np.int64).reshape(len(q), len(v))
    return np.array([one(big[0][a], big[1][b]) for a, b in zip(*pairs)], np.int64)


class _Best:
    """The k highest scores of each query so far, ties to smaller vec_id, and the k-th of them."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, np.iinfo(np.int64).min)
        self.q, self.s, self.v = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, q, s, v) -> None:
        q, s, v = np.concatenate([self.q, q]), np.concatenate([self.s, s]), np.concatenate([self.v, v])
        order = np.lexsort((v, -s, q))  # -s of the least int64 stays the least: such a score never comes first
        q, s, v = q[order], s[order], v[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        self.q, self.s, self.v = (x[rank < self.k] for x in (q, s, v))
        last = rank[rank < self.k] == self.k - 1
        self.floor[self.q[last]] = self.s[last]


def _distinct(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct rows, each with its k + 1 smallest ids (one of them may be the query's own)."""
    rows, inverse = np.unique(x, axis=0, return_inverse=True) if x.shape[1] else (x[:1], np.zeros(len(x), np.int64))
    order = np.lexsort((ids, inverse.ravel()))
    cuts = np.searchsorted(inverse.ravel()[order], np.arange(len(rows) + 1))
    return rows, [ids[order[a : min(b, a + k + 1)]] for a, b in zip(cuts[:-1], cuts[1:])]


def _scan(best: _Best, qid: np.ndarray, q: np.ndarray, levels: list, ids: np.ndarray, x: np.ndarray) -> None:
    rows, owners = _distinct(ids, x, best.k)
    alive = None
    for segments, own in zip(LEVELS, levels):
        if (best.floor == np.iinfo(np.int64).min).any():
            break  # nothing to compare with yet
        v = _stats(rows, segments)
        if alive is None:
            alive = np.nonzero(_bound(own, v) >= best.floor[:, None])
        else:
            keep = _bound(own, v, *alive) >= best.floor[alive[0]]
            alive = alive[0][keep], alive[1][keep]
        if len(alive[0]) > SPARSE * len(q) * len(rows):
            if segments == LEVELS[-1]:
                break
            alive = None if len(alive[0]) > 0.5 * len(q) * len(rows) else alive
    if alive is None or len(alive[0]) > SPARSE * len(q) * len(rows):
        s = _exact(q, rows)
        enough = len(rows) > best.k
        kth = np.partition(s, len(rows) - best.k - 1, axis=1)[:, len(rows) - best.k - 1] if enough else best.floor
        a, b = np.nonzero(s >= np.maximum(best.floor, kth)[:, None])
        s = s[a, b]
    else:
        a, b = alive
        s = _exact(q, rows, alive)
        on = s >= best.floor[a]
        a, b, s = a[on], b[on], s[on]
    counts = np.array([len(o) for o in owners], np.int64)
    flat, at = np.concatenate(owners), np.concatenate([[0], np.cumsum(counts)])
    n = counts[b]
    a, s, pos = np.repeat(a, n), np.repeat(s, n), np.repeat(at[b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    v = flat[pos]
    other = v != qid[a]
    best.add(a[other], s[other], v[other])


def search(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """queries and vectors: (vec_id, embedding). For each query the k highest inner products of floor(scale * x), ties to smaller vec_id.

    A vector that is null or holds null or non-finite components takes no part, nor one without vec_id; a query meets candidates of
    its own length and other vec_id. Repeated candidate rows count each; of queries with one vec_id the least embedding asks. Products
    beyond 64 bits are cut to the nearest. Queries are read once and go in blocks of a set size, one after another: a block is broadcast over
    all rows, of which each task keeps k a query, and is dropped again. Other columns are left out.
    """
    spark = vectors.sparkSession
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    work = common.shared_dir(spark)
    asked = queries.where(sound).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
    asked = common.table(asked.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")), f"{work}/asked")
    blocks = -(-asked.count() // block) or 1
    rows = vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = None
    for n in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).collect()
        lengths = sorted({len(r["embedding"]) for r in chosen})
        own = []
        for d in lengths:
            same = [r for r in chosen if len(r["embedding"]) == d]
            own.append((d, np.array([r["vec_id"] for r in same], np.int64), np.floor(scale * np.array([r["embedding"] for r in same], float).reshape(len(same), d))))
        shared = spark.sparkContext.broadcast(own)

        def task(batches, shared=shared):
            groups = {d: (qid, q, [_stats(q, s) for s in LEVELS], _Best(len(qid), k), []) for d, qid, q in shared.value}

            def chunk(g):
                ids, x = np.concatenate([y[0] for y in g[4]]), np.concatenate([y[1] for y in g[4]])
                g[4].clear()
                for i in range(0, len(ids), CHUNK):
                    _scan(g[3], g[0], g[1], g[2], ids[i : i + CHUNK], x[i : i + CHUNK])

            for batch in batches:
                ids, lists = batch.column(0).to_numpy(), batch.column(1)
                size = lists.value_lengths().to_numpy()
                for d in groups.keys() & set(size.tolist()):
                    on = np.flatnonzero(size == d)
                    x = lists.take(pa.array(on)).flatten().to_numpy(zero_copy_only=False).reshape(len(on), d)
                    groups[d][4].append((ids[on], np.floor(scale * x)))
                    if sum(len(y[0]) for y in groups[d][4]) >= CHUNK:
                        chunk(groups[d])
            for g in groups.values():
                if g[4]:
                    chunk(g)
                b = g[3]
                yield pa.RecordBatch.from_arrays([pa.array(g[0][b.q], pa.int64()), pa.array(b.v, pa.int64()), pa.array(b.s, pa.int64())], ["query_id", "vec_id", "score"])

        found = rows.mapInArrow(task, "query_id long, vec_id long, score long").withColumn("rank", rank).where(F.col("rank") <= k)
        found = common.table(found.select("query_id", "rank", "vec_id", "score"), f"{work}/part{n}", CHUNK)
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.source(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % EVERY == 0))


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.e) = len(v.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
