"""Approximate nearest neighbours: multi-index hashing of learned rotated binary codes.

Vectors become binary codes by the signs of learned rotations (iterative quantisation). For
largest inner products, vectors are first scaled by the largest norm and lifted onto the unit
sphere by one more component; a query has none of it, so the angle orders by inner product.

Codes are cut into substrings, and each substring is an index from its values to the codes
that have them. Two codes within Hamming distance ``r`` differ by at most ``r // m`` bits in
at least one of ``m`` substrings (pigeonhole), so probing every value within that distance
in every index retrieves every code within the radius. Those are reranked by the exact inner
product of the original vectors, in double precision, component by component. Queries that
find fewer than ``k`` that way are searched again without a radius.

All rows are indexed, in blocks of bounded size; all queries probe all blocks, in blocks of
bounded size. What a cell of queries and rows sends on is at most ``k`` rows per query, so a
dense group of vectors costs no more than any other.

The rotations and the radius are learned from a bounded sample: the ``SAMPLE`` vectors with
the smallest hashes of their ids, some of them as queries. The radius is the one that holds
``CONFIDENCE`` of their true neighbours within the sample; in more data neighbours are nearer.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have not
the most frequent length (the smaller, if tied) take no part, nor do rows without an id. Rows
equal in id and vector count once. Rows that repeat an id with unlike vectors are candidates
each, also of one another; the query of such an id is its smallest vector. Ties go to the
smaller id. Other columns are neither read nor returned. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import python_workers, written

BITS, SUBSTRINGS = 256, 16
SAMPLE, SAMPLE_QUERIES, CONFIDENCE, SWEEPS = 8192, 256, 0.97, 15
#: Rows and queries of a cell.
ROWS, QUERIES = 8192, 1024
_POP = np.bitwise_count(np.arange(1 << 16, dtype=np.uint16))


@dataclass(frozen=True)
class Index:
    rotation: np.ndarray  # (dimensions + 1, BITS)
    norm: float  # the largest of all rows
    radius: int

    def codes(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        x = vectors / self.norm
        up = np.zeros(len(x)) if queries else np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))
        signs = np.column_stack([x, up]) @ self.rotation > 0
        return np.packbits(signs, axis=1).view(np.uint16)


def learned_rotation(sample: np.ndarray, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """Orthogonal rotations side by side, each fitted to make the signs of the sample lossless."""
    d = sample.shape[1]
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(-(-bits // d)):
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(SWEEPS if len(sample) else 0):
            u, _, v = np.linalg.svd(np.sign(sample @ turn).T @ sample)
            turn = (u @ v).T
        parts.append(turn)
    return np.concatenate(parts, axis=1)[:, :bits]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all codes in ``a`` to all in ``b``."""
    out = np.zeros((len(a), len(b)), np.uint16)
    wide_a, wide_b = a.view(np.uint64), b.view(np.uint64)
    for k in range(wide_a.shape[1]):
        out += np.bitwise_count(wide_a[:, k, None] ^ wide_b[None, :, k])
    return out


def probe(queries: np.ndarray, rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a row whose codes are within ``radius``."""
    if radius >= 16 * rows.shape[1]:
        return tuple(x.ravel() for x in np.indices((len(queries), len(rows))))
    near = radius // rows.shape[1]
    candidates = np.zeros((len(queries), len(rows)), bool)
    for k in range(rows.shape[1]):
        values, bucket = np.unique(rows[:, k], return_inverse=True)  # the index of substring k
        wanted, asked = np.unique(queries[:, k], return_inverse=True)
        within = _POP[wanted[:, None] ^ values[None, :]] <= near  # the values to probe
        if within.any():
            candidates |= within[:, bucket][asked]
    q, r = np.nonzero(candidates)
    apart = np.bitwise_count(queries.view(np.uint64)[q] ^ rows.view(np.uint64)[r]).sum(axis=1)
    close = apart <= radius
    return q[close], r[close]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed component by component in double precision."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best rows of each query."""
    order = np.lexsort((ids, -score, q))
    starts = np.flatnonzero(np.concatenate([[True], q[order][1:] != q[order][:-1]])) if len(order) else np.empty(0, int)
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[nth < k]


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that may take part, equal ones once."""
    good = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    return written(good.distinct(), "ann-vectors")


def train(vectors: DataFrame, k: int, bits: int = BITS, sample: int = SAMPLE) -> Index | None:
    """Rotations, norm and radius for ``vectors`` (vec_id, vector); None if there are none."""
    norm = vectors.agg(F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    if not norm:
        return None
    some = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).collect()
    x = np.array([r.vector for r in some])
    plain = Index(np.empty((0, 0)), norm * (1 + 1e-12), bits)
    scaled = x / plain.norm
    lifted = np.column_stack([scaled, np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))])
    index = Index(learned_rotation(lifted, bits), plain.norm, bits)
    asked = x[:SAMPLE_QUERIES]
    dots = asked @ x.T
    np.fill_diagonal(dots, -np.inf)
    n = min(k, len(x) - 1)
    if n < 1:
        return index
    top = np.argpartition(-dots, n - 1, axis=1)[:, :n]
    apart = distances(index.codes(asked, True), index.codes(x, False))
    radius = int(np.quantile(np.take_along_axis(apart, top, axis=1), CONFIDENCE, method="higher"))
    return Index(index.rotation, index.norm, radius)


def _search(queries: DataFrame, vectors: DataFrame, index: Index, radius: int, k: int, blocks: int, query_blocks: int) -> DataFrame:
    """The best rows of every query within the radius, by cell of the grid of blocks."""

    def cell(table: pa.Table) -> pa.Table:
        asked = table.column("asked").to_numpy()
        ids = table.column("vec_id").to_numpy()
        x = np.stack(table.column("vector").to_numpy()) if len(ids) else np.empty((0, 0))
        out = {"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)}
        if asked.any() and not asked.all():
            q, r = x[asked], x[~asked]
            q_ids, r_ids = ids[asked], ids[~asked]
            found = [probe(index.codes(q[a : a + 128], True), index.codes(r, False), radius) for a in range(0, len(q), 128)]
            parts = []
            for a, (i, j) in zip(range(0, len(q), 128), found):
                i = i + a
                other = q_ids[i] != r_ids[j]
                same = np.flatnonzero(~other)
                other[same] = (q[i[same]] != r[j[same]]).any(axis=1)
                i, j = i[other], j[other]
                score = products(q[i], r[j])
                top = best(i, r_ids[j], score, k)
                parts.append((q_ids[i[top]], r_ids[j[top]], score[top]))
            out = dict(zip(out, (np.concatenate(p) for p in zip(*parts))))
        return pa.table(out)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    rows = vectors.select(F.lit(False).alias("asked"), "vec_id", "vector", own(blocks).alias("block"), every(query_blocks).alias("query_block"))
    asks = queries.select(F.lit(True).alias("asked"), "vec_id", "vector", every(blocks).alias("block"), own(query_blocks).alias("query_block"))
    return rows.unionByName(asks).groupBy("block", "query_block").applyInArrow(cell, "query_id long, vec_id long, score double")


def neighbours(rows: DataFrame, wanted: Column, k: int, bits: int = BITS, radius: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row where ``wanted`` holds."""
    spark = rows.sparkSession
    python_workers(spark)
    everyone = usable(rows)
    lengths = everyone.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not lengths:
        return empty
    vectors = everyone.where(F.size("vector") == lengths[0].length)
    n, n_queries = vectors.agg(F.count("*"), F.countDistinct(F.when(wanted, F.col("vec_id")))).first()
    index = train(vectors, k, bits)
    if index is None or not n_queries:
        return empty
    queries = written(vectors.where(wanted).groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-queries")
    blocks, query_blocks = -(-n // ROWS), -(-n_queries // QUERIES)
    reach = index.radius if radius is None else radius
    found = written(_search(queries, vectors, index, reach, k, blocks, query_blocks), "ann-found")
    counts = found.groupBy("query_id").agg(F.count("*").alias("n"))
    short = queries.join(counts, F.col("vec_id") == F.col("query_id"), "left").where(F.coalesce("n", F.lit(0)) < min(k, n - 1))
    short = written(short.select("vec_id", "vector"), "ann-short")
    n_short = short.count()
    if n_short:
        again = _search(short, vectors, index, bits, k, blocks, -(-n_short // QUERIES))
        found = found.join(short, F.col("query_id") == short["vec_id"], "left_anti").unionByName(again)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
