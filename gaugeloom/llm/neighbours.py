"""Nearest neighbours by inner product with collision-counting hashing.

Each block of vectors keeps one sorted array per random projection. A query's
window in an array is centred on its own projection; a vector whose projections
fall into the windows of at least ``threshold`` arrays is verified by its exact inner product. If
too few vectors have been verified, all windows are widened (virtual rehashing:
the same sorted arrays serve every radius) until enough are found.

Vectors are lengthened by one component so that all have the length of the
longest; then the nearest by distance have the largest inner product. For this they
are scaled by a power of two, so that no finite vector overflows or vanishes as a whole; scores are of the vectors as they are.

Vectors and queries are dealt into blocks by a hash, and each block of vectors
meets each block of queries in a task of its own. A task returns the best of every
query, and these few rows are ranked per query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloom.llm.common import partitions

PROJECTIONS = 128
#: Collisions from which on a vector is verified.
THRESHOLD = 91
#: Share of a block that is verified before a search ends, and how many there are at least for each neighbour asked for
#: (over all blocks that is; the more blocks there are, the fewer of the nearest lie in one).
SHARE = 0.05
AT_LEAST = 40
#: Half-width of the first windows in standard deviations of the projections, and how much each round widens them.
FIRST = 1.2
WIDEN = 1.05
BLOCK = 8192
QUERIES = 2048
SEED = 20


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    d = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(d, lambda x: F.coalesce(x != 0, F.lit(False)))


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def _collisions(order: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """In how many arrays each vector lies in the window; counted from whichever side of the borders holds less."""
    arrays, n = order.shape
    if 2 * int((high - low).sum()) <= arrays * n:
        return np.bincount(np.concatenate([o[a:b] for o, a, b in zip(order, low, high, strict=True)]), minlength=n)
    outside = [o[:a] for o, a in zip(order, low, strict=True)] + [o[b:] for o, b in zip(order, high, strict=True)]
    return arrays - np.bincount(np.concatenate(outside), minlength=n)


def _candidates(arrays: np.ndarray, order: np.ndarray, centres: np.ndarray, unit: float, enough: int, threshold: int) -> list[np.ndarray]:
    """For each query (a column of ``centres``) the numbers of the vectors that collide with it often enough."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * centres.shape[1]
    width, waiting = FIRST * unit, np.arange(centres.shape[1])
    while len(waiting):
        own = centres[:, waiting]
        low = np.stack([np.searchsorted(a, c - width) for a, c in zip(arrays, own, strict=True)])
        high = np.stack([np.searchsorted(a, c + width, side="right") for a, c in zip(arrays, own, strict=True)])
        few = []
        for at, q in enumerate(waiting.tolist()):
            out[q] = np.flatnonzero(_collisions(order, low[:, at], high[:, at]) >= threshold)
            if len(out[q]) < enough:
                few.append(q)
        waiting, width = np.array(few, dtype=np.int64), width * WIDEN
    return out


def _directions(queries: np.ndarray) -> np.ndarray:
    """Queries of length one; the largest component is taken out first, as squares may not be finite."""
    own = queries / np.abs(queries).max(axis=1, keepdims=True)
    return own / np.linalg.norm(own, axis=1, keepdims=True)


def projected(vectors: np.ndarray, queries: np.ndarray, longest: float, projections: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted arrays, the order that sorts them, and the centres of the queries' windows."""
    axes = np.random.default_rng(SEED).standard_normal((projections, vectors.shape[1] + 1))
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    cast = axes[:, :-1] @ vectors.T + axes[:, -1:] * rest
    order = np.argsort(cast, axis=1)
    # Only the direction of a query matters, so it is brought to the common length.
    return np.take_along_axis(cast, order, axis=1), order, axes[:, :-1] @ (_directions(queries) * longest).T


def enough_of(n: int, blocks: int, k: int, share: float = SHARE) -> int:
    """How many vectors of a block of ``n`` are verified at least."""
    return min(n, max(math.ceil(AT_LEAST * (k + 1) / math.sqrt(blocks)), math.ceil(share * n)))


def _search(k: int, blocks: int, size: int, longest: float, scale: float, projections: int, threshold: int, share: float):
    def each(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return kind.empty_table()
        ids, vectors = left.column("vec_id").to_numpy(), _matrix(left.column("embedding"), size)
        query_ids, queries = right.column("vec_id").to_numpy(), _matrix(right.column("embedding"), size)
        arrays, order, aimed = projected(vectors * scale, queries, longest, projections)
        enough = enough_of(len(ids), blocks, k, share)
        rows = []
        for q, found, query in zip(query_ids.tolist(), _candidates(arrays, order, aimed, longest, enough, threshold), queries, strict=True):
            found = found[ids[found] != q]
            with np.errstate(over="ignore", invalid="ignore"):
                score = np.nan_to_num(vectors[found] @ query, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            if len(score) > k:  # all that tie with the last one stay until ties are broken
                near = score >= np.partition(score, -k)[-k]
                found, score = found[near], score[near]
            best = np.lexsort((ids[found], -score))[:k]
            rows.append((np.full(len(best), q), ids[found][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kind.types, strict=True)], schema=kind)

    return each


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, projections: int = PROJECTIONS, threshold: int = THRESHOLD, share: float = SHARE
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of ``vectors`` to each row of ``queries``.

    Both have vec_id and embedding (array of numbers); other columns are
    ignored. Nearness is the largest inner product in double precision, which may be infinite (one that is no number ranks last); equal ones go
    by the smaller vec_id. A row never finds its own vec_id. Vectors that are
    null, zero or hold null, NaN or infinity take no part, nor do rows with a null vec_id. Rows with
    the same vec_id are one entry, the first in order of their vectors. All vectors
    need the same length, else it is an error. An empty table gives an empty result.
    """
    spark = vectors.sparkSession

    def fit(df: DataFrame) -> DataFrame:
        own = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
        return own.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))

    base, asked = fit(vectors), fit(queries)
    largest = F.max(F.array_max(F.transform("embedding", F.abs)))
    n, size, smallest, top = base.agg(F.count(F.lit(1)), F.max(F.size("embedding")), F.min(F.size("embedding")), largest).first()
    schema = "query_id long, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size != smallest:
        raise ValueError(f"vectors of {smallest} and {size} components")
    scale = 2.0 ** max(-1000, min(1000, -math.frexp(top)[1]))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + (x * scale) * (x * scale))
    longest = math.sqrt(base.agg(F.max(square)).first()[0])
    m = asked.count()
    blocks, groups = -(-n // block), max(1, -(-m // QUERIES))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    left = base.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("b"), every(groups).alias("g"))
    right = asked.select("vec_id", "embedding", every(blocks).alias("b"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g"))
    found = left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInArrow(_search(k, blocks, size, longest, scale, projections, threshold, share), schema)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.repartition(partitions(spark), "query_id").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
