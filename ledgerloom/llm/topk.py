"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... equal segments.  With the mean and deviation of each segment,
``sum of length * (mean * mean' + deviation * deviation')`` is never below the inner product (and
the matching expression never above the distance): Cauchy and Schwarz on what is left when the
means are taken out.  At every resolution the bound of all pairs is one small matrix product.

Queries and rows are dealt out in blocks; one task holds one block of each.  It scores the rows
with the best coarse bounds exactly, which gives every query a score to beat, then drops pairs
whose bound is below it, coarse to fine, and computes the survivors exactly.  Each block returns
its best ``k`` for each query, and these are merged.  Nothing is dropped but by a bound, so the
result is exact.  Block sizes are fixed, so memory does not grow with the table.

Rows whose vector is null, or holds a null or non-finite component, take no part.  Vectors of
unequal length count as filled up with zeros.  A query's own row is no candidate; another row with
the same id is.  A null id is a candidate (after all others in a tie), never a query.  Empty tables
give no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, tasks
from .registry import named, table

#: Rows of one block, and queries of one block.
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 1_024
SEGMENTS = (1, 4, 16)
#: With a larger share of the pairs left, a bound is one matrix product, else it is taken pair by pair.
_DENSE = 0.1
_LAST = np.iinfo(np.int64).max


def finite_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows that take part, each with a number of its own (row) and its components as doubles."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v")
    ).filter(F.col("v").isNotNull() & ~bad)


def packed(df: DataFrame, wide: int, kind: str) -> DataFrame:
    """The array ``v`` as bytes of ``wide`` numbers, filled up with zeros."""
    schema = "row long, vec_id long, v binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [np.asarray(x, "f8") for x in b.column(2).to_pylist()]
            full = [np.pad(x, (0, wide - len(x))).astype(kind).tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(full, pa.binary())], ["row", "vec_id", "v"])

    return df.mapInArrow(pack, schema)


def matrix(values: pd.Series, kind: str, wide: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), wide)


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that a plain product of two gives the bound."""
    wide = x.shape[1]
    cuts = np.linspace(0, wide, min(segments, max(wide, 1)) + 1).astype(int)[:-1]
    lengths = np.diff(np.append(cuts, wide))
    sums = np.add.reduceat(x, cuts, axis=1)
    squares = np.add.reduceat(x * x, cuts, axis=1)
    means = sums / lengths
    rest = np.sqrt(np.maximum(squares - sums * means, 0))
    return np.hstack([means * np.sqrt(lengths), rest])


def best_in_block(q: np.ndarray, x: np.ndarray, same: np.ndarray, order: np.ndarray, k: int, segments=SEGMENTS):
    """Indices (query, row) and scores of each query's best ``k`` rows of the block.

    ``same`` holds for each query the index of its own row in the block, or -1; ``order`` is the
    rank of the rows' ids.
    """
    qf, xf = q.astype("f8"), x.astype("f8")
    # Rounding errors of the bounds: a margin far above what the products can lose, as one more term.
    q_margin, x_margin = 1e-9 * np.sqrt((qf * qf).sum(1, keepdims=True)), np.sqrt((xf * xf).sum(1, keepdims=True))
    alive = np.ones((len(q), len(x)), bool)
    own = np.nonzero(same >= 0)[0]
    alive[own, same[own]] = False
    # What is below the worst of k candidates cannot be among the best k.
    lowest = np.iinfo(np.int64).min
    to_beat = np.full(len(q), lowest)
    for s in segments:
        a, b = np.hstack([segment_features(qf, s), q_margin]), np.hstack([segment_features(xf, s), x_margin])
        if alive.mean() > _DENSE:
            bound = a @ b.T + 1e-6
            bound[~alive] = -np.inf
            if len(x) >= k:
                seed = np.argpartition(bound, -k, axis=1)[:, -k:]
                exact = np.einsum("qkd,qd->qk", x[seed], q)
                exact[np.isneginf(np.take_along_axis(bound, seed, 1))] = lowest
                to_beat = np.maximum(to_beat, exact.min(1))
            alive &= bound >= to_beat[:, None]
        else:
            qi, xi = np.nonzero(alive)
            for lo in range(0, len(qi), 500_000):
                i, j = qi[lo : lo + 500_000], xi[lo : lo + 500_000]
                alive[i, j] = np.einsum("nd,nd->n", a[i], b[j]) + 1e-6 >= to_beat[i]
    qi, xi = np.nonzero(alive)
    score = np.empty(len(qi), np.int64)
    for lo in range(0, len(qi), 500_000):
        i, j = qi[lo : lo + 500_000], xi[lo : lo + 500_000]
        score[lo : lo + 500_000] = np.einsum("nd,nd->n", q[i], x[j])
    best = np.lexsort((order[xi], -score, qi))
    qi, xi, score = qi[best], xi[best], score[best]
    starts = np.searchsorted(qi, np.arange(len(q)))
    keep = np.arange(len(qi)) - starts[qi] < k
    return qi[keep], xi[keep], score[keep]


def topk(df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` best rows by the integer inner product of
    ``floor(scale * component)``, ties to the smaller id.  Scores must fit 64 bits."""
    valid = stage(finite_vectors(df, vec_id, vector))
    figures = valid.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count(F.when(is_query, 1))).first()
    rows, wide, n_queries = figures[0], max(figures[1] or 0, 1), figures[2]
    n_row_blocks = max(2 * tasks(df), -(-rows // BLOCK_ROWS))
    n_query_blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    whole = valid.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    vectors = packed(whole, wide, "<i8")
    spread = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    everyone = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    x = vectors.withColumn("rb", spread(n_row_blocks)).withColumn("qb", everyone(n_query_blocks))
    q = vectors.filter(is_query).withColumn("qb", spread(n_query_blocks)).withColumn("rb", everyone(n_row_blocks))

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        a, b = matrix(queries["v"], "<i8", wide), matrix(block["v"], "<i8", wide)
        rows = pd.Index(block["row"])
        same = rows.get_indexer(queries["row"])
        ids = block["vec_id"].astype("Int64").fillna(_LAST).to_numpy(np.int64)
        order = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
        qi, xi, score = best_in_block(a, b, same, order, k)
        return pd.DataFrame(
            {
                "query": queries["row"].to_numpy()[qi],
                "query_id": queries["vec_id"].to_numpy()[qi],
                "vec_id": block["vec_id"].astype("Int64").array[xi],
                "score": score,
            }
        )

    found = q.groupBy("qb", "rb").cogroup(x.groupBy("qb", "rb")).applyInPandas(search, "query long, query_id long, vec_id long, score long")
    return merged(found, k)


def merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query out of those of its blocks."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(list_zip(q.e, x.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@named("op10_topk", _SQL)
def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)
