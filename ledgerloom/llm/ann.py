"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product.  Vectors are divided by the largest norm and get one more component
that fills each up to norm one; queries are made unit vectors.  Then the nearest in Euclidean
distance, for which Gaussian projections are the 2-stable hash, has the largest inner product.

Each of ``TABLES`` tables cuts ``HASHES`` random projections into cells; the cells of a vector are
its bucket.  A query visits its own bucket and perturbed ones (one cell down or up in some
projections) in the order of their estimated success: the sum of the squared distances to the cell
borders it would cross.  All candidates are scored exactly on the original vectors in double
precision, and the tables' answers are merged.

How many buckets are visited is measured, not set: ``SAMPLE`` queries, picked by a hash, are
answered exactly over all rows, in blocks, and the number of probes is the smallest that finds
``RECALL`` of their neighbours (at most all perturbations).  That sample and the widths of the
cells, from as many rows, are all that is fitted; every row is indexed.

Buckets are dealt to groups by hash; a bucket with more rows than a group has on average is dealt
out over several, and its queries go to each.  A query's vector is sent once to a group, with the
list of buckets it visits there, and a score that the k-th answer cannot be below: the k-th best
of a few thousand rows that all queries are compared with (candidates like all others).

Rows whose vector is null, zero, or holds a null or non-finite component take no part.  Vectors of
unequal length count as filled up with zeros.  A query's own row is no candidate; other rows with
the same id are.  A null id comes last in a tie.  Fewer rows than neighbours give all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, tasks
from .registry import named, table
from .topk import finite_vectors, matrix, merged, packed

TABLES, HASHES = 4, 8
#: Width of a cell, in deviations of the projections.
WIDTH = 2.0
SAMPLE, RECALL = 128, 0.97
#: Rows that every query is compared with first: their k-th best score is one that any answer beats.
FIRST_ROWS = 4096
_SEED = 17
_STEPS = np.array(list(product((0, -1, 1), repeat=HASHES)), np.int8)
_MIX = np.random.default_rng(23).integers(1, 2**62, HASHES, dtype=np.int64) * 2 + 1


class _Index:
    """The hash functions: the same everywhere, from a seed, the largest norm and the cell width."""

    def __init__(self, wide: int, largest: float, width: float):
        random = np.random.default_rng(_SEED)
        self.largest, self.width = largest, width
        self.directions = random.standard_normal((TABLES, wide + 1, HASHES))
        self.shifts = random.uniform(0, 1, (TABLES, HASHES))

    def unit(self, x: np.ndarray, query: bool) -> np.ndarray:
        if query:
            return np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True)), np.zeros((len(x), 1))])
        x = x / self.largest
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))])

    def cells(self, x: np.ndarray, t: int, query: bool = False) -> np.ndarray:
        return self.unit(x, query) @ self.directions[t] / self.width + self.shifts[t]

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (np.floor(cells).astype(np.int64) * _MIX).sum(-1)

    def costs(self, cells: np.ndarray) -> np.ndarray:
        """For each query and perturbation the estimate: smaller is more likely."""
        inside = cells - np.floor(cells)
        down, up = inside**2, (1 - inside) ** 2
        out = np.zeros((len(cells), len(_STEPS)))
        for i in range(HASHES):
            out += np.stack([np.zeros(len(cells)), down[:, i], up[:, i]], 1)[:, np.where(_STEPS[:, i] < 0, 1, _STEPS[:, i] * 2)]
        return out

    def probes(self, cells: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The buckets each query visits (query, rank)."""
        cost = self.costs(cells)
        order = np.argpartition(cost, n - 1, axis=1)[:, :n] if n < cost.shape[1] else np.arange(n)[None].repeat(len(cost), 0)
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(cost, order, 1), 1, kind="stable"), 1)
        base = np.floor(cells).astype(np.int64)
        with np.errstate(over="ignore"):
            steps = (_STEPS.astype(np.int64) * _MIX).sum(1)
            return (base * _MIX).sum(1)[:, None] + steps[order], order


def _exact_sample(vectors: DataFrame, sample: pd.DataFrame, wide: int, k: int) -> pd.DataFrame:
    """The exact nearest rows of the sampled queries: each task's best, then the best of those."""
    q, own = matrix(sample["v"], "<f8", wide), sample["row"].to_numpy()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, rows = matrix(b.column(2).to_pylist(), "<f8", wide), b.column(0).to_numpy()
            score = q @ x.T
            score[own[:, None] == rows[None]] = -np.inf
            n = min(k, len(rows))
            at = np.argpartition(-score, n - 1, axis=1)[:, :n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(q)), n)),
                    pa.array(rows[at].ravel()),
                    pa.array(np.take_along_axis(score, at, 1).ravel()),
                    pa.array([b.column(2)[i].as_py() for i in at.ravel()], pa.binary()),
                ],
                ["query", "row", "score", "v"],
            )

    found = vectors.mapInArrow(best, "query long, row long, score double, v binary").filter("score > '-Infinity'")
    first = Window.partitionBy("query").orderBy(F.desc("score"), "row")
    return found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k).select("query", "v").toPandas()  # SAMPLE * k rows


def _fit_probes(index: _Index, sample: pd.DataFrame, nearest: pd.DataFrame, wide: int, recall: float) -> int:
    """The smallest number of probes that reaches the recall on the sample."""
    if not len(nearest):
        return 1
    q, x = matrix(sample["v"], "<f8", wide), matrix(nearest["v"], "<f8", wide)
    of = nearest["query"].to_numpy()
    rank = np.full(len(of), len(_STEPS))
    for t in range(TABLES):
        cells = index.cells(q, t, True)
        step = np.floor(index.cells(x, t)).astype(np.int64) - np.floor(cells).astype(np.int64)[of]
        near = (np.abs(step) <= 1).all(1)
        _, order = index.probes(cells, len(_STEPS))
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None].repeat(len(order), 0), 1)
        code = np.zeros(len(of), np.int64)
        for i in range(HASHES):
            code = code * 3 + np.where(step[:, i] < 0, 1, np.where(step[:, i] > 0, 2, 0))
        rank = np.minimum(rank, np.where(near, place[of, np.where(near, code, 0)], len(_STEPS)))
    wanted = np.sort(rank)[min(len(rank) - 1, int(np.ceil(recall * len(rank))) - 1)]
    return int(min(len(_STEPS), wanted + 1))


def _runs(x: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal values start and stop."""
    if not len(x):
        return [], []
    first = np.nonzero(np.concatenate([[True], x[1:] != x[:-1]]))[0]
    return first.tolist(), np.append(first[1:], len(x)).tolist()


def nearest(
    df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` rows with the largest inner product found for each query."""
    rows = finite_vectors(df, vec_id, vector).filter(F.exists("v", lambda x: x != 0))
    rows = stage(rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))))
    n, wide, largest = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max("norm")).first()
    wide, largest = max(wide or 0, 1), largest or 1.0
    vectors = stage(packed(rows.select("row", "vec_id", "v"), wide, "<f8"))
    picked = F.xxhash64("row", F.lit(3))
    sample = vectors.filter(is_query).orderBy(picked, "row").limit(SAMPLE).toPandas()
    some = vectors.orderBy(picked, "row").limit(FIRST_ROWS).toPandas()
    index = _Index(wide, largest, 1.0)
    if len(some):
        spread = np.std([index.cells(matrix(some["v"], "<f8", wide), t) - index.shifts[t] for t in range(TABLES)])
        index.width = max(WIDTH * float(spread), 1e-12)
    probes = _fit_probes(index, sample, _exact_sample(vectors, sample, wide, k), wide, recall) if len(sample) else 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(2).to_pylist(), "<f8", wide)
            for t in range(TABLES):
                columns = [pa.array(np.full(len(x), t, np.int32)), pa.array(index.bucket(index.cells(x, t))), *b.columns]
                yield pa.RecordBatch.from_arrays(columns, ["tab", "bucket", "row", "vec_id", "v"])

    known, known_rows = matrix(some["v"], "<f8", wide), some["row"].to_numpy()
    groups = tasks(df)
    # Buckets larger than a group is on average: at most TABLES * groups of them.
    counts = vectors.mapInArrow(place, "tab int, bucket long, row long, vec_id long, v binary").groupBy("tab", "bucket").count()
    large = {(r["tab"], r["bucket"]): -(-r["count"] * groups // max(1, n)) for r in counts.filter(F.col("count") * groups > n).collect()}

    def group_of(bucket: np.ndarray, t: int, part: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (bucket.astype(np.uint64) + np.uint64(t + 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        return ((h >> np.uint64(33)).astype(np.int64) + part) % groups

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with the group their bucket, or their part of a large bucket, is in."""
        for b in place(batches):
            if b.num_rows:
                t, bucket, row = b.column(0)[0].as_py(), b.column(1).to_numpy(), b.column(2).to_numpy()
                parts = np.array([large.get((t, x), 1) for x in bucket.tolist()])
                group = group_of(bucket, t, (row * 0x2545F491 >> 16) % parts)
                yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), *b.columns], ["g", *b.schema.names])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the groups they visit, and there the tables and buckets."""
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                q, found = matrix(b.column(2).to_pylist(), "<f8", wide), []
                score = np.where(b.column(0).to_numpy()[:, None] == known_rows[None], -np.inf, q @ known.T)
                least = np.partition(score, -k, axis=1)[:, -k] if len(known) >= k else np.full(len(q), -np.inf)
                # Below by more than rounding, so that no equal score is lost.
                least -= 1e-9 * np.abs(np.where(np.isfinite(least), least, 0)) + 1e-12 * largest * largest
                for t in range(TABLES):
                    bucket, _ = index.probes(index.cells(q, t, True), probes)
                    of = np.repeat(np.arange(len(q)), bucket.shape[1])
                    bucket = bucket.ravel()
                    parts = np.array([large.get((t, x), 1) for x in bucket.tolist()])
                    of, parts, bucket = np.repeat(of, parts), np.repeat(parts, parts), np.repeat(bucket, parts)
                    first = np.concatenate([[True], (of[1:] != of[:-1]) | (bucket[1:] != bucket[:-1])])
                    part = np.arange(len(of)) - np.maximum.accumulate(np.where(first, np.arange(len(of)), 0))
                    found.append(np.stack([of, group_of(bucket, t, part), np.full(len(of), t), bucket], 1))
                found = np.unique(np.concatenate(found), axis=0)
                new = np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(1)])
                starts = np.append(np.nonzero(new)[0], len(found))
                of, group = found[new, 0], found[new, 1]
                lists = [found[a:z, 2:].tobytes() for a, z in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group.astype(np.int32)), *[c.take(pa.array(of)) for c in b.columns], pa.array(least[of]), pa.array(lists, pa.binary())],
                    ["g", "row", "vec_id", "v", "least", "visits"],
                )

    known_ids = pa.array(some["vec_id"].astype("Int64"), pa.int64())

    def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of the first rows: candidates like those of the buckets."""
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                q = matrix(b.column(2).to_pylist(), "<f8", wide)
                score = np.where(b.column(0).to_numpy()[:, None] == known_rows[None], -np.inf, q @ known.T)
                n = min(k, len(known))
                at = np.argpartition(-score, n - 1, axis=1)[:, :n] if n else np.empty((len(q), 0), np.int64)
                of, at = np.repeat(np.arange(len(q)), n), at.ravel()
                real = score[of, at] > -np.inf
                of, at = of[real], at[real]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(of)),
                        b.column(1).take(pa.array(of)),
                        pa.array(known_rows[at], pa.int64()),
                        known_ids.take(pa.array(at)),
                        pa.array(np.einsum("nd,nd->n", q[of], known[at])),
                    ],
                    ["query", "query_id", "row", "vec_id", "score"],
                )

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        at, of, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if queries.num_rows and block.num_rows:
            x, q = (matrix(t.column("v").to_pylist(), "<f8", wide) for t in (block, queries))
            tab, bucket = block.column("tab").to_numpy().astype(np.int64), block.column("bucket").to_numpy()
            order = np.lexsort((bucket, tab))
            keys = np.stack([tab, bucket], 1)[order]
            starts = np.nonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))[0]
            place = {k: i for i, k in enumerate(map(tuple, keys[starts].tolist()))}
            stops = np.append(starts[1:], len(keys))
            # Who visits each bucket: the queries of a bucket are scored against its rows in one product.
            lists = [np.frombuffer(v, np.int64).reshape(-1, 2) for v in queries.column("visits").to_pylist()]
            who = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
            where = np.fromiter((place.get(k, -1) for k in map(tuple, np.concatenate(lists).tolist())), np.int64, len(who))
            who, where = who[where >= 0], where[where >= 0]
            by = np.argsort(where, kind="stable")
            who, where = who[by], where[by]
            least, sorted_x = queries.column("least").to_numpy(), x[order]
            found = []
            for lo, hi in zip(*_runs(where), strict=True):
                a, z = starts[where[lo]], stops[where[lo]]
                for s in range(a, z, 4096):
                    e = min(z, s + 4096)
                    i, j = np.nonzero(q[who[lo:hi]] @ sorted_x[s:e].T >= least[who[lo:hi], None])
                    found.append((who[lo:hi][i], order[s:e][j]))
            if found:
                of, at = (np.concatenate(f) for f in zip(*found, strict=True))
            rows, own = block.column("row").to_numpy(), queries.column("row").to_numpy()
            other = rows[at] != own[of]
            of, at = of[other], at[other]
            score = np.einsum("nd,nd->n", q[of], x[at])
            ids = block.column("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            rank = np.lexsort((rows[at], ids[at], -score, of))
            of, at, score = of[rank], at[rank], score[rank]
            once = np.ones(len(of), bool)  # a row that several tables found
            once[1:] = (of[1:] != of[:-1]) | (rows[at][1:] != rows[at][:-1])
            of, at, score = of[once], at[once], score[once]
            begin = np.searchsorted(of, of)
            best = np.arange(len(of)) - begin < k
            of, at, score = of[best], at[best], score[best]
        return pa.table(
            [
                queries.column("row").take(pa.array(of)),
                queries.column("vec_id").take(pa.array(of)),
                block.column("row").take(pa.array(at)),
                block.column("vec_id").take(pa.array(at)),
                pa.array(score),
            ],
            names=["query", "query_id", "row", "vec_id", "score"],
        )

    x = vectors.mapInArrow(deal, "g int, tab int, bucket long, row long, vec_id long, v binary")
    q = vectors.filter(is_query).mapInArrow(visit, "g int, row long, vec_id long, v binary, least double, visits binary")
    schema = "query long, query_id long, row long, vec_id long, score double"
    found = q.groupBy("g").cogroup(x.groupBy("g")).applyInArrow(search, schema)
    found = found.union(vectors.filter(is_query).mapInArrow(opening, schema))
    once = found.groupBy("query", "query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    return merged(once, k)


@named("op7_ann")
def op7_ann(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
