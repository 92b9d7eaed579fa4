"""Statistics of hundreds of columns in one pass, as mergeable states.

One aggregate expression for each column and measure is more than code generation takes once a table
has some hundred columns.  Here a task turns its batches into one small state for each column, so
the number of shuffled rows is columns times tasks, and the states are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import stage

_STATE = (
    "column string, rows bigint, nulls bigint, n bigint, low double, high double, mean double, "
    "pairs bigint, mx double, my double, sxx double, syy double, sxy double"
)
#: Sums of squares below this share of the squares themselves are rounding, not spread.
_NO_SPREAD = 1e-24


def _moments(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """n, means and centred second moments of every column of ``x`` with ``y``, over rows that have both."""
    both = ~np.isnan(x) & ~np.isnan(y)[:, None]
    n = both.sum(axis=0)
    per = np.maximum(n, 1)
    mx, my = np.where(both, x, 0).sum(axis=0) / per, np.where(both, y[:, None], 0).sum(axis=0) / per
    dx, dy = np.where(both, x - mx, 0), np.where(both, y[:, None] - my, 0)
    return [n, mx, my, (dx * dx).sum(axis=0), (dy * dy).sum(axis=0), (dx * dy).sum(axis=0)]


def _merge(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    n = a[0] + b[0]
    per = np.maximum(n, 1)
    dx, dy, w = b[1] - a[1], b[2] - a[2], a[0] * b[0] / per
    return [n, a[1] + dx * b[0] / per, a[2] + dy * b[0] / per, a[3] + b[3] + w * dx * dx, a[4] + b[4] + w * dy * dy, a[5] + b[5] + w * dx * dy]


def column_states(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """One state for each column and task."""
    cols = list(cols)
    as_double = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(target).cast("double").alias("__y"))

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, rows = len(cols), 0
        nulls, n, total = np.zeros(p, "int64"), np.zeros(p, "int64"), np.zeros(p)
        low, high, second = np.full(p, np.inf), np.full(p, -np.inf), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows += batch.num_rows
            nulls += [c.null_count for c in batch.columns[:p]]
            *x, y = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            x = np.column_stack(x)
            there = ~np.isnan(x)
            n += there.sum(axis=0)
            total += np.where(there, x, 0).sum(axis=0)
            low = np.minimum(low, np.where(there, x, np.inf).min(axis=0))
            high = np.maximum(high, np.where(there, x, -np.inf).max(axis=0))
            new = _moments(x, y)
            second = new if second is None else _merge(second, new)
        if second is None:
            return
        empty = n == 0
        mean = pa.array(total / np.maximum(n, 1), mask=empty)
        ends = [pa.array(e, mask=empty) for e in (low, high)]
        arrays = [pa.array(cols), pa.array([rows] * p, pa.int64()), pa.array(nulls), pa.array(n), *ends, mean]
        arrays += [pa.array(second[0].astype("int64")), *[pa.array(s) for s in second[1:]]]
        yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _STATE.split(", ")])

    return as_double.mapInArrow(states, _STATE)


def wide_profile(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """column, rows, nulls, null_ratio, low, high, mean and corr (with ``target``) of numeric columns.

    The table is read once.  NaN is no null but has no part in extremes, mean and correlation; a pair
    with a missing side has no part in the correlation.  A column without values or without spread
    has a null correlation.  An empty table gives no rows.  Extremes are doubles, so integers beyond
    2^53 are rounded.
    """
    if not cols:
        raise ValueError("no columns to profile")
    states = stage(column_states(df, cols, target)).df
    # Second moments are centred on the common mean: a state's own, and its distance times its size.
    centre = states.groupBy("column").agg(
        F.try_divide(F.sum(F.col("pairs") * F.col("mx")), F.sum("pairs")).alias("cx"),
        F.try_divide(F.sum(F.col("pairs") * F.col("my")), F.sum("pairs")).alias("cy"),
    )
    near = states.join(F.broadcast(centre), "column")  # one row for each column
    dx, dy, w = F.col("mx") - F.col("cx"), F.col("my") - F.col("cy"), F.col("pairs")
    found = near.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("mean"),
        F.sum(F.col("sxx") + w * dx * dx).alias("sxx"),
        F.sum(F.col("syy") + w * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + w * dx * dy).alias("sxy"),
        F.sum(w * F.col("mx") * F.col("mx") + F.col("sxx")).alias("qx"),
        F.sum(w * F.col("my") * F.col("my") + F.col("syy")).alias("qy"),
    )
    spread = (F.col("sxx") > F.col("qx") * _NO_SPREAD) & (F.col("syy") > F.col("qy") * _NO_SPREAD)
    corr = F.when(spread, F.col("sxy") / (F.sqrt("sxx") * F.sqrt("syy")))
    return found.select(
        "column", "rows", "nulls", (F.col("nulls") / F.col("rows")).alias("null_ratio"), "low", "high", "mean", corr.alias("corr")
    )
