"""Profiling: what is in a table.  Each function makes one pass for all columns it is given."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import setting
from .keyed import attach, running_total, stage
from .ranks import values_at_ranks

QUARTILES = (0.25, 0.5, 0.75)

# Correlation sums are handed on in tiles of this many columns squared, and added up so many at a time.
_TILE, _FAN = 64, 16


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, by: Sequence[str], cols: Sequence[str], kind: str) -> DataFrame:
    """(by.., column, value) rows with one value type."""
    cast = df.select(*by, *[F.col(c).cast(kind).alias(c) for c in cols])
    return cast.unpivot(list(by), list(cols), "column", "value")


def shape(df: DataFrame, name: str) -> DataFrame:
    return df.agg(
        F.lit(name).alias("table"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("cols"),
    )


def column_types(df: DataFrame, *, text_only: bool = False) -> DataFrame:
    """Type of each column with its count of present values."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    names = [c for c, t in types.items() if not text_only or t == "string"]
    wide = df.agg(*[F.count(c).alias(c) for c in names])
    kinds = F.create_map(*[F.lit(x) for c in names for x in (c, types[c])])
    long = wide.unpivot([], names, "column", "non_null")
    return long.select("column", kinds[F.col("column")].alias("dtype"), "non_null")


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "nulls")


def any_null_columns(df: DataFrame) -> DataFrame:
    """How many columns have a missing value."""
    return null_counts(df).agg(F.count_if(F.col("nulls") > 0).alias("columns_with_null"))


def null_ratios(df: DataFrame, cols: Sequence[str] | None = None, *, k: int | None = 20) -> DataFrame:
    """Percent missing of the columns that miss any, largest first."""
    cols = list(cols or df.columns)
    share = [(F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1))).alias(c) for c in cols]
    long = df.agg(*share).unpivot([], cols, "column", "missing_ratio")
    ranked = long.filter(F.col("missing_ratio") > 0).orderBy(F.desc("missing_ratio"), "column")
    return ranked if k is None else ranked.limit(k)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each present value, most frequent first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col)


def value_shares(df: DataFrame, col: str, *, k: int = 5) -> DataFrame:
    """Share of the ``k`` most frequent values, a missing value being one of them."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts).df
    total = counts.agg(F.sum("n")).first()[0] or 0
    shares = counts.select(col, F.try_divide(F.col("n"), F.lit(total)).alias("share"))
    return shares.orderBy(F.desc("share"), F.col(col).asc_nulls_last()).limit(k)


def category_counts(df: DataFrame, cols: Sequence[str], *, k: int | None = None) -> DataFrame:
    """Frequency of every present value of many columns, in one shuffle; optionally the top ``k``.

    Ranks come from a running total that stays distributed however many values a column has.
    """
    long = _long(df, [], cols, "string").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    if k is None:
        return counts
    ready = stage(counts.select("*", (-F.col("n")).alias("__down"), F.lit(1).alias("__one")))
    ranked = running_total(ready, ["column"], ["__down", "value"], "__one", "rank")
    return ranked.filter(F.col("rank") <= k).select("column", "value", "n", F.col("rank").cast("int").alias("rank"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent of class 0 and class 1."""
    total = F.count(label)
    one, zero = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        zero.alias("regular"),
        one.alias("positive"),
        F.try_divide(zero * 100.0, total).alias("regular_perc"),
        F.try_divide(one * 100.0, total).alias("positive_perc"),
    )


# Columns described in one aggregate, and how many tasks' worth of numbers the built-in percentile
# may gather.
_DESCRIBED_TOGETHER = 20
_PERCENTILE_TASKS = 4


def describe(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    *,
    by: Sequence[str] = (),
    probs: Sequence[float] = QUARTILES,
    exact: bool = True,
) -> DataFrame:
    """count, mean, std, min, quantiles, max of numeric columns, one row per column (and group).

    Exact quantiles come from the built-in percentile while all numbers fit one task, and beyond
    that from the values at neighbouring ranks.  ``exact=False`` takes them from a sketch.
    """
    cols, by = list(cols or numeric_columns(df)), list(by)
    names = [f"p{round(p * 100)}" for p in probs]
    order = [*by, "column", "count", "mean", "std", "min", *names, "max"]
    levels = "array(" + ", ".join(f"{float(p)}D" for p in probs) + ")"
    if not exact:
        quantiles = f"percentile_approx({{x}}, {levels}, 10000) as q"
    else:
        rows = df.count()
        numbers = rows * min(len(cols), _DESCRIBED_TOGETHER)
        fits = numbers <= _PERCENTILE_TASKS * setting(df.sparkSession, "rowsPerTask")
        quantiles = f"percentile({{x}}, {levels}) as q" if fits else None
    stats = "count({x}) as count, avg({x}) as mean, stddev_samp({x}) as std, min({x}) as min, max({x}) as max"
    if quantiles:
        stats = f"{stats}, {quantiles}"

    parts = []
    for start in range(0, len(cols), _DESCRIBED_TOGETHER):
        some = cols[start : start + _DESCRIBED_TOGETHER]
        filled = {c: stats.format(x=f"cast(`{c}` as double)") for c in some}
        wide = df.groupBy(*by).agg(*[F.expr(f"struct('{c}' as column, {e}) as `{c}`") for c, e in filled.items()])
        entries = F.explode(F.array(*[F.col(f"`{c}`") for c in some])).alias("__e")
        parts.append(wide.select(*by, entries).select(*by, "__e.*"))
    table = reduce(DataFrame.unionByName, parts)
    if quantiles:
        return table.select("*", *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(names)]).select(*order)

    keys = [*by, "column"]
    at = [(F.col("__rows") - 1) * F.lit(p) for p in probs]
    ranks = {f"__lo{i}": F.floor(x) for i, x in enumerate(at)} | {f"__hi{i}": F.ceil(x) for i, x in enumerate(at)}
    long = _long(df, by, cols, "double")
    found = stage(values_at_ranks(long, keys, "value", ranks, probs, rows * len(cols)))
    wide = attach(table, found, keys, null_safe=True)
    between = [
        (F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * (x - F.floor(x))).alias(n)
        for i, (n, x) in enumerate(zip(names, at))
    ]
    return wide.select("*", *between).select(*order)


def _extremes(df: DataFrame, col: str) -> tuple[float, float]:
    lo, hi = df.agg(F.min(F.col(col).cast("double")), F.max(F.col(col).cast("double"))).first()
    return lo, hi


def _bin(col: str, lo: float, hi: float, bins: int) -> Column:
    """Bin number from 0; the last bin includes its right edge."""
    x = F.col(col).cast("double")
    raw = F.floor((x - F.lit(lo)) * bins / F.lit(hi - lo)) if hi > lo else F.floor(x * 0)
    return F.least(raw, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, *, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts between the extremes of all rows; groups share the edges."""
    present = df.filter(F.col(col).isNotNull())
    lo, hi = _extremes(present, col)
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins
    counts = present.groupBy(*by, _bin(col, lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    left = F.lit(lo) + F.col("bin") * F.lit(width)
    return counts.select(*by, "bin", left.alias("left_edge"), "n")


def histogram_density(
    df: DataFrame, col: str, *, low: float, high: float, edges: int, by: Sequence[str] = ()
) -> DataFrame:
    """Counts between fixed edges, normalised to area 1 per group; values outside are dropped."""
    bins = edges - 1
    width = (high - low) / bins
    inside = df.filter(F.col(col).between(low, high))
    counts = inside.groupBy(*by, _bin(col, low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # At most `bins` rows a group are left here.
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("density", F.col("n") / (total * F.lit(width)))


def time_series(df: DataFrame, period: str, measure: str) -> DataFrame:
    return df.groupBy(period).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(measure).alias("min_value"),
        F.avg(measure).alias("avg_value"),
        F.max(measure).alias("max_value"),
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows with both values; null, not an error, where one of them is constant."""
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(both_x) * F.stddev_pop(both_y))


def target_correlations(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Correlation of the label with each column, missing values as 0."""
    y = F.col(label).cast("double")
    wide = df.agg(*[pearson(y, F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "corr")


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair (first <= second in the given order) over complete pairs.

    NaN is a missing value.
    """
    cols = list(cols or numeric_columns(df))
    df = df.select(*[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in cols])
    return _correlation_blocks(df, cols)


# A variance below this share of the raw second moment is rounding, not spread.
_NO_SPREAD = 1e-13


def _correlation_blocks(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pair sums as matrix products over each task's rows, cut into tiles, and the tiles of the tasks
    added up in a tree: no group has more than ``_FAN`` tiles, whatever the number of tasks.

    Columns are first centred on their means (one row on the driver) to keep the sums accurate.
    """
    p = len(cols)
    wanted = [f"{f}(cast(`{c}` as double)) as {f}_{i}" for i, c in enumerate(cols) for f in ("avg", "min", "max")]
    ends = df.agg(*[F.expr(w) for w in wanted]).first()
    # A constant column is shifted by its value, so that it is exactly zero.
    shift = [ends[f"min_{i}"] if ends[f"min_{i}"] == ends[f"max_{i}"] else ends[f"avg_{i}"] for i in range(p)]
    centred = df.select(
        *[(F.col(c).cast("double") - F.lit(float(shift[i] or 0.0))).alias(f"x{i}") for i, c in enumerate(cols)]
    )
    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")
    tiled = "part int, a int, b int, sums binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), p, p))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            here = ~np.isnan(x)
            x = np.where(here, x, 0.0)
            m, sq = here.astype(float), x * x
            sx, sxx = x.T @ m, sq.T @ m
            total += np.stack([m.T @ m, sx, sx.T, sxx, sxx.T, x.T @ x])
        part = TaskContext.get().partitionId()
        for a, b in combinations_with_replacement(range(0, p, _TILE), 2):
            tile = total[:, a : a + _TILE, b : b + _TILE].tobytes()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "a": pa.array([a], pa.int32()), "b": pa.array([b], pa.int32()), "sums": [tile]})

    def add(tiles: pa.Table) -> pa.Table:
        tiles = tiles.sort_by("part")  # always in the same order, so that a rerun rounds alike
        total = sum(np.frombuffer(x) for x in tiles.column("sums").to_pylist())
        first = tiles.slice(0, 1)
        parent = pa.array([first.column("part")[0].as_py() // _FAN], pa.int32())
        return pa.table([parent, first.column("a"), first.column("b"), pa.array([total.tobytes()])], names=["part", "a", "b", "sums"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, tile in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "sums")], strict=True):
                total = np.frombuffer(tile).reshape(len(sums), min(_TILE, p - a), -1)
                i, j = np.indices(total.shape[1:])
                keep = i + a <= j + b
                ends = [pa.array((x[keep] + o).astype("int32")) for x, o in ((i, a), (j, b))]
                yield pa.RecordBatch.from_arrays([*ends, *[pa.array(t[keep]) for t in total]], names=["i", "j", *sums])

    tiles = stage(centred.mapInArrow(partial, tiled)).df
    last = tiles.agg(F.max("part")).first()[0] or 0
    while last:
        group = F.floor(F.col("part") / _FAN).alias("group")
        tiles = stage(tiles.groupBy(group, "a", "b").applyInArrow(add, tiled)).df
        last //= _FAN
    pair = tiles.mapInArrow(pairs, "i int, j int, " + ", ".join(f"{s} double" for s in sums))

    def variance(total: str, squares: str) -> Column:
        v = F.col(squares) - F.try_divide(F.col(total) * F.col(total), F.col("n"))
        return F.when(v > F.col(squares) * _NO_SPREAD, v)

    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    corr = cov / (F.sqrt(variance("sx", "sxx")) * F.sqrt(variance("sy", "syy")))
    name = F.create_map(*[F.lit(v) for i, c in enumerate(cols) for v in (i, c)])
    return pair.select(name[F.col("i")].alias("col_a"), name[F.col("j")].alias("col_b"), corr.alias("corr"))


# Exclusive bounds of the integer types and of half and single precision.
_INT_BOUNDS = (("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647))
_HALF_MAX, _SINGLE_MAX = 65504.0, 3.4028234663852886e38


def narrow_types(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """Smallest type for each numeric column, from its extremes (one aggregate, one row).

    Bounds are exclusive.  Values in the half-precision range become ``float``, the narrowest
    Spark has; other columns keep their type.
    """
    cols = list(cols or numeric_columns(df))
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in cols for f in (F.min, F.max)]).first()
    chosen = {}
    for c in cols:
        kind = df.schema[c].dataType
        lo, hi = ends[f"min_{c}"], ends[f"max_{c}"]
        chosen[c] = kind.simpleString()
        if lo is None or isinstance(kind, T.DecimalType):
            continue
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            half = lo > -_HALF_MAX and hi < _HALF_MAX
            single = lo > -_SINGLE_MAX and hi < _SINGLE_MAX
            chosen[c] = "float" if half or single else "double"
        else:
            fitting = [t for t, low, high in _INT_BOUNDS if lo > low and hi < high]
            chosen[c] = fitting[0] if fitting else "bigint"
    return chosen


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def lossless_check(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Rows whose value changes when a column is narrowed and widened back."""
    changed = []
    for c, t in types.items():
        back = F.col(c).try_cast(t).cast(df.schema[c].dataType)
        changed.append(F.count_if(~F.col(c).eqNullSafe(back)).alias(c))
    return df.agg(*changed).unpivot([], list(types), "column", "changed")
