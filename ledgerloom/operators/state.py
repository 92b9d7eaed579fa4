"""What was learned per key, kept between runs and brought up to date without the old rows.

A state holds, for one key (one or several columns): the rows of each value, count, mean and second
central moment of each measure (of a label this is its target mean), and how often each value of a
column occurs with the key, for modes.  Two states of different rows merge into the state of all of
them: counts add up, moments by the pairwise formula, in which nothing large is subtracted.  So a new
month costs one aggregate over its own rows and one join of keyed tables.

States are saved as numbered versions of Parquet tables.  A version is complete once its ``meta`` table
is there, which is written last; a run that dies before leaves the earlier version as the latest.

A missing key is a key of its own in the state; ``apply`` matches it only with ``null_keys``.  Missing
measures and values are not counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed import attach, stage

STATISTICS = ("count", "mean", "std")


@dataclass(frozen=True)
class KeyState:
    """``moments``: keys, n, and n_, mean_, m2_ of each measure; ``values``: keys, value, n by column."""

    keys: tuple[str, ...]
    measures: tuple[str, ...]
    moments: DataFrame
    values: dict[str, DataFrame]


def fit(df: DataFrame, keys: Sequence[str], measures: Sequence[str] = (), modes: Sequence[str] = ()) -> KeyState:
    """The state of the rows of ``df``."""
    sums: list[Column] = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        x = F.col(m).cast("double")
        sums += [F.count(x).alias(f"n_{m}"), F.avg(x).alias(f"mean_{m}"), (F.var_pop(x) * F.count(x)).alias(f"m2_{m}")]
    moments = df.groupBy(*keys).agg(*sums)
    values = {
        c: df.filter(F.col(c).isNotNull()).groupBy(*keys, F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        for c in modes
    }
    return KeyState(tuple(keys), tuple(measures), moments, values)


def _outer(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both tables side by side, ``a_`` and ``b_`` before the other columns; missing keys are equal."""
    left = a.select(*[F.col(k).alias(f"a_{k}") for k in keys], *[F.col(c).alias(f"a_{c}") for c in a.columns if c not in keys])
    right = b.select(*[F.col(k).alias(f"b_{k}") for k in keys], *[F.col(c).alias(f"b_{c}") for c in b.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
    return left.join(right, same, "full_outer")


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def merge(a: KeyState, b: KeyState) -> KeyState:
    """The state of the rows of both."""
    if (a.keys, a.measures, sorted(a.values)) != (b.keys, b.measures, sorted(b.values)):
        raise ValueError("states of different keys, measures or modes do not merge")
    both = _outer(a.moments, b.moments, a.keys)
    columns = [F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in a.keys] + [(_zero("a_n") + _zero("b_n")).alias("n")]
    for m in a.measures:
        n_a, n_b = _zero(f"a_n_{m}"), _zero(f"b_n_{m}")
        n, step = n_a + n_b, F.col(f"b_mean_{m}") - F.col(f"a_mean_{m}")
        mean = F.coalesce(F.col(f"a_mean_{m}") + step * n_b / n, f"a_mean_{m}", f"b_mean_{m}")
        spread = F.coalesce(step * step * n_a * n_b / n, F.lit(0.0))
        m2 = F.when(n > 0, _zero(f"a_m2_{m}") + _zero(f"b_m2_{m}") + spread)
        columns += [n.alias(f"n_{m}"), mean.alias(f"mean_{m}"), m2.alias(f"m2_{m}")]
    values = {}
    for c in a.values:
        keys = [*a.keys, "value"]
        counts = _outer(a.values[c], b.values[c], keys)
        values[c] = counts.select(*[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys], (_zero("a_n") + _zero("b_n")).alias("n"))
    return KeyState(a.keys, a.measures, both.select(*columns), values)


def _versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of all versions, and of the complete ones."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop(path)):
        return [], []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop(path))]
    every = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
    return every, [v for v in every if fs.exists(hadoop(f"{path}/v{v}/meta/_SUCCESS"))]


def save(state: KeyState, path: str) -> int:
    """Write the state as a new version; earlier ones stay.  The number of the version."""
    spark = state.moments.sparkSession
    every, _ = _versions(spark, path)
    version = (every[-1] if every else 0) + 1
    state.moments.write.parquet(f"{path}/v{version}/moments")
    for i, c in enumerate(sorted(state.values)):
        state.values[c].write.parquet(f"{path}/v{version}/values{i}")
    meta = [(list(state.keys), list(state.measures), sorted(state.values))]
    spark.createDataFrame(meta, "keys array<string>, measures array<string>, modes array<string>").coalesce(1).write.parquet(
        f"{path}/v{version}/meta"
    )
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> KeyState:
    """A saved state, by default the latest complete one."""
    complete = _versions(spark, path)[1]
    if version is None and complete:
        version = complete[-1]
    if version not in complete:
        raise ValueError(f"no complete version {version or ''} of a state in {path}")
    at = f"{path}/v{version}"
    meta = spark.read.parquet(f"{at}/meta").first()
    values = {c: spark.read.parquet(f"{at}/values{i}") for i, c in enumerate(meta["modes"])}
    return KeyState(tuple(meta["keys"]), tuple(meta["measures"]), spark.read.parquet(f"{at}/moments"), values)


def table(state: KeyState, statistics: Sequence[str] = STATISTICS) -> DataFrame:
    """keys, n, ``<measure>_<statistic>`` and ``<column>_mode`` (the largest value on a tie)."""
    columns = {
        "count": lambda m: F.col(f"n_{m}"),
        "mean": lambda m: F.col(f"mean_{m}"),
        "std": lambda m: F.when(F.col(f"n_{m}") > 1, F.sqrt(F.col(f"m2_{m}") / (F.col(f"n_{m}") - 1))),
    }
    out = state.moments.select(*state.keys, "n", *[columns[s](m).alias(f"{m}_{s}") for m in state.measures for s in statistics])
    for c, counts in state.values.items():
        top = counts.groupBy(*state.keys).agg(F.max(F.struct("n", "value")).getField("value").alias(f"{c}_mode"))
        both = _outer(out, top, state.keys)  # a key without such values has no mode
        names = [x for x in out.columns if x not in state.keys]
        out = both.select(*[F.col(f"a_{k}").alias(k) for k in state.keys], *[F.col(f"a_{x}").alias(x) for x in names], F.col(f"b_{c}_mode").alias(f"{c}_mode"))
    return out


def apply(
    state: KeyState,
    df: DataFrame,
    *,
    prefix: str = "",
    statistics: Sequence[str] = STATISTICS,
    null_keys: bool = False,
    id_col: str | None = None,
) -> DataFrame:
    """``df`` with the key's rows (``<prefix>n``), statistics and modes; unknown keys give null."""
    found = table(state, statistics)
    names = [c for c in found.columns if c not in state.keys]
    ready = stage(found.select(*state.keys, F.col("n").alias("__n"), *[F.col(c).alias(prefix + c) for c in names]))
    return attach(df, ready, list(state.keys), [prefix + c for c in names], null_safe=null_keys, weight="__n", id_col=id_col)
