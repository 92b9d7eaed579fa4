"""Choosing columns and rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import attach, stage
from .ranks import values_at_ranks


def keep_columns(df: DataFrame, wanted: Sequence[str], always: Sequence[str] = ()) -> DataFrame:
    """The listed columns that exist, in table order, plus those always kept."""
    keep = {*wanted, *always}
    return df.select(*[c for c in df.columns if c in keep])


def drop_named(df: DataFrame, names: DataFrame, column: str = "feature") -> DataFrame:
    """Drop the columns a table names.  Only names that are columns here reach the driver."""
    listed = names.filter(F.col(column).isin(df.columns)).select(column).distinct()
    return df.drop(*[r[column] for r in listed.collect()])


def keep_members(
    df: DataFrame, keys: DataFrame, on: Sequence[str], *, negate: bool = False, null_safe: bool = False
) -> DataFrame:
    """Rows whose key is (or is not) in another table; ``df`` may repeat keys heavily."""
    members = stage(keys.select(*on).distinct().withColumn("__member", F.lit(True)))
    marked = attach(df, members, list(on), ["__member"], null_safe=null_safe)
    test = F.col("__member").isNull() if negate else F.col("__member").isNotNull()
    return marked.filter(test).select(*df.columns)


def last_period_split(df: DataFrame, period: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last period is the test, the one before it is left out."""
    last = df.agg(F.max(period)).first()[0]
    return df.filter(F.col(period) < last - 1), df.filter(F.col(period) == last)


def row_cutoff(df: DataFrame, order: Sequence[str], k: int) -> list | None:
    """Order values of the ``k``-th row (from 1), or null when there are fewer rows.

    Missing values come first, as in Spark's own order.

    Found one order column after the other from ranks, so the table is not sorted and no long
    list of rows meets in one task.
    """
    total = df.count()
    if k > total:
        return None
    fixed: list = []
    for i, c in enumerate(order):
        prefix = [F.col(o).eqNullSafe(F.lit(v)) for o, v in zip(order[:i], fixed)]
        rows = df.filter(reduce(lambda a, b: a & b, prefix)) if prefix else df
        missing = rows.agg(F.count_if(F.col(c).isNull())).first()[0]
        if k <= missing:
            fixed.append(None)
            total = missing
            continue
        k, total = k - missing, total - missing
        found = values_at_ranks(rows, [], c, {"at": F.lit(k - 1)}, [(k - 1) / max(1, total - 1)], total)
        value = found.first()["at"]
        fixed.append(value)
        if i + 1 < len(order):
            counts = rows.agg(F.count_if(F.col(c) < F.lit(value)), F.count_if(F.col(c) == F.lit(value))).first()
            k, total = k - counts[0], counts[1]
    return fixed


def _before(order: Sequence[str], cut: Sequence, *, inclusive: bool):
    tests = []
    for i, c in enumerate(order):
        if cut[i] is None:
            continue  # nothing comes before a missing value
        step = [F.col(o).eqNullSafe(F.lit(v)) for o, v in zip(order[:i], cut)]
        tests.append(reduce(lambda a, b: a & b, [*step, F.col(c).isNull() | (F.col(c) < F.lit(cut[i]))]))
    if inclusive:
        tests.append(reduce(lambda a, b: a & b, [F.col(o).eqNullSafe(F.lit(v)) for o, v in zip(order, cut)]))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def first_rows(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows in order: a filter on the cutoff row.  ``order`` must be unique."""
    cut = row_cutoff(df, order, k)
    return df if cut is None else df.filter(_before(order, cut, inclusive=True))


def last_rows(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """The last ``k`` rows in order."""
    skip = df.count() - k
    cut = row_cutoff(df, order, skip) if skip > 0 else None
    return df if cut is None else df.filter(~_before(order, cut, inclusive=True))
