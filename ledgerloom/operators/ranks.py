"""Exact values at given ranks, found without sorting a whole column.

Small inputs are counted per distinct value.  Large ones are first narrowed: a quantile sketch
brackets every wanted rank, values outside the brackets are only counted, and just the few values
inside are kept apart.  Whether the brackets really held the ranks is checked from exact counts;
if one ever did not, the full count answers instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import setting
from .keyed import attach, running_total, stage

# The sketch is off by at most 1/accuracy of the rows; the bracket is three times as wide.
_ACCURACY = 10_000
_MARGIN = 3 / _ACCURACY

# From this many tasks' worth of rows on, two light passes are cheaper than counting every value.
_NARROW_FROM_TASKS = 16


def values_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, Column],
    near: Sequence[float],
    rows: int,
) -> DataFrame:
    """Per group: ``__rows`` and the value at each rank (from 0, nulls not counted).

    A rank is an expression over ``__rows``; ``near`` holds the fractions of the group the ranks
    lie close to; ``rows`` is about how many rows there are.
    """
    keys = list(keys)
    present = df.filter(F.col(value).isNotNull()).select(*keys, value)
    if rows > _NARROW_FROM_TASKS * setting(df.sparkSession, "rowsPerTask"):
        found = stage(_pick(present, keys, value, ranks, near)).df
        missed = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in ranks])
        if found.filter(missed).isEmpty():
            return found
    return _pick(present, keys, value, ranks, ())


def _pick(present, keys, value, ranks, near) -> DataFrame:
    rows = F.count(F.lit(1)).alias("__rows")
    ends = [min(1.0, max(0.0, p + side * _MARGIN)) for p in near for side in (-1, 1)]
    sketch = [F.percentile_approx(value, ends, _ACCURACY).alias("__ends")] if ends else []
    totals = stage(present.groupBy(*keys).agg(rows, *sketch) if keys else present.agg(rows, *sketch))
    inside, at = F.lit(True), F.col(value)
    if ends:
        present = _with_group(present, totals, keys, ["__ends"])
        edge = [F.get("__ends", F.lit(i)) for i in range(len(ends))]
        inside = reduce(lambda a, b: a | b, [F.col(value).between(edge[i], edge[i + 1]) for i in range(0, len(ends), 2)])
        # Elsewhere the value only matters as one more row above the nearest bracket below it.
        below = [F.when(F.col(value) > edge[i], edge[i]) for i in range(1, len(ends), 2)]
        nearest = F.greatest(*below) if len(below) > 1 else below[0]
        at = F.when(inside, F.col(value)).otherwise(nearest)
    counted = present.groupBy(*keys, at.alias("__value_at")).agg(
        F.count_if(inside).alias("__in"), F.count(F.lit(1)).alias("__n")
    )
    upto = running_total(stage(counted), keys, ["__value_at"], "__n", "__upto")
    ranked = _with_group(upto, totals, keys, ["__rows"])
    last = F.col("__upto") - F.col("__n") + F.col("__in")  # rows up to and with this value itself
    first = F.col("__upto") - F.col("__n")
    picks = [F.max(F.when((first <= r) & (r < last), F.col("__value_at"))).alias(name) for name, r in ranks.items()]
    return ranked.groupBy(*keys).agg(F.max("__rows").alias("__rows"), *picks)


def _with_group(df: DataFrame, totals, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    if keys:
        return attach(df, totals.select(*keys, *values), keys, values, null_safe=True)
    row = totals.df.first()  # one group, one row
    return df.withColumns({v: F.lit(row[v]) for v in values})
