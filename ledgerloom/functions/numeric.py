"""Column expressions on numbers.  A null stays null unless the name says otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed import MISSING_FEATURE


def log(c: Column) -> Column:
    return F.ln(c)


def log1p(c: Column) -> Column:
    return F.log1p(c)


def decimal_part(c: Column, scale: int = 1000) -> Column:
    """The digits after the point as an integer, cut off and not rounded."""
    return ((c - c.cast("bigint")) * scale).cast("int")


def frac_distance(c: Column, other: Column) -> Column:
    """Distance of the fraction of ``c`` (0 when missing) from ``other``."""
    filled = F.coalesce(c, F.lit(0.0))
    return F.abs(filled - filled.cast("bigint") - other)


def clip(c: Column, low=None, high=None) -> Column:
    """Bound a value; plain ``greatest``/``least`` would turn a null into the bound."""
    out = c
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    return out


def not_null_flag(c: Column) -> Column:
    return F.when(c.isNotNull(), 1).otherwise(0)


def threshold_flag(c: Column, bound) -> Column:
    """1 where ``c >= bound``, else 0; a missing value counts as below."""
    return F.when(c >= bound, 1).otherwise(0)


def fill_cast_int(c: Column, fill: int = -1) -> Column:
    return F.coalesce(c, F.lit(fill)).cast("int")


def fill_const(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def fill_sentinel(df: DataFrame, cols: Sequence[str] | None = None, value: float = MISSING_FEATURE) -> DataFrame:
    """Replace every missing number by one sentinel; a type keeps, unless too narrow for it."""
    if cols is None:
        cols = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    types = {f.name: f.dataType for f in df.schema}
    types = {c: T.ShortType() if isinstance(t, T.ByteType) else t for c, t in types.items()}
    filled: Mapping[str, Column] = {
        c: F.coalesce(F.col(c), F.lit(value).cast(types[c])) for c in cols
    }
    return df.withColumns(filled)


def row_sum(*cols: Column) -> Column:
    """Sum across columns, missing ones counted as 0."""
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(c, F.lit(0))
    return out


def row_null_count(*cols: Column) -> Column:
    out = F.lit(0)
    for c in cols:
        out = out + c.isNull().cast("int")
    return out


def to_numeric(c: Column) -> Column:
    """Parse a number; text that is none becomes null."""
    return c.try_cast("double")


def abs_sqrt(c: Column) -> Column:
    """Root of the square, that is the absolute value."""
    return F.abs(c)
