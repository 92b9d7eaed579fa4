"""Putting feature sets side by side.  Rows are matched by a unique key, never by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keyed import stage


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Refuse a table whose key repeats: joining it would multiply rows.  Hands out the table as it
    was stored for the check, so that it is not computed again."""
    stored = stage(df).df
    repeated = stored.groupBy(key).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"{key} is not unique")
    return stored


def new_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of ``right`` that ``left`` does not have, sorted."""
    return sorted(set(right.columns) - set(left.columns))


def bind_columns(left: DataFrame, right: DataFrame, *, key: str, check: bool = True) -> DataFrame:
    """Add the columns that are not present yet; on a name both have, ``left`` wins."""
    right = right.select(key, *new_columns(left, right))
    return left.join(require_unique(right, key) if check else right, key, "left")


def assemble_sets(base: DataFrame, *sets: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Fold feature sets into one wide table, earlier sets taking precedence.

    All joins use the same key, so the growing left side is exchanged at most once; each set is
    pruned to its new columns before it moves.  Sets saved with ``save_bucketed`` need no
    exchange at all.
    """
    out = base
    for right in sets:
        out = bind_columns(out, right, key=key, check=check)
    return out


def save_bucketed(df: DataFrame, table: str, path: str, *, key: str, buckets: int) -> DataFrame:
    """Save a feature set as a table bucketed and sorted by its key, for joins without exchange."""
    writer = df.write.bucketBy(buckets, key).sortBy(key).option("path", path)
    writer.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns other than ids, time and label."""
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
