"""Choosing features by their correlation with the label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import target_correlations


def best_by_correlation(
    df: DataFrame, label: str, base: Sequence[str], derived: Sequence[str]
) -> DataFrame:
    """For each base column the derived column most correlated with the label.

    A derived column belongs to every base column whose name its own name contains.  Both lists
    are column names, so the pairs are few and fixed before any row is read.
    """
    pairs = [(b, d) for b in base for d in derived if b in d]
    corr = target_correlations(df, label, list(dict.fromkeys(d for _, d in pairs)))
    bases = {d: [b for b, x in pairs if x == d] for d in dict.fromkeys(d for _, d in pairs)}
    owners = F.create_map(
        *[x for d, bs in bases.items() for x in (F.lit(d), F.array(*[F.lit(b) for b in bs]))]
    )
    long = corr.withColumn("base", F.explode(owners[F.col("column")]))
    usable = long.filter(F.abs("corr") > 0)
    best = F.max(F.struct(F.abs("corr").alias("abs_corr"), F.col("column").alias("best")))
    picked = usable.groupBy("base").agg(best.alias("top"))
    return picked.select("base", "top.best", "top.abs_corr")


def drop_weaker(df: DataFrame, best: DataFrame, derived: Sequence[str]) -> DataFrame:
    """Drop the derived columns that are best for no base column."""
    kept = {r["best"] for r in best.select("best").collect()}  # one name per base column
    return df.drop(*[c for c in derived if c not in kept])
