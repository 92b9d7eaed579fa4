"""Folds, scores and feature rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import attach, measure, running_total, stage


def _deal(sizes: Mapping[int, int], k: int) -> list[tuple[int, list[tuple[int, list[int]]]]]:
    """How groups are dealt to ``k`` folds, the largest first, each to the lightest fold.

    ``sizes`` is the number of groups of each size.  Groups of one size form a run: its first
    groups fill up the lighter folds, a fold joins in once the others have caught up with it, and
    from then on folds take turns.  For each size: from which place in the run on, whose turns.
    """
    load, out = [0] * k, []
    for size in sorted(sizes, reverse=True):
        lightest = sorted(range(k), key=lambda f: (load[f], f))
        parts: list[tuple[int, list[int]]] = []
        for i, f in enumerate(lightest):
            taken = {f: 0}
            for g in lightest[:i]:  # groups that g has got before f is the lightest
                gap = load[f] - load[g]
                taken[g] = -(-gap // size) + (gap % size == 0 and g < f)
            start = sum(taken.values())
            if start >= sizes[size]:
                break
            parts.append((start, sorted(taken, key=lambda g: (load[g] + taken[g] * size, g))))
        for (start, turns), end in zip(parts, [*[s for s, _ in parts[1:]], sizes[size]]):
            whole, rest = divmod(end - start, len(turns))
            for j, g in enumerate(turns):
                load[g] += size * (whole + (j < rest))
        out.append((size, parts))
    return out


def group_folds(df: DataFrame, group: str, *, k: int = 5, fold: str = "fold") -> DataFrame:
    """Give all rows of a group the same fold, folds being about equally large.

    Groups are counted on the cluster; the largest one goes to the lightest fold, and so on (the
    smaller value, and the lower fold, first on a tie).  The driver sees how many groups there are
    of each size; a group finds its fold from its size and its place among those of equal size.
    """
    groups = stage(df.groupBy(group).agg(F.count(F.lit(1)).alias("__n"), F.lit(1).alias("__one")))
    sizes = {r["__n"]: r["count"] for r in groups.df.groupBy("__n").count().collect()}
    schema = "__n bigint, __parts array<struct<start: bigint, turns: array<int>>>"
    turns = measure(df.sparkSession.createDataFrame(_deal(sizes, k), schema))
    placed = running_total(groups, ["__n"], [group], "__one", "__upto")
    placed = attach(placed, turns, ["__n"], ["__parts"])
    place = F.col("__upto") - 1
    part = F.element_at(F.filter("__parts", lambda p: p["start"] <= place), -1)
    turn = F.get(part["turns"], ((place - part["start"]) % F.size(part["turns"])).cast("int"))
    table = stage(placed.select(group, "__n", turn.alias(fold)))
    return attach(df, table, [group], [fold], null_safe=True, weight="__n")


def random_folds(df: DataFrame, id_col: str, *, k: int = 5, seed: int = 42, fold: str = "fold") -> DataFrame:
    """A shuffled fold that depends on the id alone, so a recomputed task agrees with itself."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}"))
    key = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return df.withColumn(fold, F.pmod(key, F.lit(k)).cast("int"))


def last_fold(df: DataFrame, *, k: int = 5, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(train, holdout) with the last fold as the only holdout."""
    return df.filter(F.col(fold) != k - 1), df.filter(F.col(fold) == k - 1)


def auc(df: DataFrame, *, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null where a class is missing.

    A row without a score is an error: leaving it out would flatter the scores.

    Rows are first counted per distinct score.  The rank sum then needs only a running total over
    scores, which stays distributed even when every row has its own score.
    """
    by = list(by)
    y = F.col(label)
    missing = F.raise_error(F.lit(f"{score} is missing for some rows")).cast(df.schema[score].dataType)
    counts = df.groupBy(*by, F.coalesce(F.col(score), missing).alias("__score")).agg(
        F.count_if(y == 1).alias("__pos"), F.count_if(y == 0).alias("__neg")
    )
    table = stage(counts)
    below = running_total(table, by, ["__score"], "__neg", "__upto")
    won = F.col("__pos") * (F.col("__upto") - F.col("__neg") / F.lit(2.0))
    pairs = F.sum("__pos").cast("double") * F.sum("__neg").cast("double")
    return below.groupBy(*by).agg(F.try_divide(F.sum(won), pairs).alias("auc"))


def auc_by_fold(df: DataFrame, *, label: str, score: str, fold: str = "fold") -> DataFrame:
    """AUC of each fold beside the mean over folds."""
    per_fold = stage(auc(df, label=label, score=score, by=[fold])).df
    mean = per_fold.agg(F.avg("auc")).first()[0]
    return per_fold.withColumn("mean_auc", F.lit(mean).cast("double"))


def auc_hard_label(
    df: DataFrame, *, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """AUC of the predicted class instead of the probability."""
    hard = df.withColumn("__class", F.when(F.col(score) > threshold, 1.0).otherwise(0.0))
    return auc(hard, label=label, score="__class", by=by)


def bagged_mean(scores: DataFrame, *, key: str, score: str) -> DataFrame:
    """Mean score over folds for each row."""
    return scores.groupBy(key).agg(F.avg(score).alias(score))


def mean_importance(
    long: DataFrame, *, feature: str = "feature", value: str = "importance", folds: int | None = None
) -> DataFrame:
    """Mean importance of a feature over the folds that used it, or over all ``folds``."""
    mean: Column = F.avg(value) if folds is None else F.sum(value) / F.lit(folds)
    return long.groupBy(feature).agg(mean.alias(value))


def top_features(ranked: DataFrame, k: int, *, feature: str = "feature", value: str = "importance") -> DataFrame:
    return ranked.orderBy(F.desc(value), feature).limit(k)


def bottom_features(ranked: DataFrame, k: int, *, feature: str = "feature", value: str = "importance") -> DataFrame:
    """The ``k`` least important features, candidates to drop."""
    return ranked.orderBy(F.asc(value), feature).limit(k)


def cumulative_importance(
    ranked: DataFrame, *, feature: str = "feature", value: str = "importance", order_by: str = "feature"
) -> DataFrame:
    """Running total and cumulative percent, by feature name or by descending importance."""
    total = ranked.agg(F.sum(value)).first()[0]
    table = ranked.select(feature, value, (-F.col(value)).alias("__down"))
    order = {"feature": [feature], "importance": ["__down", feature]}[order_by]
    summed = running_total(stage(table), [], order, value, "cum_sum").drop("__down")
    share = F.try_divide(F.col(value), F.lit(total))
    percent = F.try_divide(F.col("cum_sum") * 100.0, F.lit(total))
    return summed.withColumns({"perc": share, "cum_perc": percent})


def keep_cumulative(cumulative: DataFrame, threshold: float) -> DataFrame:
    """Features up to a cumulative percentage."""
    return cumulative.filter(F.col("cum_perc") <= threshold)
