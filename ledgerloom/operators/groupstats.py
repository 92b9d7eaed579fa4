"""Statistics of a key, of a period, or of a key within a period, given back to every row.

All of them aggregate first and join the small result back, so that a hot key never becomes one
window in one task.  All measures of a call, and up to ten keys, share a scan and a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import Sized, attach_all, combine_sets, grouped, lookup, passes, stage_sets

AGGREGATES = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
}


def _stat(measure: str, agg: str) -> str:
    return f"__{measure}__{agg}"


def _stat_columns(measures: Sequence[str], aggs: Sequence[str]) -> list[Column]:
    return [AGGREGATES[a](m).alias(_stat(m, a)) for m in measures for a in aggs]


def _ready(table: Sized, keys: Sequence[str], renamed: dict[str, str]) -> Sized:
    cols = [F.col(old).alias(new) for old, new in renamed.items()]
    return table.select(*keys, F.col("n").alias("__n"), *cols)


def uid_stats(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    aggs: Sequence[str] = ("mean", "std"),
    *,
    id_col: str | None = None,
) -> DataFrame:
    """Statistics of each measure per key over all rows, as ``<key>_<measure>_<agg>``."""
    found = grouped(df, [[k] for k in keys], _stat_columns(measures, aggs))
    lookups = []
    for k in keys:
        names = {_stat(m, a): f"{k}_{m}_{a}" for m in measures for a in aggs}
        lookups.append(lookup(_ready(found[(k,)], [k], names), [k], list(names.values()), weight="__n"))
    return attach_all(df, lookups, id_col=id_col)


def uid_std_norm(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], *, id_col: str | None = None
) -> DataFrame:
    """Distance from the key's mean in standard deviations, as ``<key>_<measure>_std_norm``."""
    wide = uid_stats(df, keys, measures, ("mean", "std"), id_col=id_col)
    normed = [
        F.try_divide(F.col(m) - F.col(f"{k}_{m}_mean"), F.col(f"{k}_{m}_std")).alias(f"{k}_{m}_std_norm")
        for k in keys
        for m in measures
    ]
    return wide.select(*df.columns, *normed)


def period_totals(df: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Rows in the period of each row, as ``<period>_total``."""
    found = grouped(df, [[p] for p in periods], [])
    totals = {p: found[(p,)].select(p, F.col("n").alias(f"{p}_total")) for p in periods}
    return attach_all(df, [lookup(t, [p], [f"{p}_total"], weight=f"{p}_total") for p, t in totals.items()])


def timeblock_frequency(
    df: DataFrame,
    cols: Sequence[str],
    periods: Sequence[str],
    *,
    with_proportions: bool = True,
    only_proportions: bool = False,
    id_col: str | None = None,
) -> DataFrame:
    """How often a value occurs in the period of the row, as ``<column>_<period>``.

    With ``with_proportions`` the share of the period's rows comes beside it, with
    ``only_proportions`` instead of it.  A missing value is a value of its own.
    """
    if with_proportions and only_proportions:
        raise ValueError("with_proportions and only_proportions exclude each other")
    pairs = [(c, p) for p in periods for c in cols]
    share = with_proportions or only_proportions
    sets = [list(pair) for pair in pairs] + ([[p] for p in periods] if share else [])
    found = grouped(df, sets, [], keep_nulls=True)
    lookups, extra = [], []
    if share:
        for p in periods:
            total = found[(p,)].select(p, F.col("n").alias(f"__total_{p}"))
            lookups.append(lookup(total, [p], [f"__total_{p}"], null_safe=True, weight=f"__total_{p}"))
    for c, p in pairs:
        name, n = f"{c}_{p}", f"__count_{c}_{p}"
        ready = found[(c, p)].select(c, p, F.col("n").alias(n))
        lookups.append(lookup(ready, [c, p], [n], null_safe=True, weight=n))
        proportion = F.try_divide(F.col(n), F.col(f"__total_{p}")) if share else None
        extra.append((proportion if only_proportions else F.col(n)).alias(name))
        if with_proportions:
            extra.append(proportion.alias(f"{name}_proportions"))
    out = attach_all(df, lookups, id_col=id_col)
    return out.select(*df.columns, *extra)


def period_scaling(
    df: DataFrame,
    measures: Sequence[str],
    periods: Sequence[str],
    *,
    kinds: Sequence[str] = ("min_max", "std_score"),
    split_col: str = "split",
) -> DataFrame:
    """Scale each measure inside its period and split.

    ``min_max`` gives the place between the period's extremes, ``std_score`` the distance from
    its mean in standard deviations; both as ``<measure>_<period>_<kind>``.
    """
    needs = {"min_max": ("min", "max"), "std_score": ("mean", "std")}
    aggs = [a for k in kinds for a in needs[k]]
    found = grouped(df, [[split_col, p] for p in periods], _stat_columns(measures, aggs))
    lookups, extra = [], []
    for p in periods:
        names = {_stat(m, a): f"{_stat(m, a)}__{p}" for m in measures for a in aggs}
        ready = _ready(found[(split_col, p)], [split_col, p], names)
        lookups.append(lookup(ready, [split_col, p], list(names.values()), weight="__n"))
        for m in measures:
            at = {a: F.col(names[_stat(m, a)]) for a in aggs}
            x = F.col(m)
            if "min_max" in kinds:
                scaled = F.try_divide(x - at["min"], at["max"] - at["min"])
                extra.append(scaled.cast("double").alias(f"{m}_{p}_min_max"))
            if "std_score" in kinds:
                extra.append(F.try_divide(x - at["mean"], at["std"]).alias(f"{m}_{p}_std_score"))
    return attach_all(df, lookups).select(*df.columns, *extra)


def ratio_to_group(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    aggs: Sequence[str] = ("mean", "std"),
    *,
    split_col: str = "split",
    id_col: str | None = None,
) -> DataFrame:
    """Measure over its key's mean (or deviation) within the split: ``<measure>_to_<agg>_<key>``."""
    keys = list(dict.fromkeys(k for _, k in pairs))
    measures = list(dict.fromkeys(m for m, _ in pairs))
    found = grouped(df, [[split_col, k] for k in keys], _stat_columns(measures, aggs))
    lookups, extra = [], []
    for k in keys:
        wanted = [m for m, key in dict.fromkeys(pairs) if key == k]
        names = {_stat(m, a): f"{_stat(m, a)}__{k}" for m in wanted for a in aggs}
        ready = _ready(found[(split_col, k)], [split_col, k], names)
        lookups.append(lookup(ready, [split_col, k], list(names.values()), weight="__n"))
        for m in wanted:
            for a in aggs:
                ratio = F.try_divide(F.col(m), F.col(names[_stat(m, a)]))
                extra.append(ratio.alias(f"{m}_to_{a}_{k}"))
    return attach_all(df, lookups, id_col=id_col).select(*df.columns, *extra)


def conditional_ratio(
    df: DataFrame, part: Sequence[str], whole: Sequence[str], out: str, *, id_col: str | None = None
) -> DataFrame:
    """Rows sharing the ``part`` key over rows sharing the ``whole`` key; null if a member is."""
    found = grouped(df, [part, whole], [])
    lookups = []
    for keys, name in ((part, "__part"), (whole, "__whole")):
        ready = found[tuple(keys)].select(*keys, F.col("n").alias(name))
        lookups.append(lookup(ready, list(keys), [name], weight=name))
    wide = attach_all(df, lookups, id_col=id_col)
    return wide.select(*df.columns, F.try_divide("__part", "__whole").alias(out))


def mean_distance(
    df: DataFrame,
    keys: Sequence[str],
    positions: Sequence[tuple[str, str, str]],
    *,
    split_col: str = "split",
    id_col: str | None = None,
) -> DataFrame:
    """Distance of a position from its mean for the key in the period, within the split.

    ``positions`` lists (period, position, suffix); the result is ``<key>_<period><suffix>``.
    Rows with a missing key form a group of their own.
    """
    sets = {(k, p): [split_col, k, p] for k in keys for p, _, _ in positions}
    measures = list(dict.fromkeys(x for _, x, _ in positions))
    found = grouped(df, list(sets.values()), _stat_columns(measures, ["mean"]), keep_nulls=True)
    lookups, extra = [], []
    for k in keys:
        for period, position, suffix in positions:
            on = sets[(k, period)]
            name = f"__mean_{k}_{period}_{position}"
            ready = _ready(found[tuple(on)], on, {_stat(position, "mean"): name})
            lookups.append(lookup(ready, on, [name], null_safe=True, weight="__n"))
            extra.append((F.col(position) - F.col(name)).alias(f"{k}_{period}{suffix}"))
    return attach_all(df, lookups, id_col=id_col).select(*df.columns, *extra)


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, counted: str = "n") -> DataFrame:
    """The most frequent value per key, the largest one on a tie, with the rows of the key.

    ``df`` already holds a count per (key, value), so this is a plain maximum, combined on the
    map side, and no sorted window.
    """
    top = F.max(F.struct(F.col(counted), F.col(value)))
    return df.groupBy(*keys).agg(F.sum(counted).alias("n"), top.getField(value).alias("mode"))


def _modes(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> dict[tuple[str, ...], Sized]:
    """Most frequent last member of each key set per the members before it.

    Counts and modes of the sets of a pass come from one plan: count per (key, value), then the
    maximum per key, stored once.  Values of different types go in passes of their own, so that a
    mode has its column's type.
    """
    found: dict[tuple[str, ...], Sized] = {}
    by_kind: dict[str, list[Sequence[str]]] = {}
    for s in key_sets:
        by_kind.setdefault(df.schema[s[-1]].dataType.simpleString(), []).append(s)
    for kind, sets in [(kind, sets) for kind, same in by_kind.items() for sets in passes(same)]:
        counts, ids = combine_sets(df, sets, [F.count(F.lit(1)).alias("n")])
        keys = list(dict.fromkeys(c for s in sets for c in s[:-1]))
        value = F.coalesce(*[F.when(F.col("__set") == ids[s], F.col(s[-1]).cast(kind)) for s in sets])
        modes = most_frequent(counts.withColumn("__value", value), ["__set", *keys], "__value")
        found |= stage_sets(modes, ids, ["n", "mode"], keys=lambda s: s[:-1])
    return found


def mode_distance(
    df: DataFrame,
    keys: Sequence[str],
    positions: Sequence[tuple[str, str, str]],
    *,
    split_col: str = "split",
    id_col: str | None = None,
) -> DataFrame:
    """Distance of a position from its most frequent value for the key in the period.

    Named like ``mean_distance``; a row with a missing key gets null.
    """
    sets = {(k, p, x): (split_col, k, p, x) for k in keys for p, x, _ in positions}
    found = _modes(df, list(sets.values()))
    lookups, extra = [], []
    for k in keys:
        for period, position, suffix in positions:
            on = [split_col, k, period]
            name = f"__mode_{k}_{period}_{position}"
            ready = _ready(found[sets[(k, period, position)]], on, {"mode": name})
            lookups.append(lookup(ready, on, [name], weight="__n"))
            extra.append((F.col(position) - F.col(name)).alias(f"{k}_{period}{suffix}"))
    return attach_all(df, lookups, id_col=id_col).select(*df.columns, *extra)


def scale_by_train_max(df: DataFrame, cols: Sequence[str], *, split_col: str = "split") -> DataFrame:
    """Column over its largest training value, as ``<column>_scaled``."""
    top = df.filter(F.col(split_col) == "train").agg(*[F.max(c).alias(c) for c in cols]).first()
    return df.withColumns({f"{c}_scaled": F.try_divide(F.col(c), F.lit(top[c])) for c in cols})


def clip_to_last_period(
    df: DataFrame, cols: Sequence[str], period: str, *, split_col: str = "split"
) -> DataFrame:
    """Cap each column at its maximum in the last training period."""
    train = df.filter(F.col(split_col) == "train")
    last = train.agg(F.max(period)).first()[0]
    top = train.filter(F.col(period) == F.lit(last)).agg(*[F.max(c).alias(c) for c in cols]).first()
    capped = {
        c: F.when(F.col(c) > F.lit(top[c]), F.lit(top[c])).otherwise(F.col(c))
        for c in cols
        if top[c] is not None
    }
    return df.withColumns(capped)
