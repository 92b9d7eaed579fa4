"""Queries on statistics per key, per period and per key within a period."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import concat_key
from ..operators import evaluate, groupstats
from . import roles
from .encoders import UID_SQL, uid_columns
from .registry import R, named, r

WITH_UIDS = f"WITH {roles.TRANSACTIONS}, u AS (SELECT *, {UID_SQL} FROM txn)"


def _uids(spark, d):
    return roles.transactions(spark, d).withColumns(uid_columns())


STAT_KEYS = ("card1", "addr1", "uid", "uid2", "bank_type")
STAT_MEASURES = ("amount", "D1", "D2")


def _rounded(df, cols, digits=4):
    return df.select("txn_id", *[r(c, digits).alias(c) for c in cols])


@named(
    "agg_uid_stats",
    WITH_UIDS
    + "".join(
        f", s{i} AS (SELECT {k} AS k, "
        + ", ".join(
            f"{R(f'avg({m})', 5)} AS {k}_{m}_mean, {R(f'stddev_samp({m})', 4)} AS {k}_{m}_std" for m in STAT_MEASURES
        )
        + f" FROM u WHERE {k} IS NOT NULL GROUP BY 1)"
        for i, k in enumerate(STAT_KEYS)
    )
    + " SELECT txn_id, "
    + ", ".join(f"{k}_{m}_{a}" for k in STAT_KEYS for m in STAT_MEASURES for a in ("mean", "std"))
    + " FROM u "
    + " ".join(f"LEFT JOIN s{i} ON u.{k} = s{i}.k" for i, k in enumerate(STAT_KEYS)),
)
def agg_uid_stats(spark, d):
    t = _uids(spark, d).select("txn_id", *STAT_KEYS, *STAT_MEASURES)
    out = groupstats.uid_stats(t, list(STAT_KEYS), list(STAT_MEASURES))
    names = [(f"{k}_{m}_{a}", 5 if a == "mean" else 4) for k in STAT_KEYS for m in STAT_MEASURES for a in ("mean", "std")]
    return out.select("txn_id", *[r(n, digits).alias(n) for n, digits in names])


@named(
    "agg_uid_std_norm",
    WITH_UIDS
    + f""", s AS (SELECT uid AS k, avg(amount) AS m, stddev_samp(amount) AS sd FROM u GROUP BY 1)
  SELECT txn_id, {R('(amount - m) / nullif(sd, 0)', 7)} AS uid_amount_std_norm FROM u JOIN s ON uid = k""",
)
def agg_uid_std_norm(spark, d):
    t = _uids(spark, d).select("txn_id", "uid", "amount")
    return _rounded(groupstats.uid_std_norm(t, ["uid"], ["amount"]), ["uid_amount_std_norm"], 7)


@named(
    "agg_period_total",
    f"""WITH {roles.EVENTS} SELECT event_id, count(*) OVER (PARTITION BY DT_M) AS DT_M_total,
  count(*) OVER (PARTITION BY DT_W) AS DT_W_total, count(*) OVER (PARTITION BY DT_D) AS DT_D_total FROM ev""",
)
def agg_period_total(spark, d):
    e = roles.events(spark, d).select("event_id", "DT_M", "DT_W", "DT_D")
    return groupstats.period_totals(e, ["DT_M", "DT_W", "DT_D"]).drop("DT_M", "DT_W", "DT_D")


def _block(c: str, p: str) -> str:
    share = f"count(*) OVER (PARTITION BY {c}, {p}) * 1.0 / count(*) OVER (PARTITION BY {p})"
    return f"{R(share, 8)} AS {c}_{p}"


@named(
    "agg_timeblock_freq",
    f"""WITH {roles.EVENTS} SELECT event_id, {', '.join(_block(c, p) for p in ('DT_M', 'DT_W', 'DT_D')
    for c in ('kind', 'user_id'))} FROM ev""",
)
def agg_timeblock_freq(spark, d):
    e = roles.events(spark, d).select("event_id", "kind", "user_id", "DT_M", "DT_W", "DT_D")
    periods, cols = ["DT_M", "DT_W", "DT_D"], ["kind", "user_id"]
    out = groupstats.timeblock_frequency(e, cols, periods, with_proportions=False, only_proportions=True)
    return out.select("event_id", *[r(f"{c}_{p}", 8).alias(f"{c}_{p}") for p in periods for c in cols])


def _minmax(c: str, p: str) -> str:
    w = f"OVER (PARTITION BY split, {p})"
    return f"{R(f'({c} - min({c}) {w}) / nullif(max({c}) {w} - min({c}) {w}, 0)', 8)} AS {c}_{p}_min_max"


def _zscore(c: str, p: str) -> str:
    w = f"OVER (PARTITION BY split, {p})"
    return f"{R(f'({c} - avg({c}) {w}) / nullif(stddev_samp({c}) {w}, 0)', 7)} AS {c}_{p}_std_score"


SCALED = [(c, p) for c in ("amount", "D2") for p in ("DT_M", "DT_Y")]


def _with_year(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", "amount", "D2", "DT_M", F.year("ts").alias("DT_Y"))
    return t


@named(
    "agg_period_minmax",
    f"""WITH {roles.TRANSACTIONS}, y AS (SELECT *, year(ts) AS DT_Y FROM txn)
  SELECT txn_id, {', '.join(_minmax(c, p) for c, p in SCALED)} FROM y""",
)
def agg_period_minmax(spark, d):
    out = groupstats.period_scaling(_with_year(spark, d), ["amount", "D2"], ["DT_M", "DT_Y"], kinds=["min_max"])
    return _rounded(out, [f"{c}_{p}_min_max" for c, p in SCALED], 8)


@named(
    "agg_period_zscore",
    f"""WITH {roles.TRANSACTIONS}, y AS (SELECT *, year(ts) AS DT_Y FROM txn)
  SELECT txn_id, {', '.join(_zscore(c, p) for c, p in SCALED)} FROM y""",
)
def agg_period_zscore(spark, d):
    out = groupstats.period_scaling(_with_year(spark, d), ["amount", "D2"], ["DT_M", "DT_Y"], kinds=["std_score"])
    return _rounded(out, [f"{c}_{p}_std_score" for c, p in SCALED], 7)


RATIOS = [("amount", "card1"), ("amount", "addr1"), ("D2", "addr1")]


def _ratio(m: str, k: str, a: str) -> str:
    f = {"mean": "avg", "std": "stddev_samp"}[a]
    value = R(f"{m} / nullif({f}({m}) OVER (PARTITION BY split, {k}), 0)", 7)
    return f"CASE WHEN {k} IS NOT NULL THEN {value} END AS {m}_to_{a}_{k}"


def _ratio_sql(a: str) -> str:
    return f"WITH {roles.TRANSACTIONS} SELECT txn_id, {', '.join(_ratio(m, k, a) for m, k in RATIOS)} FROM txn"


def _ratios(spark, d, a):
    t = roles.transactions(spark, d).select("txn_id", "split", "card1", "addr1", "amount", "D2")
    out = groupstats.ratio_to_group(t, RATIOS, [a])
    return _rounded(out, [f"{m}_to_{a}_{k}" for m, k in RATIOS], 7)


@named("agg_ratio_to_mean", _ratio_sql("mean"))
def agg_ratio_to_mean(spark, d):
    return _ratios(spark, d, "mean")


@named("agg_ratio_to_std", _ratio_sql("std"))
def agg_ratio_to_std(spark, d):
    return _ratios(spark, d, "std")


@named(
    "agg_cond_ratio",
    f"""WITH {roles.TRANSACTIONS}, b AS (SELECT card3, card5, count(*) AS n FROM txn
  WHERE card3 IS NOT NULL AND card5 IS NOT NULL GROUP BY 1, 2),
  a AS (SELECT card3, card5, addr1, count(*) AS n FROM txn
  WHERE card3 IS NOT NULL AND card5 IS NOT NULL AND addr1 IS NOT NULL GROUP BY 1, 2, 3)
  SELECT txn_id, {R('a.n * 1.0 / b.n', 8)} AS address_match FROM txn t
  LEFT JOIN b ON t.card3 = b.card3 AND t.card5 = b.card5
  LEFT JOIN a ON t.card3 = a.card3 AND t.card5 = a.card5 AND t.addr1 = a.addr1""",
)
def agg_cond_ratio(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "card3", "card5", "addr1")
    out = groupstats.conditional_ratio(t, ["card3", "card5", "addr1"], ["card3", "card5"], "address_match")
    return _rounded(out, ["address_match"], 8)


POSITIONS = [
    ("DT_D", "DT_hour", "_hour_dist"),
    ("DT_W", "DT_day_week", "_week_day_dist"),
    ("DT_M", "DT_day_month", "_month_day_dist"),
]
EVENT_KEYS = ("user_id", "kind", "pair")
EVENTS_BOTH = f"WITH {roles.EVENTS}, e AS (SELECT *, CAST(user_id AS VARCHAR) || '_' || coalesce(kind, 'nan') AS pair FROM ev)"


def _events_both(spark, d):
    cols = ["event_id", "split", "user_id", "kind", "DT_M", "DT_W", "DT_D", "DT_hour", "DT_day_week", "DT_day_month"]
    e = roles.events(spark, d).select(*cols)
    return e.withColumn("pair", concat_key(F.col("user_id"), F.col("kind")))


@named(
    "agg_mean_dist",
    EVENTS_BOTH
    + " SELECT event_id, "
    + ", ".join(
        R(f"{x} - avg({x}) OVER (PARTITION BY split, {k}, {p})", 6) + f" AS {k}_{p}{s}"
        for k in EVENT_KEYS
        for p, x, s in POSITIONS
    )
    + " FROM e",
)
def agg_mean_dist(spark, d):
    out = groupstats.mean_distance(_events_both(spark, d), list(EVENT_KEYS), POSITIONS)
    names = [f"{k}_{p}{s}" for k in EVENT_KEYS for p, _, s in POSITIONS]
    return out.select("event_id", *[r(n).alias(n) for n in names])


def _mode_cte(k: str, p: str, x: str) -> str:
    return f"""m_{k}_{p} AS (SELECT split, {k}, {p}, {x} AS mode FROM (SELECT split, {k}, {p}, {x},
  row_number() OVER (PARTITION BY split, {k}, {p} ORDER BY count(*) DESC, {x} DESC) AS rn
  FROM e GROUP BY split, {k}, {p}, {x}) WHERE rn = 1)"""


def _mode_sql(keys, positions) -> str:
    pairs = [(k, p, x, s) for k in keys for p, x, s in positions]
    return (
        EVENTS_BOTH
        + "".join(f", {_mode_cte(k, p, x)}" for k, p, x, _ in pairs)
        + " SELECT e.event_id, "
        + ", ".join(f"e.{x} - m_{k}_{p}.mode AS {k}_{p}{s}_best" for k, p, x, s in pairs)
        + " FROM e "
        + " ".join(
            f"LEFT JOIN m_{k}_{p} ON e.split = m_{k}_{p}.split AND e.{k} = m_{k}_{p}.{k} AND e.{p} = m_{k}_{p}.{p}"
            for k, p, _, _ in pairs
        )
    )


@named("agg_mode_dist", _mode_sql(EVENT_KEYS, POSITIONS))
def agg_mode_dist(spark, d):
    positions = [(p, x, f"{s}_best") for p, x, s in POSITIONS]
    out = groupstats.mode_distance(_events_both(spark, d), list(EVENT_KEYS), positions)
    return out.select("event_id", *[f"{k}_{p}{s}" for k in EVENT_KEYS for p, _, s in positions])


@named(
    "agg_scalar_scale",
    f"""WITH {roles.TRANSACTIONS}, m AS (SELECT max(D1) AS a, max(D2) AS b FROM txn WHERE split = 'train')
  SELECT txn_id, {R('D1 / a', 8)} AS D1_scaled, {R('D2 / b', 8)} AS D2_scaled FROM txn, m""",
)
def agg_scalar_scale(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", "D1", "D2")
    return _rounded(groupstats.scale_by_train_max(t, ["D1", "D2"]), ["D1_scaled", "D2_scaled"], 8)


@named(
    "agg_clip_last_period",
    f"""WITH {roles.TRANSACTIONS}, l AS (SELECT max(DT_M) AS last FROM txn WHERE split = 'train'),
  m AS (SELECT max(amount) AS a, max(D2) AS b FROM txn, l WHERE split = 'train' AND DT_M = last)
  SELECT txn_id, CASE WHEN amount > a THEN a ELSE amount END AS amount, CASE WHEN D2 > b THEN b ELSE D2 END AS D2
  FROM txn, m""",
)
def agg_clip_last_period(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", "DT_M", "amount", "D2")
    return groupstats.clip_to_last_period(t, ["amount", "D2"], "DT_M").select("txn_id", "amount", "D2")


@named(
    "agg_importance_mean",
    f"""WITH {roles.IMPORTANCES} SELECT feature, {R('avg(importance)')} AS used_folds,
  {R('sum(importance) / 5')} AS all_folds FROM imp GROUP BY 1""",
)
def agg_importance_mean(spark, d):
    imp = roles.importances(spark, d)
    used = evaluate.mean_importance(imp).withColumnRenamed("importance", "used_folds")
    every = evaluate.mean_importance(imp, folds=5).withColumnRenamed("importance", "all_folds")
    both = used.join(every, "feature")
    return both.select("feature", r("used_folds").alias("used_folds"), r("all_folds").alias("all_folds"))


@named(
    "win_transform",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, {R('avg(amount) OVER (PARTITION BY card1)')} AS card1_amount_mean,
  {R('stddev_samp(amount) OVER (PARTITION BY card1)', 4)} AS card1_amount_std FROM txn""",
)
def win_transform(spark, d):
    # An unbounded window per key gives the same; aggregate and join also stands a hot key.
    t = roles.orders(spark, d).select("txn_id", "card1", "amount")
    out = groupstats.uid_stats(t, ["card1"], ["amount"])
    return out.select(
        "txn_id", r("card1_amount_mean").alias("card1_amount_mean"), r("card1_amount_std", 4).alias("card1_amount_std")
    )


@named(
    "win_keep_last",
    EVENTS_BOTH
    + """ SELECT user_id, DT_W, mode, n FROM (SELECT user_id, DT_W, DT_hour AS mode, sum(count(*)) OVER
  (PARTITION BY user_id, DT_W) AS n, row_number() OVER (PARTITION BY user_id, DT_W ORDER BY count(*) DESC,
  DT_hour DESC) AS rn FROM e GROUP BY user_id, DT_W, DT_hour) WHERE rn = 1""",
)
def win_keep_last(spark, d):
    counts = roles.events(spark, d).groupBy("user_id", "DT_W", "DT_hour").agg(F.count(F.lit(1)).alias("n"))
    return groupstats.most_frequent(counts, ["user_id", "DT_W"], "DT_hour")


CUM = f"""WITH {roles.IMPORTANCES}, m AS (SELECT feature, avg(importance) AS importance FROM imp GROUP BY 1),
  c AS (SELECT feature, importance, sum(importance) OVER (ORDER BY feature ROWS UNBOUNDED PRECEDING) AS cum_sum,
  sum(importance) OVER () AS total FROM m)"""


def _cumulative(spark, d, order_by="feature"):
    return evaluate.cumulative_importance(evaluate.mean_importance(roles.importances(spark, d)), order_by=order_by)


@named(
    "win_cumsum",
    CUM
    + f""" SELECT feature, {R('importance / total', 8)} AS perc, {R('cum_sum', 4)} AS cum_sum,
  {R('100 * cum_sum / total')} AS cum_perc FROM c""",
)
def win_cumsum(spark, d):
    out = _cumulative(spark, d)
    return out.select(
        "feature", r("perc", 8).alias("perc"), r("cum_sum", 4).alias("cum_sum"), r("cum_perc").alias("cum_perc")
    )


@named("win_cum_filter", CUM + " SELECT feature FROM c WHERE 100 * cum_sum / total <= 85")
def win_cum_filter(spark, d):
    return evaluate.keep_cumulative(_cumulative(spark, d), 85).select("feature")


@named(
    "sel_cum_importance",
    CUM
    + """ SELECT feature FROM (SELECT feature, sum(importance) OVER (ORDER BY importance DESC, feature
  ROWS UNBOUNDED PRECEDING) AS s, total FROM c) WHERE 100 * s / total <= 95""",
)
def sel_cum_importance(spark, d):
    return evaluate.keep_cumulative(_cumulative(spark, d, "importance"), 95).select("feature")
