"""Join and assembly queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import literal_map
from ..operators import assemble, encode, evaluate, groupstats, profile, rows, selection
from ..operators.keyed import attach, measure
from . import roles
from .registry import R, named, r


def _identity(spark, d):
    return roles.table(spark, d, "events").select(
        F.col("event_id").alias("txn_id"), "event_type", "value", F.col("user_id").alias("device")
    )


@named(
    "join_left_identity",
    f"""WITH {roles.ORDERS} SELECT txn_id, amount, split, event_type, value, user_id AS device
  FROM txn LEFT JOIN events ON txn_id = event_id""",
)
def join_left_identity(spark, d):
    o = roles.orders(spark, d).select("txn_id", "amount", "split")
    return o.join(_identity(spark, d), "txn_id", "left")


@named(
    "join_semi_keys",
    f"""WITH {roles.ORDERS} SELECT event_id AS txn_id, event_type, value, user_id AS device FROM events
  WHERE event_id IN (SELECT txn_id FROM txn WHERE split = 'train')""",
)
def join_semi_keys(spark, d):
    train = roles.orders(spark, d).filter(F.col("split") == "train")
    # One row per id on both sides, so there is nothing to spread.
    return _identity(spark, d).join(train.select("txn_id"), "txn_id", "left_semi")


@named(
    "join_anti_keys",
    f"""WITH {roles.ORDERS} SELECT txn_id, card1, amount FROM txn WHERE split = 'train'
  AND card1 NOT IN (SELECT card1 FROM txn WHERE split = 'test' AND card1 IS NOT NULL)""",
)
def join_anti_keys(spark, d):
    o = roles.orders(spark, d)
    train = o.filter(F.col("split") == "train").select("txn_id", "card1", "amount")
    return rows.keep_members(train, o.filter(F.col("split") == "test"), ["card1"], negate=True)


@named(
    "join_lookup",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, addr1, n_name AS nation FROM txn
  LEFT JOIN (SELECT CASE WHEN n_nationkey < 20 THEN n_nationkey END AS k, n_name FROM nation) ON addr1 = k""",
)
def join_lookup(spark, d):
    known = F.when(F.col("n_nationkey") < 20, F.col("n_nationkey")).alias("n_nationkey")
    names = roles.table(spark, d, "nation").select(known, F.col("n_name").alias("nation"))
    t = roles.transactions(spark, d).select("txn_id", "addr1")
    return attach(t, measure(names), {"addr1": "n_nationkey"})


@named(
    "join_lookup_nullsafe",
    f"""WITH {roles.TRANSACTIONS}, n AS (SELECT nullif(n_nationkey, 0) AS k, n_name AS nation FROM nation)
  SELECT txn_id, addr1, nation FROM txn LEFT JOIN n ON addr1 IS NOT DISTINCT FROM k""",
)
def join_lookup_nullsafe(spark, d):
    names = roles.table(spark, d, "nation")
    names = names.select(F.nullif("n_nationkey", F.lit(0)).alias("addr1"), F.col("n_name").alias("nation"))
    t = roles.transactions(spark, d).select("txn_id", "addr1")
    return attach(t, measure(names), ["addr1"], null_safe=True)


@named(
    "join_literal_dict",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, CASE product WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3
  WHEN '3-MEDIUM' THEN 2 END AS urgency FROM txn""",
)
def join_literal_dict(spark, d):
    codes = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2}
    return roles.orders(spark, d).select("txn_id", literal_map(F.col("product"), codes).alias("urgency"))


@named(
    "bind_columns",
    f"""WITH {roles.TRANSACTIONS}, x AS (SELECT CASE WHEN txn_id % 3 <> 0 THEN txn_id ELSE -txn_id END AS txn_id, -1.0 AS amount, D1, D2 FROM txn)
  SELECT t.txn_id, t.amount, t.product, x.D1, x.D2 FROM txn t LEFT JOIN x ON t.txn_id = x.txn_id""",
)
def bind_columns(spark, d):
    left = roles.orders(spark, d).select("txn_id", "amount", "product")
    other = F.when(F.col("txn_id") % 3 != 0, F.col("txn_id")).otherwise(-F.col("txn_id"))
    right = roles.transactions(spark, d).select(other.alias("txn_id"), F.lit(-1.0).alias("amount"), "D1", "D2")
    return assemble.bind_columns(left, right, key="txn_id")


@named(
    "set_column_difference",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, D1, D2, addr1, card3, card5 FROM txn""",
)
def set_column_difference(spark, d):
    wide = roles.transactions(spark, d)
    return wide.select("txn_id", *assemble.new_columns(roles.orders(spark, d), wide))


@named(
    "asm_feature_sets",
    f"""WITH {roles.TRANSACTIONS},
  a AS (SELECT txn_id, DT_M, product FROM txn),
  b AS (SELECT txn_id, 'b' AS product, amount, card3 FROM txn),
  c AS (SELECT txn_id, 'c' AS card3, count(*) OVER (PARTITION BY card1) AS card1_fq_enc FROM txn),
  e AS (SELECT event_id AS txn_id, value, event_type, -1 AS DT_M FROM events)
  SELECT a.txn_id, a.DT_M, a.product, b.amount, b.card3, c.card1_fq_enc, e.value, e.event_type
  FROM a LEFT JOIN b USING (txn_id) LEFT JOIN c USING (txn_id) LEFT JOIN e ON a.txn_id = e.txn_id""",
)
def asm_feature_sets(spark, d):
    t = roles.transactions(spark, d)
    base = t.select("txn_id", "DT_M", "product")
    second = t.select("txn_id", F.lit("b").alias("product"), "amount", "card3")
    counted = encode.fit_counts(t, ["card1"]).apply(t.select("txn_id", "card1"), suffix="_fq_enc")
    third = counted.select("txn_id", F.lit("c").alias("card3"), "card1_fq_enc")
    fourth = roles.table(spark, d, "events").select(
        F.col("event_id").alias("txn_id"), "value", "event_type", F.lit(-1).alias("DT_M")
    )
    return assemble.assemble_sets(base, second, third, fourth, key="txn_id")


BEST = ("amount", "D1", "D2")


def _derived(spark, d):
    t = roles.transactions(spark, d).filter(F.col("split") == "train")
    wide = groupstats.period_scaling(t, ["amount", "D2"], ["DT_M"])
    logs = {f"{c}_log": F.log1p(F.abs(F.col(c))) for c in ("amount", "D1", "D2")}
    return wide.withColumns(logs)


DERIVED_SQL = f"""{roles.TRANSACTIONS}, g AS (SELECT DT_M, min(amount) AS lo_a, max(amount) AS hi_a, avg(amount) AS mean_a,
  stddev_samp(amount) AS sd_a, min(D2) AS lo_d, max(D2) AS hi_d, avg(D2) AS mean_d, stddev_samp(D2) AS sd_d
  FROM txn WHERE split = 'train' GROUP BY 1),
  w AS (SELECT label, (amount - lo_a) / nullif(hi_a - lo_a, 0) AS amount_DT_M_min_max,
  (amount - mean_a) / nullif(sd_a, 0) AS amount_DT_M_std_score, (D2 - lo_d) / nullif(hi_d - lo_d, 0) AS D2_DT_M_min_max,
  (D2 - mean_d) / nullif(sd_d, 0) AS D2_DT_M_std_score, ln(1 + abs(amount)) AS amount_log, ln(1 + abs(D1)) AS D1_log,
  ln(1 + abs(D2)) AS D2_log FROM txn JOIN g USING (DT_M) WHERE split = 'train')"""
DERIVED = (
    "amount_DT_M_min_max", "amount_DT_M_std_score", "D2_DT_M_min_max", "D2_DT_M_std_score",
    "amount_log", "D1_log", "D2_log",
)


@named(
    "sel_best_by_corr",
    f"WITH {DERIVED_SQL}, c AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS best, abs(corr(CAST(label AS DOUBLE), coalesce({c}, 0))) AS a FROM w" for c in DERIVED
    )
    + f"""), b AS (SELECT * FROM (VALUES ('amount'), ('D1'), ('D2')) v(base)),
  k AS (SELECT base, best, a, row_number() OVER (PARTITION BY base ORDER BY a DESC) AS rn FROM b JOIN c
  ON contains(best, base) WHERE a > 0) SELECT base, best, {R('a', 8)} AS abs_corr FROM k WHERE rn = 1""",
)
def sel_best_by_corr(spark, d):
    found = selection.best_by_correlation(_derived(spark, d), "label", list(BEST), list(DERIVED))
    return found.withColumn("abs_corr", r("abs_corr", 8))


RANKED = ("amount", "D1", "D2", "card1", "addr1")


@named(
    "sel_drop_low_importance",
    f"WITH {roles.TRANSACTIONS}, imp AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, abs(corr(CAST(label AS DOUBLE), CAST(coalesce({c}, 0) AS DOUBLE))) AS a FROM txn"
        for c in RANKED
    )
    + "), kept AS (SELECT feature FROM imp ORDER BY a DESC, feature DESC LIMIT 3), long AS ("
    + " UNION ALL ".join(f"SELECT txn_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM txn" for c in RANKED)
    + ") SELECT * FROM long WHERE feature IN (SELECT feature FROM kept) AND value IS NOT NULL",
)
def sel_drop_low_importance(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "label", *[F.col(c).cast("double") for c in RANKED])
    strength = profile.target_correlations(t, "label", list(RANKED))
    ranked = strength.select(F.col("column").alias("feature"), F.abs("corr").alias("importance"))
    kept = rows.drop_named(t, evaluate.bottom_features(ranked, 2)).drop("label")
    # Shown as (row, feature, value), since which columns remain depends on the data.
    long = kept.unpivot(["txn_id"], [c for c in kept.columns if c != "txn_id"], "feature", "value")
    return long.filter(F.col("value").isNotNull())
