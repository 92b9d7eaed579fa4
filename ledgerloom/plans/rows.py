"""Column choice, row choice and key masks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import evaluate, masks, profile, rows
from ..sources import tables as io
from . import roles
from .registry import R, named, r

CLIENT = "txn_id, split"


@named("proj_whitelist", f"WITH {roles.TRANSACTIONS} SELECT ts, product, label, card3, D1, amount FROM txn")
def proj_whitelist(spark, d):
    wanted = ["amount", "product", "card3", "D1", "V307", "DeviceInfo"]
    return rows.keep_columns(roles.transactions(spark, d), wanted, always=["label", "ts"])


@named("proj_drop", f"WITH {roles.TRANSACTIONS} SELECT amount, product, card1, card4, addr1, card3, card5, D1, D2 FROM txn")
def proj_drop(spark, d):
    return roles.transactions(spark, d).drop("txn_id", "ts", "label", "split", "DT_M")


@named(
    "proj_drop_by_table",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, card1, amount, ts, product, label, split, DT_M, addr1, card3, D1 FROM txn""",
)
def proj_drop_by_table(spark, d):
    t = roles.transactions(spark, d)
    listed = profile.null_counts(t, ["card3", "card4", "card5", "D1", "D2"]).filter(F.col("nulls") > 0)
    return rows.drop_named(t, listed, "column")


@named("filter_class", f"WITH {roles.ORDERS} SELECT txn_id, amount FROM txn WHERE label = 1")
def filter_class(spark, d):
    return roles.orders(spark, d).filter(F.col("label") == 1).select("txn_id", "amount")


@named("filter_non_null", f"WITH {roles.TRANSACTIONS} SELECT txn_id, D2 FROM txn WHERE D2 IS NOT NULL")
def filter_non_null(spark, d):
    return roles.transactions(spark, d).filter(F.col("D2").isNotNull()).select("txn_id", "D2")


@named(
    "filter_rows_head_tail",
    f"""WITH {roles.ORDERS}, n AS (SELECT txn_id, ts, row_number() OVER (ORDER BY ts, txn_id) AS up,
  row_number() OVER (ORDER BY ts DESC, txn_id DESC) AS down FROM txn)
  SELECT txn_id, 'head' AS part FROM n WHERE up <= 9000
  UNION ALL SELECT txn_id, 'tail' FROM n WHERE down <= 2000""",
)
def filter_rows_head_tail(spark, d):
    o = roles.orders(spark, d).select("txn_id", dates.epoch(F.col("ts"), "MICROSECOND").alias("at"))
    first = rows.first_rows(o, ["at", "txn_id"], 9000).select("txn_id", F.lit("head").alias("part"))
    last = rows.last_rows(o, ["at", "txn_id"], 2000).select("txn_id", F.lit("tail").alias("part"))
    return first.unionByName(last)


@named(
    "split_last_period",
    f"""WITH {roles.ORDERS}, m AS (SELECT max(DT_M) AS last FROM txn)
  SELECT txn_id, DT_M, CASE WHEN DT_M = last THEN 'test' ELSE 'train' END AS part FROM txn, m
  WHERE DT_M = last OR DT_M < last - 1""",
)
def split_last_period(spark, d):
    train, test = rows.last_period_split(roles.orders(spark, d).select("txn_id", "DT_M"), "DT_M")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _seen(c: str) -> str:
    return f"""CASE WHEN EXISTS (SELECT 1 FROM txn t WHERE t.split <> a.split
  AND t.{c} IS NOT DISTINCT FROM a.{c}) THEN 1 ELSE 0 END AS {c}_check"""


@named(
    "pred_isin_flag",
    f"WITH {roles.TRANSACTIONS} SELECT {CLIENT}, {_seen('card1')}, {_seen('card4')}, {_seen('D2')} FROM txn a",
)
def pred_isin_flag(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", "card1", "card4", "D2")
    flagged = masks.seen_in_other_split(t, ["card1", "card4", "D2"])
    return flagged.drop("card1", "card4", "D2")


def _counts(c: str) -> str:
    return f"""(SELECT {c} AS k, count(*) AS n, count(*) FILTER (split = 'train') AS n_train,
  count(*) FILTER (split = 'test') AS n_test FROM txn GROUP BY 1)"""


@named(
    "null_if_rare_train",
    f"""WITH {roles.TRANSACTIONS} SELECT {CLIENT}, CASE WHEN n_train > 10 THEN card1 END AS card1 FROM txn
  LEFT JOIN {_counts('card1')} ON card1 = k""",
)
def null_if_rare_train(spark, d):
    t = roles.orders(spark, d).select("txn_id", "split", "card1")
    return masks.null_if_rare(t, ["card1"], min_count=10, scope="train")


@named(
    "null_if_rare_union",
    f"""WITH {roles.TRANSACTIONS} SELECT {CLIENT}, CASE WHEN a.n > 7 THEN card1 END AS card1,
  CASE WHEN b.n > 2 THEN D2 END AS D2 FROM txn
  LEFT JOIN {_counts('card1')} a ON card1 = a.k LEFT JOIN {_counts('D2')} b ON D2 = b.k""",
)
def null_if_rare_union(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", "card1", "D2")
    masked = masks.null_if_rare(t, ["card1"], min_count=7)
    return masks.null_if_rare(masked, ["D2"], min_count=2)


@named(
    "null_if_unshared",
    f"""WITH {roles.TRANSACTIONS} SELECT {CLIENT}, CASE WHEN a.n_train > 0 AND a.n_test > 0 THEN card1 END AS card1,
  CASE WHEN b.n_train > 0 AND b.n_test > 0 THEN card5 END AS card5 FROM txn
  LEFT JOIN {_counts('card1')} a ON card1 = a.k LEFT JOIN {_counts('card5')} b ON card5 = b.k""",
)
def null_if_unshared(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", "card1", "card5")
    return masks.null_if_unshared(t, ["card1", "card5"])


@named(
    "others_bucket",
    f"""WITH {roles.TRANSACTIONS}, c AS (SELECT split, addr1, count(*) AS n FROM txn GROUP BY 1, 2)
  SELECT txn_id, t.split, CASE WHEN n < 200 THEN 'Others' ELSE CAST(t.addr1 AS VARCHAR) END AS addr1
  FROM txn t LEFT JOIN c ON t.split = c.split AND t.addr1 = c.addr1""",
)
def others_bucket(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", F.col("addr1").cast("string").alias("addr1"))
    return masks.others_bucket(t, "addr1", min_count=200)


@named(
    "proj_by_type",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, amount, lower(coalesce(product, 'nan')) AS product,
  lower(coalesce(card5, 'nan')) AS card5, lower(coalesce(split, 'nan')) AS split FROM txn""",
)
def proj_by_type(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "amount", "product", "card5", "split")
    return io.transform_text(t, lambda c: F.lower(F.coalesce(c, F.lit("nan"))))


@named(
    "proj_rename",
    f"""WITH {roles.TRANSACTIONS} SELECT card3, {R('avg(amount)', 4)} AS "card3_amount_mean" FROM txn GROUP BY 1""",
)
def proj_rename(spark, d):
    means = roles.transactions(spark, d).groupBy("card3").agg(F.avg("amount").alias("mean"))
    return means.withColumnRenamed("mean", "card3_amount_mean").withColumn(
        "card3_amount_mean", r("card3_amount_mean", 4)
    )


@named(
    "lit_flag",
    f"""WITH {roles.ORDERS} SELECT txn_id, CASE WHEN e.event_id IS NOT NULL THEN 1 END AS had_id,
  CASE WHEN split = 'test' THEN 0 ELSE label END AS label FROM txn LEFT JOIN events e ON txn_id = e.event_id""",
)
def lit_flag(spark, d):
    identity = roles.table(spark, d, "events").select(F.col("event_id").alias("txn_id"), F.lit(1).alias("had_id"))
    o = roles.orders(spark, d)
    label = F.when(F.col("split") == "test", F.lit(0)).otherwise(F.col("label")).alias("label")
    return o.join(identity, "txn_id", "left").select("txn_id", "had_id", label)


@named("set_union_all", f"""WITH {roles.ORDERS} SELECT amount, product FROM txn WHERE split = 'train'
  UNION ALL SELECT amount, product FROM txn WHERE split = 'test'""")
def set_union_all(spark, d):
    o = roles.orders(spark, d)
    parts = [o.filter(F.col("split") == s).select("amount", "product") for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


@named(
    "set_union_stack",
    f"""WITH {roles.IMPORTANCES} SELECT fold, feature, {R('importance', 4)} AS importance FROM imp""",
)
def set_union_stack(spark, d):
    imp = roles.importances(spark, d).withColumn("importance", r("importance", 4))
    return reduce(DataFrame.unionByName, [imp.filter(F.col("fold") == f) for f in range(5)])


@named("set_distinct", f"WITH {roles.TRANSACTIONS} SELECT DISTINCT card1, card5 FROM txn WHERE split = 'test'")
def set_distinct(spark, d):
    return roles.transactions(spark, d).filter(F.col("split") == "test").select("card1", "card5").distinct()


@named(
    "topk_importance",
    f"""WITH {roles.IMPORTANCES} SELECT feature, {R('avg(importance)')} AS importance FROM imp GROUP BY 1
  ORDER BY avg(importance) DESC, feature LIMIT 50""",
)
def topk_importance(spark, d):
    mean = evaluate.mean_importance(roles.importances(spark, d))
    return evaluate.top_features(mean, 50).withColumn("importance", r("importance"))


@named(
    "bottomk_importance",
    f"""WITH {roles.IMPORTANCES} SELECT feature, {R('avg(importance)')} AS importance FROM imp GROUP BY 1
  ORDER BY avg(importance), feature LIMIT 33""",
)
def bottomk_importance(spark, d):
    mean = evaluate.mean_importance(roles.importances(spark, d))
    return evaluate.bottom_features(mean, 33).withColumn("importance", r("importance"))
