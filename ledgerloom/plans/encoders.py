"""Encoder queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import concat_key
from ..operators import encode
from ..operators.keyed import attach_all, grouped, lookup
from . import roles
from .registry import R, named, r


def _base(spark, d, *cols):
    return roles.transactions(spark, d).select("txn_id", "split", "label", *cols)


def _count_join(c: str, nulls: bool, alias: str, where: str = "") -> str:
    test = f"t.{c} IS NOT DISTINCT FROM {alias}.k" if nulls else f"t.{c} = {alias}.k"
    return f"LEFT JOIN (SELECT {c} AS k, count(*) AS n FROM txn {where} GROUP BY 1) {alias} ON {test}"


COUNTED = ("card1", "addr1", "card5", "D2")


@named(
    "enc_count_union",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, "
    + ", ".join(f"{c}.n AS {c}_fq_enc" for c in COUNTED)
    + " FROM txn t "
    + " ".join(_count_join(c, False, c) for c in COUNTED),
)
def enc_count_union(spark, d):
    t = _base(spark, d, *COUNTED)
    out = encode.fit_counts(t, COUNTED).apply(t, suffix="_fq_enc")
    return out.select("txn_id", *[f"{c}_fq_enc" for c in COUNTED])


@named(
    "enc_count_union_inplace",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, a.n AS card4, b.n AS card5 FROM txn t "
    + _count_join("card4", False, "a") + " " + _count_join("card5", False, "b"),
)
def enc_count_union_inplace(spark, d):
    t = _base(spark, d, "card4", "card5")
    return encode.fit_counts(t, ["card4", "card5"]).apply(t, inplace=True).drop("split", "label")


@named(
    "enc_count_union_nulls",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, a.n AS card4_fq_enc, b.n AS addr1_fq_enc, c.n AS D2_fq_enc FROM txn t "
    + " ".join(_count_join(c, True, x) for c, x in (("card4", "a"), ("addr1", "b"), ("D2", "c"))),
)
def enc_count_union_nulls(spark, d):
    t = _base(spark, d, "card4", "addr1", "D2")
    out = encode.fit_counts(t, ["card4", "addr1", "D2"], count_nulls=True).apply(t, suffix="_fq_enc")
    return out.select("txn_id", "card4_fq_enc", "addr1_fq_enc", "D2_fq_enc")


@named(
    "enc_count_split",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, count(*) OVER (PARTITION BY split, card4) AS card4_count_dist,
  count(*) OVER (PARTITION BY split, addr1) AS addr1_count_dist FROM txn""",
)
def enc_count_split(spark, d):
    t = _base(spark, d, "card4", "addr1")
    fitted = encode.fit_counts(t, ["card4", "addr1"], scope="split", count_nulls=True)
    return fitted.apply(t, suffix="_count_dist").select("txn_id", "card4_count_dist", "addr1_count_dist")


def _mean_join(c: str, alias: str) -> str:
    return (
        f"LEFT JOIN (SELECT {c} AS k, {R('avg(label)', 8)} AS m FROM txn WHERE split = 'train' GROUP BY 1) {alias} "
        f"ON t.{c} = {alias}.k"
    )


@named(
    "enc_target_mean",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, a.m AS product_target_mean, b.m AS card5_target_mean FROM txn t "
    + _mean_join("product", "a") + " " + _mean_join("card5", "b"),
)
def enc_target_mean(spark, d):
    t = _base(spark, d, "product", "card5")
    out = encode.fit_target_mean(t, ["product", "card5"], "label").apply(t, suffix="_target_mean")
    return out.select("txn_id", *[r(f"{c}_target_mean", 8).alias(f"{c}_target_mean") for c in ("product", "card5")])


@named(
    "enc_target_mean_inplace",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, a.m AS product, b.m AS card1 FROM txn t "
    + _mean_join("product", "a") + " " + _mean_join("card1", "b"),
)
def enc_target_mean_inplace(spark, d):
    t = _base(spark, d, "product", "card1")
    out = encode.fit_target_mean(t, ["product", "card1"], "label").apply(t, inplace=True)
    return out.select("txn_id", r("product", 8).alias("product"), r("card1", 8).alias("card1"))


def _label(expression: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {expression}) - 1 AS BIGINT)"


@named(
    "enc_label",
    f"""WITH {roles.TRANSACTIONS}, c AS (SELECT *, CAST(card1 AS VARCHAR) AS uid FROM txn)
  SELECT txn_id, {_label("coalesce(card4, 'unseen_before_label')")} AS card4,
  {_label("coalesce(card5, 'unseen_before_label')")} AS card5, {_label('uid')} AS uid FROM c""",
)
def enc_label(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "card4", "card5", F.col("card1").cast("string").alias("uid"))
    return encode.fit_labels(t, ["card4", "card5", "uid"]).apply(t, inplace=True)


def _key(*cols: str) -> str:
    return " || '_' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in cols)


@named(
    "fn_cross_label",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, {_label(_key('card1', 'card5'))} AS card1__card5,
  {_label(_key('addr1', 'card1'))} AS addr1__card1 FROM txn""",
)
def fn_cross_label(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "card1", "card5", "addr1")
    crossed = encode.cross_labels(t, [("card1", "card5"), ("addr1", "card1")])
    return crossed.select("txn_id", "card1__card5", "addr1__card1")


@named(
    "flagship",
    f"""WITH {roles.TRANSACTIONS}, u AS (SELECT card1, count(*) AS n, avg(amount) AS m, stddev_samp(amount) AS s
  FROM txn GROUP BY 1), p AS (SELECT card1, split, avg(amount) AS m FROM txn GROUP BY 1, 2)
  SELECT txn_id, u.n AS card1_fq_enc, {R('u.m', 6)} AS card1_amount_mean, {R('u.s', 4)} AS card1_amount_std,
  {R('amount / nullif(p.m, 0)', 8)} AS amount_to_mean_card1
  FROM txn t JOIN u ON t.card1 = u.card1 JOIN p ON t.card1 = p.card1 AND t.split = p.split""",
)
def flagship(spark, d):
    # The count, the statistics over all rows and the mean per split come from one scan.
    t = roles.orders(spark, d).select("txn_id", "split", "card1", "amount")
    both, each = ["card1"], ["split", "card1"]
    found = grouped(t, [both, each], [F.avg("amount").alias("mean"), F.stddev_samp("amount").alias("std")])
    overall = found[tuple(both)].select(
        "card1",
        F.col("n").alias("card1_fq_enc"),
        F.col("mean").alias("card1_amount_mean"),
        F.col("std").alias("card1_amount_std"),
    )
    per_split = found[tuple(each)].select(*each, F.col("n").alias("__n"), F.col("mean").alias("split_mean"))
    names = ["card1_fq_enc", "card1_amount_mean", "card1_amount_std"]
    out = attach_all(
        t,
        [
            lookup(overall, both, names, weight="card1_fq_enc"),
            lookup(per_split, each, ["split_mean"], weight="__n"),
        ],
        id_col="txn_id",
    )
    return out.select(
        "txn_id",
        "card1_fq_enc",
        r("card1_amount_mean").alias("card1_amount_mean"),
        r("card1_amount_std", 4).alias("card1_amount_std"),
        r(F.try_divide("amount", "split_mean"), 8).alias("amount_to_mean_card1"),
    )


def uid_columns():
    return {
        "uid": concat_key(F.col("card1"), F.col("addr1")),
        "uid2": concat_key(F.col("card1"), F.col("addr1"), F.col("card5")),
        "bank_type": concat_key(F.col("card3"), F.col("card5")),
    }


UID_SQL = f"{_key('card1', 'addr1')} AS uid, {_key('card1', 'addr1', 'card5')} AS uid2, {_key('card3', 'card5')} AS bank_type"
