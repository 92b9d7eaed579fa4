"""Encoders that learn by fold, and states that learn month by month."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode, state
from ..session import output_path
from . import roles
from .registry import R, named, r

OOF = ("product", "card5", "card1")


def _oof(c: str, alias: str) -> str:
    return f"""LEFT JOIN (SELECT {c} AS k, fold, sum(label) AS s, count(label) AS n, sum(sum(label)) OVER w AS all_s,
  sum(count(label)) OVER w AS all_n FROM f WHERE split = 'train' GROUP BY 1, 2 WINDOW w AS (PARTITION BY {c})) {alias}
  ON f.{c} = {alias}.k AND f.fold = {alias}.fold
  LEFT JOIN (SELECT {c} AS k, avg(label) AS m FROM f WHERE split = 'train' GROUP BY 1) {alias}t ON f.{c} = {alias}t.k"""


def _oof_value(alias: str) -> str:
    return R(f"CASE WHEN split = 'train' THEN ({alias}.all_s - {alias}.s) / nullif(CAST({alias}.all_n - {alias}.n AS DOUBLE), 0) ELSE {alias}t.m END", 8)


@named(
    "enc_target_mean_oof",
    f"""WITH {roles.TRANSACTIONS}, f AS (SELECT *, DT_M % 5 AS fold FROM txn)
  SELECT txn_id, {', '.join(f"{_oof_value(f'x{i}')} AS {c}_target_mean" for i, c in enumerate(OOF))}
  FROM f {' '.join(_oof(c, f'x{i}') for i, c in enumerate(OOF))}""",
)
def enc_target_mean_oof(spark, d):
    t = roles.transactions(spark, d).select("txn_id", "split", "label", *OOF, F.pmod("DT_M", F.lit(5)).alias("fold"))
    out = encode.out_of_fold_target_mean(t, list(OOF), "label", id_col="txn_id")
    return out.select("txn_id", *[r(f"{c}_target_mean", 8).alias(f"{c}_target_mean") for c in OOF])


@named(
    "state_uid_stats",
    f"""WITH {roles.TRANSACTIONS}, c AS (SELECT card1, product, count(*) AS n FROM txn GROUP BY 1, 2),
  m AS (SELECT card1, product FROM c QUALIFY row_number() OVER (PARTITION BY card1 ORDER BY n DESC, product DESC) = 1),
  s AS (SELECT card1, count(*) AS n, avg(amount) AS amount_mean, stddev_samp(amount) AS amount_std,
  count(D2) AS D2_count, avg(D2) AS D2_mean, avg(label) AS label_mean FROM txn GROUP BY 1)
  SELECT txn_id, s.n AS card1_n, {R('amount_mean', 5)} AS card1_amount_mean, {R('amount_std', 4)} AS card1_amount_std,
  D2_count AS card1_D2_count, {R('D2_mean', 5)} AS card1_D2_mean, {R('label_mean', 8)} AS card1_label_mean,
  m.product AS card1_product_mode FROM txn JOIN s USING (card1) JOIN m USING (card1)""",
)
def state_uid_stats(spark, d):
    """A state of the years up to 1998, saved, read again and brought up to date year by year."""
    t = roles.transactions(spark, d).select("txn_id", "card1", "amount", "D2", "label", "product", "DT_M")
    learn = lambda rows: state.fit(rows, ["card1"], ["amount", "D2", "label"], ["product"])
    path = output_path(spark)
    state.save(learn(t.filter("DT_M <= 48")), path)
    for first, last in ((49, 60), (61, 72), (73, 1200)):
        new = learn(t.filter(F.col("DT_M").between(first, last)))
        state.save(state.merge(state.load(spark, path), new), path)
    out = state.apply(state.load(spark, path), t, prefix="card1_", id_col="txn_id")
    digits = {"card1_amount_mean": 5, "card1_amount_std": 4, "card1_D2_mean": 5, "card1_label_mean": 8}
    return out.select(
        "txn_id", "card1_n", "card1_D2_count", "card1_product_mode", *[r(c, n).alias(c) for c, n in digits.items()]
    )
