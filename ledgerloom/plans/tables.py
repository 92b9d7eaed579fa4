"""Source and sink queries: written, read back, and compared with the table they came from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import output_path
from ..sources import infer
from ..sources import tables as io
from . import roles
from .registry import R, named, r

ORDERS_CSV = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string"
)


@named(
    "src_csv",
    """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority FROM orders""",
)
def src_csv(spark, d):
    o = roles.table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    path = io.write_csv(o.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))), output_path(spark))
    back = io.read_csv(spark, path, ORDERS_CSV)
    return back.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate")


# Columns of two CSV files, with the text each holds in SQL; the label is in the first file only.
_UNTYPED = {
    "id": "o_orderkey",
    "client": "o_custkey",
    "small": "o_custkey % 250 - 122",
    "price": "o_totalprice",
    "status": "nullif(o_orderstatus, 'P')",
    "mostly_int": "CASE WHEN o_orderkey % 1000 = 999 THEN 'none' ELSE CAST(o_custkey AS STRING) END",
    "half": "CASE WHEN o_orderkey % 1000 = 998 THEN '0.5' WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS STRING) END",
    "nothing": "CAST(NULL AS STRING)",
    "label": "o_custkey % 2",
}


def _inferred(spark, d):
    """Half of the orders in each of two files, without types, read back."""
    o = roles.table(spark, d, "orders")
    halves = [o.filter(f"o_orderkey % 2 = {i}").selectExpr(*[f"{x} AS {c}" for c, x in _UNTYPED.items()]) for i in (0, 1)]
    paths = [io.write_csv(h, output_path(spark)) for h in (halves[0], halves[1].drop("label"))]
    return infer.read_csv_inferred(spark, *paths)


@named(
    "src_csv_inferred",
    "SELECT "
    + ", ".join(f"{x.replace('STRING', 'VARCHAR')} AS {c}" for c, x in _UNTYPED.items() if c not in ("half", "nothing", "label"))
    + """, CAST(CASE WHEN o_orderkey % 1000 = 998 THEN 0.5 WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS DOUBLE) AS half,
  CAST(NULL AS DOUBLE) AS nothing, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 2 END AS label FROM orders""",
)
def src_csv_inferred(spark, d):
    first, second = _inferred(spark, d)
    return first.unionByName(second, allowMissingColumns=True)


def _integer_sql(c: str, x: str) -> str:
    bounds = " ".join(f"WHEN min({x}) >= -{2**b} AND max({x}) < {2**b} THEN '{t}'" for t, b in (("tinyint", 7), ("smallint", 15), ("int", 31)))
    return f"SELECT '{c}' AS name, CASE {bounds} ELSE 'bigint' END AS type FROM orders"


@named(
    "src_csv_types",
    " UNION ALL ".join(_integer_sql(c, x) for c, x in _UNTYPED.items() if c in ("id", "client", "small", "label"))
    + " UNION ALL SELECT * FROM (VALUES ('price', 'double'), ('status', 'string'), ('nothing', 'double')) v(name, type)"
    + " UNION ALL SELECT 'mostly_int', CASE WHEN count(*) FILTER (o_orderkey % 1000 = 999) > 0 THEN 'string' END FROM orders"
    + " UNION ALL SELECT 'half', CASE WHEN count(*) FILTER (o_orderkey % 1000 = 998) > 0 THEN 'double' END FROM orders",
)
def src_csv_types(spark, d):
    first, _ = _inferred(spark, d)
    return spark.createDataFrame(first.dtypes, "name string, type string")


@named("src_stage", f"WITH {roles.TRANSACTIONS} SELECT txn_id, card1, amount, card5, D2, label, split, DT_M FROM txn")
def src_stage(spark, d):
    t = roles.transactions(spark, d)
    path = io.write_stage(t, output_path(spark), partition_by=["split"])
    return io.read_stage(spark, path).select("txn_id", "card1", "amount", "card5", "D2", "label", "split", "DT_M")


@named("sink_csv", "SELECT event_id, event_type, value, props FROM events")
def sink_csv(spark, d):
    # `props` is JSON, full of quotes and commas.
    e = roles.table(spark, d, "events").select("event_id", "event_type", "value", "props")
    return io.read_csv(spark, io.write_csv(e, output_path(spark)), "event_id bigint, event_type string, value double, props string")


@named(
    "sink_scores",
    f"""WITH {roles.ORDERS} SELECT txn_id, CASE WHEN card4 IS NOT NULL THEN {R('amount / 1000000')} END AS score
  FROM txn WHERE split = 'test'""",
)
def sink_scores(spark, d):
    test = roles.orders(spark, d).filter(F.col("split") == "test")
    sample = test.select("txn_id", F.lit(0.5).alias("score"))
    scores = test.filter(F.col("card4").isNotNull()).select("txn_id", r(F.col("amount") / 1000000).alias("score"))
    path = io.write_scores(sample, scores, output_path(spark), key="txn_id", score="score")
    return io.read_csv(spark, path, "txn_id bigint, score double")


@named("sink_exclusions", f"WITH {roles.ORDERS} SELECT card1, amount, product, card4 FROM txn")
def sink_exclusions(spark, d):
    path = io.write_exclusions(spark, ["txn_id", "ts", "label", "split", "DT_M", "DT_M"], output_path(spark))
    return roles.orders(spark, d).drop(*io.read_exclusions(spark, path))
