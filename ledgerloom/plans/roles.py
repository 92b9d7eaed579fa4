"""The test tables in the roles of a transaction table, an identity table and a label table.

Every view exists twice, as a DataFrame and as a common table expression with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.keyed import attach, measure

BASE_YEAR = 1995
SPLIT_DAY = "2001-01-01"


# Declared, so that opening a table reads no file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions without customer columns: one row per order."""
    o = table(spark, folder, "orders")
    ts = F.col("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("card1"),
        F.col("o_totalprice").alias("amount"),
        ts.alias("ts"),
        F.col("o_orderpriority").alias("product"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("card4"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        F.when(ts < F.lit(SPLIT_DAY).cast("timestamp_ntz"), "train").otherwise("test").alias("split"),
        dates.month_idx(ts, BASE_YEAR).alias("DT_M"),
    )


ORDERS = """txn AS (SELECT o_orderkey AS txn_id, o_custkey AS card1, o_totalprice AS amount,
  CAST(o_orderdate AS TIMESTAMP) AS ts, o_orderpriority AS product,
  nullif(o_orderpriority, '5-LOW') AS card4,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
  CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN 'train' ELSE 'test' END AS split,
  CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS DT_M
  FROM orders)"""


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with the customer's columns: region key, segment and a signed measure."""
    customer = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("addr1"),
        F.col("c_mktsegment").alias("card3"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("card5"),
        F.col("c_acctbal").alias("D1"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("D2"),
    )
    return attach(orders(spark, folder), measure(customer), {"card1": "c_custkey"})


TRANSACTIONS = (
    ORDERS.replace("txn AS (SELECT", "txn AS (SELECT nullif(c_nationkey, 0) AS addr1, c_mktsegment AS card3,\n"
    "  nullif(c_mktsegment, 'BUILDING') AS card5, c_acctbal AS D1,\n"
    "  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS D2,")
    .replace("FROM orders", "FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
)


# A label that can be learned, but not from one column: two waves and their product, noise from the id, and a
# level of its own where the measure is missing.
def learnable(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with such a label."""
    wave = lambda c, w: F.abs(F.pmod(F.floor(c), F.lit(2 * w)) - w) / w
    a, b = wave("amount", 100_000), wave("D1", 2_000)
    noise = F.conv(F.substring(F.md5(F.col("txn_id").cast("string").cast("binary")), 1, 6), 16, 10).cast("bigint") / 16777216
    chance = F.when(F.col("D2").isNull(), 0.9).otherwise(0.05 + 0.5 * a * b + 0.35 * b)
    return transactions(spark, folder).withColumn("label", (noise < chance).cast("int"))


LEARNABLE = TRANSACTIONS.replace("txn AS (", "plain AS (", 1) + """,
  txn AS (SELECT * EXCLUDE (label), CASE WHEN CAST('0x' || substr(md5(CAST(txn_id AS VARCHAR)), 1, 6) AS BIGINT) / 16777216 <
  CASE WHEN D2 IS NULL THEN 0.9::DOUBLE ELSE 0.05::DOUBLE + 0.5::DOUBLE * (abs((CAST(floor(amount) AS BIGINT) % 200000) - 100000) / 100000) *
  (abs((CAST(floor(D1) AS BIGINT) % 4000 + 4000) % 4000 - 2000) / 2000)
  + 0.35::DOUBLE * (abs((CAST(floor(D1) AS BIGINT) % 4000 + 4000) % 4000 - 2000) / 2000) END THEN 1 ELSE 0 END AS label FROM plain)"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a split by time and calendar columns; the time of day is real."""
    e = table(spark, folder, "events")
    ts = F.col("ts")
    return e.select(
        "event_id",
        "user_id",
        "event_type",
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
        "value",
        ts.alias("ts"),
        F.when(ts < F.lit("2024-01-24").cast("timestamp_ntz"), "train").otherwise("test").alias("split"),
        dates.month_idx(ts, 2024).alias("DT_M"),
        dates.week_idx(ts, 2024).alias("DT_W"),
        dates.day_idx(ts, 2024).alias("DT_D"),
        dates.hour(ts).alias("DT_hour"),
        dates.day_of_week(ts).alias("DT_day_week"),
        dates.day_of_month(ts).alias("DT_day_month"),
    )


EVENTS = """ev AS (SELECT event_id, user_id, event_type, nullif(event_type, 'error') AS kind, value,
  CAST(ts AS TIMESTAMP) AS ts,
  CASE WHEN ts < TIMESTAMP '2024-01-24' THEN 'train' ELSE 'test' END AS split,
  CAST((year(ts) - 2024) * 12 + month(ts) AS INTEGER) AS DT_M,
  CAST((year(ts) - 2024) * 52 + week(ts) AS INTEGER) AS DT_W,
  CAST((year(ts) - 2024) * 365 + dayofyear(ts) AS INTEGER) AS DT_D,
  CAST(hour(ts) AS INTEGER) AS DT_hour,
  CAST(isodow(ts) - 1 AS INTEGER) AS DT_day_week,
  CAST(day(ts) AS INTEGER) AS DT_day_month
  FROM events)"""


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels where they have one: real missing values."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, folder, "labels"), "doc_id", "left")


DOCUMENTS = """doc AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def importances(spark: SparkSession, folder: str) -> DataFrame:
    """A (fold, feature, importance) table derived from the events."""
    e = events(spark, folder)
    feature = F.concat_ws("_", "event_type", F.format_string("%02d", "DT_day_month"))
    return (
        e.groupBy(F.pmod("user_id", F.lit(5)).cast("int").alias("fold"), feature.alias("feature"))
        .agg(F.sum("value").alias("importance"))
    )


IMPORTANCES = (
    EVENTS
    + """, imp AS (SELECT CAST(user_id % 5 AS INTEGER) AS fold,
  event_type || '_' || lpad(CAST(DT_day_month AS VARCHAR), 2, '0') AS feature, sum(value) AS importance
  FROM ev GROUP BY 1, 2)"""
)
