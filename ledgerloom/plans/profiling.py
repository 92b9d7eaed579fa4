"""Profiling queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import concat_key
from ..functions import dates
from ..operators import masks, profile
from . import roles
from .registry import R, named, r

SHAPES = ("orders", "customer", "lineitem", "events", "documents")


@named(
    "prof_shape",
    """SELECT 'orders' AS "table", count(*) AS rows, 6 AS cols FROM orders
  UNION ALL SELECT 'customer', count(*), 5 FROM customer
  UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
  UNION ALL SELECT 'events', count(*), 6 FROM events
  UNION ALL SELECT 'documents', count(*), 5 FROM documents""",
)
def prof_shape(spark, d):
    return reduce(DataFrame.unionByName, [profile.shape(roles.table(spark, d, t), t) for t in SHAPES])


@named(
    "prof_dtypes",
    """SELECT 'o_orderkey' AS "column", 'bigint' AS dtype, count(o_orderkey) AS non_null FROM orders
  UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders
  UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
  UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
  UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
  UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
)
def prof_dtypes(spark, d):
    return profile.column_types(roles.table(spark, d, "orders"))


@named("prof_head", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def prof_head(spark, d):
    return profile.head(roles.table(spark, d, "customer"), ["c_custkey"], 5)


def _describe_sql(source: str, cols: list[str], by: str = "") -> str:
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    parts = []
    for c in cols:
        parts.append(
            f"""SELECT {head}'{c}' AS "column", count({c}) AS count, {R(f'avg({c})', 4)} AS mean,
  {R(f'stddev_samp({c})', 4)} AS std, {R(f'min({c})', 4)} AS min,
  {R(f'quantile_cont({c}, 0.25)', 4)} AS p25, {R(f'quantile_cont({c}, 0.5)', 4)} AS p50,
  {R(f'quantile_cont({c}, 0.75)', 4)} AS p75, {R(f'max({c})', 4)} AS max FROM {source}{tail}"""
        )
    return "\n UNION ALL ".join(parts)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r(c, 4) + F.lit(0.0) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
]


@named("prof_describe", _describe_sql("lineitem", NUMERIC))
def prof_describe(spark, d):
    return _rounded(profile.describe(roles.table(spark, d, "lineitem")))


@named("prof_describe_by_class", f"WITH {roles.ORDERS} {_describe_sql('txn', ['amount'], 'label')}")
def prof_describe_by_class(spark, d):
    return _rounded(profile.describe(roles.orders(spark, d), ["amount"], by=["label"]))


@named(
    "prof_any_null_cols",
    f"""WITH {roles.DOCUMENTS} SELECT CAST((count(doc_id) < count(*))::INT + (count(lang) < count(*))::INT
  + (count(source) < count(*))::INT + (count(n_chars) < count(*))::INT
  + (count(quality) < count(*))::INT + (count(toxic) < count(*))::INT AS BIGINT) AS columns_with_null FROM doc""",
)
def prof_any_null_cols(spark, d):
    return profile.any_null_columns(roles.labelled_documents(spark, d))


@named(
    "prof_null_counts",
    f"""WITH {roles.DOCUMENTS} """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM doc"""
        for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    ),
)
def prof_null_counts(spark, d):
    return profile.null_counts(roles.labelled_documents(spark, d))


def _null_ratio_sql(k: int) -> str:
    cols = ("card4", "addr1", "card3", "card5", "D1", "D2", "amount")
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {R(f'100.0 * (count(*) - count({c})) / count(*)')} AS missing_ratio FROM txn"""
        for c in cols
    )
    return f"""WITH {roles.TRANSACTIONS} SELECT * FROM ({parts}) WHERE missing_ratio > 0
  ORDER BY missing_ratio DESC, "column" LIMIT {k}"""


def _null_ratios(spark, d, k):
    cols = ["card4", "addr1", "card3", "card5", "D1", "D2", "amount"]
    found = profile.null_ratios(roles.transactions(spark, d), cols, k=k)
    return found.withColumn("missing_ratio", r("missing_ratio"))


@named("prof_null_ratio", _null_ratio_sql(20))
def prof_null_ratio(spark, d):
    return _null_ratios(spark, d, 20)


@named("topk_null_cols", _null_ratio_sql(2))
def topk_null_cols(spark, d):
    return _null_ratios(spark, d, 2)


@named("prof_value_counts", f"WITH {roles.EVENTS} SELECT kind, count(*) AS n FROM ev WHERE kind IS NOT NULL GROUP BY 1")
def prof_value_counts(spark, d):
    return profile.value_counts(roles.events(spark, d), "kind")


@named(
    "prof_value_counts_norm",
    f"""WITH {roles.DOCUMENTS} SELECT quality, {R('count(*) * 1.0 / (SELECT count(*) FROM doc)')} AS share
  FROM doc GROUP BY 1 ORDER BY share DESC, quality LIMIT 5""",
)
def prof_value_counts_norm(spark, d):
    return profile.value_shares(roles.labelled_documents(spark, d), "quality").withColumn("share", r("share"))


UIDS = {
    "uid": "CAST(card1 AS VARCHAR) || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan')",
    "uid2": "CAST(card1 AS VARCHAR) || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan') || '_' || coalesce(card5, 'nan')",
}


def with_uids(df: DataFrame) -> DataFrame:
    uid = concat_key(F.col("card1"), F.col("addr1"))
    return df.withColumns({"uid": uid, "uid2": concat_key(F.col("card1"), F.col("addr1"), F.col("card5"))})


TOP_VALUE_COLUMNS = ("card1", "uid", "uid2")


@named(
    "prof_top_values",
    f"""WITH {roles.TRANSACTIONS}, u AS (SELECT CAST(card1 AS VARCHAR) AS card1, {UIDS['uid']} AS uid,
  {UIDS['uid2']} AS uid2 FROM txn WHERE split = 'train'), c AS ("""
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM u GROUP BY 2""" for c in TOP_VALUE_COLUMNS
    )
    + """) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank
  FROM c) WHERE rank <= 10""",
)
def prof_top_values(spark, d):
    train = with_uids(roles.transactions(spark, d)).filter(F.col("split") == "train")
    return profile.category_counts(train, list(TOP_VALUE_COLUMNS), k=10)


@named(
    "prof_class_balance",
    f"""WITH {roles.ORDERS} SELECT count(*) FILTER (label = 0) AS regular, count(*) FILTER (label = 1) AS positive,
  {R('100.0 * count(*) FILTER (label = 0) / count(label)')} AS regular_perc,
  {R('100.0 * count(*) FILTER (label = 1) / count(label)')} AS positive_perc FROM txn""",
)
def prof_class_balance(spark, d):
    found = profile.class_balance(roles.orders(spark, d), "label")
    return found.withColumns({c: r(c) for c in ("regular_perc", "positive_perc")})


CATEGORIES = ("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_discount_pct")


@named(
    "prof_category_counts",
    "WITH li AS (SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS l_discount_pct FROM lineitem) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM li GROUP BY 2"""
        for c in CATEGORIES
    ),
)
def prof_category_counts(spark, d):
    percent = F.round(F.col("l_discount") * 100).cast("int")
    li = roles.table(spark, d, "lineitem").withColumn("l_discount_pct", percent)
    return profile.category_counts(li, list(CATEGORIES))


@named(
    "prof_histogram",
    f"""WITH {roles.TRANSACTIONS}, e AS (SELECT min(D2) AS lo, max(D2) AS hi FROM txn)
  SELECT bin, {R('lo + bin * ((hi - lo) / 77)')} AS left_edge, count(*) AS n FROM
  (SELECT CAST(least(floor((D2 - lo) * 77 / (hi - lo)), 76) AS INTEGER) AS bin, lo, hi FROM txn, e
  WHERE D2 IS NOT NULL) GROUP BY bin, lo, hi""",
)
def prof_histogram(spark, d):
    return profile.histogram(roles.transactions(spark, d), "D2", bins=77).withColumn("left_edge", r("left_edge"))


@named(
    "prof_histogram_density",
    f"""WITH {roles.ORDERS}, b AS (SELECT label,
  CAST(least(floor((amount - 20000.0) * 99 / 230000.0), 98) AS INTEGER) AS bin FROM txn
  WHERE amount BETWEEN 20000.0 AND 250000.0), c AS (SELECT label, bin, count(*) AS n FROM b GROUP BY 1, 2)
  SELECT label, bin, n, {R('n / (sum(n) OVER (PARTITION BY label) * (230000.0 / 99)) * 1000', 6)} AS density_per_1000
  FROM c""",
)
def prof_histogram_density(spark, d):
    o = roles.orders(spark, d)
    found = profile.histogram_density(o, "amount", low=20000.0, high=250000.0, edges=100, by=["label"])
    return found.select("label", "bin", "n", r(F.col("density") * 1000).alias("density_per_1000"))


@named(
    "prof_hist_compare",
    f"""WITH {roles.ORDERS}, s AS (SELECT split, epoch(ts) AS t FROM txn),
  e AS (SELECT CAST(min(t) AS DOUBLE) AS lo, CAST(max(t) AS DOUBLE) AS hi FROM s)
  SELECT split, CAST(least(floor((t - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin, count(*) AS n
  FROM s, e GROUP BY 1, 2""",
)
def prof_hist_compare(spark, d):
    o = roles.orders(spark, d).select("split", dates.epoch(F.col("ts")).alias("t"))
    return profile.histogram(o, "t", bins=10, by=["split"]).drop("left_edge")


@named(
    "prof_time_series",
    f"""WITH {roles.EVENTS} SELECT DT_D, count(*) AS n, min(value) AS min_value, {R('avg(value)')} AS avg_value,
  max(value) AS max_value FROM ev GROUP BY 1""",
)
def prof_time_series(spark, d):
    return profile.time_series(roles.events(spark, d), "DT_D", "value").withColumn("avg_value", r("avg_value"))


CORR = tuple(NUMERIC)
CORR_SQL = tuple("CASE WHEN l_discount > 0 THEN l_discount END" if c == "l_discount" else c for c in NUMERIC)


def _corr_input(spark, d):
    li = roles.table(spark, d, "lineitem")
    return li.withColumn("l_discount", F.when(F.col("l_discount") > 0, F.col("l_discount"))).select(*CORR)


def _corr_sql() -> str:
    pairs = [(i, j) for i in range(len(CORR)) for j in range(i, len(CORR))]
    return " UNION ALL ".join(
        f"""SELECT '{CORR[i]}' AS col_a, '{CORR[j]}' AS col_b, {R(f'corr({CORR_SQL[i]}, {CORR_SQL[j]})', 8)} AS corr
  FROM lineitem""".replace("FROM lineitem", f"FROM lineitem WHERE {CORR_SQL[i]} IS NOT NULL AND {CORR_SQL[j]} IS NOT NULL")
        for i, j in pairs
    )


# More columns than one aggregate takes, each missing (null or NaN) in rows of its own.
WIDE = [f"(l_quantity * {i + 1} + l_partkey) % {7 + i} + l_tax" for i in range(14)]


def _wide_sql() -> str:
    cols = ", ".join(f"CASE WHEN l_linenumber % 4 <> {i % 4} THEN CAST({x} AS DOUBLE) END AS c{i}" for i, x in enumerate(WIDE))
    pairs = [(i, j) for i in range(len(WIDE)) for j in range(i, len(WIDE))]
    found = " UNION ALL ".join(
        f"SELECT 'c{i}' AS col_a, 'c{j}' AS col_b, {R(f'corr(c{i}, c{j})', 7)} AS corr FROM w "
        f"WHERE c{i} IS NOT NULL AND c{j} IS NOT NULL"
        for i, j in pairs
    )
    return f"WITH w AS (SELECT {cols} FROM lineitem) {found}"


@named("prof_corr_wide", _wide_sql())
def prof_corr_wide(spark, d):
    missing = ("CAST('NaN' AS DOUBLE)", "CAST(NULL AS DOUBLE)")
    cols = [
        f"CASE WHEN l_linenumber % 4 <> {i % 4} THEN CAST({x} AS DOUBLE) ELSE {missing[i % 2]} END AS c{i}"
        for i, x in enumerate(WIDE)
    ]
    w = roles.table(spark, d, "lineitem").selectExpr(*cols)
    return profile.correlation_matrix(w).withColumn("corr", r("corr", 7))


@named("prof_corr_matrix", _corr_sql())
def prof_corr_matrix(spark, d):
    return profile.correlation_matrix(_corr_input(spark, d)).withColumn("corr", r("corr", 8))


TARGETS = ("amount", "D1", "D2", "addr1")


@named(
    "prof_corr_target",
    f"WITH {roles.TRANSACTIONS} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {R(f'corr(CAST(label AS DOUBLE), CAST(coalesce({c}, 0) AS DOUBLE))', 8)} AS corr
  FROM txn WHERE split = 'train'"""
        for c in TARGETS
    ),
)
def prof_corr_target(spark, d):
    train = roles.transactions(spark, d).filter(F.col("split") == "train")
    return profile.target_correlations(train, "label", list(TARGETS)).withColumn("corr", r("corr", 8))


def _overlap_sql(c: str) -> str:
    hit = f"EXISTS (SELECT 1 FROM txn t WHERE t.split = 'test' AND t.{c} IS NOT DISTINCT FROM a.{c})"
    return f"""SELECT '{c}' AS "column", count(*) FILTER ({hit}) AS in_test,
  count(*) FILTER (NOT {hit}) AS not_in_test FROM txn a WHERE a.split = 'train'"""


@named("prof_split_overlap", f"WITH {roles.TRANSACTIONS} {_overlap_sql('card1')} UNION ALL {_overlap_sql('addr1')}")
def prof_split_overlap(spark, d):
    return masks.split_overlap(roles.transactions(spark, d), ["card1", "addr1"])


@named(
    "prof_rare_count",
    f"""WITH {roles.TRANSACTIONS}, a AS (SELECT card1, count(*) AS n FROM txn GROUP BY 1),
  b AS (SELECT amount, count(*) AS n FROM txn GROUP BY 1)
  SELECT 'card1' AS "column", count(*) FILTER (n <= 2) AS rare_keys FROM a
  UNION ALL SELECT 'amount', count(*) FILTER (n <= 2) FROM b""",
)
def prof_rare_count(spark, d):
    return masks.rare_counts(roles.orders(spark, d), ["card1", "amount"])


KEYS = ["l_orderkey", "l_partkey", "l_suppkey"]  # their narrowest type depends on the size of the tables
NARROWED = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@named(
    "prof_narrow_types",
    f"""SELECT CAST(l_linenumber AS TINYINT) AS l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity,
  {R('CAST(l_extendedprice AS FLOAT)', 4)} AS l_extendedprice, {R('CAST(l_discount AS FLOAT)', 8)} AS l_discount,
  {R('CAST(l_tax AS FLOAT)', 8)} AS l_tax, {', '.join(KEYS)}
  FROM lineitem""",
)
def prof_narrow_types(spark, d):
    li = roles.table(spark, d, "lineitem").select(*NARROWED, *KEYS)
    out = profile.apply_types(li, profile.narrow_types(li))
    rounded = {"l_extendedprice": r("l_extendedprice", 4), "l_discount": r("l_discount", 8), "l_tax": r("l_tax", 8)}
    return out.withColumns(rounded | {c: F.col(c).cast("bigint") for c in KEYS})


@named(
    "prof_lossless_check",
    "SELECT unnest(['l_linenumber', 'l_orderkey', 'l_partkey', 'l_suppkey']) AS \"column\", "
    "CAST(0 AS BIGINT) AS changed UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{c}', count(*) FILTER ({c} <> CAST(CAST({c} AS FLOAT) AS DOUBLE)) FROM lineitem"
        for c in NARROWED[1:]
    ),
)
def prof_lossless_check(spark, d):
    li = roles.table(spark, d, "lineitem").select(*NARROWED, *KEYS)
    return profile.lossless_check(li, profile.narrow_types(li))
