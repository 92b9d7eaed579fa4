"""Queries on column expressions: text, numbers, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, fixed, numeric, text
from ..operators.rows import keep_columns
from . import roles
from .registry import R, named, r


@named(
    "fn_split_part",
    """SELECT p_partkey, nullif(split_part(p_name, ' ', 1), '') AS first_word,
  nullif(split_part(p_brand, '#', 2), '') AS brand_number, nullif(split_part(p_name, ' ', 3), '') AS third_word,
  nullif(split_part(p_brand, '/', 2), '') AS no_such FROM part""",
)
def fn_split_part(spark, d):
    name, brand = F.col("p_name"), F.col("p_brand")
    return roles.table(spark, d, "part").select(
        "p_partkey",
        text.split_part(name, " ", 0).alias("first_word"),
        text.split_part(brand, "#", 1).alias("brand_number"),
        text.split_part(name, " ", 2).alias("third_word"),
        text.split_part(brand, "/", 1).alias("no_such"),
    )


SCREEN = "CASE WHEN p_size > 5 THEN CAST(p_size AS VARCHAR) || 'x' || CAST(p_partkey % 1000 AS VARCHAR) END"


@named(
    "fn_split_resolution",
    f"""WITH s AS (SELECT p_partkey, {SCREEN} AS screen FROM part)
  SELECT p_partkey, CAST(split_part(coalesce(screen, '0x0'), 'x', 1) AS INTEGER) AS width,
  CAST(split_part(coalesce(screen, '0x0'), 'x', 2) AS INTEGER) AS height, nullif(screen, '0x0') AS screen FROM s""",
)
def fn_split_resolution(spark, d):
    size = F.concat_ws("x", F.col("p_size").cast("string"), F.pmod("p_partkey", F.lit(1000)).cast("string"))
    p = roles.table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") > 5, size).alias("screen"))
    width, height, screen = text.resolution(F.col("screen"))
    return p.select("p_partkey", width.alias("width"), height.alias("height"), screen.alias("screen"))


@named(
    "fn_status_code",
    """SELECT event_id, nullif(CAST(CASE WHEN event_type <> 'error' THEN user_id % 4 ELSE 0 END AS INTEGER), 0) AS code
  FROM events""",
)
def fn_status_code(spark, d):
    # 'match_status:<n>' for all but the errors, which have no status.
    status = F.concat(F.lit("match_status:"), F.pmod("user_id", F.lit(4)).cast("string"))
    e = roles.events(spark, d).select("event_id", F.when(F.col("event_type") != "error", status).alias("status"))
    return e.select("event_id", text.status_code(F.col("status")).alias("code"))


@named(
    "fn_binary_map",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linestatus WHEN 'F' THEN 0 END AS m_flag,
  CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 0 END AS found,
  CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 1 WHEN 'R' THEN 0 END AS newness,
  CASE l_linenumber WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 1 END AS proxy FROM lineitem""",
)
def fn_binary_map(spark, d):
    flag = F.col("l_returnflag")
    found = F.when(flag == "A", "Found").when(flag == "N", "NotFound").otherwise(flag)
    newness = F.when(flag == "A", "New").when(flag == "N", "Found").when(flag == "R", "Unknown")
    proxies = {i + 1: name for i, name in enumerate(fixed.PROXY_CLASS)}
    return roles.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        text.literal_map(F.col("l_linestatus"), fixed.TRUE_FALSE).alias("m_flag"),
        text.literal_map(found, fixed.FOUND).alias("found"),
        text.literal_map(newness, fixed.NEW_FOUND_UNKNOWN).alias("newness"),
        text.literal_map(text.literal_map(F.col("l_linenumber"), proxies), fixed.PROXY_CLASS).alias("proxy"),
    )


PART_RULES = (("ring", "jewel"), ("red", "warm"), ("gear", "machine"), ("r", "other"))
DEVICE = "upper(substr(p_name, 1, 1)) || substr(p_type, 1, 3) || '-' || split_part(p_brand, '#', 2)"


@named(
    "fn_contains_rules",
    "WITH n AS (SELECT p_partkey, p_name, " + DEVICE + " AS device FROM part) SELECT p_partkey, CASE "
    + " ".join(f"WHEN contains(p_name, '{a}') THEN '{b}'" for a, b in PART_RULES)
    + " ELSE p_name END AS kind, CASE "
    + " ".join(f"WHEN contains(device, '{a}') THEN '{b}'" for a, b in fixed.DEVICE_BRANDS)
    + " ELSE device END AS brand FROM n",
)
def fn_contains_rules(spark, d):
    initial = F.upper(F.substring("p_name", 1, 1))
    device = F.concat(initial, F.substring("p_type", 1, 3), F.lit("-"), text.split_part(F.col("p_brand"), "#", 1))
    return roles.table(spark, d, "part").select(
        "p_partkey",
        text.contains_rules(F.col("p_name"), PART_RULES).alias("kind"),
        text.contains_rules(device, fixed.DEVICE_BRANDS).alias("brand"),
    )


DOMAIN_SQL = """(SELECT page_id, host, CASE page_id % 6 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'live.com.mx'
  WHEN 2 THEN 'scranton.edu' WHEN 3 THEN 'gmail' WHEN 4 THEN host END AS domain
  FROM (SELECT page_id, regexp_extract(url, '//([^/]*)', 1) AS host FROM pages))"""


def _domains(spark, d):
    p = roles.table(spark, d, "pages").select("page_id", F.regexp_extract("url", "//([^/]*)", 1).alias("host"))
    names = {0: "gmail.com", 1: "live.com.mx", 2: "scranton.edu", 3: "gmail"}
    slot = F.pmod("page_id", F.lit(6)).cast("int")
    domain = F.when(slot == 4, F.col("host")).otherwise(text.literal_map(slot, names))
    return p.withColumn("domain", domain)


@named(
    "fn_email_provider",
    f"""SELECT page_id, CASE domain WHEN 'gmail.com' THEN 'google' WHEN 'live.com.mx' THEN 'microsoft'
  WHEN 'scranton.edu' THEN 'other' WHEN 'gmail' THEN 'google' END AS provider FROM {DOMAIN_SQL}""",
)
def fn_email_provider(spark, d):
    return _domains(spark, d).select("page_id", text.email_provider(F.col("domain")).alias("provider"))


@named(
    "fn_domain_suffix",
    f"""SELECT page_id, CASE WHEN s IN ('gmail', 'net', 'edu') THEN 'us' ELSE s END AS suffix,
  CASE WHEN h IN ('gmail', 'net', 'edu') THEN 'us' ELSE h END AS host_suffix FROM
  (SELECT page_id, split_part(coalesce(domain, 'nan'), '.', -1) AS s, split_part(host, '.', -1) AS h
  FROM {DOMAIN_SQL})""",
)
def fn_domain_suffix(spark, d):
    return _domains(spark, d).select(
        "page_id",
        text.domain_suffix(F.col("domain")).alias("suffix"),
        text.domain_suffix(F.col("host")).alias("host_suffix"),
    )


# Code points are compared as a hash of the whole text.
@named(
    "fn_letters_only",
    r"""SELECT doc_id, length(t) AS letters, md5(t) AS hash FROM
  (SELECT doc_id, regexp_replace(text, '[^\p{L}]', '', 'g') AS t FROM documents)""",
)
def fn_letters_only(spark, d):
    t = text.letters_only(F.col("text"))
    return roles.table(spark, d, "documents").select("doc_id", F.length(t).alias("letters"), F.md5(t).alias("hash"))


@named(
    "fn_digits_only",
    r"""SELECT doc_id, length(t) AS digits, md5(t) AS hash FROM
  (SELECT doc_id, regexp_replace(text, '[^\p{N}]', '', 'g') AS t FROM documents)""",
)
def fn_digits_only(spark, d):
    t = text.digits_only(F.col("text"))
    return roles.table(spark, d, "documents").select("doc_id", F.length(t).alias("digits"), F.md5(t).alias("hash"))


@named(
    "fn_lower_default",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, lower(coalesce(card5, 'unknown_device')) AS device,
  regexp_replace(lower(coalesce(card5, 'unknown_device')), '[^a-z]', '', 'g') AS device_name FROM txn""",
)
def fn_lower_default(spark, d):
    device = text.lower_default(F.col("card5"))
    t = roles.transactions(spark, d)
    return t.select("txn_id", device.alias("device"), text.letters_only(device).alias("device_name"))


@named(
    "fn_concat_key",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, CAST(card1 AS VARCHAR) || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan')
  || '_' || coalesce(card5, 'nan') AS uid FROM txn""",
)
def fn_concat_key(spark, d):
    t = roles.transactions(spark, d)
    return t.select("txn_id", text.concat_key(F.col("card1"), F.col("addr1"), F.col("card5")).alias("uid"))


@named("fn_log", f"WITH {roles.TRANSACTIONS} SELECT txn_id, {R('CASE WHEN D1 > 0 THEN ln(D1) END', 8)} AS log_d1 FROM txn")
def fn_log(spark, d):
    return roles.transactions(spark, d).select("txn_id", r(numeric.log(F.col("D1")), 8).alias("log_d1"))


@named(
    "fn_log1p",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, {R('ln(1 + amount)', 8)} AS log_amount,
  {R('CASE WHEN D1 > -1 THEN ln(1 + D1) END', 8)} AS log_d1 FROM txn""",
)
def fn_log1p(spark, d):
    return roles.transactions(spark, d).select(
        "txn_id",
        r(numeric.log1p(F.col("amount")), 8).alias("log_amount"),
        r(numeric.log1p(F.col("D1")), 8).alias("log_d1"),
    )


@named(
    "fn_decimal_part",
    f"WITH {roles.ORDERS} SELECT txn_id, CAST(trunc((amount - trunc(amount)) * 1000) AS INTEGER) AS decimals FROM txn",
)
def fn_decimal_part(spark, d):
    return roles.orders(spark, d).select("txn_id", numeric.decimal_part(F.col("amount")).alias("decimals"))


@named(
    "fn_frac_distance",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, {R('abs(coalesce(D2, 0) - trunc(coalesce(D2, 0)) - DT_M / 100)')} AS dist
  FROM txn""",
)
def fn_frac_distance(spark, d):
    dist = numeric.frac_distance(F.col("D2"), F.col("DT_M") / 100)
    return roles.transactions(spark, d).select("txn_id", r(dist).alias("dist"))


@named(
    "fn_clip",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, CASE WHEN D1 < 0 THEN 0 ELSE D1 END AS low,
  CASE WHEN D2 > 5000 THEN 5000 ELSE D2 END AS high,
  CASE WHEN amount < 10000 THEN 10000 WHEN amount > 300000 THEN 300000 ELSE amount END AS two FROM txn""",
)
def fn_clip(spark, d):
    return roles.transactions(spark, d).select(
        "txn_id",
        numeric.clip(F.col("D1"), low=0.0).alias("low"),
        numeric.clip(F.col("D2"), high=5000.0).alias("high"),
        numeric.clip(F.col("amount"), 10000.0, 300000.0).alias("two"),
    )


@named(
    "fn_not_null_flag",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, CASE WHEN D2 IS NULL THEN 0 ELSE 1 END AS D2_not_na FROM txn",
)
def fn_not_null_flag(spark, d):
    return roles.transactions(spark, d).select("txn_id", numeric.not_null_flag(F.col("D2")).alias("D2_not_na"))


@named(
    "fn_threshold_flag",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, CASE WHEN D2 >= 1000 THEN 1 ELSE 0 END AS D2_large FROM txn",
)
def fn_threshold_flag(spark, d):
    return roles.transactions(spark, d).select("txn_id", numeric.threshold_flag(F.col("D2"), 1000).alias("D2_large"))


@named(
    "fn_fill_cast_int",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, CAST(trunc(coalesce(D2, -1)) AS INTEGER) AS D2 FROM txn",
)
def fn_fill_cast_int(spark, d):
    return roles.transactions(spark, d).select("txn_id", numeric.fill_cast_int(F.col("D2")).alias("D2"))


@named(
    "fn_fill_sentinel",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, card4, coalesce(addr1, -10000) AS addr1, D1,
  coalesce(D2, -10000) AS D2 FROM txn""",
)
def fn_fill_sentinel(spark, d):
    return numeric.fill_sentinel(roles.transactions(spark, d).select("txn_id", "card4", "addr1", "D1", "D2"))


FLAGS_SQL = """m AS (SELECT txn_id, CASE WHEN card4 IS NOT NULL THEN label END AS f1,
  CASE WHEN card5 IS NOT NULL THEN label END AS f2, CASE WHEN D2 IS NOT NULL THEN 1 END AS f3,
  CASE WHEN addr1 > 10 THEN 1 WHEN addr1 IS NOT NULL THEN 0 END AS f4 FROM txn)"""


def _flags(spark, d):
    t, label = roles.transactions(spark, d), F.col("label")
    return t.select(
        "txn_id",
        F.when(F.col("card4").isNotNull(), label).alias("f1"),
        F.when(F.col("card5").isNotNull(), label).alias("f2"),
        F.when(F.col("D2").isNotNull(), 1).alias("f3"),
        F.when(F.col("addr1") > 10, 1).when(F.col("addr1").isNotNull(), 0).alias("f4"),
    )


FLAGS = ("f1", "f2", "f3", "f4")


@named(
    "fn_row_sum",
    f"""WITH {roles.TRANSACTIONS}, {FLAGS_SQL} SELECT txn_id,
  coalesce(f1, 0) + coalesce(f2, 0) + coalesce(f3, 0) + coalesce(f4, 0) AS M_sum FROM m""",
)
def fn_row_sum(spark, d):
    return _flags(spark, d).select("txn_id", numeric.row_sum(*[F.col(c) for c in FLAGS]).alias("M_sum"))


@named(
    "fn_row_null_count",
    f"""WITH {roles.TRANSACTIONS}, {FLAGS_SQL} SELECT txn_id,
  {' + '.join(f'({c} IS NULL)::INT' for c in FLAGS)} AS M_na FROM m""",
)
def fn_row_null_count(spark, d):
    return _flags(spark, d).select("txn_id", numeric.row_null_count(*[F.col(c) for c in FLAGS]).alias("M_na"))


@named(
    "fn_to_numeric",
    """SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand, TRY_CAST(p_type AS DOUBLE) AS type
  FROM part""",
)
def fn_to_numeric(spark, d):
    brand = text.split_part(F.col("p_brand"), "#", 1)
    return roles.table(spark, d, "part").select(
        "p_partkey", numeric.to_numeric(brand).alias("brand"), numeric.to_numeric(F.col("p_type")).alias("type")
    )


@named(
    "fn_cast",
    f"""WITH {roles.TRANSACTIONS} SELECT CAST(txn_id AS VARCHAR) AS txn_id, CAST(trunc(amount) AS BIGINT) AS amount,
  CAST(label AS DOUBLE) AS label, CAST(addr1 AS VARCHAR) AS addr1 FROM txn""",
)
def fn_cast(spark, d):
    t = keep_columns(roles.transactions(spark, d), ["txn_id", "amount", "label", "addr1"])
    kinds = {"txn_id": "string", "amount": "bigint", "label": "double", "addr1": "string"}
    return t.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])


@named(
    "fn_fill_const",
    f"""WITH {roles.TRANSACTIONS} SELECT txn_id, coalesce(card5, 'unseen_before_label') AS card5, coalesce(D2, 0) AS D2
  FROM txn""",
)
def fn_fill_const(spark, d):
    return roles.transactions(spark, d).select(
        "txn_id",
        numeric.fill_const(F.col("card5"), fixed.UNSEEN_LABEL).alias("card5"),
        numeric.fill_const(F.col("D2"), 0.0).alias("D2"),
    )


@named("fn_abs_sqrt", f"WITH {roles.TRANSACTIONS} SELECT txn_id, {R('(D1 ** 2) ** 0.5')} AS D1 FROM txn")
def fn_abs_sqrt(spark, d):
    return roles.transactions(spark, d).select("txn_id", r(numeric.abs_sqrt(F.col("D1"))).alias("D1"))


# Seconds since the origin: the order dates, wrapped to 400 days so that they meet the holidays,
# with the time of day taken from the order key.
SECONDS_SQL = """s AS (SELECT o_orderkey AS txn_id,
  (CAST(epoch(o_orderdate) AS BIGINT) - 788918400) % (400 * 86400) + (o_orderkey * 977) % 86400 AS dt FROM orders),
  t AS (SELECT *, TIMESTAMP '2017-11-30' + to_seconds(dt) AS ts FROM s)"""


def _seconds(spark, d):
    wrapped = F.pmod(dates.epoch(F.col("o_orderdate")) - 788918400, F.lit(400 * 86400))
    time_of_day = F.pmod(F.col("o_orderkey") * 977, F.lit(86400))
    s = roles.table(spark, d, "orders").select(F.col("o_orderkey").alias("txn_id"), (wrapped + time_of_day).alias("dt"))
    return s.withColumn("ts", dates.from_seconds(F.col("dt")))


def _date_query(name: str, sql: str, build):
    @named(name, f"WITH {SECONDS_SQL} SELECT txn_id, {sql} FROM t")
    def query(spark, d):
        return _seconds(spark, d).select("txn_id", *build())


def _ts():
    return F.col("ts")


_date_query(
    "dt_from_seconds",
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts",
    lambda: [F.date_format(_ts(), "yyyy-MM-dd HH:mm:ss").alias("ts")],
)
_date_query(
    "dt_month_idx",
    "CAST((year(ts) - 2017) * 12 + month(ts) AS INTEGER) AS DT_M",
    lambda: [dates.month_idx(_ts()).alias("DT_M")],
)
_date_query(
    "dt_week_idx",
    "CAST((year(ts) - 2017) * 52 + week(ts) AS INTEGER) AS DT_W",
    lambda: [dates.week_idx(_ts()).alias("DT_W")],
)
_date_query(
    "dt_day_idx",
    "CAST((year(ts) - 2017) * 365 + dayofyear(ts) AS INTEGER) AS DT_D",
    lambda: [dates.day_idx(_ts()).alias("DT_D")],
)
_date_query("dt_hour", "CAST(hour(ts) AS INTEGER) AS DT_hour", lambda: [dates.hour(_ts()).alias("DT_hour")])
_date_query(
    "dt_dow", "CAST(isodow(ts) - 1 AS INTEGER) AS DT_day_week", lambda: [dates.day_of_week(_ts()).alias("DT_day_week")]
)
_date_query(
    "dt_dom", "CAST(day(ts) AS INTEGER) AS DT_day_month", lambda: [dates.day_of_month(_ts()).alias("DT_day_month")]
)
_date_query(
    "dt_is_december",
    "CAST(month(ts) = 12 AS INTEGER) AS is_december",
    lambda: [dates.is_december(_ts()).alias("is_december")],
)
_date_query(
    "dt_is_holiday",
    "CAST(CAST(ts AS DATE) IN ("
    + ", ".join(f"DATE '{day}'" for day in fixed.US_HOLIDAYS)
    + ") AS INTEGER) AS is_holiday",
    lambda: [dates.is_holiday(_ts()).alias("is_holiday")],
)
_date_query(
    "dt_raw_dow",
    "CAST(floor(((dt / 86400.0 - 1) % 7 + 7) % 7) AS INTEGER) AS raw_dow",
    lambda: [dates.raw_day_of_week(F.col("dt")).alias("raw_dow")],
)
_date_query(
    "dt_raw_hour",
    "CAST(floor(dt / 3600.0) % 24 AS INTEGER) AS raw_hour",
    lambda: [dates.raw_hour(F.col("dt")).alias("raw_hour")],
)
