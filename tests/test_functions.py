from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, fixed, numeric, text

def C():
    return F.col("c")


def over(spark, values, kind, *exprs):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, c {kind}")
    out = df.select("i", *[e.alias(f"o{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(exprs) > 1 else r[1] for r in out]


def test_split_part(spark):
    assert over(spark, ["a/b", "abc", "", None], "string", text.split_part(C(), "/", 1)) == ["b", None, None, None]
    assert over(spark, ["a.b.c"], "string", text.split_part(C(), ".", 2)) == ["c"]


def test_resolution(spark):
    got = over(spark, ["1920x1080", None, "0x0", "wide"], "string", *text.resolution(C()))
    assert got == [(1920, 1080, "1920x1080"), (0, 0, None), (0, 0, None), (None, None, "wide")]


def test_status_code(spark):
    got = over(spark, ["match_status:2", "match_status:0", None, "none", "x:y"], "string", text.status_code(C()))
    assert got == [2, None, None, None, None]


def test_fixed_maps(spark):
    assert over(spark, ["T", "F", "x", None], "string", text.literal_map(C(), fixed.TRUE_FALSE)) == [1, 0, None, None]
    proxies = ["TRANSPARENT", "IP_PROXY:HIDDEN", "IP_PROXY"]
    assert over(spark, proxies, "string", text.literal_map(C(), fixed.PROXY_CLASS)) == [4, 1, 3]


def test_first_rule_wins(spark):
    devices = ["SM-G960", "Moto G4", "moto x", "VS-L33", "XT1", "ASUS Linux", "iOS", "", None]
    want = ["Samsung", "Motorola", "Motorola", "Huawei", "Sony", "Linux", "iOS", "", None]
    assert over(spark, devices, "string", text.contains_rules(C(), fixed.DEVICE_BRANDS)) == want


def test_mail_domains(spark):
    domains = ["gmail.com", "hotmail.co.uk", "prodigy.net.mx", "nowhere.org", None]
    assert len(fixed.EMAIL_PROVIDERS) == 60
    assert over(spark, domains, "string", text.email_provider(C())) == ["google", "microsoft", "att", None, None]
    suffixes = over(spark, [*domains, "gmail", "twc.net", "mit.edu"], "string", text.domain_suffix(C()))
    assert suffixes == ["com", "uk", "mx", "org", "nan", "us", "us", "us"]


def test_letters_digits_and_defaults(spark):
    values = ["SM-G9 ßé²", "", None]
    assert over(spark, values, "string", text.letters_only(C())) == ["SMGßé", "", None]
    assert over(spark, values, "string", text.digits_only(C())) == ["9²", "", None]
    assert over(spark, values, "string", text.lower_default(C())) == ["sm-g9 ßé²", "", "unknown_device"]


def test_keys_keep_missing_members(spark):
    assert over(spark, ["a", None], "string", text.concat_key(C(), F.lit(3), C())) == ["a_3_a", "nan_3_nan"]


def test_logs(spark):
    got = over(spark, [1.0, 0.0, -3.0, None], "double", numeric.log(C()), numeric.log1p(C()))
    assert got[0] == (0.0, pytest.approx(0.6931471805599453))
    assert got[1:] == [(None, 0.0), (None, None), (None, None)]


def test_decimals(spark):
    assert over(spark, [59.95, 3.0, -2.5, None], "double", numeric.decimal_part(C())) == [950, 0, -500, None]
    got = over(spark, [2.75, None, 3.0], "double", numeric.frac_distance(C(), F.lit(0.25)))
    assert got == [0.5, 0.25, 0.25]


def test_clip_and_flags(spark):
    values = [-1.0, 0.5, 9.0, None]
    assert over(spark, values, "double", numeric.clip(C(), 0.0, 5.0)) == [0.0, 0.5, 5.0, None]
    assert over(spark, values, "double", numeric.clip(C(), low=0.0)) == [0.0, 0.5, 9.0, None]
    assert over(spark, values, "double", numeric.not_null_flag(C())) == [1, 1, 1, 0]
    assert over(spark, values, "double", numeric.threshold_flag(C(), 0.5)) == [0, 1, 1, 0]
    assert over(spark, [2.9, -2.9, None], "double", numeric.fill_cast_int(C())) == [2, -2, -1]
    assert over(spark, values, "double", numeric.abs_sqrt(C())) == [1.0, 0.5, 9.0, None]


def test_fills_rows_and_parsing(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, 2.5, None)], "a tinyint, b double, s string")
    assert [tuple(r) for r in numeric.fill_sentinel(df).collect()] == [(1, -10000.0, "x"), (-10000, 2.5, None)]
    row = df.select(numeric.row_sum(F.col("a"), F.col("b")), numeric.row_null_count(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in row] == [(1.0, 1), (2.5, 1)]
    assert over(spark, ["1.5", "x", None, " 2 "], "string", numeric.to_numeric(C())) == [1.5, None, None, 2.0]


def test_calendar_around_new_year(spark):
    origin = datetime(2017, 11, 30)
    days = [datetime(2017, 12, 25), datetime(2017, 12, 31, 23, 59, 59), datetime(2018, 1, 1), datetime(2018, 12, 31)]
    seconds = [int((d - origin).total_seconds()) for d in days]
    ts = dates.from_seconds(C())
    names = list(dates.calendar(ts))
    got = [dict(zip(names, r)) for r in over(spark, seconds, "long", *dates.calendar(ts).values())]
    for d, r in zip(days, got):
        iso = d.isocalendar()
        assert r["DT_M"] == (d.year - 2017) * 12 + d.month
        assert r["DT_W"] == (d.year - 2017) * 52 + iso[1]
        assert r["DT_D"] == (d.year - 2017) * 365 + d.timetuple().tm_yday
        assert (r["DT_hour"], r["DT_day_week"], r["DT_day_month"]) == (d.hour, d.weekday(), d.day)
        assert r["is_december"] == int(d.month == 12)
    assert [r["is_holiday"] for r in got] == [1, 0, 1, 0]
    assert got[3]["DT_W"] == 53  # last days of December already belong to ISO week 1


def test_raw_clock(spark):
    seconds = [0, 86399, 86400, 86400 * 8 + 3600 * 5 + 1, 3600 * 25]
    want = [(int((s / 86400 - 1) % 7), int(s // 3600) % 24) for s in seconds]
    assert over(spark, seconds, "long", dates.raw_day_of_week(C()), dates.raw_hour(C())) == want


def test_seconds_before_the_origin(spark):
    got = over(spark, [-1], "long", F.date_format(dates.from_seconds(C()), "yyyy-MM-dd HH:mm:ss"))
    assert got == [str(datetime(2017, 11, 30) - timedelta(seconds=1))]
