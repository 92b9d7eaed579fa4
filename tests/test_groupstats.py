import random
import statistics as st
from collections import Counter, defaultdict

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ledgerloom.operators import groupstats as g


@pytest.fixture(params=["broadcast", "shuffled"], autouse=True)
def joined(request, setting):
    if request.param == "shuffled":
        setting("spark.ledgerloom.broadcastBytes", 0)


def frame(spark, rows, schema="id int, split string, k string, p int, x double"):
    return spark.createDataFrame(rows, schema)


ROWS = [
    (0, "train", "a", 1, 3.0),
    (1, "train", "a", 1, 3.0),
    (2, "train", "b", 1, 5.0),
    (3, "test", "a", 1, 9.0),
    (4, "test", None, 2, 1.0),
    (5, "train", None, 2, None),
]


def column(df, c):
    return [r[c] for r in df.orderBy("id").collect()]


def test_uid_stats(spark):
    out = g.uid_stats(frame(spark, ROWS), ["k"], ["x"])
    assert column(out, "k_x_mean") == [5.0, 5.0, 5.0, 5.0, None, None]
    sd = st.stdev([3, 3, 9])
    assert column(out, "k_x_std") == [pytest.approx(sd)] * 2 + [None, pytest.approx(sd), None, None]


def test_std_norm_is_null_without_spread(spark):
    rows = [(0, "train", "z", 1, 3.0), (1, "train", "z", 1, 3.0), (2, "train", "o", 1, 4.0)]
    out = g.uid_std_norm(frame(spark, rows), ["k"], ["x"])
    assert column(out, "k_x_std_norm") == [None, None, None]
    assert out.columns == ["id", "split", "k", "p", "x", "k_x_std_norm"]


def test_period_scaling_is_per_split(spark):
    rows = [(0, "train", "a", 1, 2.0), (1, "train", "a", 1, 6.0), (2, "test", "a", 1, 7.0), (3, "train", "a", 2, 1.0)]
    out = g.period_scaling(frame(spark, rows), ["x"], ["p"])
    assert column(out, "x_p_min_max") == [0.0, 1.0, None, None]
    sd = st.stdev([2, 6])
    assert column(out, "x_p_std_score") == [pytest.approx(-2 / sd), pytest.approx(2 / sd), None, None]


def test_period_totals(spark):
    assert column(g.period_totals(frame(spark, ROWS), ["p"]), "p_total") == [4, 4, 4, 4, 2, 2]


def test_timeblock_frequency_keeps_missing_keys(spark):
    out = g.timeblock_frequency(frame(spark, ROWS), ["k"], ["p"])
    assert column(out, "k_p") == [3, 3, 1, 3, 2, 2]
    assert column(out, "k_p_proportions") == [0.75, 0.75, 0.25, 0.75, 1.0, 1.0]
    only = g.timeblock_frequency(frame(spark, ROWS), ["k"], ["p"], with_proportions=False, only_proportions=True)
    assert column(only, "k_p") == [0.75, 0.75, 0.25, 0.75, 1.0, 1.0] and "k_p_proportions" not in only.columns
    plain = g.timeblock_frequency(frame(spark, ROWS), ["k"], ["p"], with_proportions=False)
    assert column(plain, "k_p") == [3, 3, 1, 3, 2, 2]
    with pytest.raises(ValueError):
        g.timeblock_frequency(frame(spark, ROWS), ["k"], ["p"], only_proportions=True)


def test_ratio_to_group(spark):
    out = g.ratio_to_group(frame(spark, ROWS), [("x", "k")])
    assert column(out, "x_to_mean_k") == [1.0, 1.0, 1.0, 1.0, None, None]
    assert column(out, "x_to_std_k") == [None] * 6  # no spread, or one row


def test_conditional_ratio_needs_all_members(spark):
    out = g.conditional_ratio(frame(spark, ROWS), ["k", "p"], ["p"], "share")
    assert column(out, "share") == [0.75, 0.75, 0.25, 0.75, None, None]


def test_mean_distance_groups_missing_keys(spark):
    rows = [(0, "train", None, 1, 2.0), (1, "train", None, 1, 4.0), (2, "train", "a", 1, 7.0), (3, "test", None, 1, 9.0)]
    out = g.mean_distance(frame(spark, rows), ["k"], [("p", "x", "_dist")])
    assert column(out, "k_p_dist") == [-1.0, 1.0, 0.0, 0.0]


def test_mode_distance_takes_the_largest_on_a_tie(spark):
    rows = [(i, "train", "a", 1, x) for i, x in enumerate([2.0, 2.0, 3.0, 3.0, 1.0])]
    rows += [(5, "train", None, 1, 8.0), (6, "test", "a", 1, 8.0)]
    out = g.mode_distance(frame(spark, rows), ["k"], [("p", "x", "_best")])
    assert column(out, "k_p_best") == [-1.0, -1.0, 0.0, 0.0, -2.0, None, 0.0]


def test_mode_distance_against_brute_force(spark):
    rng = random.Random(5)
    schema = "id int, split string, k string, j int, p int, q int, x int, y int"
    rows = [
        (i, rng.choice(["train", "test"]), rng.choice("abc"), rng.randrange(3), rng.randrange(3), rng.randrange(2),
         rng.randrange(4), rng.randrange(5))
        for i in range(400)
    ]
    out = g.mode_distance(spark.createDataFrame(rows, schema), ["k", "j"], [("p", "x", "_x"), ("q", "y", "_y")])
    names = schema.replace(",", "").split()[::2]
    table = [dict(zip(names, r)) for r in rows]
    for key in ("k", "j"):
        for period, pos, suffix in (("p", "x", "_x"), ("q", "y", "_y")):
            seen = defaultdict(Counter)
            for r in table:
                seen[r["split"], r[key], r[period]][r[pos]] += 1
            mode = {gk: max(c, key=lambda v: (c[v], v)) for gk, c in seen.items()}
            want = [r[pos] - mode[r["split"], r[key], r[period]] for r in table]
            assert column(out, f"{key}_{period}{suffix}") == want


def test_train_max_and_last_period_cap(spark):
    rows = [(0, "train", "a", 1, 8.0), (1, "train", "a", 2, 4.0), (2, "test", "a", 3, 16.0), (3, "train", "a", 2, None)]
    df = frame(spark, rows)
    assert column(g.scale_by_train_max(df, ["x"]), "x_scaled") == [1.0, 0.5, 2.0, None]
    assert column(g.clip_to_last_period(df, ["x"], "p"), "x") == [4.0, 4.0, 4.0, None]


def test_no_windows_over_rows(spark, folder):
    df = frame(spark, ROWS)
    outs = [
        g.uid_stats(df, ["k"], ["x"]),
        g.period_scaling(df, ["x"], ["p"]),
        g.ratio_to_group(df, [("x", "k")]),
        g.mean_distance(df, ["k"], [("p", "x", "_d")]),
    ]
    for out in outs:
        plan = plan_of(out)
        assert "Window" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_partitioning_does_not_matter(spark):
    rows = [(i, "train" if i % 3 else "test", f"k{i % 7}", i % 4, float(i % 11)) for i in range(300)]
    df = frame(spark, rows)
    make = lambda d: g.ratio_to_group(g.uid_stats(d, ["k"], ["x"], ["mean", "max"]), [("x", "k")], ["mean"])
    a, b = make(df.coalesce(1)), make(df.orderBy(F.desc("x")).repartition(9))
    close = zip(rows_of(a, "id"), rows_of(b, "id"))
    assert all(p == pytest.approx(q) for x, y in close for p, q in zip(x, y) if isinstance(p, float))


def test_modes_keep_the_type_of_their_column(spark):
    """Integers beyond 2^53 and dates in one call."""
    import datetime

    from ledgerloom.operators.groupstats import _modes

    big, day = 2**60 + 1, datetime.date(2020, 1, 2)
    rows = [("train", "k", 1, big, day), ("train", "k", 1, big, day), ("train", "k", 1, 5, datetime.date(2021, 1, 1))]
    df = spark.createDataFrame(rows, "split string, key string, month int, position bigint, seen date")
    sets = [("split", "key", "month", "position"), ("split", "key", "month", "seen")]
    found = _modes(df, sets)
    assert [found[s].df.first()["mode"] for s in sets] == [big, day]
