import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerloom.operators import profile, ranks


@pytest.fixture
def numbers(spark):
    rng = random.Random(11)
    rows = [
        (
            "a" if rng.random() < 0.7 else "b",
            round(rng.gauss(0, 50), 2) if rng.random() < 0.9 else None,
            rng.choice([1, 1, 1, 5]),
            None,
        )
        for _ in range(2000)
    ]
    return rows, spark.createDataFrame(rows, "g string, x double, y int, e double").repartition(6)


def check_describe(rows, out):
    got = {(r["g"], r["column"]): r for r in out.collect()}
    for g in "ab":
        for i, c in ((1, "x"), (2, "y")):
            v = np.array([r[i] for r in rows if r[0] == g and r[i] is not None], float)
            r = got[g, c]
            assert r["count"] == len(v)
            want = [v.mean(), v.std(ddof=1), v.min(), *np.percentile(v, [25, 50, 75]), v.max()]
            have = [r[n] for n in ("mean", "std", "min", "p25", "p50", "p75", "max")]
            assert have == pytest.approx(want)
        empty = got[g, "e"]
        assert empty["count"] == 0 and all(empty[n] is None for n in ("mean", "std", "min", "p25", "p50", "p75", "max"))


@pytest.mark.parametrize("per_task", [1_000_000, 1500, 100, 5])
def test_describe_is_exact_on_every_path(numbers, setting, per_task):
    # Built-in percentile; counted values in one task; counted values in slices; narrowed first.
    setting("spark.ledgerloom.rowsPerTask", per_task)
    rows, df = numbers
    check_describe(rows, profile.describe(df, ["x", "y", "e"], by=["g"]))


def test_ranks_fall_back_when_a_bracket_misses(numbers, setting, monkeypatch):
    setting("spark.ledgerloom.rowsPerTask", 10)
    rows, df = numbers
    v = sorted(r[1] for r in rows if r[1] is not None)
    found = ranks.values_at_ranks(df, [], "x", {"at": F.lit(900)}, [0.1], len(v))  # 0.1 is far from rank 900
    assert found.first()["at"] == v[900]


def test_describe_without_groups_and_approximate(numbers):
    rows, df = numbers
    exact = profile.describe(df, ["x"]).first()
    near = profile.describe(df, ["x"], exact=False).first()
    v = np.array([r[1] for r in rows if r[1] is not None])
    assert exact["p50"] == pytest.approx(np.median(v))
    assert near["p50"] == pytest.approx(np.median(v), abs=1.0) and near["mean"] == pytest.approx(exact["mean"])


@pytest.mark.parametrize("extra", [0, 12])
def test_correlations_of_complete_pairs(spark, extra):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3 + extra)) + 1e6
    x[:, 1] += x[:, 0] * 0.5
    hide = rng.random(x.shape) < 0.2
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [[None if h else float(v) for v, h in zip(a, b)] for a, b in zip(x, hide)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert len(got) == len(names) * (len(names) + 1) // 2
    for i in range(len(names)):
        for j in range(i, len(names)):
            both = ~hide[:, i] & ~hide[:, j]
            assert got[names[i], names[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)


@pytest.mark.parametrize("extra", [0, 12])
def test_correlation_without_spread_is_null(spark, extra):
    # c holds one value wherever a is present.
    data = [(1.0, None, 0.1, 7.7), (2.0, None, 0.1, 7.7), (None, 3.0, 0.3, 7.7), (4.0, 5.0, 0.1, 7.7)]
    df = spark.createDataFrame(data, "a double, b double, c double, k double")
    df = df.withColumns({f"z{i}": F.col("a") * (i + 2) for i in range(extra)})
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert got["a", "a"] == pytest.approx(1.0)
    assert all(got[p] is None for p in (("a", "b"), ("a", "c"), ("a", "k"), ("k", "k")))
    if extra:
        assert got["a", "z0"] == pytest.approx(1.0)


def test_histogram_against_numpy(numbers):
    rows, df = numbers
    v = np.array([r[1] for r in rows if r[1] is not None])
    counts, edges = np.histogram(v, bins=77)
    got = {r["bin"]: (r["left_edge"], r["n"]) for r in profile.histogram(df, "x", bins=77).collect()}
    assert [got.get(i, (0, 0))[1] for i in range(77)] == list(counts)
    assert all(got[i][0] == pytest.approx(edges[i]) for i in got)
    one = profile.histogram(df.withColumn("x", F.lit(4.0)), "x", bins=10)
    assert rows_of(one.select("bin", "n")) == [(0, 2000)]


def test_density_against_numpy(numbers):
    rows, df = numbers
    v = np.array([r[1] for r in rows if r[1] is not None])
    density, _ = np.histogram(v, np.linspace(-20, 30, 26), density=True)
    got = {r["bin"]: r["density"] for r in profile.histogram_density(df, "x", low=-20.0, high=30.0, edges=26).collect()}
    assert [got.get(i, 0) for i in range(25)] == pytest.approx(list(density))


def test_nulls_shares_and_classes(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 0), ("b", None)], "k string, y int")
    assert rows_of(profile.null_counts(df)) == [("k", 1), ("y", 1)]
    assert rows_of(profile.null_ratios(df)) == [("k", 25.0), ("y", 25.0)]
    assert profile.any_null_columns(df).first()[0] == 2
    assert [tuple(r) for r in profile.value_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in profile.value_shares(df, "k").collect()] == [("a", 0.5), ("b", 0.25), (None, 0.25)]
    assert tuple(profile.class_balance(df, "y").first()) == (2, 1, pytest.approx(200 / 3), pytest.approx(100 / 3))
    assert rows_of(profile.column_types(df)) == [("k", "string", 3), ("y", "int", 3)]
    assert rows_of(profile.column_types(df, text_only=True)) == [("k", "string", 3)]
    assert tuple(profile.shape(df, "t").first()) == ("t", 4, 2)


@pytest.mark.parametrize("per_task", [1_000_000, 5])
def test_top_values(spark, setting, per_task):
    setting("spark.ledgerloom.rowsPerTask", per_task)
    df = spark.createDataFrame([(i % 40, i % 3) for i in range(200)], "a int, b int")
    out = profile.category_counts(df, ["a", "b"], k=2)
    assert rows_of(out, "column", "rank") == [("a", "0", 5, 1), ("a", "1", 5, 2), ("b", "0", 67, 1), ("b", "1", 67, 2)]


def test_narrowing_has_exclusive_bounds(spark):
    rows = [(-127, 127, 32766, 32767, 2**31 - 1, 1.5, 65504.0, 1e39, None)]
    cols = "a long, b long, c long, d long, e long, f double, g double, h double, n long"
    df = spark.createDataFrame(rows, cols)
    types = profile.narrow_types(df)
    assert types == {
        "a": "tinyint", "b": "smallint", "c": "smallint", "d": "int", "e": "bigint",
        "f": "float", "g": "float", "h": "double", "n": "bigint",
    }
    out = profile.apply_types(df, types)
    assert out.first()["b"] == 127 and dict(out.dtypes) == types


def test_lossless_check_finds_what_narrowing_changes(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.1), (3, None)], "a long, x double")
    assert rows_of(profile.lossless_check(df, profile.narrow_types(df))) == [("a", 0), ("x", 1)]


@pytest.mark.parametrize("columns", [3, 14])
def test_nan_is_missing_in_correlations(spark, columns):
    nan = float("nan")
    data = [(1.0, 2.0, nan), (2.0, nan, 1.0), (3.0, 5.0, 2.0), (4.0, 9.0, None), (5.0, 7.0, 4.0)]
    wide = [(*r, *[float(i * j % 5) for j in range(columns - 3)]) for i, r in enumerate(data)]
    names = [f"c{i}" for i in range(columns)]
    df = spark.createDataFrame(wide, ", ".join(f"{n} double" for n in names))
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df).collect()}
    pairs = [(a, b) for a, b, _ in data if a == a and b == b]
    n, mx, my = len(pairs), sum(a for a, _ in pairs) / len(pairs), sum(b for _, b in pairs) / len(pairs)
    cov = sum((a - mx) * (b - my) for a, b in pairs)
    spread = (sum((a - mx) ** 2 for a, _ in pairs) * sum((b - my) ** 2 for _, b in pairs)) ** 0.5
    assert n == 4 and got["c0", "c1"] == pytest.approx(cov / spread)


def test_correlations_of_430_columns(spark):
    """Several tiles a side and several levels of the tree, with NaN, null and a constant column."""
    rng = np.random.default_rng(3)
    n, p = 700, 430
    x = rng.normal(size=(n, p)) + rng.normal(size=(n, 1)) * rng.uniform(0, 2, p) + 1e6
    x[:, 7] = 3.0
    rows = [[None if (i + j) % 11 == 0 else float("nan") if (i * j) % 13 == 5 else float(x[i, j]) for j in range(p)] for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"c{j} double" for j in range(p))).repartition(40)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert len(got) == p * (p + 1) // 2
    plain = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for i, j in [(0, 0), (0, 1), (63, 64), (5, 429), (64, 128), (127, 300), (428, 429), (429, 429)]:
        here = ~np.isnan(plain[:, i]) & ~np.isnan(plain[:, j])
        assert got[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(plain[here, i], plain[here, j])[0, 1], abs=1e-9)
    assert all(got[k] is None for k in got if "c7" in k)
