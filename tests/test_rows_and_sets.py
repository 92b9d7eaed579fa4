import random
from datetime import datetime

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ledgerloom.operators import assemble, rows, selection
from ledgerloom.sources import tables as io


@pytest.mark.parametrize("per_task", [1_000_000, 10])
def test_first_and_last_rows(spark, setting, per_task):
    setting("spark.ledgerloom.rowsPerTask", per_task)
    rng = random.Random(1)
    data = [(rng.choice([1, 2, 2, 2, 9]), i) for i in range(500)]
    df = spark.createDataFrame(data, "t int, i int").repartition(4)
    order = sorted(data)
    for k in (1, 77, 250, 499, 500):
        assert rows_of(rows.first_rows(df, ["t", "i"], k)) == order[:k]
        assert rows_of(rows.last_rows(df, ["t", "i"], k)) == order[-k:]
    assert rows.first_rows(df, ["t", "i"], 900).count() == 500
    assert rows.last_rows(df, ["t", "i"], 900).count() == 500


def test_first_rows_is_a_filter(spark):
    df = spark.range(100).select(F.col("id").alias("t"), F.col("id").alias("i"))
    plan = plan_of(rows.first_rows(df, ["t", "i"], 10))
    assert "Exchange" not in plan and "Sort" not in plan


def test_last_period_split(spark):
    df = spark.createDataFrame([(m,) for m in (1, 1, 2, 3, 4, 4)], "m int")
    train, test = rows.last_period_split(df, "m")
    assert rows_of(train) == [(1,), (1,), (2,)] and rows_of(test) == [(4,), (4,)]


@pytest.mark.parametrize("limit", [None, 0])
def test_members(spark, setting, limit):
    if limit is not None:
        setting("spark.ledgerloom.broadcastBytes", limit)
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows_of(rows.keep_members(df, keys, ["k"])) == [(1, "a"), (2, "a")]
    assert rows_of(rows.keep_members(df, keys, ["k"], negate=True)) == [(3, "b"), (4, None)]
    assert rows_of(rows.keep_members(df, keys, ["k"], null_safe=True)) == [(1, "a"), (2, "a"), (4, None)]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rows.keep_columns(df, ["c", "x"], always=["a"]).columns == ["a", "c"]
    names = spark.createDataFrame([("b",), ("x",), ("b",)], "feature string")
    assert rows.drop_named(df, names).columns == ["a", "c"]


def test_bind_refuses_a_repeated_key(spark):
    left = spark.createDataFrame([(1, "l")], "id int, a string")
    right = spark.createDataFrame([(1, "r", 5), (1, "r", 6)], "id int, a string, b int")
    with pytest.raises(ValueError, match="not unique"):
        assemble.bind_columns(left, right, key="id")
    out = assemble.bind_columns(left, right.filter("b = 5"), key="id")
    assert rows_of(out) == [(1, "l", 5)]


def test_the_first_set_wins(spark):
    base = spark.createDataFrame([(1, "base"), (2, "base")], "id int, a string")
    second = spark.createDataFrame([(1, "x", 10)], "id int, a string, b int")
    third = spark.createDataFrame([(2, 99, "t")], "id int, b int, c string")
    out = assemble.assemble_sets(base, second, third, key="id")
    assert out.columns == ["id", "a", "b", "c"]
    assert rows_of(out, "id") == [(1, "base", 10, None), (2, "base", None, "t")]
    assert assemble.new_columns(base, third) == ["b", "c"]


def test_bucketed_sets_join_without_exchange(spark, tmp_path, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    sets = []
    for name in ("one", "two"):
        df = spark.range(200).select("id", (F.col("id") * 2).alias(f"x_{name}"))
        sets.append(assemble.save_bucketed(df, f"set_{name}", str(tmp_path / name), key="id", buckets=4))
    out = assemble.assemble_sets(*sets, key="id", check=False)
    plan = plan_of(out)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert out.count() == 200
    for name in ("one", "two"):
        spark.sql(f"DROP TABLE set_{name}")


def test_best_correlated_column_per_base(spark):
    rows_in = [(i % 2, float(i % 2) * 3 + i * 0.01, float(i), float(i % 2), None) for i in range(40)]
    df = spark.createDataFrame(rows_in, "y int, a_1 double, a_2 double, ab_1 double, b_9 double")
    derived = ["a_1", "a_2", "ab_1", "b_9"]
    best = selection.best_by_correlation(df, "y", ["a_", "b", "zz"], derived)
    got = {r["base"]: r["best"] for r in best.collect()}
    assert got == {"a_": "a_1", "b": "ab_1"}
    assert selection.drop_weaker(df, best, derived).columns == ["y", "a_1", "ab_1"]


def test_csv_round_trip(spark, tmp_path):
    schema = "i int, s string, x double, t timestamp"
    data = [
        (1, 'say "hi", twice, "', 0.1, datetime(2020, 1, 2, 3, 4, 5, 678901)),
        (2, "line\nbreak", None, None),
        (None, "back\\slash", -1e300, None),
        (4, None, 2.0, None),
        (5, " pad ", 2.0, None),
    ]
    df = spark.createDataFrame(data, schema)
    path = io.write_csv(df, str(tmp_path / "out"))
    back = io.read_csv(spark, path, schema, multiline=True)
    assert rows_of(back, "x", "i") == rows_of(df, "x", "i")
    blank = io.write_csv(spark.createDataFrame([(1, "")], "i int, s string"), str(tmp_path / "blank"))
    assert rows_of(io.read_csv(spark, blank, "i int, s string")) == [(1, None)]


def test_scores_follow_the_sample(spark, tmp_path):
    sample = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.5)], "id int, y double")
    scores = spark.createDataFrame([(1, 0.25), (3, 0.75), (9, 1.0)], "id int, y double")
    path = io.write_scores(sample, scores, str(tmp_path / "scores"), key="id", score="y")
    assert rows_of(io.read_csv(spark, path, "id int, y double")) == [(1, 0.25), (2, None), (3, 0.75)]


def test_exclusions_round_trip(spark, tmp_path):
    path = io.write_exclusions(spark, ["b", "a", "b"], str(tmp_path / "names"))
    assert io.read_exclusions(spark, path) == ["a", "b"]
    df = spark.createDataFrame([(1, "X")], "n int, s string")
    assert io.text_columns(df) == ["s"]
    assert io.transform_text(df, F.lower).first()["s"] == "x"
    assert io.typed(df, n="string").dtypes == [("n", "string"), ("s", "string")]


def test_missing_order_values_come_first(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (4, 4), (5, 5)], "a int, b int")
    take = lambda d: sorted(r["b"] for r in d.collect())
    assert [take(rows.first_rows(df, ["a", "b"], k)) for k in (1, 3, 4)] == [[1], [1, 2, 3], [1, 2, 3, 4]]
    assert [take(rows.last_rows(df, ["a", "b"], k)) for k in (3, 4)] == [[3, 4, 5], [2, 3, 4, 5]]
