import random
from collections import defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerloom.operators import evaluate, modeling


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_task", [1_000_000, 7])
@pytest.mark.parametrize("levels", [3, 1000])
def test_auc_against_brute_force(spark, setting, per_task, levels):
    setting("spark.ledgerloom.rowsPerTask", per_task)
    rng = random.Random(levels)
    rows = [(f % 3, rng.randrange(2) if f % 3 else 1, rng.randrange(levels) / 7) for f in range(240)]
    df = spark.createDataFrame(rows, "fold int, y int, s double").repartition(5)
    whole = evaluate.auc(df, label="y", score="s").first()["auc"]
    assert whole == pytest.approx(brute_auc([r[1:] for r in rows]))
    folds = {r["fold"]: r for r in evaluate.auc_by_fold(df, label="y", score="s").collect()}
    for f in range(3):
        want = brute_auc([r[1:] for r in rows if r[0] == f])
        assert folds[f]["auc"] == (None if want is None else pytest.approx(want))
    assert folds[1]["mean_auc"] == pytest.approx((folds[1]["auc"] + folds[2]["auc"]) / 2)


def test_auc_of_ties_and_classes(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "y int, s double")
    assert evaluate.auc(df, label="y", score="s").first()["auc"] == 0.5
    hard = spark.createDataFrame([(1, 0.9), (0, 0.6), (1, 0.55), (0, 0.1)], "y int, s double")
    assert evaluate.auc_hard_label(hard, label="y", score="s").first()["auc"] == 0.75


def test_group_folds_balance_and_keep_groups_together(spark):
    sizes = {1: 50, 2: 40, 3: 30, 4: 20, 5: 10, 6: 10, None: 5}
    df = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)], "g int").repartition(4)
    out = evaluate.group_folds(df, "g", k=3)
    found = {(r["g"], r["fold"]): r["n"] for r in out.groupBy("g", "fold").agg(F.count("*").alias("n")).collect()}
    assert len(found) == 7  # one fold per group
    load = defaultdict(int)
    for (_, f), n in found.items():
        load[f] += n
    assert sorted(load.values()) == [50, 55, 60]


@pytest.mark.parametrize("seed", range(40))
def test_groups_are_dealt_like_one_after_the_other(seed):
    rng = random.Random(seed)
    k = rng.randint(1, 6)
    sizes = {rng.randint(1, 12): rng.randint(1, 30) for _ in range(rng.randint(1, 6))}
    load, want = [0] * k, []
    for size in sorted(sizes, reverse=True):
        for _ in range(sizes[size]):
            f = min(range(k), key=lambda f: (load[f], f))
            load[f] += size
            want.append(f)
    got = []
    for size, parts in evaluate._deal(sizes, k):
        for place in range(sizes[size]):
            start, turns = [p for p in parts if p[0] <= place][-1]
            got.append(turns[(place - start) % len(turns)])
    assert got == want


def test_auc_refuses_rows_without_a_score(spark):
    df = spark.createDataFrame([(1, 0.5), (0, None)], "y int, s double")
    with pytest.raises(Exception, match="missing"):
        evaluate.auc(df, label="y", score="s").collect()


def test_random_folds_depend_on_the_id_only(spark):
    df = spark.range(1000)
    a = rows_of(evaluate.random_folds(df, "id", k=5, seed=1))
    assert a == rows_of(evaluate.random_folds(df.repartition(13), "id", k=5, seed=1))
    assert a != rows_of(evaluate.random_folds(df, "id", k=5, seed=2))
    assert {f for _, f in a} == set(range(5))
    train, holdout = evaluate.last_fold(evaluate.random_folds(df, "id"))
    assert train.count() + holdout.count() == 1000 and holdout.select("fold").distinct().first()[0] == 4


def test_importance_rankings(spark, setting):
    long = spark.createDataFrame([(0, "a", 4.0), (1, "a", 2.0), (0, "b", 1.0), (0, "c", 1.0)], "fold int, feature string, importance double")
    used = evaluate.mean_importance(long)
    assert rows_of(used) == [("a", 3.0), ("b", 1.0), ("c", 1.0)]
    assert rows_of(evaluate.mean_importance(long, folds=2)) == [("a", 3.0), ("b", 0.5), ("c", 0.5)]
    assert [r[0] for r in evaluate.top_features(used, 2).collect()] == ["a", "b"]
    assert [r[0] for r in evaluate.bottom_features(used, 2).collect()] == ["b", "c"]
    for per_task in (1_000_000, 1):
        setting("spark.ledgerloom.rowsPerTask", per_task)
        by_name = evaluate.cumulative_importance(used)
        assert rows_of(by_name.select("feature", "cum_sum", "cum_perc")) == [("a", 3.0, 60.0), ("b", 4.0, 80.0), ("c", 5.0, 100.0)]
        by_value = evaluate.cumulative_importance(used.filter("feature <> 'c'"), order_by="importance")
        assert rows_of(evaluate.keep_cumulative(by_value, 75).select("feature")) == [("a",)]


def test_bagged_mean(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4), (2, 1.0)], "id int, s double")
    assert rows_of(evaluate.bagged_mean(df, key="id", score="s")) == [(1, pytest.approx(0.3)), (2, 1.0)]


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        x, z = rng.random(), rng.random()
        rows.append((i, i % 6, int(x + 0.2 * rng.random() > 0.6), x, z if i % 9 else None))
    df = spark.createDataFrame(rows, "id int, month int, y int, x double, z double")
    vec = modeling.feature_vector(df, ["x", "z"], keep=["id", "month", "y"])
    folded = evaluate.group_folds(vec, "month", k=3)
    models = modeling.cross_validate(folded, label="y", k=3, params={"maxIter": 4, "maxDepth": 2})
    return folded, models


def test_missing_features_become_the_sentinel(learned):
    folded, _ = learned
    assert folded.filter("id = 0").first()["features"].toArray()[1] == -10000.0


def test_out_of_fold_scores(learned):
    folded, models = learned
    scored = modeling.out_of_fold(models, folded, keep=["id", "y"])
    assert scored.count() == 600 and scored.select("id").distinct().count() == 600
    assert evaluate.auc(scored, label="y", score="score").first()["auc"] > 0.9


def test_bagged_scores_equal_the_mean_of_fold_scores(learned):
    folded, models = learned
    each = modeling.fold_scores(models, folded, keep=["id"])
    assert each.count() == 1800
    mean = {r["id"]: r["score"] for r in evaluate.bagged_mean(each, key="id", score="score").collect()}
    bagged = {r["id"]: r["score"] for r in modeling.bagged_scores(models, folded, keep=["id"]).collect()}
    assert bagged == pytest.approx(mean)


def test_importance_names_the_features(learned):
    folded, models = learned
    table = modeling.importance_table(folded, models, ["x", "z"])
    mean = {r["feature"]: r["importance"] for r in evaluate.mean_importance(table, folds=3).collect()}
    assert table.count() == 6 and mean["x"] > mean["z"]


def test_param_search_ranks_trials(learned):
    folded, _ = learned
    found = modeling.param_search(
        folded.withColumn("valid", F.col("fold") == 2),
        label="y",
        valid_flag="valid",
        bounds={"maxDepth": (1, 4), "stepSize": (0.05, 0.5)},
        integers=["maxDepth"],
        init_points=1,
        n_iter=1,
        fixed={"maxIter": 2},
    ).collect()
    assert len(found) == 2 and found[0]["auc"] >= found[1]["auc"]
    assert all(r["maxDepth"] == int(r["maxDepth"]) and 0.05 <= r["stepSize"] <= 0.5 for r in found)
