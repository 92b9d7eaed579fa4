import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import encode, modeling, state


def rows_for(seed, n, keys):
    rng = random.Random(seed)
    return [
        (rng.choice(keys), rng.choice([None, "x", "y", "z"]), None if rng.random() < 0.2 else rng.gauss(1e6, 3.0), rng.randint(0, 1))
        for _ in range(n)
    ]


SCHEMA = "key string, kind string, v double, y int"


def fitted(df):
    return state.fit(df, ["key"], ["v", "y"], ["kind"])


def as_dict(s):
    return {r["key"]: r.asDict() for r in state.table(s).collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for c in a[k]:
            assert a[k][c] == (pytest.approx(b[k][c], rel=1e-9) if isinstance(b[k][c], float) else b[k][c]), (k, c)


def test_merged_states_equal_the_state_of_all_rows(spark, tmp_path):
    """Hot, new, gone and missing keys; three months; means large beside their spread."""
    months = [rows_for(1, 400, ["hot"] * 20 + ["a", "b", None]), rows_for(2, 90, ["hot", "c", None]), rows_for(3, 60, ["d", "a"])]
    frames = [spark.createDataFrame(m, SCHEMA) for m in months]
    path = f"{tmp_path}/state"
    assert state.save(fitted(frames[0]), path) == 1
    for i, new in enumerate(frames[1:]):
        assert state.save(state.merge(state.load(spark, path), fitted(new)), path) == i + 2
    everything = [r for m in months for r in m]
    close(as_dict(state.load(spark, path)), as_dict(fitted(spark.createDataFrame(everything, SCHEMA))))
    close(as_dict(state.load(spark, path, 1)), as_dict(fitted(frames[0])))
    got = as_dict(state.load(spark, path))["hot"]
    v = [x for k, _, x, _ in everything if k == "hot" and x is not None]
    assert got["v_std"] == pytest.approx(statistics.stdev(v), rel=1e-9) and got["v_count"] == len(v)
    kinds = [c for k, c, _, _ in everything if k == "hot" and c]
    assert got["kind_mode"] == max((kinds.count(c), c) for c in kinds)[1]


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    path = f"{tmp_path}/state"
    df = spark.createDataFrame(rows_for(1, 20, ["a"]), SCHEMA)
    with pytest.raises(ValueError, match="no complete version"):
        state.load(spark, path)
    state.save(fitted(df), path)
    fitted(df).moments.write.parquet(f"{path}/v2/moments")  # a run that died here
    assert as_dict(state.load(spark, path)).keys() == {"a"}
    assert state.save(fitted(df), path) == 3
    with pytest.raises(ValueError, match="do not merge"):
        state.merge(fitted(df), state.fit(df, ["kind"]))


def test_states_of_no_rows_and_unknown_keys(spark):
    some, none = spark.createDataFrame(rows_for(4, 30, ["a", None]), SCHEMA), spark.createDataFrame([], SCHEMA)
    close(as_dict(state.merge(fitted(none), fitted(some))), as_dict(fitted(some)))
    close(as_dict(state.merge(fitted(some), fitted(none))), as_dict(fitted(some)))
    asked = spark.createDataFrame([("a",), ("new",), (None,)], "key string")
    got = {r["key"]: r["n"] for r in state.apply(fitted(some), asked).collect()}
    assert got["a"] > 0 and got["new"] is None and got[None] is None
    assert {r["key"]: r["n"] for r in state.apply(fitted(some), asked, null_keys=True).collect()}[None] > 0


@pytest.mark.parametrize("large", [False, True])
def test_no_row_sees_the_labels_of_its_fold(spark, setting, large):
    if large:
        setting("spark.ledgerloom.broadcastBytes", 0)
    rng = random.Random(8)
    rows = [(i, rng.choice(["train"] * 4 + ["test"]), rng.randint(0, 4), rng.choice(["hot"] * 50 + [f"k{i % 30}", None]), rng.choice([0, 1, None])) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, split string, fold int, key string, y int")
    got = {r["id"]: r["key_target_mean"] for r in encode.out_of_fold_target_mean(df, ["key"], "y", id_col="id").collect()}
    for i, split, fold, key, _ in rows:
        seen = [y for _, s, f, k, y in rows if s == "train" and k == key and y is not None and (split == "test" or f != fold)]
        want = sum(seen) / len(seen) if seen and key else None
        assert got[i] == (want if want is None else pytest.approx(want))


def test_random_labels_do_not_leak(spark):
    """Keys of their own learn nothing, keys of a few rows nothing that goes with the label."""
    rng = random.Random(9)
    rows = [(i, "train", rng.randint(0, 4), f"own {i}", f"few {i % 1500}", rng.randint(0, 1)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id int, split string, fold int, own string, few string, y int")
    out = encode.out_of_fold_target_mean(df, ["own", "few"], "y")
    assert out.filter(F.col("own_target_mean").isNotNull()).count() == 0
    inside = encode.fit_target_mean(df, ["few"], "y").apply(df)
    assert inside.agg(F.corr("few_enc", "y")).first()[0] > 0.3
    assert out.agg(F.corr("few_target_mean", "y")).first()[0] < 0.05


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(6)
    rows = []
    for i in range(2000):
        a, b = rng.random(), rng.random()
        rows.append((int(rng.random() < (0.9 if a > 0.5 else 0.1) * b + 0.1 * (1 - b)), a, b if i % 7 else None, i % 4 == 0))
    df = spark.createDataFrame(rows, "y int, a double, b double, valid boolean")
    return modeling.stage(modeling.feature_vector(df, ["a", "b"], keep=["y", "valid"], missing=["b"])).df


def test_missing_values_have_an_entry_of_their_own(noisy):
    vectors = [r["features"].toArray() for r in noisy.limit(50).collect()]
    assert all(len(v) == 3 and (v[2] == 1) == (v[1] == -10000) for v in vectors)


def test_patience_finds_the_best_number_of_trees(noisy):
    params = {"maxIter": 60, "maxDepth": 3, "stepSize": 0.3}
    model = modeling.train_gbt(noisy, label="y", valid_flag="valid", params=params, patience=15)
    whole = modeling.train_gbt(noisy.filter("not valid"), label="y", params=params)
    losses = whole.evaluateEachIteration(noisy.filter("valid"))
    n = model.getNumTrees
    assert losses[n - 1] == min(losses[: n + 15]) and 1 < n < 60
    assert model.evaluateEachIteration(noisy.filter("valid"))[-1] == pytest.approx(losses[n - 1])
    assert modeling.train_gbt(noisy, label="y", valid_flag="valid", params=params).getNumTrees <= n


def test_the_best_model_is_cut_off_the_trained_one(noisy, monkeypatch):
    trained = []

    class Counted(modeling.GBTClassifier):
        def fit(self, *args):
            model = super().fit(*args)
            trained.append(model.getNumTrees)
            return model

    monkeypatch.setattr(modeling, "GBTClassifier", Counted)
    params = {"maxIter": 30, "maxDepth": 3, "stepSize": 0.3}
    model = modeling.train_gbt(noisy, label="y", valid_flag="valid", params=params, patience=15)
    assert trained == [30] and 1 < model.getNumTrees < 30
    alone = modeling.train_gbt(noisy.filter("not valid"), label="y", params={**params, "maxIter": model.getNumTrees})
    scores = [[tuple(r) for r in modeling.score_rows(m, noisy, keep=["y"]).collect()] for m in (model, alone)]
    assert scores[0] == scores[1] and model.featureImportances == alone.featureImportances


def test_many_rows_are_trained_without_a_first_try(noisy, monkeypatch):
    trained = []

    class Counted(modeling.GBTClassifier):
        def fit(self, *args):
            model = super().fit(*args)
            trained.append(model.getNumTrees)
            return model

    monkeypatch.setattr(modeling, "GBTClassifier", Counted)
    monkeypatch.setattr(modeling, "FIRST_TREES", 2)
    options = dict(label="y", valid_flag="valid", params={"maxIter": 25, "maxDepth": 3, "stepSize": 0.1}, patience=3)
    rows = noisy.filter("not valid").count()
    monkeypatch.setattr(modeling, "LONG_ROWS", rows + 1, raising=False)
    few = modeling.train_gbt(noisy, **options)
    assert trained[:2] == [4, 20]  # too short at first
    trained.clear()
    monkeypatch.setattr(modeling, "LONG_ROWS", rows)
    many = modeling.train_gbt(noisy, **options)
    assert trained == [25] and many.getNumTrees == few.getNumTrees
    scores = [[tuple(r) for r in modeling.score_rows(m, noisy, keep=["y"]).collect()] for m in (few, many)]
    assert scores[0] == scores[1] and few.featureImportances == many.featureImportances


def test_fold_models_share_the_cores(spark, noisy, monkeypatch):
    seen = []

    class Counted(modeling.GBTClassifier):
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return super().fit(rows)

    monkeypatch.setattr(modeling, "GBTClassifier", Counted)
    data = noisy.withColumn("fold", F.col("valid").cast("int")).repartition(16)
    n = [data.filter(F.col("fold") != f).count() for f in range(2)]
    options = dict(label="y", k=2, params={"maxIter": 2, "maxDepth": 2}, patience=2)
    models = modeling.cross_validate(data, **options)
    cores = spark.sparkContext.defaultParallelism
    assert modeling.stage(data).df.rdd.getNumPartitions() > cores // 2
    assert [t for t, _ in seen] == [cores // 2] * 2 and sorted(r for _, r in seen) == sorted(n)
    seen.clear()
    monkeypatch.setattr(modeling, "TRAIN_ROWS_PER_TASK", 10)  # more rows, more tasks
    wide = modeling.cross_validate(data, **options)
    assert min(t for t, _ in seen) > cores // 2 and sorted(r for _, r in seen) == sorted(n)
    # The shares of importance are not compared: the sentinel and the entry for missing values tie.
    for few, many in zip(models, wide):
        scores = [[r["score"] for r in modeling.score_rows(m, noisy, keep=[]).collect()] for m in (few, many)]
        assert scores[0] == pytest.approx(scores[1])


def test_halving_is_never_below_the_first_budget(noisy):
    options = dict(label="y", valid_flag="valid", bounds={"maxDepth": (1, 4), "stepSize": (0.05, 0.5)}, integers=["maxDepth"], init_points=2, n_iter=2)
    first = modeling.param_search(noisy, **options, budgets=(3,)).collect()
    found = modeling.param_search(noisy, **options, budgets=(3, 12, 24)).collect()
    assert found[0]["auc"] >= first[0]["auc"] and len(found) == 4
    assert found[0]["auc"] == max(r["auc"] for r in found)
