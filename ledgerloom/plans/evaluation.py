"""Folds, scores and model queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import evaluate, modeling
from ..operators.keyed import stage
from . import roles
from .registry import R, named, r


LIGHTEST = "CASE least(a0, a1, a2, a3, a4) WHEN a0 THEN 0 WHEN a1 THEN 1 WHEN a2 THEN 2 WHEN a3 THEN 3 ELSE 4 END"


@named(
    "cv_group_folds",
    f"""WITH RECURSIVE {roles.ORDERS}, g AS (SELECT DT_M, n, row_number() OVER (ORDER BY n DESC, DT_M) AS i
  FROM (SELECT DT_M, count(*) AS n FROM txn GROUP BY 1)),
  a(i, DT_M, fold, a0, a1, a2, a3, a4) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
    CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL SELECT g.i, g.DT_M, {LIGHTEST}, {', '.join(f"a{k} + CASE WHEN {LIGHTEST} = {k} THEN n ELSE 0 END" for k in range(5))}
  FROM a JOIN g ON g.i = a.i + 1)
  SELECT txn_id, txn.DT_M, fold FROM txn JOIN a ON txn.DT_M = a.DT_M""",
)
def cv_group_folds(spark, d):
    o = roles.orders(spark, d).select("txn_id", "DT_M")
    return evaluate.group_folds(o, "DT_M", k=5)


@named(
    "cv_random_folds",
    f"""WITH {roles.ORDERS} SELECT txn_id, label,
  CAST(CAST('0x' || substr(md5(txn_id || ':42'), 1, 15) AS BIGINT) % 5 AS INTEGER) AS fold FROM txn""",
)
def cv_random_folds(spark, d):
    return evaluate.random_folds(roles.orders(spark, d).select("txn_id", "label"), "txn_id", k=5)


@named(
    "cv_last_fold",
    f"WITH {roles.ORDERS} SELECT txn_id, CASE WHEN txn_id % 5 = 4 THEN 1 ELSE 0 END AS holdout FROM txn",
)
def cv_last_fold(spark, d):
    o = roles.orders(spark, d).select("txn_id", F.pmod("txn_id", F.lit(5)).cast("int").alias("fold"))
    train, holdout = evaluate.last_fold(o, k=5)
    parts = [p.select("txn_id", F.lit(i).alias("holdout")) for i, p in enumerate((train, holdout))]
    return parts[0].unionByName(parts[1])


def _auc_sql(source: str, score: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""x AS (SELECT {head}label, rank() OVER ({part}ORDER BY {score}) +
  (count(*) OVER ({part + ('' if not by else ', ' + score) if by else 'PARTITION BY ' + score}) - 1) / 2.0 AS mid
  FROM {source}),
  y AS (SELECT {head}(sum(mid) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
  / nullif(CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0), 0) AS auc FROM x{tail})"""


SCORED_SQL = f"{roles.ORDERS}, s AS (SELECT txn_id, label, DT_M % 5 AS fold, floor(amount / 1000) + label * 40 AS score FROM txn)"


def _scored(spark, d):
    o = roles.orders(spark, d)
    score = F.floor(F.col("amount") / 1000).cast("double") + F.col("label") * 40
    return o.select("txn_id", "label", F.pmod("DT_M", F.lit(5)).alias("fold"), score.alias("score"))


@named("ev_auc", f"WITH {SCORED_SQL}, {_auc_sql('s', 'score')} SELECT {R('auc', 9)} AS auc FROM y")
def ev_auc(spark, d):
    return evaluate.auc(_scored(spark, d), label="label", score="score").select(r("auc", 9).alias("auc"))


@named(
    "ev_auc_by_fold",
    f"""WITH {SCORED_SQL}, {_auc_sql('s', 'score', 'fold')}
  SELECT fold, {R('auc', 9)} AS auc, {R('avg(auc) OVER ()', 9)} AS mean_auc FROM y""",
)
def ev_auc_by_fold(spark, d):
    out = evaluate.auc_by_fold(_scored(spark, d), label="label", score="score")
    return out.select("fold", r("auc", 9).alias("auc"), r("mean_auc", 9).alias("mean_auc"))


@named(
    "ev_auc_hard_label",
    f"""WITH {SCORED_SQL}, h AS (SELECT label, CASE WHEN score > 270 THEN 1 ELSE 0 END AS score FROM s),
  {_auc_sql('h', 'score')} SELECT {R('auc', 9)} AS auc FROM y""",
)
def ev_auc_hard_label(spark, d):
    found = evaluate.auc_hard_label(_scored(spark, d), label="label", score="score", threshold=270)
    return found.select(r("auc", 9).alias("auc"))


# ---- models.  A tree ensemble has no SQL form.  The SQL states what its rows must be, and gives the exact AUC of
# the best single column, which a model has to beat: one that learns nothing does not.


FEATURES = ("amount", "D1", "D2", "addr1", "card1", "DT_M")
MISSING = ("D2", "addr1")
#: What the training adds to the columns: whether a value is missing.
ENTRIES = (*FEATURES, *[f"{c}_missing" for c in MISSING])
TREES = {"maxIter": 400, "maxDepth": 4, "maxBins": 32, "stepSize": 0.1}
#: Trees without gain after which training stops; the reference's 500 are a twentieth of its rounds.
PATIENCE = 20
FOLDS = 5
SINGLE_AUC = 0.01
_ONE_COLUMN = " UNION ALL ".join(
    f"SELECT label, '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), -10000) AS value FROM txn WHERE split = '{{split}}'" for c in FEATURES
)


def _best_sql(split: str) -> str:
    """The largest AUC of a column, in either direction."""
    return f"""c AS ({_ONE_COLUMN.format(split=split)}), {_auc_sql('c', 'value', 'feature')},
  best AS (SELECT {R('max(greatest(auc, 1 - auc))', 9)} AS best_feature_auc FROM y)"""


def _folds_sql(source: str) -> str:
    return f"""{source}, g AS (SELECT DT_M, n, row_number() OVER (ORDER BY n DESC, DT_M) AS i
  FROM (SELECT DT_M, count(*) AS n FROM txn WHERE split = 'train' GROUP BY 1)),
  a(i, DT_M, fold, a0, a1, a2, a3, a4) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
    CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL SELECT g.i, g.DT_M, {LIGHTEST}, {', '.join(f"a{k} + CASE WHEN {LIGHTEST} = {k} THEN n ELSE 0 END" for k in range(5))}
  FROM a JOIN g ON g.i = a.i + 1)"""


def _matrix(spark, d):
    t = roles.learnable(spark, d)
    return modeling.feature_vector(t, FEATURES, keep=["txn_id", "split", "label", "DT_M"], missing=MISSING)


def _folded(spark, d):
    train = _matrix(spark, d).filter(F.col("split") == "train")
    return evaluate.group_folds(train, "DT_M", k=FOLDS)


def _best_feature(spark, d, split: str) -> float:
    """The exact AUC of the best single column."""
    t = roles.learnable(spark, d).filter(F.col("split") == split)
    values = t.select("label", *[F.coalesce(F.col(c).cast("double"), F.lit(-10000.0)).alias(c) for c in FEATURES])
    long = values.unpivot(["label"], list(FEATURES), "feature", "value")
    found = evaluate.auc(long, label="label", score="value", by=["feature"])
    return found.agg(F.round(F.max(F.greatest(F.col("auc"), 1 - F.col("auc"))), 9)).first()[0]


_trained: dict[tuple[str, str], list] = {}


def _fold_models(spark, d):
    """The folds and their models, trained once for a table in a session: several queries use them."""
    key, folded = (spark.sparkContext.applicationId, d), _folded(spark, d)
    if key not in _trained:
        _trained.clear()
        _trained[key] = modeling.cross_validate(folded, label="label", k=FOLDS, params=TREES, patience=PATIENCE)
    return folded, _trained[key]


def _auc_of(scored) -> float:
    return evaluate.auc(scored, label="label", score="score").first()["auc"]


def _inside():
    return ((F.col("score") > 0) & (F.col("score") < 1)).alias("in_range")


@named(
    "asm_vector",
    f"WITH {roles.TRANSACTIONS} SELECT txn_id, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), -10000) AS f_{c}" for c in FEATURES)
    + " FROM txn",
)
def asm_vector(spark, d):
    entries = vector_to_array("features")
    rows = modeling.feature_vector(roles.transactions(spark, d), FEATURES, keep=["txn_id"])
    return rows.select("txn_id", *[entries[i].alias(f"f_{c}") for i, c in enumerate(FEATURES)])


@named(
    "ml_train_gbt",
    f"""WITH {roles.LEARNABLE}, {_best_sql('test')}
  SELECT txn_id, label, TRUE AS in_range, best_feature_auc, TRUE AS model_above FROM txn, best WHERE split = 'test'""",
)
def ml_train_gbt(spark, d):
    """One model, stopped on the last fold of the training months: every test row scored once, and the
    model's AUC against that of the best column."""
    folded = _folded(spark, d)
    flagged = stage(folded.withColumn("valid", F.col("fold") == FOLDS - 1)).df
    model = modeling.train_gbt(flagged, label="label", valid_flag="valid", params=TREES, patience=PATIENCE)
    test = _matrix(spark, d).filter(F.col("split") == "test")
    scored = stage(modeling.score_rows(model, test, keep=["txn_id", "label"])).df
    best = _best_feature(spark, d, "test")
    above = F.lit(_auc_of(scored) > best + SINGLE_AUC)
    return scored.select("txn_id", "label", _inside(), F.lit(best).alias("best_feature_auc"), above.alias("model_above"))


@named(
    "ml_oof_predict",
    f"""WITH RECURSIVE {_folds_sql(roles.LEARNABLE)}, {_best_sql('train')}
  SELECT txn_id, label, fold, TRUE AS in_range, best_feature_auc, TRUE AS model_above FROM best, txn
  JOIN a ON txn.DT_M = a.DT_M WHERE split = 'train'""",
)
def ml_oof_predict(spark, d):
    """Every training row scored once, by the model of the fold it is in; each fold's AUC is above that of the best column."""
    folded, models = _fold_models(spark, d)
    scored = stage(modeling.out_of_fold(models, folded, keep=["txn_id", "label"])).df
    best = _best_feature(spark, d, "train")
    above = F.lit(_auc_of(scored) > best + SINGLE_AUC)
    return scored.select("txn_id", "label", "fold", _inside(), F.lit(best).alias("best_feature_auc"), above.alias("model_above"))


@named("ml_oof_scores")
def ml_oof_scores(spark, d):
    """The scores themselves."""
    folded, models = _fold_models(spark, d)
    return modeling.out_of_fold(models, folded, keep=["txn_id", "label"])


@named("ml_fold_auc")
def ml_fold_auc(spark, d):
    """AUC of each fold beside its model's number of trees."""
    folded, models = _fold_models(spark, d)
    scored = modeling.out_of_fold(models, folded, keep=["label"])
    trees = spark.createDataFrame([(f, m.getNumTrees) for f, m in enumerate(models)], "fold int, trees int")
    return evaluate.auc_by_fold(scored, label="label", score="score").join(F.broadcast(trees), "fold")


@named(
    "ml_bagged_predict",
    f"""WITH {roles.LEARNABLE}, {_best_sql('test')}
  SELECT txn_id, label, TRUE AS is_mean, best_feature_auc, TRUE AS model_above FROM txn, best WHERE split = 'test'""",
)
def ml_bagged_predict(spark, d):
    """Test rows scored by all fold models in one pass; the bagged score is the mean of the folds'."""
    _, models = _fold_models(spark, d)
    test = _matrix(spark, d).filter(F.col("split") == "test")
    bagged = stage(modeling.bagged_scores(models, test, keep=["txn_id", "label"])).df
    each = modeling.fold_scores(models, test, keep=["txn_id"])
    mean = evaluate.bagged_mean(each, key="txn_id", score="score").withColumnRenamed("score", "mean")
    best = _best_feature(spark, d, "test")
    above = F.lit(_auc_of(bagged) > best + SINGLE_AUC)
    same = (F.abs(F.col("score") - F.col("mean")) < 1e-9).alias("is_mean")
    return bagged.join(mean, "txn_id").select("txn_id", "label", same, F.lit(best).alias("best_feature_auc"), above.alias("model_above"))


@named(
    "ml_importance",
    "SELECT fold, feature, TRUE AS in_range, TRUE AS sums_to_one, feature IN ('amount', 'D1') AS matters FROM range(5) t(fold), "
    f"(SELECT unnest({list(ENTRIES)}) AS feature)",
)
def ml_importance(spark, d):
    """A share for each fold and feature; those of a fold add up to 1.  Over the folds the two columns
    that the label comes from matter most."""
    _, models = _fold_models(spark, d)
    table = modeling.importance_table(_matrix(spark, d), models, ENTRIES)
    sums = table.groupBy("fold").agg(F.sum("importance").alias("total"))
    first = [row["feature"] for row in evaluate.top_features(evaluate.mean_importance(table), 2).collect()]
    return table.join(sums, "fold").select(
        F.col("fold").cast("bigint").alias("fold"),
        "feature",
        F.col("importance").between(0, 1).alias("in_range"),
        (F.abs(F.col("total") - 1) < 1e-6).alias("sums_to_one"),
        F.col("feature").isin(first).alias("matters"),
    )


@named("ml_importance_values")
def ml_importance_values(spark, d):
    """Mean importance of each feature over the folds."""
    _, models = _fold_models(spark, d)
    return evaluate.mean_importance(modeling.importance_table(_matrix(spark, d), models, ENTRIES))


@named(
    "ml_drop_worst",
    f"""WITH {roles.LEARNABLE}, {_best_sql('train')} SELECT t.*, best_feature_auc, TRUE AS model_above, TRUE AS keeps_what_matters
  FROM best, (VALUES (0, 6, 0), (1, 4, 2), (2, 2, 2)) t(round, n_features, n_dropped)""",
)
def ml_drop_worst(spark, d):
    """All features, then twice without the two least important ones: the two that the label comes from are left."""
    train = roles.learnable(spark, d).filter(F.col("split") == "train")
    folded = evaluate.group_folds(train.select("label", *FEATURES), "DT_M", k=FOLDS)
    few = {**TREES, "maxIter": 80}
    found = stage(modeling.drop_worst(folded, FEATURES, label="label", drop=2, rounds=2, k=FOLDS, params=few, patience=PATIENCE)).df
    best = _best_feature(spark, d, "train")
    return found.select(
        "round",
        "n_features",
        F.size("dropped").alias("n_dropped"),
        F.lit(best).alias("best_feature_auc"),
        (F.col("auc") > best + SINGLE_AUC).alias("model_above"),
        (~F.arrays_overlap("dropped", F.array(F.lit("amount"), F.lit("D1")))).alias("keeps_what_matters"),
    )


# The trials that the seed draws, written out.
@named(
    "ml_param_search",
    f"""WITH {roles.LEARNABLE}, s AS (SELECT * FROM (VALUES
  (0, 3, 0.510004::DOUBLE, 0.118757::DOUBLE),
  (1, 2, 0.794588::DOUBLE, 0.219175::DOUBLE),
  (2, 4, 0.534776::DOUBLE, 0.15548::DOUBLE),
  (3, 2, 0.587455::DOUBLE, 0.176339::DOUBLE),
  (4, 2, 0.579535::DOUBLE, 0.212471::DOUBLE),
  (5, 3, 0.588176::DOUBLE, 0.197316::DOUBLE),
  (6, 4, 0.5026::DOUBLE, 0.251455::DOUBLE),
  (7, 4, 0.6361::DOUBLE, 0.08887::DOUBLE),
  (8, 4, 0.634638::DOUBLE, 0.073186::DOUBLE),
  (9, 2, 0.838998::DOUBLE, 0.200932::DOUBLE)) t(trial, maxDepth, subsamplingRate, stepSize)), {_best_sql('train')}
  SELECT s.*, best_feature_auc, TRUE AS winner_above FROM s, best""",
)
def ml_param_search(spark, d):
    """Ten trials by halving, on the last training fold."""
    folded = _folded(spark, d).withColumn("valid", F.col("fold") == FOLDS - 1)
    found = modeling.param_search(
        folded,
        label="label",
        valid_flag="valid",
        bounds={"maxDepth": (2, 5), "subsamplingRate": (0.5, 0.9), "stepSize": (0.05, 0.3)},
        integers=["maxDepth"],
        init_points=3,
        n_iter=7,
        budgets=(5, 20, 80),
    )
    found = stage(found).df
    best = _best_feature(spark, d, "train")
    above = found.agg(F.max("auc")).first()[0] > best + SINGLE_AUC
    rounded = {"subsamplingRate": r("subsamplingRate"), "stepSize": r("stepSize"), "maxDepth": F.col("maxDepth").cast("int")}
    columns = [c for c in found.columns if c not in ("auc", "trees")]
    return found.withColumns(rounded).select(*columns, F.lit(best).alias("best_feature_auc"), F.lit(above).alias("winner_above"))
