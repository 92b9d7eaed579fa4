import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, row string, score string"


def brute(rows, k, step):
    ok = [(i, np.floor(256 * np.array(v, "f4").astype("f8")).astype(int)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    wide = max((len(v) for _, v in ok), default=0)
    ok = [(i, np.pad(v, (0, wide - len(v)))) for i, v in ok]
    out = []
    for a, (q, x) in enumerate(ok):
        if q is not None and q % step == 0:
            best = sorted(((-int(x @ y), i is None, i or 0) for b, (i, y) in enumerate(ok) if a != b))[:k]
            out += [(q, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [1, 5])
def test_against_brute_force(spark, k, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).round(1).tolist()) for i in range(300)]
    rows += [(i, rows[i % 7][1]) for i in range(300, 420)]  # ties
    rows += [(500, None), (501, [float("nan")] * 16), (502, [1.0, None]), (503, [float("inf")]), (504, [2.0, 1.0]), (None, [0.5] * 16), (505, []), (510, rows[0][1]), (510, rows[0][1])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 20)
    got = sorted(map(tuple, topk.topk(df, F.col("vec_id") % 10 == 0, k=k).collect()), key=str)
    assert got == brute(rows, k, 10)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], "", ""), (1, [2.0], "", "")], SCHEMA)
    assert [tuple(r) for r in topk.topk(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 131072)]
    assert topk.topk(df.filter("false"), F.col("vec_id") == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 24)), rng.normal(size=(60, 24))
    for s in (1, 3, 5, 24):
        assert (topk.segment_features(x, s) @ topk.segment_features(y, s).T >= x @ y.T - 1e-9).all()
