"""Many columns in one pass."""

import math

import numpy as np
import pytest

from ledgerloom.operators import wide


@pytest.mark.parametrize("parts", [1, 5])
def test_states_of_many_columns(spark, parts):
    rng = np.random.default_rng(3)
    p, rows = 430, 300
    x = rng.normal(size=(rows, p)) + 1e6
    x[:, 7] = 0.1
    y = rng.integers(0, 2, rows).astype(float)
    missing = rng.random((rows, p)) < 0.2
    missing[:, 9] = True
    data = [[None if m else float(v) for v, m in zip(r, k, strict=True)] + [float(t) if i % 13 else None] for i, (r, k, t) in enumerate(zip(x, missing, y, strict=True))]
    data[0][3] = math.nan
    cols = [f"c{i}" for i in range(p)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in [*cols, "y"])).repartition(parts)
    got = {r["column"]: r for r in wide.wide_profile(df, cols, "y").collect()}
    assert len(got) == p and got["c9"]["nulls"] == rows
    assert got["c9"]["low"] is None and got["c9"]["mean"] is None and got["c9"]["corr"] is None and got["c7"]["corr"] is None
    for i, c in enumerate(cols):
        if i in (7, 9):
            continue
        own = [(r[i], r[p]) for r in data if r[i] is not None and not math.isnan(r[i])]
        pairs = np.array([t for t in own if t[1] is not None])
        assert (got[c]["rows"], got[c]["nulls"]) == (rows, sum(r[i] is None for r in data))
        assert got[c]["low"] == min(v for v, _ in own) and got[c]["high"] == max(v for v, _ in own)
        assert got[c]["mean"] == pytest.approx(np.mean([v for v, _ in own]), rel=1e-12)
        assert got[c]["corr"] == pytest.approx(np.corrcoef(pairs.T)[0, 1], abs=1e-8)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "a double, y double")
    assert wide.wide_profile(empty, ["a"], "y").count() == 0
    with pytest.raises(ValueError):
        wide.wide_profile(empty, [], "y")
    one = spark.createDataFrame([(1, None)], "a int, y double")
    assert wide.wide_profile(one, ["a"], "y").first().asDict() == {
        "column": "a", "rows": 1, "nulls": 0, "null_ratio": 0.0, "low": 1.0, "high": 1.0, "mean": 1.0, "corr": None,
    }
