import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, row string, norm string"


def valid(rows):
    ok = [(i, np.array(v, "f4").astype("f8")) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v))]
    wide = max(len(v) for _, v in ok)
    return [(i, np.pad(v, (0, wide - len(v)))) for i, v in ok]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 24))
    rows = [(i, (centres[i % 8] + rng.normal(size=24) * rng.uniform(0.2, 1.5)).tolist()) for i in range(3000)]
    rows += [(5000 + i, rows[3][1]) for i in range(300)]  # a hot vector
    rows += [(9000, None), (9020, [0.0] * 24), (9040, [float("nan")] * 24), (9060, [1.0, None]), (9080, [1.0, 2.0]), (None, [0.1] * 24), (20, rows[20][1])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(6)
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    ok = valid(rows)
    x = np.stack([v for _, v in ok])
    place = {}
    for n, (i, _) in enumerate(ok):
        place.setdefault(i, n)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    hits = total = 0
    for n, (i, q) in enumerate(ok):
        if i is None or i % 20 or i == 20:
            continue
        score = x @ q
        score[n] = -np.inf
        best = np.sort(score)[::-1][:20]
        own = sorted(by[i], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        for r in own:
            assert abs(r["score"] - x[place[r["vec_id"]]] @ q) < 1e-9 * max(1, abs(r["score"]))
        order = [(-r["score"], r["vec_id"] is None, r["vec_id"] or 0) for r in own]
        assert order == sorted(order)
        hits += sum(r["score"] >= best[-1] - 1e-9 for r in own)
        total += 20
    assert hits / total >= 0.94
    assert {9000, 9020, 9040, 9060}.isdisjoint(by)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "", ""), (1, [2.0, 1.0], "", ""), (2, [1.0, 1.0], "", "")], SCHEMA)
    got = [tuple(r) for r in ann.nearest(df, F.col("vec_id") == 0, recall=1.0).collect()]
    assert {g[2] for g in got} <= {1, 2} and all(g[0] == 0 for g in got)
    assert ann.nearest(df.filter("false"), F.col("vec_id") == 0).count() == 0


def test_probe_order():
    """The visited buckets are the perturbations by their cost, the own bucket first."""
    index = ann._Index(8, 1.0, 0.7)
    cells = index.cells(np.random.default_rng(1).normal(size=(5, 8)), 0, True)
    buckets, order = index.probes(cells, 40)
    assert (buckets[:, 0] == index.bucket(cells)).all()
    cost = np.take_along_axis(index.costs(cells), order, 1)
    assert (np.diff(cost, axis=1) >= 0).all()
    step = ann._STEPS[order[2, 7]]
    assert buckets[2, 7] == index.bucket(np.floor(cells[2]) + step)
