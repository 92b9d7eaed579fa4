import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, taken string"


def water(sizes, weights, total, most):
    """Excess dealt out again and again, by hand."""
    caps, out = [most * s for s in sizes], [0.0] * len(sizes)
    free, left = set(range(len(sizes))), total
    while free:
        w = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / w > caps[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = caps[i]
            free.discard(i)
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
    return out


@pytest.fixture
def documents(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), ["a", "b", "c", "d", None][i % 5 if i < 200 else 0], "x") for i in range(600)]
    rows += [(None, "n n n", "a", "x"), (None, "n n n", "a", "x"), (900, None, "b", "x"), (901, "", None, "x"), (902, None, "empty", "x"), (903, "long " * 20_000, "c", "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_and_budgets(documents):
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count()
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    order = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(order))]
    for s, size, target in zip(order, sizes, water(sizes, weights, 1.5 * sum(sizes), 2.0)):
        assert {r["source_size"] for r in by[s]} == {size}
        assert all(abs(r["target"] - target) < 1e-6 * max(1, target) for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - target) <= 3  # equal rows round down


def test_reruns_and_partitions_agree(documents, setting):
    one = sorted(map(str, mixing.mix(documents).collect()))
    setting("spark.sql.shuffle.partitions", 3)
    assert sorted(map(str, mixing.mix(documents.repartition(7)).collect())) == one


def test_documents_of_the_mix(documents):
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    taken = {(r["doc_id"], r["text"]): r["taken"] for r in mixing.mix(documents.filter("doc_id is not null")).collect()}
    got = {}
    for r in mixing.mixed_documents(documents.filter("doc_id is not null")).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    assert got == {k[0]: v for k, v in taken.items() if v}
    assert {r["taken"] for r in mixed.select("taken").distinct().collect()} == {"x"}


def test_empty(documents):
    assert mixing.mix(documents.filter("false")).count() == 0
    nothing = documents.withColumn("text", F.lit(None).cast("string"))
    assert {r["taken"] for r in mixing.mix(nothing).collect()} == {0}
