import random
from collections import Counter, defaultdict

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators.keyed import (
    attach,
    attach_all,
    fits_broadcast,
    grouped,
    lookup,
    measure,
    passes,
    running_total,
    stage,
)


@pytest.fixture
def facts(spark):
    """A third of all rows on one key, some without a key, some with a key of their own."""
    rng = random.Random(7)
    keys = ["hot"] * 200 + [None] * 100 + [f"k{rng.randrange(60)}" for _ in range(300)]
    rows = [(i, k, float(rng.randrange(50))) for i, k in enumerate(keys)]
    return rows, spark.createDataFrame(rows, "id long, k string, x double").repartition(6)


def expected(rows, null_safe):
    n = Counter(k for _, k, _ in rows)
    if not null_safe:
        del n[None]
    return [(i, n.get(k)) for i, k, _ in rows]


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("weight", ["n", None])
@pytest.mark.parametrize("id_col", ["id", None])
@pytest.mark.parametrize("limit", [None, 0])
def test_attach_agrees_however_it_joins(facts, setting, null_safe, weight, id_col, limit):
    rows, df = facts
    if limit is not None:
        setting("spark.ledgerloom.broadcastBytes", limit)
    table = grouped(df, [["k"]], [], keep_nulls=True)[("k",)]
    ready = table.select("k", "n", F.col("n").alias("found"))
    out = attach(df, ready, ["k"], ["found"], null_safe=null_safe, weight=weight, id_col=id_col)
    assert out.columns == ["id", "k", "x", "found"]
    assert rows_of(out.select("id", "found")) == sorted(expected(rows, null_safe))


def test_hot_keys_leave_the_shuffled_key(facts, no_broadcast, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    _, df = facts
    table = grouped(df, [["k"]], [F.avg("x").alias("m")])[("k",)]
    out = attach(df, table, ["k"], ["m"], weight="n")
    plan = plan_of(out)
    assert "SortMergeJoin" in plan and "__slot" in plan and "CartesianProduct" not in plan
    marked = plan.split("SortMergeJoin")[1].splitlines()[0]
    assert "__slot#" in marked and "__slot_key#" in marked  # the slot is part of the join key


def test_hot_and_missing_keys_are_spread(spark, no_broadcast, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    setting("spark.sql.adaptive.enabled", "false")
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 3 == 2, F.concat(F.lit("k"), i % 5000))
    df = stage(spark.range(0, 30_000, 1, 40).select("id", key.alias("k"))).df.repartition(40, "id")
    table = grouped(df, [["k"]], [F.max("id").alias("top")])[("k",)]

    def largest(joined):
        return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    ours = attach(df, table, ["k"], ["top"], weight="n")
    plain = df.join(table.df.select("k", "top"), "k", "left")
    assert ours.count() == 30_000 and ours.filter("k is not null and top is null").isEmpty()
    assert largest(plain) > 10_000 and largest(ours) < 8_000  # of 30,000 rows in 8 partitions


def test_a_small_table_leaves_the_facts_where_they_are(facts):
    _, df = facts
    table = grouped(df, [["k"]], [F.avg("x").alias("m")])[("k",)]
    assert fits_broadcast(table)
    plan = plan_of(attach(df.select("id", "k"), table, ["k"], ["m"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_wide_rows_move_once_for_many_large_tables(facts, no_broadcast, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    _, df = facts
    keys = [f"k{i}" for i in range(6)]
    wide = stage(df.withColumns({k: F.concat("k", F.col("id") % (i + 3)) for i, k in enumerate(keys)})).df
    tables = grouped(wide, [[k] for k in keys], [])
    lookups = [lookup(tables[(k,)].select(k, F.col("n").alias(f"n_{k}")), [k], [f"n_{k}"], weight=f"n_{k}") for k in keys]
    out = attach_all(wide, lookups, id_col="id")
    plan = plan_of(out)
    assert plan.count("SortMergeJoin") == 2 * len(keys)  # one by key, one by id, for each table
    wide_exchanges = [p for p in plan.split("Exchange hashpartitioning(id")[1:] if "x#" in p.split("Exchange")[0]]
    assert len(wide_exchanges) == 1
    other = attach_all(wide, lookups)
    assert rows_of(out) == rows_of(other)


def test_broadcasts_of_one_call_are_bounded_together(facts, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    _, df = facts
    tables = grouped(df, [["k"], ["x"], ["id"]], [])
    lookups = [lookup(t.select(*k, F.col("n").alias(f"n_{k[0]}")), k, [f"n_{k[0]}"], null_safe=True, weight=f"n_{k[0]}") for k, t in tables.items()]
    free = attach_all(df, lookups)
    assert "SortMergeJoin" not in plan_of(free)
    by_size = sorted(t.bytes for t in tables.values())
    setting("spark.ledgerloom.broadcastTotalBytes", by_size[0] + by_size[1])
    bounded = attach_all(df, lookups)
    assert plan_of(bounded).count("SortMergeJoin") == 1
    assert rows_of(free) == rows_of(bounded)


def test_attach_refuses_a_column_it_would_overwrite(facts):
    _, df = facts
    table = grouped(df, [["k"]], [F.avg("x").alias("x")])[("k",)]
    with pytest.raises(ValueError, match="already present"):
        attach(df, table, ["k"], ["x"])


@pytest.mark.parametrize("keep_nulls", [True, False])
def test_grouped_sets_equal_separate_aggregates(spark, facts, keep_nulls):
    _, df = facts
    wide = df.withColumn("j", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    sets = [["k"], ["j"], ["k", "j"]]
    found = grouped(wide, sets, [F.sum("x").alias("s")], keep_nulls=keep_nulls)
    for keys in sets:
        want = wide.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("x").alias("s"))
        want = want if keep_nulls else want.dropna(subset=keys)
        got = found[tuple(keys)]
        assert got.df.exceptAll(want).isEmpty() and want.exceptAll(got.df).isEmpty()
        assert got.rows == want.count() and got.bytes > 0


def test_many_keys_take_several_passes(spark):
    names = [f"c{i}" for i in range(23)]
    df = spark.range(50).select(*[(F.col("id") % (i + 2)).alias(c) for i, c in enumerate(names)])
    assert [len(p) for p in passes([[c] for c in names])] == [7, 8, 8]
    found = grouped(df, [[c] for c in names], [])
    assert {k: v.rows for k, v in found.items()} == {(c,): min(50, i + 2) for i, c in enumerate(names)}
    assert all(v.df.agg(F.sum("n")).first()[0] == 50 for v in found.values())


def test_grouped_sets_share_one_stored_table(facts):
    _, df = facts
    found = grouped(df, [["k"], ["id"], ["k", "id"]], [])
    files = [set(s.df.inputFiles()) for s in found.values()]
    assert len({f.split("/__set=")[0] for fs in files for f in fs}) == 1
    plan = plan_of(found[("k",)].df)
    assert "PartitionFilters: [isnotnull(__set" in plan  # only the set's own files are read


@pytest.mark.parametrize("per_task", [1_000_000, 37])
def test_running_total(spark, setting, per_task):
    setting("spark.ledgerloom.rowsPerTask", per_task)
    rng = random.Random(3)
    rows = [(g, i, rng.randrange(9)) for g in ("a", "b", None) for i in range(150)]
    table = stage(spark.createDataFrame(rows, "g string, i int, v long").repartition(5))
    got = rows_of(running_total(table, ["g"], ["i"], "v", "upto").select("g", "i", "upto"), "g", "i")
    sums, want = defaultdict(int), []
    for g, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        sums[g] += v
        want.append((g, i, sums[g]))
    assert got == want


def test_measure_counts_text(spark):
    table = measure(spark.createDataFrame([("abc",), ("é",), (None,)], "t string"))
    assert table.rows == 3 and table.bytes == 3 * 24 + 3 + 2


def test_staged_types_and_nulls_survive(spark):
    df = spark.createDataFrame([(1, None, 2.5), (None, "x", None)], "a int, b string, c double")
    assert sorted(stage(df).df.collect(), key=str) == sorted(df.collect(), key=str)
    empty = stage(df.limit(0))
    assert empty.rows == 0 and empty.df.count() == 0


def test_shared_folder_is_never_a_machine_s_own_on_a_cluster(spark, tmp_path):
    class Conf:
        def get(self, name):
            return None

    class Context:
        master, applicationId, folder = "yarn", "app", None

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.folder

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(Session())
    Session.sparkContext.folder = "hdfs://shared"
    assert session.stage_path(Session()).startswith("hdfs://shared/ledgerloom/app/")
    assert session.stage_path(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_ids_that_repeat_or_are_missing_change_nothing(spark, no_broadcast, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", -1)
    df = stage(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "b")], "id int, k string")).df
    table = grouped(df, [["k"]], [])[("k",)].select("k", F.col("n").alias("m"))
    out = attach_all(df, [lookup(table, ["k"], ["m"])], id_col="id")
    assert rows_of(out) == rows_of(attach_all(df, [lookup(table, ["k"], ["m"])]))
    assert [r["m"] for r in out.collect()] == [2, 2, 2, 2]


def test_results_outlive_what_was_staged(spark):
    path = session.output_path(spark)
    with session.staging(spark):
        table = stage(spark.range(3)).df
        table.write.parquet(path)
    with pytest.raises(Exception):
        table.collect()
    assert spark.read.parquet(path).count() == 3
