"""Keyed tables: how they are stored, measured and joined back.

Almost every operator in the library has two halves: aggregate something per key, then give
each row the aggregate of its key.  The aggregate half is cheap to distribute (partial
aggregation shrinks a hot key to one row per map task).  The join half is where skew hurts, so it
lives here once:

* the table is written to the shared folder and measured while it is written;
* a table under the broadcast limit is broadcast: the fact side is not shuffled at all;
* a larger table is joined in two steps.  The keys with more rows than a reducer gets on average
  (there are at most as many as reducers) are broadcast; rows with such a key, or with a null key that matches nothing, are spread over
  all reducers, and only the remaining rows meet the remaining keys in a shuffled join.  No
  key is dropped and none is left to a single task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import setting, stage_path


@dataclass(frozen=True)
class Sized:
    """A DataFrame with a measured row count and in-memory width (both upper estimates)."""

    df: DataFrame
    rows: int
    bytes: int

    def select(self, *cols) -> "Sized":
        return Sized(self.df.select(*cols), self.rows, self.bytes)


def row_width(schema: T.StructType) -> str:
    """Approximate bytes of one row in a hash table, as an expression."""
    text = [
        f"coalesce(octet_length(`{f.name}`), 0)"
        for f in schema
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    return " + ".join([f"{16 + 8 * len(schema)}L", *text])


def _metrics(df: DataFrame) -> list[Column]:
    return [F.expr("count(1) as rows"), F.expr(f"sum({row_width(df.schema)}) as bytes")]


def measure(df: DataFrame) -> Sized:
    """Size of a table that is already stored: one aggregate over the columns it keeps."""
    got = df.agg(*_metrics(df)).first()
    return Sized(df, int(got["rows"]), int(got["bytes"] or 0))


def stage(df: DataFrame, partition_by: Sequence[str] = ()) -> Sized:
    """Write ``df`` to the shared folder and read it back, measured by the write itself."""
    spark = df.sparkSession
    path = stage_path(spark)
    seen = Observation()
    df.observe(seen, *_metrics(df)).write.partitionBy(*partition_by).parquet(path)
    got = seen.get
    back = spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    return Sized(back, int(got.get("rows") or 0), int(got.get("bytes") or 0))


def fits_broadcast(table: Sized) -> bool:
    return table.bytes <= setting(table.df.sparkSession, "broadcastBytes")


def _same(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    op = "<=>" if null_safe else "="
    return F.expr(" and ".join(f"`{a}` {op} `{b}`" for a, b in pairs))


@dataclass(frozen=True)
class Lookup:
    """A one-row-per-key table to join.

    ``on`` maps columns of the facts to key columns of the table.  ``weight`` is a column of the
    table with the number of rows per key; without it the heavy keys are counted in the facts.
    """

    table: Sized
    on: Mapping[str, str]
    values: Sequence[str]
    null_safe: bool = False
    weight: str | None = None

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return [(left, f"__key{i}") for i, left in enumerate(self.on)]

    @property
    def key_names(self) -> list[str]:
        return [k for _, k in self.pairs]

    @property
    def keys(self) -> list[str]:
        return [f"`{c}` as __key{i}" for i, c in enumerate(self.on.values())]


def lookup(
    table: Sized,
    on: Sequence[str] | Mapping[str, str],
    values: Sequence[str] | None = None,
    *,
    null_safe: bool = False,
    weight: str | None = None,
) -> Lookup:
    on = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    if values is None:
        values = [c for c in table.df.columns if c not in on.values() and c != weight]
    return Lookup(table, on, list(values), null_safe, weight)


def _broadcast_together(lookups: Sequence[Lookup]) -> set[int]:
    """Positions of the tables to broadcast: the smallest ones, while their sum stays in bounds."""
    chosen: set[int] = set()
    if lookups:
        left = setting(lookups[0].table.df.sparkSession, "broadcastTotalBytes")
        for i in sorted(range(len(lookups)), key=lambda i: lookups[i].table.bytes):
            left -= lookups[i].table.bytes
            if left < 0 or not fits_broadcast(lookups[i].table):
                break
            chosen.add(i)
    return chosen


def attach(
    df: DataFrame,
    table: Sized,
    on: Sequence[str] | Mapping[str, str],
    values: Sequence[str] | None = None,
    *,
    null_safe: bool = False,
    weight: str | None = None,
    id_col: str | None = None,
) -> DataFrame:
    """Left join one keyed table, safe against hot keys and null keys (see ``attach_all``)."""
    return attach_all(df, [lookup(table, on, values, null_safe=null_safe, weight=weight)], id_col=id_col)


def attach_all(df: DataFrame, lookups: Sequence[Lookup], *, id_col: str | None = None) -> DataFrame:
    """Left join any number of keyed tables.

    With ``id_col`` the tables too large to broadcast are joined to the id and the keys alone, each
    on its own, and the results meet the wide rows by id, so that those are exchanged once and not
    once per key.  That needs ids that are neither missing nor repeated, which is counted first;
    otherwise the ids are not used.
    """
    taken = set(df.columns)
    for item in lookups:
        clash = taken & set(item.values)
        if clash:
            raise ValueError(f"columns already present: {sorted(clash)}")
        taken |= set(item.values)
    small = _broadcast_together(lookups)
    large = [item for i, item in enumerate(lookups) if i not in small]
    out, slim = df, None
    if large and id_col is not None:
        keys = list(dict.fromkeys(c for item in large for c in item.on if c != id_col))
        slim = stage(df.select(id_col, *keys))
        ids = slim.df.agg(F.countDistinct(id_col)).first()[0]
        slim = slim.df if ids == slim.rows else None
    if slim is not None:
        for item in large:
            found = _split_join(slim.select(id_col, *[c for c in item.on if c != id_col]), item)
            out = out.join(found.select(id_col, *item.values), id_col, "left")
    else:
        for item in large:
            out = _split_join(out, item)
    for i, item in enumerate(lookups):
        if i in small:
            right = item.table.df.selectExpr(*item.keys, *[f"`{v}`" for v in item.values])
            out = out.join(F.broadcast(right), _same(item.pairs, item.null_safe), "left").drop(*item.key_names)
    return out.select(*df.columns, *[v for item in lookups for v in item.values])


def _split_join(df: DataFrame, item: Lookup) -> DataFrame:
    """Broadcast the keys with more than a reducer's share of the rows, shuffle the rest; rows of
    the former are spread evenly."""
    table, on, values, null_safe, weight = item.table, item.on, item.values, item.null_safe, item.weight
    pairs, keys, key_names = item.pairs, item.keys, item.key_names
    reducers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = [f"`{v}` as __hot{i}" for i, v in enumerate(values)]
    held_names = [f"__hot{i}" for i in range(len(values))]
    if weight is not None:
        total = table.df.agg(F.sum(weight)).first()[0] or 0
        heaviest = table.df.filter(F.col(weight) * reducers > total)
        hot = heaviest.selectExpr(*keys, *held, "true as __is_hot")
    else:
        counts = stage(df.groupBy(*[F.col(f"`{left}`").alias(k) for left, k in pairs]).count()).df
        total = counts.agg(F.sum("count")).first()[0] or 0
        heavy = stage(counts.filter(F.col("count") * reducers > total).drop("count")).df
        right = table.df.selectExpr(*[f"`{c}` as __t{i}" for i, c in enumerate(on.values())], *held)
        test = _same([(k, f"__t{i}") for i, k in enumerate(key_names)], null_safe)
        known = right.join(F.broadcast(heavy), test, "inner").select(*key_names, *held_names)
        listed = heavy.selectExpr(*[f"{k} as __h{i}" for i, k in enumerate(key_names)])
        test = _same([(f"__h{i}", k) for i, k in enumerate(key_names)], True)
        hot = listed.join(F.broadcast(known), test, "left").selectExpr(
            *[f"__h{i} as {k}" for i, k in enumerate(key_names)], *held_names, "true as __is_hot"
        )

    # Fewer rows than there are reducers, whatever the size of the data.
    marked = df.join(F.broadcast(hot), _same(pairs, null_safe), "left").drop(*key_names)
    spread = ["__is_hot is not null"]
    if not null_safe:
        spread += [f"`{left}` is null" for left, _ in pairs]
    # The slot is the map task's number: the same when a lost task is run again, unlike rand().
    slot = f"if({' or '.join(spread)}, spark_partition_id() + 1, 0)"
    marked = marked.withColumn("__slot", F.expr(slot))
    # Always 0, but not a literal: a literal would be folded and the slot would leave the join key.
    always = f"pmod(hash({', '.join(key_names)}), 1) as __slot_key"
    cold = table.df.selectExpr(*keys, *[f"`{v}` as __cold{i}" for i, v in enumerate(values)])
    cold = cold.selectExpr("*", always)
    joined = marked.join(cold, _same([*pairs, ("__slot", "__slot_key")], null_safe), "left")
    out = [f"coalesce(__hot{i}, __cold{i}) as `{v}`" for i, v in enumerate(values)]
    return joined.selectExpr(*[f"`{c}`" for c in df.columns], *out)


def running_total(
    table: Sized, groups: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Add the running sum of ``value`` in ``order`` inside each group.

    Up to one task's worth of rows this is a plain window.  Above, the rows are range
    partitioned (so that no group is tied to one task), summed per slice, and each slice starts
    from the total of the slices before it.
    """
    spark = table.df.sparkSession
    tasks = math.ceil(table.rows / setting(spark, "rowsPerTask"))
    upto_here = (Window.unboundedPreceding, Window.currentRow)
    if tasks <= 1:
        w = Window.partitionBy(*groups).orderBy(*order).rowsBetween(*upto_here)
        return table.df.withColumn(out, F.sum(value).over(w))
    ranged = table.df.repartitionByRange(tasks, *groups, *order)
    sliced = stage(ranged.withColumn("__slice", F.spark_partition_id()))
    sums = sliced.df.groupBy(*groups, "__slice").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(
        sums.withColumn("__base", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    )
    w = Window.partitionBy(*groups, "__slice").orderBy(*order).rowsBetween(*upto_here)
    inside = sliced.df.withColumn("__run", F.sum(value).over(w))
    full = attach(inside, base, [*groups, "__slice"], null_safe=True)
    return full.withColumn(out, F.col("__base") + F.col("__run")).drop("__base", "__run", "__slice")


# Grouping sets share a scan but also each other's (empty) columns, so their cost grows with the
# square of their number; and a grouping id has 63 bits.
_SETS_PER_PASS = 10


def passes(key_sets: Sequence[Sequence[str]]) -> list[list[tuple[str, ...]]]:
    """The distinct key sets, dealt out evenly to passes over the facts."""
    sets = list(dict.fromkeys(tuple(s) for s in key_sets))
    count = math.ceil(len(sets) / _SETS_PER_PASS)
    return [sets[i * len(sets) // count : (i + 1) * len(sets) // count] for i in range(count)]


def combine_sets(
    df: DataFrame, key_sets: Sequence[Sequence[str]], aggs: Sequence[Column], *, keep_nulls: bool = False
) -> tuple[DataFrame, dict[tuple[str, ...], int]]:
    """Aggregates for several key sets in one table, the set numbered in ``__set``.

    The sets are grouping sets of one aggregate, so the facts are read once and rows are combined
    before they are moved.  Without ``keep_nulls`` keys with a null member are left out.
    """
    sets = list(dict.fromkeys(tuple(s) for s in key_sets))
    cols = list(dict.fromkeys(c for s in sets for c in s))
    # grouping_id has one bit per column, set where the column is not part of the set.
    ids = {s: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets}
    number = F.grouping_id().alias("__set")
    table = df.groupingSets([list(s) for s in sets], *cols).agg(number, *aggs)
    if not keep_nulls:
        whole = [" and ".join([f"__set = {ids[s]}", *[f"`{c}` is not null" for c in s]]) for s in sets]
        table = table.filter(" or ".join(f"({w})" for w in whole))
    return table, ids


def stage_sets(
    table: DataFrame,
    ids: Mapping[tuple[str, ...], int],
    values: Sequence[str],
    keys: Callable[[tuple[str, ...]], Sequence[str]] = tuple,
) -> dict[tuple[str, ...], Sized]:
    """Store the table of several key sets once and hand out one sized table per set.

    ``keys`` gives the columns that identify a row of a set, when they are not all its members.
    """
    spark = table.sparkSession
    path = stage_path(spark)
    seen = Observation()
    width = row_width(table.schema)
    metrics = []
    for number in ids.values():
        metrics.append(F.expr(f"count_if(__set = {number}) as rows_{number}"))
        metrics.append(F.expr(f"sum(if(__set = {number}, {width}, 0)) as bytes_{number}"))
    table.observe(seen, *metrics).write.partitionBy("__set").parquet(path)
    got = seen.get
    back = spark.read.schema(table.schema).parquet(path)
    return {
        s: Sized(
            back.filter(f"__set = {number}").select(*[f"`{c}`" for c in keys(s)], *values),
            int(got.get(f"rows_{number}") or 0),
            int(got.get(f"bytes_{number}") or 0),
        )
        for s, number in ids.items()
    }


def grouped(
    df: DataFrame, key_sets: Sequence[Sequence[str]], aggs: Sequence[Column], *, keep_nulls: bool = False
) -> dict[tuple[str, ...], Sized]:
    """One staged table per key set; up to ten sets share a scan and a shuffle of the facts.

    Each table carries its keys, the aggregates and ``n``, the number of rows of the key.
    """
    measures = [F.count(F.lit(1)).alias("n"), *aggs]
    found: dict[tuple[str, ...], Sized] = {}
    for sets in passes(key_sets):
        if len(sets) == 1:
            table = df.groupBy(*sets[0]).agg(*measures)
            found[sets[0]] = stage(table if keep_nulls else table.dropna(subset=list(sets[0])))
            continue
        table, ids = combine_sets(df, sets, measures, keep_nulls=keep_nulls)
        keys = {c for s in sets for c in s}
        found |= stage_sets(table, ids, [c for c in table.columns if c not in keys and c != "__set"])
    return found
