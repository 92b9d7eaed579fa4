"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key.  Within each source the documents are range-partitioned by
that key (it is uniform, so equal ranges hold about equal numbers of rows and need no sampling),
sorted inside each range, and numbered by a prefix sum of their sizes: a running sum inside the
range on top of the totals of the ranges before it.  The source's budget is cut exactly: whole
passes over the source first, then the documents before the cut, then part of the one on it.

How many ranges a source gets follows its share of the rows, so a source with a third of all
documents is spread over a third of the tasks.

Targets: source number i in code-point order (null last) has weight ``weights[i % len(weights)]``;
``share`` of all words is dealt out by weight; a target stops at ``most`` times its source's words,
and what is left over goes to the others by weight until none is above.  That is a water level:
sources in the order of cap over weight are full up to the first whose cap exceeds the level.

Null text has size 0, a null source is a source of its own (the last).  Rows that agree in id and
size share what is left at the cut evenly, rounded down.  An empty table gives an empty result.
All columns of the input are kept, except that one named like an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, tasks, word_count
from .registry import named, table

WEIGHTS = (5, 2, 1)
ADDED = ("size", "source_size", "target", "taken")
#: Up to this many sources (some 10 MB), their table is sent to all tasks; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 100_000
_HALF = 30


def random_key(doc_id: Column, seed: int) -> Column:
    """A uniform number under 2**60 from the id; a null id is the empty text."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Adds rank, target, epochs and rest (words to take beyond whole passes) to (source, source_size, rows)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(by_name) - 1)
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(dealt, F.col("rank") % len(weights)))
    ranked = ranked.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_fullness = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy(F.lit(0))
    before = by_fullness.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fullness.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    ranked = ranked.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    ranked = ranked.withColumn("level", F.first(fits, ignorenulls=True).over(everything.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap")))
    budget = F.floor(F.col("target")).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    return (
        ranked.withColumn("target", target)
        .withColumn("epochs", epochs)
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .select("source", "source_size", "rows", "rank", "target", "epochs", "rest")
    )


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a staged table of sources while its counted rows stay under the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def mix(
    df: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
) -> DataFrame:
    """``df`` with size, source_size, target and taken (words of the document that the mix takes).

    ``size`` is the number of words, by default of the column ``text``.  ``taken`` is
    ``epochs * size`` and, up to the source's cut, another ``size``.
    """
    size = word_count(F.col("text")) if size is None else size
    key = random_key(F.col(doc_id), seed)
    narrow = stage(
        df.select(F.col(source).alias("source"), F.col(doc_id).alias("id"), size.alias("size"), key.alias("key"))
    )
    sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = stage(targets(sums, weights, share, most))

    # Ranges of the key, as many as four for each reducer in all.
    share_of_rows = F.col("rows") / F.sum("rows").over(Window.partitionBy(F.lit(0)))
    ranges = F.ceil(share_of_rows * (4 * tasks(df))).cast("bigint").alias("ranges")
    dealt = sources.select(F.col("source").alias("__source"), "rank", "rest", ranges)
    bucket = F.shiftright(F.shiftright("key", _HALF) * F.col("ranges"), _HALF)
    placed = (
        narrow.filter("size > 0")
        .join(_small(dealt), F.col("source").eqNullSafe(F.col("__source")))
        .select("rank", "rest", bucket.alias("bucket"), "key", "id", "size")
    )
    in_source = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    totals = totals.select("rank", "bucket", F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("base"))

    ordered = Window.partitionBy("rank", "bucket").orderBy("key", "id", "size")
    equal = placed.repartition("rank", "bucket").groupBy("rank", "rest", "bucket", "key", "id", "size").agg(
        F.count(F.lit(1)).alias("copies")
    )
    running = F.sum(F.col("size") * F.col("copies")).over(ordered) - F.col("size") * F.col("copies")
    cut = (
        equal.withColumn("running", running)
        .join(totals, ["rank", "bucket"])
        .withColumn("left", F.col("rest") - F.col("base") - F.col("running"))
        .filter((F.col("left") >= 0) & (F.col("left") < F.col("size") * F.col("copies")))
        .select(
            "rank",
            F.struct("key", "id", "size").alias("cut"),
            F.floor(F.col("left") / F.col("copies")).cast("bigint").alias("left"),
        )
    )
    budgets = stage(sources.join(cut, "rank", "left")).select(
        F.col("source").alias("__source"), "source_size", "target", "epochs", "cut", "left"
    )
    mine = F.struct(F.col("__key").alias("key"), F.col(doc_id).alias("id"), F.col("size").alias("size"))
    more = (
        F.when(F.col("cut").isNull(), 0)
        .when(mine < F.col("cut"), F.col("size"))
        .when(mine.eqNullSafe(F.col("cut")), F.col("left"))
        .otherwise(0)
    )
    return (
        df.withColumns({"size": size, "__key": key})
        .join(_small(budgets), F.col(source).eqNullSafe(F.col("__source")))
        .select(
            *[c for c in df.columns if c not in ADDED],
            "size",
            "source_size",
            "target",
            F.when(F.col("size") > 0, F.col("epochs") * F.col("size") + more).otherwise(0).cast("bigint").alias("taken"),
        )
    )


def mixed_documents(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix itself, with the columns of ``df``: a row for each pass over a document.

    A document that the cut divides appears once more with its first words only.
    """
    rows = df.select(
        F.struct(*df.columns).alias("__row"), F.col(doc_id).alias("__id"), F.col(source).alias("__from"), F.col(text).alias("__text")
    )
    mixed = mix(rows, "__id", "__from", word_count(F.col("__text")), **options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    part = F.col("taken") - whole * F.col("size")
    passes = F.array_repeat(F.lit(-1).cast("bigint"), whole.cast("int"))
    passes = F.when(part > 0, F.concat(passes, F.array(part))).otherwise(passes)
    rows = mixed.withColumn("__words", F.explode(passes))
    cut = F.when(F.col("__words") < 0, F.col("__text")).otherwise(first_words(F.col("__text"), F.col("__words")))
    return rows.select(*[cut.alias(c) if c == text else F.col("__row").getField(c).alias(c) for c in df.columns])


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text, one space between them."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), 1, n.cast("int")), " ")


_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':42'), 1, 15))::BIGINT AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight,
         2 * source_size::DOUBLE AS cap FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT *, least(cap, weight * (SELECT arg_min(level, (cap / weight, rank)) FROM l WHERE level <= cap / weight)) AS target
  FROM l
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target)::BIGINT / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), p AS (
  SELECT d.*, b.source_size, b.target, b.epochs, floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM p
"""


@named("op3_mix", _SQL)
def op3_mix(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    sizes = stage(documents.select("doc_id", "source", word_count(F.col("text")).alias("words")))
    return mix(sizes, size=F.col("words")).select("doc_id", "size", "source_size", "target", "taken")
