"""License scans: an exact set-similarity join of text blocks with notice templates, native only.

Blocks are overlapping windows of words, so a notice may be wrapped over lines, indented or set behind
comment signs, and its words cannot lie scattered over a long text.  A text is cut into chunks of ``CHUNK``
words; a template of ``n`` words is looked for in windows of ``2 * ceil(n / CHUNK)`` chunks, one starting
every ``ceil(n / CHUNK)`` chunks, so that every run of ``n`` words lies whole in one of them.

A block carries a notice when at least ``threshold`` of the distinct words of one of its templates
occur in it (containment); a template of fewer than ``WHOLE`` words must occur whole, since its few
distinguishing words may be the missing ones.  The join is exact and filtered:

* **order**: template words are ordered by the number of chunks of the whole corpus that hold them,
  rarest first;
* **prefix**: a block that contains ``need`` of a template's ``n`` words must hold one of its
  ``n - need + 1`` rarest, so only those words are looked up;
* **length**: blocks with fewer than ``need`` distinct template words are out;
* **position**: with a common word at place ``i`` of the template and place ``j`` among the block's
  template words, at most ``min(n - i, m - j)`` words can be common if it is the first one, so the
  pair is out where that is below ``need``;
* what is left is verified by intersecting the full sets.

One pass over the texts keeps, per chunk, only the template words it holds; frequencies, lookup and
verification run on that narrow table.  Its rows are never shuffled by word: the prefix table is as
large as the templates, so it is sent to the tasks, and a notice that a third of all documents
carry makes no hot key.

Beside the join, *base* phrases are counted where their words stand consecutively.

Null text is empty: no words, no places, no labels, score 0.  Repeated or null ids are rows of their
own.  Other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage
from .registry import named, table

# Phrases and labels of the contract.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Notices and the labels they give.
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
THRESHOLD = 0.8
#: Templates of fewer distinct words must be contained whole.
WHOLE = 10
#: Words of a chunk; windows are made of chunks.
CHUNK = 12
# A word of the lower-cased text, and the same class before lower-casing.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case.  The built-in function does more, but only two characters beyond ASCII
    become ASCII by it; texts that hold one go the slower way."""
    odd = text.contains("K") | text.contains("İ")
    return F.when(odd, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def _gap() -> str:
    """What stands between two words."""
    return r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _pattern(phrase: str) -> str:
    return rf"(?<!{_WORD}){_gap().join(phrase.split())}(?!{_WORD})"


def _words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_WORD + "+")).cast("bigint")


def scan(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score, and
    ``notices``: first word of the window, label and containment of every template found."""
    spark = df.sparkSession
    words = [sorted(set(t.split())) for _, t in templates]
    spans = [_chunks(t) for _, t in templates]
    vocabulary = sorted({w for t in words for w in t})

    lowered = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        lower_ascii(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text"),
    )
    any_phrase = "|".join(_pattern(p) for p, _ in phrases)
    # Places of different phrases end in different words, so each is counted by itself.
    counts = [F.regexp_count("text", F.lit(_pattern(p))).cast("bigint") for p, _ in phrases]
    head = F.regexp_extract("text", rf"(?s)^(.*?)(?:{any_phrase})", 1)
    tail = F.array_max(F.array(*[_last_start(p) for p, _ in phrases]))
    # A text without the last word of a phrase has no place of it, which is cheaper to see.
    ends = F.lit(False)
    for last in sorted({p.split()[-1] for p, _ in phrases}):
        ends = ends | F.col("text").contains(last)
    has = ends & F.col("text").rlike(any_phrase)
    read = lowered.select(
        "row",
        "doc_id",
        F.when(has, F.array(*counts)).alias("counts"),
        F.when(has, _words_in(head)).alias("first_word"),
        F.when(has, tail).alias("last_word"),
        F.regexp_extract_all("text", F.lit(_WORD + "+"), F.lit(0)).alias("words"),
    )

    def known(at: Column) -> Column:
        return F.array_distinct(F.filter(F.slice("words", at * CHUNK + 1, CHUNK), lambda w: w.isin(vocabulary)))

    documents = stage(
        read.select(
            "row",
            "doc_id",
            "counts",
            "first_word",
            "last_word",
            F.size("words").cast("bigint").alias("n_words"),
            F.transform(_range(F.ceil(F.size("words") / CHUNK)), known).alias("chunks"),
        )
    )

    # Corpus frequency of the template words, in chunks.
    frequency = documents.select(F.explode(F.flatten("chunks")).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in frequency.collect()}  # at most one row per template word
    order = sorted(vocabulary, key=lambda w: (found.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    entries, sets = [], []
    for number, ((label, _), own, span) in enumerate(zip(templates, words, spans, strict=True)):
        own = sorted(rank[w] for w in own)
        need = _need(len(own), threshold)
        sets.append((number, label, own, need))
        entries += [(r, span, number, i, len(own), need) for i, r in enumerate(own[: len(own) - need + 1])]
    prefix = _values(spark, entries, "rank int, span int, template int, i int, n_template int, need int")

    # Windows with enough words and one of the prefix; most documents hold no prefix word at all.
    def windows(span: int) -> Column:
        rare = [order[r] for r, s, *_ in entries if s == span]
        least = min(_need(len(t), threshold) for t, s in zip(words, spans, strict=True) if s == span)

        def window(at: Column) -> Column:
            hits = F.array_distinct(F.flatten(F.slice("chunks", at * span + 1, 2 * span)))
            return F.struct(F.lit(span).alias("span"), (at * span * CHUNK).alias("block"), hits.alias("hits"))

        every = F.transform(_range(F.ceil(F.size("chunks") / span)), window)
        return F.filter(every, lambda x: (F.size(x["hits"]) >= least) & F.exists(x["hits"], lambda w: w.isin(rare)))

    prefixes = sorted({order[r] for r, *_ in entries})
    block = documents.filter(F.exists("chunks", lambda c: F.exists(c, lambda w: w.isin(prefixes))))
    block = block.select("row", F.inline(F.concat(*[windows(s) for s in sorted(set(spans))])))
    ranks = F.create_map(*[x for w in vocabulary for x in (F.lit(w), F.lit(rank[w]))])
    prefix = _values(spark, entries, "rank int, span int, template int, i int, n_template int, need int")

    ranked = block.select(
        "row", "span", "block", F.array_sort(F.transform("hits", lambda w: F.get(F.map_values(ranks), F.array_position(F.map_keys(ranks), w).cast("int") - 1))).alias("ranks")
    )
    candidates = (
        ranked.select("row", "span", "block", "ranks", F.posexplode("ranks").alias("j", "rank"))
        .join(F.broadcast(prefix), ["rank", "span"])
        .filter(F.least(F.col("n_template") - F.col("i"), F.size("ranks") - F.col("j")) >= F.col("need"))
        .select("row", "block", "ranks", "template")
    )
    full = _values(
        spark,
        [(n, label, own, need) for n, label, own, need in sets],
        "template int, label string, own array<int>, need int",
    )
    common = F.size(F.array_intersect("ranks", "own"))
    notices = (
        candidates.join(F.broadcast(full), "template")
        .withColumn("common", common)
        .filter(F.col("common") >= F.col("need"))
        .select("row", F.struct("block", "label", (F.col("common") / F.size("own")).alias("containment")).alias("notice"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("notice")).alias("notices"))
    )
    base = F.array(*[F.when(F.get("counts", F.lit(i)) > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)])
    base = F.array_sort(F.array_distinct(F.array_compact(F.when(F.col("counts").isNotNull(), base).otherwise(F.array()))))
    nothing = F.expr("cast(array() as array<struct<block:int,label:string,containment:double>>)")
    return (
        documents.select("row", "doc_id", "counts", "first_word", "last_word", "n_words", base.alias("base"))
        .join(notices, "row", "left")
        .withColumn("notices", F.coalesce("notices", nothing))
        .select(
            "doc_id",
            "n_words",
            F.coalesce(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)).alias("n_base"),
            "first_word",
            "last_word",
            F.array_join("base", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("base", F.col("notices.label"))), ",").alias("labels"),
            F.greatest(
                F.when(F.size("base") > 0, 1.0).otherwise(0.0),
                F.coalesce(F.array_max(F.col("notices.containment")), F.lit(0.0)),
            ).alias("score"),
            "notices",
        )
    )


def _need(n: int, threshold: float) -> int:
    """How many of the ``n`` words of a template a block must hold."""
    return n if n < WHOLE else max(1, math.ceil(threshold * n - 1e-9))


def _chunks(template: str) -> int:
    """How many chunks a template's words fill, repeated ones too."""
    return -(-len(template.split()) // CHUNK)


def _range(n: Column) -> Column:
    """0 ... n - 1, empty where n is 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.expr("cast(array() as array<int>)"))


def _last_start(phrase: str) -> Column:
    """Number of words before the last place of the phrase, null without one."""
    before = F.regexp_extract("text", rf"(?s)^(.*){_pattern(phrase)}", 1)
    return F.when(F.col("text").rlike(_pattern(phrase)), _words_in(before))


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small constant table as an expression, so that no Python task makes it."""

    def literal(x) -> Column:
        return F.array(*[F.lit(y) for y in x]) if isinstance(x, list) else F.lit(x)

    names = [c.split()[0] for c in schema.split(", ")]
    structs = [F.struct(*[literal(x).alias(n) for n, x in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _sql() -> str:
    word, gap = _WORD + "+", _gap()
    # The engine of the check has no look-around: words are joined by single spaces instead.
    templates = ",\n    ".join(f"('{label}', '{text}', {_chunks(text)})" for label, text in TEMPLATES)
    return rf"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{word}') AS ws
  FROM documents
), hit AS (
  SELECT r, i,
    CASE WHEN ws[i] = 'mit' AND ws[i + 1] = 'license' THEN 'mit'
         WHEN ws[i] = 'apache' AND ws[i + 1] = 'license' THEN 'apache'
         WHEN ws[i] = 'general' AND ws[i + 1] = 'public' AND ws[i + 2] = 'license' THEN 'gpl' END AS label
  FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)
), base AS (
  SELECT r, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS labels
  FROM hit WHERE label IS NOT NULL GROUP BY r
), template AS (
  SELECT label, list_distinct(string_split(text, ' ')) AS ts, span * {CHUNK} AS size FROM (VALUES
    {templates}) v(label, text, span)
), size AS (
  SELECT DISTINCT size FROM template
), block AS (
  SELECT r, size, list_distinct(ws[b * size + 1:(b + 2) * size]) AS ls
  FROM (SELECT r, ws, size, unnest(range(0, ((len(ws) + size - 1) // size)::BIGINT)) AS b FROM w, size)
), notice AS (
  SELECT r, label, len(list_intersect(ls, ts)) / len(ts)::DOUBLE AS c FROM block JOIN template USING (size)
  WHERE len(list_intersect(ls, ts)) >= CASE WHEN len(ts) < {WHOLE} THEN len(ts) ELSE ceil({THRESHOLD} * len(ts) - 1e-9) END
), found AS (
  SELECT r, list(DISTINCT label) AS labels, max(c) AS c FROM notice GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END, coalesce(c, 0))::DOUBLE AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""


@named("op9_licenses", _sql())
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents")).drop("notices")
