r"""Chat formatting by quotation linking.

A line that starts with ``>`` marks (white space between them allowed) is quoted, as deep as it has
marks.  Adjacent lines of one depth are a passage.  Its lines are normalised (marks off, lower case,
one space for white space) and joined, so that it does not matter where a mailer breaks lines.  A
passage is hashed as a whole, by paragraph, by sentence and by line, and so is every run of two,
four, eight ... adjacent sentences or lines (each hash made of two of half the length).  Within a
conversation the hashes are joined to the messages that say the same themselves.

Each hash finds the latest earlier message that says it.  A message replies to the one that its
shallowest passages found; among those a passage found whole goes before a part, a longer run before
a shorter one, then the number of hashes, then the later message.  What finds nothing starts a thread.
A passage cut inside a sentence and inside a line is only found by its other sentences and lines.
Conversations are ordered by replies: threads by turn, and under each message the replies to it by
turn.  Texts come out without quotes, without the line that announces one ("... wrote:"), and
without blank lines around them.

Before the join, what is said and what is asked are reduced to one row per hash and turn, and the
latest earlier turn is searched in blocks of 64 turns, then of 64 blocks, and so on: a sentence that
a third of all messages say or quote never meets in groups of more than 64 rows.  Threads are followed by
doubling: the number of rounds is the logarithm of the longest chain of replies.  No step needs a
whole conversation in one task; the order is a column (``path``, the turns from the thread's start
down to the message).

Null text is empty and quotes nothing; a null conversation is a conversation of its own; messages
without a turn come last and are never replied to.  Messages that agree in conversation and turn are
kept apart (a reply to such a turn goes to one of them).  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage
from .registry import named, table

_MARKS = r"^((?:[ \t]*>)+)"
_WROTE = r"wrote:[ \t]*$"
#: What is looked up: a text or run of texts of one conversation.
KEY = ["none", "conv", "run", "hash"]


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def _normal(line: Column) -> Column:
    bare = F.regexp_replace(line, _MARKS, "")
    return F.trim(F.regexp_replace(F.lower(bare), r"[\x20\x09-\x0D]+", " "))


def parsed(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Each message with its lines: level, normalised text, and whether it announces a quote."""
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), r"\r?\n")
    raw = df.select(
        F.monotonically_increasing_id().alias("message"),
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        lines.alias("lines"),
    )

    def line(x: Column, i: Column) -> Column:
        following = _level(F.coalesce(F.get("lines", i + 1), F.lit("")))
        level = _level(x)
        return F.struct(
            x.alias("raw"), level.alias("level"), _normal(x).alias("words"), ((level == 0) & (following > 0) & x.rlike(_WROTE)).alias("announces")
        )

    return raw.withColumn("lines", F.transform("lines", line))


def clean_text(lines: Column) -> Column:
    own = F.filter(lines, lambda x: (x["level"] == 0) & ~x["announces"])
    text = F.array_join(F.transform(own, lambda x: x["raw"]), "\n")
    return F.regexp_replace(F.regexp_replace(text, r"^(?:[\x20\x09-\x0D]*\n)+", ""), r"[\x20\x09-\x0D]+$", "")


def _one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "\n+", " "))


def _runs(texts: Column) -> Column:
    """Hashes of the texts, then of all runs of two of them, of four, and so on."""

    def double(levels: Column, k: Column) -> Column:
        last, half = F.element_at(levels, -1), F.pow(F.lit(2), k).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(1), F.size(last) - half), lambda i: F.md5(F.concat(F.element_at(last, i), F.element_at(last, i + half)))
        )
        return F.concat(levels, F.array(pairs))

    one = F.array(F.transform(texts, lambda x: F.md5(x)))
    doublings = F.length(F.bin(F.size(texts))) - 1
    return F.when(F.size(texts) < 2, one).otherwise(F.aggregate(F.sequence(F.lit(0), doublings - 1), one, double))


def _conversation() -> dict[str, Column]:
    """A conversation as a key, also where it is null."""
    return {"none": F.col("conv_id").isNull(), "conv": F.coalesce(F.col("conv_id").cast("string"), F.lit(""))}


def passages(messages: DataFrame) -> DataFrame:
    """message, conv_id, turn, passage (its place), level, body (normalised lines) of every passage."""
    n = F.size("lines")
    begins = F.filter(
        F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.get("lines", i - 2)["level"] != F.get("lines", i - 1)["level"])
    )
    bounds = messages.withColumn("begins", begins)

    def passage(begin: Column, k: Column) -> Column:
        end = F.coalesce(F.get("begins", k + 1), n + 1)
        own = F.filter(F.slice("lines", begin, end - begin), lambda x: ~x["announces"])
        return F.struct(F.get("lines", begin - 1)["level"].alias("level"), F.array_join(F.transform(own, lambda x: x["words"]), "\n").alias("body"))

    found = bounds.select("message", "conv_id", "turn", F.posexplode(F.transform("begins", passage)).alias("passage", "p"))
    return found.select("message", "conv_id", "turn", "passage", "p.level", "p.body").filter(F.trim(F.translate("body", "\n", " ")) != "")


def units(found: DataFrame) -> DataFrame:
    """The hashes of each passage: ``run`` (0 for a text, k for a run of 2^k), ``hash``, and ``whole``
    where that is the text of the whole passage."""
    filled = found.withColumn("whole_text", _one_line(F.col("body")))
    texts = filled.withColumns(
        {
            "said_lines": F.filter(F.split("body", "\n+"), lambda x: x != ""),
            "sentences": F.split(F.regexp_replace("whole_text", "([.!?]) ", "$1\n"), "\n"),
            "paragraphs": F.filter(F.transform(F.split("body", "\n\n+"), _one_line), lambda x: x != ""),
        }
    )
    empty = F.array().cast("array<string>")
    both = F.zip_with(
        _runs(F.col("said_lines")), _runs(F.col("sentences")), lambda a, b: F.array_union(F.coalesce(a, empty), F.coalesce(b, empty))
    )
    more = F.transform(F.array_append("paragraphs", F.col("whole_text")), lambda x: F.md5(x))
    levels = F.transform(both, lambda hashes, k: F.when(k == 0, F.array_union(hashes, more)).otherwise(F.array_distinct(hashes)))
    place = ["message", "turn", "passage", "level", *[c.alias(name) for name, c in _conversation().items()]]
    run = texts.select(*place, F.md5("whole_text").alias("whole_hash"), F.posexplode(levels).alias("run", "hashes"))
    each = run.select("*", F.explode("hashes").alias("hash"))
    whole = (F.col("run") == 0) & (F.col("hash") == F.col("whole_hash"))
    return each.withColumns({"whole": whole, "hash": F.unhex("hash")}).drop("hashes", "whole_hash")


def latest_before(asked: DataFrame, said: DataFrame) -> DataFrame:
    """KEY, turn and original (turn, -message) of the latest of ``said`` before each turn of ``asked``.

    One row per key and turn first.  The search goes up a tree of 64 children: only what finds nothing
    among its brothers asks again one level higher, so no group has more than 64 rows.
    """

    def above(x: str, level: int) -> Column:
        return F.shiftright(x, 6) if level == 0 else F.shiftright(F.col(x) + 1, 6)

    said = said.select(*KEY, F.col("turn").alias("x"), F.struct("turn", (-F.col("message")).alias("other")).alias("original"), F.lit(False).alias("asks"))
    asking = asked.select(*KEY, F.col("turn").alias("x"), F.lit(None).cast(said.schema["original"].dataType).alias("original"), F.lit(True).alias("asks"))
    wanted = asking.select(*KEY).distinct()
    both = said.join(wanted, KEY, "left_semi").union(asking)
    nodes = stage(both.groupBy(*KEY, "x").agg(F.max("original").alias("original"), F.max("asks").alias("asks")))
    answers = asking.select(*KEY, "x").distinct().select("*", F.col("x").alias("turn"), F.lit(None).cast(said.schema["original"].dataType).alias("original"))
    level = 0
    while True:
        low, high = nodes.agg(F.min("x"), F.max("x")).first()
        if low == high:
            return answers.filter("original is not null").select(*KEY, "turn", "original")
        before = Window.partitionBy(*KEY, "up").orderBy("x").rangeBetween(Window.unboundedPreceding, -1)
        searched = stage(nodes.withColumn("up", above("x", level)).withColumn("found", F.max("original").over(before)))
        hits = searched.filter("asks and found is not null").select(*KEY, "x", "found")
        answers = answers.join(hits, [*KEY, "x"], "left").select(
            *KEY, above("x", level).alias("x"), "turn", F.coalesce("original", "found").alias("original")
        )
        open_ = F.col("asks") & F.col("found").isNull()
        nodes = stage(searched.groupBy(*KEY, F.col("up").alias("x")).agg(F.max("original").alias("original"), F.max(open_).alias("asks")))
        level += 1


def link(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text (without quotes), parent_turn, root_turn, depth, path, n_quoted
    (quoted lines), n_passages (quoted passages) and n_linked (those found in an earlier message)."""
    messages = stage(parsed(df, conversation, turn, role, text))
    timed = passages(messages.filter("turn is not null").withColumn("turn", F.col("turn").cast("bigint")))
    quoted = stage(units(timed.filter("level > 0")))
    # Only conversations that quote something are looked into.
    quoting = quoted.select("none", "conv").distinct()
    said = units(timed.filter("level = 0").withColumns(_conversation()).join(quoting, ["none", "conv"], "left_semi"))
    found = stage(quoted.join(latest_before(quoted, said), [*KEY, "turn"]))
    votes = found.groupBy("message", "level", "whole", "run", "original").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("message").agg(F.max(F.struct((-F.col("level")).alias("near"), "whole", "run", "n", "original")).alias("best"))
    linked = found.select("message", "passage").distinct().groupBy("message").agg(F.count(F.lit(1)).alias("n_linked"))
    parents = stage(
        best.join(linked, "message").select(
            "message", (-F.col("best.original.other")).alias("parent"), F.col("best.original.turn").alias("parent_turn"), "n_linked"
        )
    )
    deep = F.transform("lines", lambda x: x["level"])
    begun = F.zip_with(deep, F.concat(F.array(F.lit(0)), deep), lambda now, before: (now > 0) & (now != before))

    # What lies above a message, doubled each round: the top reached so far and the turns down from it.
    above = stage(parents.select("message", F.col("parent").alias("top"), F.array("parent_turn").alias("turns")))
    while True:
        up = above.select(F.col("message").alias("top"), F.col("top").alias("further"), F.col("turns").alias("more"))
        longer = above.join(up, "top", "left")
        if not longer.filter("further is not null").limit(1).count():
            break
        above = stage(
            longer.select(
                "message", F.coalesce("further", "top").alias("top"), F.when(F.col("further").isNull(), F.col("turns")).otherwise(F.concat("more", "turns")).alias("turns")
            )
        )
    path = F.concat(F.coalesce("turns", F.array().cast("array<bigint>")), F.array(F.col("turn").cast("bigint")))
    return (
        messages.join(parents, "message", "left")
        .join(above.select("message", "turns"), "message", "left")
        .withColumn("path", path)
        .select(
            "conv_id",
            "turn",
            "role",
            clean_text(F.col("lines")).alias("text"),
            "parent_turn",
            F.get("path", F.lit(0)).alias("root_turn"),
            (F.size("path") - 1).alias("depth"),
            "path",
            F.size(F.filter("lines", lambda x: x["level"] > 0)).alias("n_quoted"),
            F.size(F.filter(begun, lambda x: x)).alias("n_passages"),
            F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        )
    )


def write_chats(linked: DataFrame, path: str) -> None:
    """Messages as ``<|role|>`` lines, in reply order, range-partitioned by conversation and path."""
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "text")
    ordered = linked.repartitionByRange("conv_id", "path").sortWithinPartitions("conv_id", "path")
    ordered.select("conv_id", "path", line.alias("chat")).write.parquet(path)


_SQL = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS message, conv_id, turn, role, regexp_split_to_array(coalesce(text, ''), '\r?\n') AS raws FROM conversations
), l AS (
  SELECT message, conv_id, turn, i, raws[i] AS raw,
    len(replace(replace(regexp_extract(raws[i], '^((?:[ \t]*>)+)', 1), ' ', ''), chr(9), '')) AS level,
    coalesce(len(regexp_extract(raws[i + 1], '^((?:[ \t]*>)+)', 1)), 0) AS following,
    trim(regexp_replace(lower(regexp_replace(raws[i], '^((?:[ \t]*>)+)', '')), '[\x20\x09-\x0D]+', ' ', 'g')) AS words
  FROM (SELECT *, unnest(range(1, len(raws) + 1)) AS i FROM m)
), t AS (
  SELECT *, level = 0 AND following > 0 AND regexp_matches(raw, 'wrote:[ \t]*$') AS announces FROM l
), r AS (
  SELECT *, level > 0 AND level <> before AS begins, sum((level <> before)::INTEGER) OVER (PARTITION BY message ORDER BY i) AS passage
  FROM (SELECT *, coalesce(lag(level) OVER (PARTITION BY message ORDER BY i), 0) AS before FROM t)
), body AS (
  SELECT message, conv_id, turn, passage, level, coalesce(string_agg(words, chr(10) ORDER BY i) FILTER (NOT announces), '') AS body FROM r GROUP BY ALL
), b AS (
  SELECT *, trim(regexp_replace(body, '\n+', ' ', 'g')) AS whole FROM body WHERE turn IS NOT NULL
), texts AS (
  SELECT *, [x FOR x IN regexp_split_to_array(body, '\n+') IF x <> ''] AS said_lines,
         regexp_split_to_array(regexp_replace(whole, '([.!?]) ', E'\\1\n', 'g'), '\n') AS sentences,
         [trim(regexp_replace(x, '\n+', ' ', 'g')) FOR x IN regexp_split_to_array(body, '\n\n+')] AS paragraphs
  FROM b WHERE whole <> ''
), series AS (
  SELECT message, conv_id, turn, passage, level, said_lines AS s FROM texts UNION ALL SELECT message, conv_id, turn, passage, level, sentences FROM texts
), lengths AS (
  SELECT *, unnest([k FOR k IN range(1, 31) IF (1::BIGINT << k) <= len(s)]) AS run FROM series
), runs AS (
  SELECT *, unnest(range(1, len(s) - (1::BIGINT << run) + 2)) AS head FROM lengths
), units AS (
  SELECT DISTINCT message, conv_id, turn, passage, level, 0 AS run, [x] AS unit, x = whole AS is_whole
  FROM (SELECT *, unnest(list_concat(said_lines, sentences, paragraphs, [whole])) AS x FROM texts) WHERE x <> ''
  UNION ALL
  SELECT DISTINCT message, conv_id, turn, passage, level, run, list_slice(s, head, head + (1::BIGINT << run) - 1), false FROM runs
), found AS (
  SELECT q.message, q.passage, q.level, q.is_whole, q.run, q.unit, max((o.turn, -o.message)) AS original
  FROM units q JOIN units o ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.run = o.run AND q.unit = o.unit
  WHERE q.level > 0 AND o.level = 0 AND o.turn < q.turn GROUP BY ALL
), votes AS (
  SELECT message, level, is_whole, run, original, count(*) AS n FROM found GROUP BY ALL
), best AS (
  SELECT message, max((-level, is_whole, run, n, original)) AS best FROM votes GROUP BY message
), parents AS (
  SELECT message, (best[5][1], -best[5][2]) AS original, n_linked
  FROM best JOIN (SELECT message, count(DISTINCT passage) AS n_linked FROM found GROUP BY message) USING (message)
), up AS (
  SELECT message, original[2] AS top, [original[1]] AS turns FROM parents
  UNION ALL
  SELECT up.message, p.original[2], list_concat([p.original[1]], up.turns) FROM up JOIN parents p ON p.message = up.top
), above AS (
  SELECT message, arg_max(turns, len(turns)) AS turns FROM up GROUP BY message
), clean AS (
  SELECT message, coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (level = 0 AND NOT announces), '') AS text,
         count(*) FILTER (level > 0) AS n_quoted, count(*) FILTER (begins) AS n_passages FROM r GROUP BY message
)
SELECT conv_id, turn, role, regexp_replace(regexp_replace(text, '^(?:[\x20\x09-\x0D]*\n)+', ''), '[\x20\x09-\x0D]+$', '') AS text,
       p.original[1] AS parent_turn, list_concat(coalesce(turns, []), [turn])[1] AS root_turn,
       coalesce(len(turns), 0)::INTEGER AS depth, coalesce(array_to_string(list_concat(coalesce(turns, []), [turn]), '/'), '') AS path,
       n_quoted::INTEGER AS n_quoted, n_passages::INTEGER AS n_passages, coalesce(n_linked, 0)::BIGINT AS n_linked
FROM m JOIN clean USING (message) LEFT JOIN parents p USING (message) LEFT JOIN above USING (message)
"""


@named("op4_chat", _SQL)
def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    return link(table(spark, folder, "conversations")).withColumn("path", F.array_join("path", "/"))
