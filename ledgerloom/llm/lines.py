"""Line deduplication over the whole corpus.

A text is split at line feeds.  A line's key is the line without ASCII white space at its ends and
with A-Z lower-cased; lines with equal keys are the same line.  Lines whose key has fewer than
``min_chars`` code points are never dropped.  A line that at least ``min_documents`` documents (rows
of the table) have loses all its copies in every document, or, with ``keep_first``, all but its
first copy in the order of ids and positions.

Each document sends one entry for each of its distinct keys: a 128-bit hash and where in the document
it stands.  The entries are range-partitioned by hash with a secondary sort by document and position,
and streamed: the first occurrence of a hash opens a run, every further document adds one to its
count, and the run holds its entries back only until it has reached ``min_documents``.  The order goes
on to the document, so a line that most documents have is spread over as many partitions as it fills:
a run that touches the border of its partition is decided by the sum of its parts, of which each
partition has two at most.

What comes back for each document is not its text but a bitmap, one bit for each line that stays,
compressed.  ``kept_text`` cuts a text by it.

Null and empty text is one empty line.  Rows are documents also where ids are null or repeated.  An
empty table gives no rows.  Other columns of the input are not read, whatever their names are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_LOWER, stage, tasks
from .registry import named, table

MIN_DOCUMENTS = 10
MIN_CHARS = 1
#: Exactly the white space that is stripped: space and \x09-\x0D.
_SPACE = b" \t\n\x0b\x0c\r"
#: A text is looked up by one of this many hash values of its row, whatever the size of the table.
_FILTER = 1 << 20
_STREAMED = "hash binary, row long, lines binary, nth long, open boolean, part int"


def line_keys(text: str | None) -> list[bytes]:
    return [x.strip(_SPACE).translate(ASCII_LOWER) for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]


def row_key(doc_id: str, text: str) -> Column:
    """Names a row by its id and text; rows that agree in both have the same lines to drop."""
    parts = (F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return F.md5(F.concat(*parts).cast("binary"))


def documents(df: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """row (a number of its own), doc_id, key, n_lines, whole (sha256 of the text) and entries of
    each document.  The numbers are new in every run: stage the result."""
    kind = df.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", kind),
            T.StructField("key", T.StringType()),
            T.StructField("n_lines", T.LongType()),
            T.StructField("whole", T.StringType()),
            T.StructField("hashes", T.ArrayType(T.BinaryType())),
            T.StructField("lines", T.ArrayType(T.BinaryType())),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            n_lines, whole, hashes, lines = [], [], [], []
            for text in batch.column(2).to_pylist():
                keys = line_keys(text)
                where: dict[bytes, list[int]] = {}
                for i, k in enumerate(keys):
                    if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode("utf-8", "surrogatepass")) >= min_chars):
                        where.setdefault(xxhash.xxh3_128_digest(k), []).append(i)
                n_lines.append(len(keys))
                whole.append(sha256((text or "").encode("utf-8", "surrogatepass")).hexdigest())
                hashes.append(list(where))
                lines.append([np.array(x, "<u4").tobytes() for x in where.values()])
            rows = at + np.arange(batch.num_rows)
            at += batch.num_rows
            kinds = [pa.list_(pa.binary())] * 2
            columns = [pa.array(n_lines, pa.int64()), pa.array(whole), *[pa.array(x, k) for x, k in zip((hashes, lines), kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), batch.column(0), batch.column(1), *columns], schema.names)

    rows = df.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(read, schema)


def streamed(entries: DataFrame, min_documents: int) -> DataFrame:
    """The entries (hash, row, lines) in order, but for runs that are too short to be dropped.

    ``nth`` is an entry's place in the part of its run that its partition ``part`` holds.  ``open`` says
    that the run touches a border and the entry is not decided here; each such run also leaves one
    record without a row, whose ``nth`` is its number of entries.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, count, first_run = TaskContext.get().partitionId(), None, 0, True
        held: list[tuple] = []  # entries of the current run that are not handed on yet
        ready: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*ready)) or [()] * 6
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32())
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _STREAMED.split(", ")])

        for rows in batches:
            for hashed, row, lines in zip(*[rows.column(i).to_pylist() for i in range(3)], strict=True):
                if hashed != current:
                    if current is not None and first_run:
                        ready.append((current, None, None, count, True, part))
                    first_run = current is None
                    current, count, held = hashed, 0, []
                entry = (hashed, row, lines, count, first_run, part)
                count += 1
                if first_run or count > min_documents:
                    ready.append(entry)
                else:
                    held.append(entry)
                    if count == min_documents:
                        ready += held
                        held = []
                if len(ready) >= 4096:
                    yield batch()
        # The last run may go on in the next partition, so it is not decided either.
        if current is not None:
            ready += [(*e[:4], True, part) for e in held if count < min_documents]
            ready.append((current, None, None, count, True, part))
        yield batch()

    keys = ["hash", "no_id", "doc_id", "row"]
    ordered = entries.repartitionByRange(tasks(entries), *keys).sortWithinPartitions(*keys).select("hash", "row", "lines")
    return stage(ordered.mapInArrow(stream, _STREAMED))


def dropped(entries: DataFrame, min_documents: int, keep_first: bool) -> DataFrame:
    """row and lines (numbers of lines, 32 bits each) of what goes."""
    found = streamed(entries, min_documents)
    # At most two rows for each task.
    runs = found.filter("row is null").groupBy("hash").agg(F.sum("nth").alias("n"), F.min("part").alias("from"))
    runs = runs.filter(F.col("n") >= min_documents)
    copies = found.filter("row is not null").join(F.broadcast(runs), "hash", "left")
    # An open run is decided by its parts together; the others have been decided while they were read.
    copies = copies.filter("not open or n is not null")
    if keep_first:
        first = (F.col("nth") == 0) & (F.col("from").isNull() | (F.col("from") == F.col("part")))
        copies = copies.withColumn("lines", F.when(first, F.expr("substring(lines, 5)")).otherwise(F.col("lines")))
    return copies.select("row", "lines")


def line_dedup(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
    keep_first: bool = False,
) -> DataFrame:
    """row, doc_id, key (see ``row_key``), n_lines, n_dropped, keep and whole of every document.

    ``keep`` is the compressed bitmap of the lines that stay (``bits``), ``whole`` the sha256 of the
    whole text.  With ``min_documents=1`` and ``keep_first`` every line stays once in the corpus.
    """
    read = stage(documents(df, doc_id, text, min_chars))
    pairs = F.explode(F.arrays_zip("hashes", "lines")).alias("entry")
    entries = read.select("row", "doc_id", F.col("doc_id").isNull().alias("no_id"), pairs)
    entries = entries.select(F.col("entry.hashes").alias("hash"), "no_id", "doc_id", "row", "entry.lines")
    gone = dropped(entries, min_documents, keep_first).groupBy("row").agg(F.collect_list("lines").alias("gone"))
    wide = read.drop("hashes", "lines").join(gone, "row", "left")
    schema = T.StructType([*read.schema.fields[:4], T.StructField("n_dropped", T.LongType()), T.StructField("keep", T.BinaryType()), read.schema["whole"]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_dropped, keep = [], []
            for n, lines in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True):
                stays = np.ones(n, bool)
                if lines:
                    stays[np.frombuffer(b"".join(lines), "<u4")] = False
                n_dropped.append(n - int(stays.sum()))
                keep.append(zlib.compress(np.packbits(stays).tobytes()))
            columns = [*batch.columns[:4], pa.array(n_dropped, pa.int64()), pa.array(keep, pa.binary()), batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return wide.mapInArrow(pack, schema)


def bits(keep: bytes, n_lines: int) -> np.ndarray:
    """For each line whether it stays."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines).astype(bool)


def cut(text: str | None, keep: bytes, n_lines: int) -> str:
    lines = (text or "").split("\n")
    return "\n".join([x for x, stays in zip(lines, bits(keep, n_lines), strict=True) if stays])


def shortened(df: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key, doc_id and kept text of every row of ``df`` that loses lines, from ``line_dedup``'s result.

    Only such rows are shuffled, and a few that share a hash value with one.
    """
    maps = found.filter("n_dropped > 0").groupBy("key").agg(F.first("keep").alias("keep"), F.first("n_lines").alias("n_lines"))
    bucket = F.pmod(F.xxhash64("key"), F.lit(_FILTER)).alias("bucket")
    wanted = found.filter("n_dropped > 0").select(bucket).distinct()
    texts = df.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).cast("string").alias("text"))
    texts = texts.select("*", bucket).join(F.broadcast(wanted), "bucket", "left_semi").drop("bucket")
    both = texts.join(maps, "key")
    schema = T.StructType([*texts.schema.fields[:2], T.StructField("kept", T.StringType())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("text", "keep", "n_lines")], strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([cut(*r) for r in rows], pa.string())], schema.names)

    return both.select("doc_id", "key", "text", "keep", "n_lines").mapInArrow(rebuild, schema)


def kept_text(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with the dropped lines cut out of its text.  Rows without such lines stay as they are."""
    found = stage(line_dedup(df, doc_id, text, **options))
    new = shortened(df, found, doc_id, text).groupBy(F.col("key").alias("__key")).agg(F.first("kept").alias("__kept"))
    rows = df.select(*df.columns, row_key(doc_id, text).alias("__key")).join(new, "__key", "left")
    columns = [F.coalesce("__kept", F.col(c)).alias(c) if c == text else F.col(c) for c in df.columns]
    return rows.select(*columns)


_SQL = f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT k, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
x AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM x WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT k) >= {MIN_DOCUMENTS})
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM x LEFT JOIN c USING (key) GROUP BY k, doc_id"""


@named("op13_lines", _SQL)
def op13_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What each document keeps: from the whole text's digest where nothing goes, else from the cut text."""
    docs = table(spark, folder, "documents")
    found = stage(line_dedup(docs))
    same = found.filter("n_dropped = 0").select("doc_id", "n_lines", "n_dropped", F.col("whole").alias("kept_sha256"))
    counts = found.filter("n_dropped > 0").groupBy("key").agg(F.first("n_lines").alias("n_lines"), F.first("n_dropped").alias("n_dropped"))
    new = shortened(docs, found).select("doc_id", "key", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    return same.union(new.join(counts, "key").select("doc_id", "n_lines", "n_dropped", "kept_sha256"))
