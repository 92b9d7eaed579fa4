"""Packing by concatenate and cut.

All documents are laid end to end and cut every ``window`` tokens, so that only the last sequence
can be short.  Pass one tokenises each document once, in the order its input partition has it, and
stores its ids beside its place in that partition.  The partitions' token totals (one number per
task) give every partition its global offset by a prefix sum.  Pass two turns each document into
its pieces: a document that crosses a window boundary leaves one record on each side of it.

Null text is empty text: such a document is the end token alone.  Null or repeated ids are ordinary
documents.  An empty table gives no piece.  Other columns of the input are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage
from .registry import named, table

#: Documents tokenised and handed on at a time.
_ROWS = 256

class _Encoder:
    """Ids of texts by a tokenizer file.

    With the same vocabulary as a rank file, the ids come from tiktoken, which gives the same ids
    at a third of the cost; texts that hold a special token's string always go to the tokenizer.
    """

    def __init__(self, vocabulary: str, ranks: str | None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
            )

    def encode(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def encoder(vocabulary: str | None = None) -> _Encoder:
    """One encoder for each worker process; by default the public byte-level BPE of 50,257 ids."""
    import public_tokenizers

    if vocabulary is None:
        return _Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return _Encoder(vocabulary, None)


def token_table(df: DataFrame, doc_id: str, text: str, end_id: int, vocabulary: str | None = None) -> DataFrame:
    """Each document's ids with ``end_id`` (little-endian unsigned 32 bits), its partition and its
    first token's place there.  Lazy: a rerun may place documents otherwise, so stage it."""
    kind = df.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("part", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("tokens", T.BinaryType()),
        ]
    )

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, encode = TaskContext.get().partitionId(), 0, None
        for whole in batches:
            encode = encode or encoder(vocabulary).encode
            for lo in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(lo, _ROWS)
                rows = [np.array([*encode(x or ""), end_id], "<u4") for x in batch.column(1).to_pylist()]
                n = np.array([len(x) for x in rows], np.int64)
                starts = first + np.cumsum(n) - n
                first += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(len(rows), part, np.int32)),
                        pa.array(starts),
                        pa.array(n),
                        pa.array([x.tobytes() for x in rows], pa.binary()),
                    ],
                    names=schema.names,
                )

    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(tokenise, schema)


def pack(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 2048,
    end_id: int = 1,
    vocabulary: str | None = None,
) -> DataFrame:
    """Pieces of all documents: sequence_id, offset, doc_id, start, length, doc_tokens, tokens.

    ``tokens`` are the piece's ids as little-endian unsigned 32-bit numbers.  ``vocabulary`` is the
    path of a tokenizer file that every executor has; by default that of the public 50k byte BPE.
    """
    documents = stage(token_table(df, doc_id, text, end_id, vocabulary))
    parts = documents.groupBy("part").agg(F.max(F.col("first") + F.col("n_tokens")).alias("total"))
    # One row per input task: the driver already keeps more than that about each task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    at = F.col("base") + F.col("first")
    placed = documents.join(F.broadcast(parts), "part").withColumn("at", at)
    end = F.col("at") + F.col("n_tokens")

    def piece(s):
        start = F.greatest(F.col("at"), s * window) - F.col("at")
        stop = F.least(end, (s + 1) * window) - F.col("at")
        return F.struct(
            s.alias("sequence_id"),
            (F.col("at") + start - s * window).alias("offset"),
            start.alias("start"),
            (stop - start).alias("length"),
            F.substring("tokens", (start * 4 + 1).cast("int"), ((stop - start) * 4).cast("int")).alias("tokens"),
        )

    windows = F.sequence(F.floor(F.col("at") / window), F.floor((end - 1) / window))
    # The pieces of a document are cut in one go: its ids are not copied once per piece.
    return placed.select("doc_id", "n_tokens", F.inline(F.transform(windows, piece))).select(
        "sequence_id", "offset", "doc_id", "start", "length", F.col("n_tokens").alias("doc_tokens"), "tokens"
    )


@named("op1_pack")
def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
