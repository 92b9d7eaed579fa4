"""Alignment of two tokenizers over a corpus.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (sentence pieces, which adds that
space itself) the text.  Both give the same bytes, so their tokens can be laid over each other: an A
and a B token whose byte ranges end together are linked, and such ends cut both rows of tokens into
groups.  Over the corpus each pair of ids is counted by its links.

The work on a chunk of documents is done on Arrow arrays: the id lists are flattened, each token keeps
its document by the list's parent indices, the tokens' byte lengths are summed up inside each document,
and a hash join of Arrow's own engine on (document, end) finds the links.  ``Table.group_by`` counts the
id pairs inside each document, and again over all documents of a task; Spark merges these partial
counts.  A document's pairs then look up their counts: the most frequent pairs (``FREQUENT`` at most,
whatever the corpus) are sent to every task and joined there, the others, none of which is hot, are
joined by Spark.

A text that is null or empty, or whose bytes either tokenizer does not give back, has no tokens: its
counts are 0 and its groups empty.  The strings of special tokens are plain text.  Rows are documents
also where ids are null or repeated.  An empty table gives no rows.  Other columns of the input are
not read, whatever their names are.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage
from .registry import named, table

#: Texts are tokenised in chunks of about this many bytes.
_CHUNK = 1 << 20
#: So many pairs at most are sent to every task.
FREQUENT = 1 << 18
#: Distinct pairs that a task gathers before it hands their counts on.
_GATHERED = 1 << 20


class _TokenizerA:
    """Byte-level BPE: ids of texts, and the bytes of each id.

    With the same vocabulary as a rank file the ids come from tiktoken, which gives the same ids.
    """

    def __init__(self, vocabulary: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.bytes = pa.array([bytes(byte[c] for c in x) if all(c in byte for c in x) else b"" for x in names], pa.large_binary())
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is None:
            return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch([" " + x for x in texts], add_special_tokens=False)]
        return [np.array(self.fast.encode_ordinary(" " + x), np.int32) for x in texts]


class _TokenizerB:
    """Sentence pieces with byte fallback."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = range(self.model.get_piece_size())
        name = self.model.id_to_piece
        self.bytes = pa.array(
            [bytes([int(name(i)[3:-1], 16)]) if self.model.is_byte(i) else name(i).replace("▁", " ").encode() for i in pieces],
            pa.large_binary(),
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int32) for x in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def tokenizers(vocabulary_a: str | None = None, model_b: str | None = None) -> tuple[_TokenizerA, _TokenizerB]:
    """The two tokenizers of a worker process, by default the public byte BPE of 50,257 ids and the
    public sentence pieces of 32,000 ids."""
    import public_tokenizers

    ranks = None
    if vocabulary_a is None:
        vocabulary_a, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return _TokenizerA(vocabulary_a, ranks), _TokenizerB(model_b or public_tokenizers.path("piece_bpe_32k.model"))


class _Tokens:
    """The tokens of a chunk, flat: ids, the document of each and where it ends in it."""

    def __init__(self, ids: list[np.ndarray], names: pa.LargeBinaryArray):
        lists = pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, ids)]), np.concatenate([np.empty(0, np.int32), *ids]))
        self.ids = lists.flatten()
        self.doc = lists.value_parent_indices().to_numpy()
        self.bytes = names.take(self.ids)
        at = np.frombuffer(self.bytes.buffers()[1], np.int64, len(self.ids) + 1, self.bytes.offset * 8)
        self.data = memoryview(self.bytes.buffers()[2] or b"").cast("B")
        self.starts = at[lists.offsets.to_numpy()]  # of each document in data, and the end
        self.ends = at[1:] - self.starts[self.doc] if len(self.ids) else np.empty(0, np.int64)

    def of(self, i: int) -> memoryview:
        return self.data[self.starts[i] : self.starts[i + 1]]

    def table(self, name: str) -> pa.Table:
        return pa.table({"doc": self.doc, "end": self.ends, name: self.ids, f"{name}_at": np.arange(len(self.ids))})


def _joined(strings: pa.Array, offsets: np.ndarray, by: str) -> pa.Array:
    """The strings between each two offsets as one."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), strings), by)


_PAIRS = pa.list_(pa.int64())


def aligned_chunk(texts: list[str | None], a: _TokenizerA, b: _TokenizerB) -> dict[str, pa.Array]:
    """n_a, n_b, n_groups, n_links, groups, pairs and links of each text.

    ``pairs`` are the distinct linked ids of the text (A's shifted by 32 bits, B's) and ``links`` how
    many links each of them has.
    """
    whole = [x.encode("utf-8", "surrogatepass") if x else b"" for x in texts]
    known = [i for i, x in enumerate(whole) if x]
    plain = [texts[i] for i in known]
    in_a, in_b = a.encode(plain), b.encode(plain)
    one, two = _Tokens(in_a, a.bytes), _Tokens(in_b, b.bytes)
    same = [k for k, i in enumerate(known) if one.of(k) == b" " + whole[i] == two.of(k)]
    if len(same) < len(known):
        known = [known[k] for k in same]
        one, two = _Tokens([in_a[k] for k in same], a.bytes), _Tokens([in_b[k] for k in same], b.bytes)
    met = one.table("a").join(two.table("b"), ["doc", "end"], join_type="inner", use_threads=False)
    met = met.take(np.argsort(met.column("a_at").to_numpy(), kind="stable"))
    doc, n = met.column("doc").to_numpy(), len(known)
    # Groups: tokens up to each common end.  The last one of a document ends with it.
    decimal = lambda x: x.ids.cast(pa.string())
    cut = lambda name: np.append(0, met.column(name).to_numpy() + 1)
    groups = pc.binary_join_element_wise(_joined(decimal(one), cut("a_at"), ","), _joined(decimal(two), cut("b_at"), ","), "|")
    n_links = np.bincount(doc, minlength=n)
    text = _joined(groups, np.append(0, np.cumsum(n_links)), ";")
    code = (met.column("a").to_numpy().astype(np.int64) << 32) | met.column("b").to_numpy()
    pairs = pa.table({"doc": doc, "pair": code}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    order = np.argsort(pairs.column("doc").to_numpy(), kind="stable")
    n_pairs = np.zeros(len(texts), np.int64)
    n_pairs[known] = np.bincount(pairs.column("doc").to_numpy(), minlength=n)
    offsets = pa.array(np.append(0, np.cumsum(n_pairs)), pa.int32())

    def spread(values: np.ndarray) -> pa.Array:
        out = np.zeros(len(texts), np.int64)
        out[known] = values
        return pa.array(out)

    strings = [""] * len(texts)
    for i, x in zip(known, text.to_pylist(), strict=True):
        strings[i] = x
    return {
        "n_a": spread(np.bincount(one.doc, minlength=n)),
        "n_b": spread(np.bincount(two.doc, minlength=n)),
        "n_groups": spread(n_links),  # no token is empty, so each common end is one link
        "n_links": spread(n_links),
        "groups": pa.array(strings, pa.string()),
        "pairs": pa.ListArray.from_arrays(offsets, pairs.column("pair").to_numpy()[order]),
        "links": pa.ListArray.from_arrays(offsets, pairs.column("count_all").to_numpy()[order]),
    }


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, x in enumerate(texts):
        size += 4 + len(x or "")
        if size >= _CHUNK:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def align(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary_a: str | None = None,
    model_b: str | None = None,
    groups: bool = False,
) -> DataFrame:
    """row (a number of its own), doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and links.

    ``groups`` adds the groups themselves: ``a1,a2|b1;a3|b2,b3``, decimal ids of A and B.  The paths are
    of files that every executor has.  Rows are numbered anew in every run: stage the result.
    """
    kind = df.schema[doc_id].dataType
    counts = ("n_a", "n_b", "n_groups", "n_links")
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", kind),
            *[T.StructField(c, T.LongType()) for c in counts],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("links", T.ArrayType(T.LongType())),
            *([T.StructField("groups", T.StringType())] if groups else []),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, both = TaskContext.get().partitionId() << 40, None
        for whole in batches:
            both = both or tokenizers(vocabulary_a, model_b)
            texts = whole.column(1).to_pylist()
            for lo, hi in _chunks(texts):
                found = aligned_chunk(texts[lo:hi], *both)
                strings = found["groups"].to_pylist()
                hashed = pa.array([sha256(x.encode()).hexdigest() if x else "" for x in strings], pa.string())
                columns = [pa.array(at + np.arange(hi - lo)), whole.column(0).slice(lo, hi - lo), *[found[c] for c in counts], hashed]
                columns += [found["pairs"], found["links"], *([found["groups"]] if groups else [])]
                at += hi - lo
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(work, schema)


def _flat(batch: pa.RecordBatch) -> pa.Table:
    """The pairs of a batch of documents: doc, pair, n."""
    pairs, links = batch.column("pairs"), batch.column("links")
    return pa.table({"doc": pc.list_parent_indices(pairs), "pair": pairs.flatten(), "n": links.flatten()})


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, a, b, n (its links in the corpus) and best: whether no other pair of its B id has more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def merged(parts: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in batches:
            new = merged([_flat(batch).drop_columns("doc")])
            held = new if held is None else merged([held, new])
            if held.num_rows >= _GATHERED:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    counts = aligned.select("pairs", "links").mapInArrow(partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stage(counts.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n"))
    # One row for each id of B that occurs: bounded by its vocabulary.
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    return stage(counts.join(F.broadcast(best), "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")))


def _frequent(counts: DataFrame) -> tuple[pa.Table, int]:
    """The most frequent pairs, and the number of links from which on a pair is one of them."""
    size = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("pairs")).collect()  # 64 rows at most
    least, total = 62, 0  # no pair has 2 ** 62 links
    for row in sorted(sizes, reverse=True):
        total += row["pairs"]
        if total > FREQUENT:
            break
        least = row["size"]
    least = 1 << least
    known = counts.filter(F.col("n") >= least).select("pair", F.col("n").alias("count"), "best")
    return known.toArrow(), least if total > FREQUENT else 0


def scored(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with n_best (links whose pair is its B id's most frequent) and count_sum (the sum of
    the links' counts), without pairs and links."""
    spark = aligned.sparkSession
    known, least = _frequent(counts)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as writer:
        writer.write_table(known)
    sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "links")]
    lists = T.ArrayType(T.LongType())
    added = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), T.StructField("pair", lists), T.StructField("n", lists)]
    schema = T.StructType([*kept, *added])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = None
        for batch in batches:
            frequent = frequent or pa.ipc.open_stream(sent.value).read_all()
            flat = _flat(batch)
            met = flat.join(frequent, "pair", join_type="left outer", use_threads=False)
            doc, n = met.column("doc").to_numpy(), met.column("n").to_numpy()
            count = met.column("count").fill_null(0).to_numpy()
            best = met.column("best").fill_null(False).to_numpy(zero_copy_only=False)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], doc, n * best)
            np.add.at(sums[1], doc, n * count)
            rare = np.nonzero(count == 0)[0]
            rare = rare[np.argsort(doc[rare], kind="stable")]
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(doc[rare], minlength=batch.num_rows))), pa.int32())
            rest = [pa.ListArray.from_arrays(offsets, x[rare]) for x in (met.column("pair").to_numpy(), n)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *map(pa.array, sums), *rest], schema.names)

    found = aligned.mapInArrow(look_up, schema)
    if not least:
        return found.drop("pair", "n")
    found = stage(found)
    # A rare pair has fewer than ``least`` links, so no key of this join is hot.
    rows = found.select("row", F.explode(F.arrays_zip("pair", "n")).alias("x")).select("row", "x.pair", F.col("x.n").alias("links"))
    rare = counts.filter(F.col("n") < least).select("pair", "n", "best")
    more = rows.join(rare, "pair").groupBy("row")
    more = more.agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    out = found.drop("pair", "n").join(more, "row", "left")
    plus = lambda c, x: (F.col(c) + F.coalesce(x, F.lit(0))).alias(c)
    return out.select(*[f.name for f in kept], plus("n_best", "more_best"), plus("count_sum", "more_sum"))


@named("op11_align")
def op11_align(spark: SparkSession, folder: str) -> DataFrame:
    aligned = stage(align(table(spark, folder, "documents")))
    found = scored(aligned, pair_counts(aligned))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
