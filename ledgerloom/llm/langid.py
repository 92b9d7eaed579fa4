"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs.  The vector of an n-gram is the product
(binding) of its letters' vectors, each rotated by its place.  A text's vector is the sum (bundle)
of its n-grams' vectors, a language's prototype the sum of the unit vectors of its training texts.
The language whose prototype has the largest cosine with the text is the prediction, and the
cosine, cut to 0..1, its score; equal cosines go to the first language in code-point order.

Letters are lower-cased; everything between them counts as one space.  Whole texts are read, a long
one in slices whose n-gram counts are added up.

The prototypes are learned from rows whose label is not null, at most about ``TRAINING_ROWS`` of
them: that is the documented bound of the classifier's sample.  Every label has an equal share of it,
so a rare language is learned from all its rows; the rows of a frequent one are drawn by a hash of the
whole row, and equal rows count once, so the bound holds also where ids are null or repeated.  Only the sums of a task's vectors leave it (one per language), so what reaches
the driver is as large as the number of languages.

Null text, and text without a letter, gives ``und`` with score 0; so does every text if nothing
could be learned.  Null ids are ordinary rows.  Repeated rows are predicted alike.  Input columns
named ``lang_pred`` or ``score`` are replaced; all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import named, table

DIMENSIONS = 1024
GRAM = 3
TRAINING_ROWS = 20_000
UNKNOWN = "und"
#: Texts bundled together, characters counted at a time, and n-gram vectors a worker remembers.
_TOGETHER, _SLICE, _REMEMBERED = 64, 1_000_000, 32_000
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    table = np.full(0x110000, _SPACE, np.int64)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams as numbers, and how often each occurs; nothing for a text without letters."""
    codes, counts, carry = [], [], np.array([_SPACE], np.int64)
    for lo in range(0, len(text), _SLICE):
        points = np.frombuffer(text[lo : lo + _SLICE].encode("utf-32-le", "surrogatepass"), "<u4")
        found = np.concatenate([carry, _letters()[points]])
        if lo + _SLICE >= len(text):
            found = np.append(found, _SPACE)
        # One space between words.
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != _SPACE) | (found[:-1] != _SPACE)
        found = found[keep]
        carry = found[-(GRAM - 1) :]
        if len(found) < GRAM:
            continue
        grams = np.zeros(len(found) - GRAM + 1, np.int64)
        for i in range(GRAM):
            grams = (grams << 21) | found[i : len(found) - GRAM + 1 + i]
        code, count = np.unique(grams, return_counts=True)
        codes.append(code)
        counts.append(count)
    if len(codes) > 1:
        code, at = np.unique(np.concatenate(codes), return_inverse=True)
        return code, np.bincount(at, np.concatenate(counts)).astype(np.int64)
    return (codes[0], counts[0]) if codes else (np.empty(0, np.int64), np.empty(0, np.int64))


class _Space:
    """Vectors of n-grams; a worker makes each when it first meets it."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.forget()

    def forget(self) -> None:
        self.at: dict[int, int] = {}
        self.vectors = np.empty((256, self.dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            random = np.random.default_rng([7, code])
            self.letters[code] = random.integers(0, 2, self.dimensions).astype(np.int8) * 2 - 1
        return self.letters[code]

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Places of the n-grams' vectors."""
        for code in codes.tolist():
            if code not in self.at:
                place = len(self.at)
                if place == len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                vector = np.ones(self.dimensions, np.int8)
                for i in range(GRAM):
                    vector *= np.roll(self.letter((code >> (21 * i)) & 0x1FFFFF), i)
                self.vectors[place] = vector
                self.at[code] = place
        return np.fromiter(map(self.at.__getitem__, codes.tolist()), np.int64, len(codes))

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text; zeros for one without letters.  Counts go in by their square root,
        so that a few very common n-grams do not drown the rest."""
        if len(self.at) > _REMEMBERED:
            self.forget()
        found = [gram_counts(x or "") for x in texts]
        every = np.unique(np.concatenate([c for c, _ in found]))
        weights = np.zeros((len(texts), len(every)), np.float32)
        for i, (codes, counts) in enumerate(found):
            weights[i, np.searchsorted(every, codes)] = np.sqrt(counts)
        places = self.rows(every)  # may move the vectors
        total = np.zeros((len(texts), self.dimensions), np.float32)
        for lo in range(0, len(places), 4096):
            total += weights[:, lo : lo + 4096] @ self.vectors[places[lo : lo + 4096]].astype(np.float32)
        return total


@lru_cache(maxsize=1)
def _space(dimensions: int) -> _Space:
    return _Space(dimensions)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x.astype("f8") ** 2).sum(1, keepdims=True))
    return np.divide(x, length, out=np.zeros(x.shape, "f8"), where=length > 0)


def learn(df: DataFrame, text: str, label: str, row_hash: Column, rows: int = TRAINING_ROWS, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The prototype of each label.  ``row_hash`` (a 64-bit number) decides which rows are learned from."""
    named_rows = df.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"), row_hash.alias("drawn"))
    labelled = named_rows.filter("label is not null and text is not null")
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}  # one row per language
    if sum(sizes.values()) > rows:
        shares = [(name, int(1_000_000 * rows / len(sizes) / n)) for name, n in sorted(sizes.items())]
        share = F.create_map(*[F.lit(x) for pair in shares for x in pair])[F.col("label")]
        labelled = labelled.filter(F.pmod("drawn", F.lit(1_000_000)) < share).dropDuplicates(["label", "drawn"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for lo in range(0, len(texts), _TOGETHER):
                unit = _unit(_space(dimensions).bundle(texts[lo : lo + _TOGETHER]))
                for name in set(labels[lo : lo + _TOGETHER]):
                    part = unit[labels[lo : lo + _TOGETHER] == name].sum(0)
                    total[name] = total.get(name, 0) + part
        names = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([total[x].tolist() for x in names], pa.list_(pa.float64()))],
            ["label", "total"],
        )

    parts = labelled.select("text", "label").mapInArrow(sums, "label string, total array<double>")
    added = (
        parts.select("label", F.posexplode("total").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.sum(F.round("x", 9).cast("decimal(28,9)")).cast("double").alias("x"))  # the same in any order of tasks
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("xs"))
        .select("label", F.col("xs.x").alias("x"))
    )
    return {r["label"]: np.array(r["x"]) for r in added.collect()}  # one row per language


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """``df`` with lang_pred and score."""
    kept = df.select(*[c for c in df.columns if c not in ("lang_pred", "score")])
    names = sorted(prototypes)
    matrix = _unit(np.array([prototypes[x] for x in names]).reshape(len(names), dimensions))
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at = kept.columns.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            preds, scores = [], []
            for lo in range(0, batch.num_rows, _TOGETHER):
                vectors = _space(dimensions).bundle(texts.slice(lo, _TOGETHER).to_pylist())
                cosine = _unit(vectors) @ matrix.T if names else np.zeros((len(vectors), 1))
                best = cosine.argmax(1)
                known = vectors.any(1) & bool(names)
                preds += [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist(), strict=True)]
                scores.append(np.where(known, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(preds, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                schema.names,
            )

    return kept.mapInArrow(predict, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text (null: empty) mod 4 is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn_documents(documents: DataFrame, rows: int = TRAINING_ROWS) -> dict[str, np.ndarray]:
    return learn(documents.filter(~held_out(F.col("doc_id"))), "text", "lang", F.xxhash64("doc_id", "text"), rows)


@named("op8_langid")
def op8_langid(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    prototypes = learn_documents(documents)
    predicted = identify(documents.select("doc_id", "text"), prototypes)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
