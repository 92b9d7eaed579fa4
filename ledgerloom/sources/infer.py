"""Types of CSV files, found from all of their values in one pass.

What is known of a column is a small state: whether it holds text, whether it holds fractions, the
extremes of its integers.  States of batches, tasks and files merge by maximum and minimum, so the
order and the number of parts do not matter, and one odd value in the last row counts as much as the
first.  Files read together (training and test) get one common type for each column they share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import _CSV, read_csv

_INTEGER = r"^[+-]?[0-9]{1,37}$"
_NUMBER = r"^(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|NaN)$"
_STATE = "column string, text boolean, fraction boolean, low decimal(38,0), high decimal(38,0)"
_TYPES = (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63))


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state for each column and batch."""
    whole = pa.decimal128(38, 0)
    for batch in batches:
        rows = []
        for name, values in zip(batch.schema.names, batch.columns, strict=True):
            values = values.drop_null()
            integer = pc.match_substring_regex(values, _INTEGER)
            other = values.filter(pc.invert(integer))
            number = pc.match_substring_regex(other, _NUMBER)
            digits = pc.replace_substring_regex(values.filter(integer), r"^\+", "")
            ends = pc.min_max(digits.cast(whole)).as_py()
            text = bool(pc.any(pc.invert(number)).as_py())
            rows.append((name, text, bool(pc.any(number).as_py()), ends["min"], ends["max"]))
        names, texts, fractions, lows, highs = zip(*rows, strict=True) if rows else ([],) * 5
        arrays = [pa.array(names, pa.string()), pa.array(texts, pa.bool_()), pa.array(fractions, pa.bool_()), pa.array(lows, whole), pa.array(highs, whole)]
        yield pa.RecordBatch.from_arrays(arrays, names=["column", "text", "fraction", "low", "high"])


def column_states(df: DataFrame) -> DataFrame:
    """One state for each column of a table of text; columns without any row are left out.

    What is shuffled is one row for each column and task, whatever the number of rows.
    """
    return merged(df.mapInArrow(_states, _STATE))


def merged(states: DataFrame) -> DataFrame:
    folded = [F.bool_or("text"), F.bool_or("fraction"), F.min("low"), F.max("high")]
    return states.groupBy("column").agg(*[f.alias(c) for f, c in zip(folded, ("text", "fraction", "low", "high"), strict=True)])


def _type(state) -> str:
    if state is None or (not state["text"] and not state["fraction"] and state["low"] is None):
        return "double"
    if state["text"]:
        return "string"
    if not state["fraction"]:
        for name, bits in _TYPES:
            if -(2**bits) <= state["low"] and state["high"] < 2**bits:
                return name
    return "double"


def infer_schemas(spark: SparkSession, *paths: str, multiline: bool = False) -> list[T.StructType]:
    """The schema of each path, each column with the type that holds its values in all of them.

    Integers take the smallest integer type, beyond 64 bits ``double``; numbers with a point or an
    exponent (and ``NaN``) are ``double``, and so is a column without values; all else is text, also
    numbers with blanks around them.  Columns that only some files have take their type from those.
    """
    raw = [spark.read.options(**_CSV, multiLine=multiline).csv(p) for p in paths]
    parts = [df.mapInArrow(_states, _STATE) for df in raw if df.columns]
    found = {}
    if parts:
        states = parts[0]
        for more in parts[1:]:
            states = states.unionAll(more)
        found = {s["column"]: s for s in merged(states).collect()}  # one row for each column
    return [T.StructType([T.StructField(c, T._parse_datatype_string(_type(found.get(c)))) for c in df.columns]) for df in raw]


def read_csv_inferred(spark: SparkSession, *paths: str, multiline: bool = False) -> list[DataFrame]:
    """Each path as a table, with the common types of all."""
    schemas = infer_schemas(spark, *paths, multiline=multiline)
    return [read_csv(spark, p, s, multiline=multiline) for p, s in zip(paths, schemas, strict=True)]
