"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_path

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new folder of the cluster's shared storage and read it back.

    Cuts the lineage: what is read afterwards survives the loss of any executor and is the same in
    every later job, whatever order or task ids the first computation had.
    """
    path = stage_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(df: DataFrame) -> int:
    """The number of reducers the session is set to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
