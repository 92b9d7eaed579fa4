"""Session settings the library reads, and the shared folder it writes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_DEFAULTS = {
    # A table is broadcast only when its measured width stays under this.
    "spark.ledgerloom.broadcastBytes": 32 * 1024 * 1024,
    # All tables one call broadcasts together stay under this.
    "spark.ledgerloom.broadcastTotalBytes": 128 * 1024 * 1024,
    # An ordered running total gives each task about this many rows.
    "spark.ledgerloom.rowsPerTask": 1_000_000,
}


def setting(spark: SparkSession, name: str) -> int:
    key = f"spark.ledgerloom.{name}"
    return int(spark.conf.get(key, str(_DEFAULTS[key])))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session that names none gets a temporary folder; on a cluster that would put
    files where no other machine sees them, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return context.getCheckpointDir()


_scope: ContextVar[str] = ContextVar("scope", default="session")


def stage_path(spark: SparkSession) -> str:
    """A new, unused path for intermediate data, grouped by application and by ``staging`` scope."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/ledgerloom/{app}/{_scope.get()}/{uuid.uuid4().hex}"


def output_path(spark: SparkSession) -> str:
    """A new path for results.  Nothing here is ever released."""
    return f"{shared_folder(spark)}/ledgerloom-output/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end; write the results before."""
    name = uuid.uuid4().hex
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)
        _delete(spark, f"/{name}")


def release_staged(spark: SparkSession) -> None:
    """Delete every table this application staged (call when its results are written)."""
    _delete(spark, "")


def _delete(spark: SparkSession, below: str) -> None:
    jvm = spark.sparkContext._jvm
    app = spark.sparkContext.applicationId
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/ledgerloom/{app}{below}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
