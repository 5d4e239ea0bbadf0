"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laketier.session import checkpoint_dir, ensure_checkpoint_dir

# The white space of every contract: blank and \t \n \v \f \r, as a Java pattern.
BLANKS = r"[\x20\x09-\x0D]+"

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
DEFAULT_BATCH_ROWS, BATCH_ROWS = "10000", "2000"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    A plain local session (tests, a laptop) without that setting gets a folder of
    its own; on a cluster a missing setting is an error.
    """
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        ensure_checkpoint_dir(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application (Spark's own
    ``addPyFile``), so that operators run whether or not it is installed there. Whole
    texts also need smaller Arrow batches than Spark's default of 10,000 rows; a
    session's own choice of that setting is left alone."""
    if spark.conf.get(BATCH_SETTING) == DEFAULT_BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_laketier_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="laketier-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(archive))
    context._laketier_shipped = True


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage at a copy that outlives any executor, fixes the rows for
    every later reader, and gives joins a side with a known size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (NULL for a NULL id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` that gives memory back when its task ends: Spark
    keeps the worker for later tasks, and what allocators hold on to would add up over
    the operators it has served."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not glibc
                pass
    return wrapped


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
