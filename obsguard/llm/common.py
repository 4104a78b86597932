"""Helpers of the training-data operators: table reads, stored intermediate tables, text batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows with this remainder of crc32(doc_id as text) mod 4 are held out of every fit.
HELD_OUT_REMAINDER = 2

_own_folder: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a folder of our own only in a local session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="obsguard-"))
    return _own_folder[0]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_kept: dict = {}


def kept_in_worker(key: tuple, build: Callable[[], object]) -> object:
    """What ``build`` makes, kept in this Python worker from task to task; one thing at a time, so that
    the operators of a pipeline, which share workers, do not add up their caches."""
    if key not in _kept:
        free_worker()
        _kept[key] = build()
    return _kept[key]


def free_worker() -> None:
    """Let go of what another operator kept in this worker, and hand its memory back to the machine."""
    _kept.clear()
    release_memory()


def release_memory() -> None:
    """Give back what Arrow's and C's allocators hold without need; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def tidy(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` for mapInArrow, with unused memory handed back after each task: a worker waits beside the JVM for the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release_memory()

    return run


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    """True for the rows that no fit may see; a null id is never learned from either, yet not held out."""
    return F.coalesce(remainder(doc_id) == HELD_OUT_REMAINDER, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) != HELD_OUT_REMAINDER, F.lit(False))


def labelled(documents: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, text, y): learnable documents with one label each; contradicting or null labels are left out."""
    one = (
        labels.where(F.col(column).isNotNull() & learnable(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(column).alias("y"), F.max(column).alias("_most"))
        .where("y = _most")
        .select("doc_id", F.col("y").cast("int").alias("y"))
    )
    return documents.select("doc_id", "text").where(learnable(F.col("doc_id"))).join(one, "doc_id")


def text_chunks(batch: pa.RecordBatch, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` cut by rows into slices of about ``budget`` bytes of text; a longer text is a slice alone."""
    column = batch.column("text")
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    group = np.cumsum(size) // budget
    edges = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *edges], [*edges, len(size)], strict=True):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the bits of each element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
