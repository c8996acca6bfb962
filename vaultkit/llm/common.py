"""Helpers shared by the operators: table access, landed intermediates, Arrow batches in slices."""

from __future__ import annotations

import contextlib
import ctypes
import pickle
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from vaultkit.session import delete_at_end, ensure_checkpoint_dir, materialize

SLICE_CHARS = 1_000_000   # text handled at once inside a task; longer texts are whole slices of their own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write once into the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    return materialize(df, name)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value):
    """A session setting for the jobs that run inside; None leaves it as it is."""
    old = spark.conf.get(key, None)
    try:
        if value is not None:
            spark.conf.set(key, str(value))
        yield
    finally:
        if value is not None:
            spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def passing_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared one; it is deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    return path


def shared_folder(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def slices(column: pa.Array, limit: int = SLICE_CHARS):
    """(first row, list of bytes or None) of a text column, about ``limit`` bytes at a time; no text is cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.cast(pa.large_binary())
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(values), 0))
    ends = np.cumsum(sizes)
    at, n = 0, len(values)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield at, values.slice(at, stop - at).to_pylist()
        at = stop


BATCH_ROWS = 2_000


def tasks(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` that keeps workers small: batches of at most ``BATCH_ROWS`` texts, and
    freed memory goes back to the system at a task's end, as a worker process serves many tasks."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark = df.sparkSession
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)

    def trimmed(batches):
        yield from run(batches)
        give_back()

    return df.mapInArrow(trimmed, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores added to any that ``df`` has as a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def share(spark: SparkSession, value):
    """Broadcast an object of this subpackage's classes by value: executors need no copy of the code."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(broadcast):
    return pickle.loads(broadcast.value)


def give_back() -> None:
    """Return freed memory of the Arrow pool and the C library to the system, where the platform can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def segments(lengths: np.ndarray) -> np.ndarray:
    """Offsets of consecutive runs with these lengths, with the total appended."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
