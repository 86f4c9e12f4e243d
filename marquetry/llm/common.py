"""Reading tables, shared scratch space and byte-bounded Arrow slices."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that a Python worker works on at once.
SLICE_BYTES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, below a local one, in local mode (tests) only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="marquetry-")
        atexit.register(shutil.rmtree, local, True)
        root = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/marquetry-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended before the interpreter
        return


#: Scratch tables of the operator that is running; they go at its end.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)
#: Shuffle files go with the action that wrote them; inside a scope every action writes a table that is read from then on.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scoped(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside go at the end, but for those with `keep`, and shuffle files with their actions."""
    before = spark.conf.get(CLEANUP, "false")
    own: list[str] = []
    token = _SCOPE.set(own)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        _SCOPE.reset(token)
        spark.conf.set(CLEANUP, before)
        for path in own:
            _remove(spark, path)


def stored(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: it is computed once, and a lost executor costs nothing written.

    The table goes with the scope it is in (`scoped`); with `keep`, or outside of one, at the interpreter's exit.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    scope = _SCOPE.get()
    if scope is None or keep:
        atexit.register(_remove, spark, path)
    else:
        scope.append(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@lru_cache(1)
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def give_back() -> None:
    """Return freed memory to the system, as a worker stays after its task."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `limit` bytes of `column` (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + limit, side="right")))
            yield batch.slice(begin, end - begin)
            give_back()
            begin = end


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array without copying; null counts as empty."""
    array = pa.compute.fill_null(array, "").cast(pa.large_string())
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
