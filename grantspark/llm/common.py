"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import forget, materialize, shared_dir  # noqa: F401  (re-exported)

#: Fixed value: the white space between words, [\x20\x09-\x0D]; ``bytes.split()`` splits at the same bytes.
SPACE = "\\x20\\x09-\\x0D"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name``."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


#: Rows of an Arrow batch: texts are long, and a batch of Spark's default of 10,000 would hold many MB several times over.
BATCH_ROWS = 2000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    return T.StructType(list(schema) + list(T.StructType.fromDDL(ddl)))


def worker_state(key, make: Callable):
    """A value made once per Python worker (a tokenizer, a word cache) and kept for its later tasks.

    Only the latest is kept: workers outlive an operator, and the next one needs the memory.
    """
    box = sys.__dict__.setdefault("_grantspark_worker_state", {})
    if key not in box:
        release_worker_state()
        box[key] = make()
    return box[key]


def release_worker_state() -> None:
    """Drop what an earlier operator left in this worker, and give its memory back to the system."""
    box = sys.__dict__.get("_grantspark_worker_state")
    if box:
        box.clear()
        return_memory()


def return_memory() -> None:
    """Give what is free in this process back to the system, which Python and malloc else keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def copies(rows: DataFrame, most: int = 1 << 12) -> DataFrame:
    """Each row ``_n`` times, with ``_i`` counting from 0 in place of ``_n``; of a row with very many copies every task writes at most ``most``."""
    few = rows.filter(F.col("_n") <= most).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_i"))
    parts = rows.filter(F.col("_n") > most).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(most).cast("long"))).alias("_from"))
    spread = parts.repartition(F.xxhash64(*parts.columns)).select("*", F.explode(F.sequence("_from", F.least(F.col("_n"), F.col("_from") + most) - 1)).alias("_i"))
    return few.union(spread.drop("_from")).drop("_n")


def runs_of(column: pa.Array, most_bytes: int = 8 << 20) -> Iterator[pa.Array]:
    """An Arrow column of strings (null: empty) in runs of about ``most_bytes``."""
    column = column.fill_null("")
    ends = np.cumsum(pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield column.slice(start, stop - start)
        start = stop


def texts_of(column: pa.Array, most_bytes: int = 8 << 20) -> Iterator[list[str]]:
    """The strings of an Arrow column (null: empty) in runs of about ``most_bytes``, so that Python objects stay few."""
    for run in runs_of(column, most_bytes):
        yield run.to_pylist()


def over_texts(fn: Callable[[list[str]], Iterable], returns: pa.DataType, column: pa.Array) -> pa.Array:
    """``fn`` maps a run of texts to as many values."""
    parts = [pa.array(fn(run), type=returns) for run in texts_of(column)]
    return pa.concat_arrays(parts) if parts else pa.array([], type=returns)


def crc_of_id(column: Column | str) -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) if isinstance(column, str) else F.crc32(column.cast("string").cast("binary"))


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
