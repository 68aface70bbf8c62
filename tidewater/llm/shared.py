"""Helpers that several operators of this package use."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import shared_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: later steps start from files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_split(id_col: str, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def give_back() -> None:
    """Return what this process has freed to the system. A Python worker outlives its task, and the C library keeps freed
    blocks below a block in use, so without this an executor holds the most that each of its workers ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others return memory by themselves
    if trim is not None:
        trim(0)


def by_characters(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts in column have at most so many characters together, or are one text: a task holds
    no more of them as Python values at a time, however many rows a batch has."""
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, ends = 0, np.cumsum(sizes)
        while at < batch.num_rows:
            held = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, held + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()
