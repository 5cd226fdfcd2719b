"""Small helpers shared by the operators on documents."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import discard, scratch_path

# A side of a join is broadcast up to this many rows of a few numbers each (some tens of MB);
# beyond it the join is left to shuffle.
BROADCAST_ROWS = 1_000_000
# Bytes of text that a worker holds as Python objects at a time; a longer text is held alone.
SLICE_BYTES = 2_000_000
LEAN_ROWS, LEAN_BYTES = 1_000, 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


_scopes: list[list[str]] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: one evaluation, short lineage.

    The result reads that folder whenever it is evaluated, so the folder stays unless a ``scope`` ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_sets(df: DataFrame, name: str) -> DataFrame:
    """As ``staged``, for rows of some kilobytes: few of them go to a Python worker, or into a row group, at a
    time, so that neither the buffers between the two nor the writer's take much of an executor."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), LEAN_ROWS) if int(before) > 0 else LEAN_ROWS)
    path = scratch_path(spark, name)
    try:
        df.write.option("parquet.block.size", LEAN_BYTES).parquet(path)
    finally:
        spark.conf.set(key, before)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the folders staged inside when the block ends; those taken off the list stay. What is
    evaluated later must not read them."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.pop()
        for path in paths:
            discard(spark, path)


def release(spark: SparkSession) -> None:
    """Frees the shuffle files of plans that are done. Spark removes them when the driver collects the plans
    as garbage, which a driver with little to do may not do for a long time."""
    gc.collect()
    spark._jvm.System.gc()


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of narrow rows, marked for broadcast if it is counted to be small enough."""
    return F.broadcast(df) if df.count() <= limit else df


def slices(batches: Iterator[pa.RecordBatch], text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``size`` bytes of the column ``text``, without copies. What
    Arrow has kept for itself goes back to the system at the end, since workers live on after their task."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        # A row belongs to the slice that its first byte falls into, and a longer text begins one.
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = (ends - sizes) // size
        cuts = np.flatnonzero(np.append(True, (begin[1:] != begin[:-1]) | (sizes[1:] > size)))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def held_out():
    """True for rows whose labels are never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
