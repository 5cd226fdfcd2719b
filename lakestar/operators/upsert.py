"""Keyed upsert of a batch into a table, as a plan over two DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import dedupe_by_key, latest_first


def _same_key(left: str, right: str, columns: Sequence[str]) -> Column:
    # A null key part matches a null key part, so that loading a batch twice changes nothing.
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _in_one_window(target: DataFrame, batch: DataFrame, match: Sequence[str], order_col: str) -> DataFrame:
    rows = target.withColumn("_fresh", F.lit(False)).unionByName(batch.withColumn("_fresh", F.lit(True)))
    ranked = [F.col(c).desc_nulls_last() for c in latest_first(target, match, order_col)]
    window = Window.partitionBy(*match).orderBy(F.col("_fresh").desc(), *ranked)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"_rank": F.row_number().over(window), "_replaced": F.first("_fresh").over(upto)})
    kept = (F.col("_fresh") & (F.col("_rank") == 1)) | ~F.col("_replaced")
    return rows.filter(kept).select(*target.columns)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_col: str,
    scope: str = "table",
    partition_cols: Sequence[str] = (),
    keep_newer: bool = False,
    together: bool = False,
    unique: bool = False,
) -> DataFrame:
    """The table after the batch: newest batch row per key, plus the target rows it leaves alone.

    ``scope="table"`` makes a key unique in the table, ``scope="partition"`` inside a partition.
    A batch row replaces the stored one; with ``keep_newer`` only if its ``order_col`` is not older.

    The target is only the streamed side of an anti join against the bare keys of the batch.
    Spark broadcasts those when their measured size allows, and the table is then not shuffled.

    ``together`` is for a batch that is no small part of the table: one window over the rows of both. Each
    input is read once and shuffled once, or not at all where both are dealt by some of the keys. ``unique`` says
    that the batch holds one row per key already.
    """
    if scope not in ("table", "partition"):
        raise ValueError(f"unknown upsert scope: {scope}")
    if scope == "partition" and not partition_cols:
        raise ValueError("partition scope needs partition columns")
    match = [*keys, *(c for c in partition_cols if scope == "partition" and c not in keys)]

    batch = batch.select(*target.columns)
    if together:
        if keep_newer:
            raise ValueError("keep_newer compares the batch with the stored rows and needs their join")
        return _in_one_window(target, batch, match, order_col)
    fresh = batch if unique else dedupe_by_key(batch, match, order_col=order_col)
    if keep_newer:
        stored = target.select(*match, F.col(order_col).alias("_stored_order")).alias("s")
        is_older = F.col("s._stored_order") > F.col(f"f.{order_col}")
        fresh = fresh.alias("f").join(stored, _same_key("f", "s", match) & is_older, "left_anti")
    # The keys come from the deduplicated rows: both uses need all columns up to the window, so
    # they share one shuffle and a costly batch plan runs once.
    untouched = target.alias("t").join(
        fresh.select(*match).alias("r"), _same_key("t", "r", match), "left_anti"
    )
    return untouched.unionByName(fresh)
