"""Row-quality operators: required columns, one row per key, valid and invalid counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS, DISTINCT_ROWS, VALID = "_rows", "_distinct_rows", "_valid"

# Why a row is not kept, as bits that add up.
NULL_KEY, COPY, SUPERSEDED, OUT_OF_RANGE = 1, 2, 4, 8
REASON_NAMES = {NULL_KEY: "null key", COPY: "copy", SUPERSEDED: "superseded", OUT_OF_RANGE: "out of range"}
REASONS, N_ROWS = "reasons", "n_rows"


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(all_present(columns))


def latest_first(df: DataFrame, keys: Sequence[str], order_col: str | None) -> list[str]:
    """The columns that rank the rows of a key: ``order_col``, then all the rest.

    Ranking by every column makes the order total, so the surviving row is the same in every run
    and after every retry; rows that still tie are identical.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    return ([order_col] if order_col and order_col not in keys else []) + rest


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    order_col: str | None = "load_date",
) -> DataFrame:
    """First row per key in ``order_by`` order; by default the latest ``order_col``.

    ``row_number() = 1`` is planned as a group limit on both sides of the shuffle: a task sends at
    most one row per key, so a key that holds a third of the table costs one row per map task.
    """
    if order_col is not None and order_col not in df.columns:
        order_col = None
    ties = [F.col(c).desc_nulls_last() for c in latest_first(df, keys, order_col)]
    order = [*(order_by or []), *ties] or [F.col(k) for k in keys]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    )


def key_groups(df: DataFrame, keys: Sequence[str], order_col: str | None = "load_date") -> DataFrame:
    """One row per key: the row ``dedupe_by_key`` keeps, its number of rows and of distinct rows.

    Rows are dealt by all their columns and sorted there, in partitions of the size a shuffle gives; nothing
    is held by the tasks that read the table, which would spill most of a large file to find few copies. The
    same sort serves the first step of the rows of a key, so a hot key costs one row per task. Null keys form groups
    of their own, so nothing is lost from the counts.
    """
    if order_col is not None and order_col not in df.columns:
        order_col = None
    ranked = latest_first(df, keys, order_col)
    copies = Window.partitionBy(*keys, *ranked).orderBy(*keys)
    marked = df.withColumn(DISTINCT_ROWS, F.row_number().over(copies) == 1)
    counts = [F.count(F.lit(1)).alias(ROWS), F.count_if(F.col(DISTINCT_ROWS)).alias(DISTINCT_ROWS)]
    if not ranked:
        return marked.groupBy(*keys).agg(*counts).select(*df.columns, ROWS, DISTINCT_ROWS)
    grouped = marked.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_top"), *counts)
    columns = [F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns]
    return grouped.select(*columns, ROWS, DISTINCT_ROWS)


def quality_groups(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    accept: Column | None = None,
    order_col: str | None = "load_date",
) -> DataFrame:
    """``key_groups`` with a flag for the groups whose kept row is valid.

    ``required`` must be part of ``keys``: a row without one of them is never valid, whatever the
    other rows of its group hold. ``accept`` is tested on the kept row only.
    """
    missing = set(required) - set(keys)
    if missing:
        raise ValueError(f"required columns outside the key: {sorted(missing)}")
    return key_groups(df, keys, order_col).withColumn(VALID, is_valid(required, accept))


def is_valid(required: Sequence[str], accept: Column | None = None) -> Column:
    """Whether the kept row of a group has all required columns and passes the value test."""
    valid = all_present(required)
    return valid if accept is None else valid & F.coalesce(accept, F.lit(False))


def quality_totals() -> list[Column]:
    """Aggregates over ``quality_groups``.

    The kept rows are part of the source and pairwise distinct, so the number of distinct source
    rows outside them (EXCEPT DISTINCT) is the difference of the two counts; no second pass over
    the source and no join is needed.
    """
    total, distinct = F.sum(ROWS), F.sum(DISTINCT_ROWS)
    valid = F.count_if(F.col(VALID))
    return [
        F.coalesce(total, F.lit(0)).cast("long").alias("total"),
        valid.alias("valid"),
        (F.coalesce(distinct, F.lit(0)) - valid).cast("long").alias("invalid_distinct"),
        (F.coalesce(total, F.lit(0)) - valid).cast("long").alias("invalid_total"),
    ]


def quality_counts(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    accept: Column | None = None,
    order_col: str | None = "load_date",
) -> DataFrame:
    """One row: total, valid, invalid_distinct and invalid_total."""
    return quality_groups(df, keys, required, accept, order_col).agg(*quality_totals())


def verdicts(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    accept: Column | None = None,
    order_col: str | None = "load_date",
    dealt: bool = False,
) -> DataFrame:
    """The distinct rows of ``df`` with ``reasons``, 0 for the rows that stay, and ``n_rows``, how many
    rows of ``df`` that is said of. The numbers add up to the rows of ``df``.

    A row without a required column has a null key. Of the others of a key, all but the latest are
    superseded. Any row may be out of range, which ``accept`` says. The one row of a key that stays does so
    once; its further copies are a second line. ``required`` must be part of ``keys``.

    Rows are dealt by all their columns and copies collapse there, as in ``key_groups``: a task that reads a
    large file would hold or spill nearly all its rows to find few copies. The latest row of a key is an
    aggregate too, kept for keys of several rows; the two meet in an equi-join, whose hot keys adaptive execution
    splits. Only copies of one row meet in a single task.

    ``dealt`` says that ``df`` is dealt by some of ``keys``: then nothing is shuffled here, and the rows of a key are
    ranked as a sorted stream in the one task that has them.
    """
    missing = set(required) - set(keys)
    if missing:
        raise ValueError(f"required columns outside the key: {sorted(missing)}")
    if order_col is not None and order_col not in df.columns:
        order_col = None
    ranked = latest_first(df, keys, order_col)
    distinct = (df if dealt else df.repartition(*df.columns)).groupBy(*df.columns).agg(F.count(F.lit(1)).alias(ROWS))
    whole, fits = all_present(required), F.lit(True)
    if accept is not None:
        fits = F.coalesce(accept, F.lit(False))
    superseded = F.lit(False)
    if ranked and dealt:
        window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ranked])
        distinct = distinct.withColumn("_late", F.row_number().over(window) > 1)
        superseded = F.col("_late")
    elif ranked:  # otherwise equal keys are equal rows
        rank = F.struct(*[F.col(f"d.{c}") for c in ranked])
        # Every row takes part, null keys too, so that both uses of the distinct rows share one shuffle.
        latest = distinct.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_top"), F.count(F.lit(1)).alias("_n"))
        latest = latest.filter(F.col("_n") > 1).drop("_n")  # a single row is the latest
        same = reduce(and_, [F.col(f"d.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys])
        distinct = distinct.alias("d").join(latest.alias("l"), same, "left").select("d.*", (rank != F.col("_top")).alias("_late"))
        superseded = F.coalesce("_late", F.lit(False))
    reasons = (
        F.when(whole, F.when(superseded, SUPERSEDED).otherwise(0)).otherwise(NULL_KEY)
        + F.when(fits, 0).otherwise(OUT_OF_RANGE)
    )
    one = F.lit(1).cast("long")

    def line(why: Column, n: Column) -> Column:
        return F.struct(why.cast("int").alias(REASONS), n.alias(N_ROWS))

    lines = F.when(F.col("_why") > 0, F.array(line(F.col("_why"), F.col(ROWS))))
    lines = lines.when(F.col(ROWS) == 1, F.array(line(F.lit(0), one)))
    lines = lines.otherwise(F.array(line(F.lit(0), one), line(F.lit(COPY), F.col(ROWS) - 1)))
    return distinct.withColumn("_why", reasons).select(*df.columns, F.inline(lines))


def verdict_totals() -> list[Column]:
    """Aggregates over ``verdicts``: the same numbers as ``quality_totals`` gives."""
    total, valid = F.coalesce(F.sum(N_ROWS), F.lit(0)), F.count_if(F.col(REASONS) == 0)
    return [
        total.cast("long").alias("total"),
        valid.alias("valid"),
        F.count_if((F.col(REASONS) != 0) & (F.col(REASONS) != COPY)).alias("invalid_distinct"),
        (total - valid).cast("long").alias("invalid_total"),
    ]


def reason_names(reasons: Column) -> Column:
    """The bits of ``reasons`` in words."""
    names = [F.when(reasons.bitwiseAND(bit) != 0, F.lit(name)) for bit, name in REASON_NAMES.items()]
    return F.array_compact(F.array(*names))


def invalid_rows(df: DataFrame, kept: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``kept`` (EXCEPT DISTINCT).

    A tagged union and one hash aggregate instead of a null-safe anti join on every column: copies
    collapse before the shuffle, so a row repeated through a third of the table stays cheap.
    """
    tagged = df.withColumn("_kept", F.lit(False)).unionByName(
        kept.select(*df.columns).withColumn("_kept", F.lit(True))
    )
    return (
        tagged.groupBy(*df.columns)
        .agg(F.bool_or("_kept").alias("_kept"))
        .filter(~F.col("_kept"))
        .drop("_kept")
    )
