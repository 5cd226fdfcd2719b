"""Table loads: read, transform, store, count and log one table.

Intermediate results that are needed more than once are written to the scratch folder and read
back. That cuts the lineage, so a lost executor never recomputes a whole load, and it keeps each
heavy plan to one evaluation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import N_ROWS, REASONS, VALID, quality_totals, verdict_totals
from ..operators.scd2 import DEFAULT_ACTOR, scd2_changes
from ..operators.upsert import upsert
from ..sources.audit import LoadAudit
from ..sources.feeds import read_feed
from ..sources.tables import (
    blank_partitions_to_null,
    discard,
    expire_snapshots,
    latest_in_batch,
    merge_partitions,
    overwrite_partitions,
    read_table,
    require_layout,
    scratch_path,
    table_count,
    write_full_reload,
    write_snapshot,
)
from ..specs import FEEDS, LOAD_DATE, DimensionSpec, FeedSpec, SilverSpec, TableSpec
from .bronze import add_audit
from .silver import bronze_columns, clean_names, feed_verdicts, standardize, valid_groups

KEEP_SNAPSHOTS = 3


@dataclass(frozen=True)
class LoadResult:
    table: str
    pre_count: int
    post_count: int
    # Set by Silver loads only.
    total: int | None = None
    valid: int | None = None
    invalid_distinct: int | None = None
    invalid_total: int | None = None


@contextmanager
def staged(
    spark: SparkSession, df: DataFrame, name: str, root: str, partition_by: Sequence[str] = ()
) -> Iterator[DataFrame]:
    """``df`` as a written table for the time of the block; ``root`` is the table it is meant for."""
    path = scratch_path(spark, name, root)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression="zstd")
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)


def ingest_feed(
    spark: SparkSession,
    source: str,
    target: str,
    app: str,
    table: str,
    as_of: dt.date,
    audit: LoadAudit,
    fmt: str = "csv",
    delimiter: str = ",",
    required: Sequence[str] = (),
) -> LoadResult:
    """Bronze: a full reload of one feed. Rows are counted by the write itself.

    A delivery without all ``required`` columns, as a wrong header or delimiter makes it, fails before
    the stored feed is touched. Further columns are stored too.
    """
    with audit.load(app, table, 0) as outcome:
        counted = Observation(f"ingest {table}")
        delivered = read_feed(spark, source, fmt, delimiter)
        missing = [c for c in required if c not in delivered.columns]
        if missing:
            raise ValueError(f"{source} has no columns {missing}, only {delivered.columns}")
        feed = add_audit(delivered, as_of)
        feed = feed.observe(counted, F.count(F.lit(1)).alias("row_count"))
        write_full_reload(feed, target, [LOAD_DATE])
        outcome.row_count = counted.get["row_count"]
    return LoadResult(table, 0, outcome.row_count)


def ingest_from_spec(
    spark: SparkSession, spec: Row, as_of: dt.date, audit: LoadAudit, scheme: str = "gs://"
) -> LoadResult:
    """Bronze load of one row of ``enabled_specs``."""
    return ingest_feed(
        spark,
        f"{scheme}{spec.inbound_bucket}/{spec.raw_file_path}{spec.raw_file_name}",
        spec.bronze_file_path,
        spec.app_name,
        spec.bronze_table_name,
        as_of,
        audit,
        spec.raw_file_format,
        spec.delimiter,
        FEEDS[spec.app_name].columns if spec.app_name in FEEDS else (),
    )


JOB_ID = "job_id"


def store_rejected(spark: SparkSession, rejected: DataFrame, root: str, job_id: int) -> None:
    """Stores the rejected rows of a job in place of those it may have stored before."""
    if rejected.isEmpty():
        discard(spark, f"{root}/{JOB_ID}={job_id}")
    else:
        overwrite_partitions(rejected.withColumn(JOB_ID, F.lit(job_id).cast("long")), root, [JOB_ID])


def read_rejected(spark: SparkSession, root: str, feed: FeedSpec) -> DataFrame:
    """Rows that loads did not keep: those of the feed, why, how many copies, and which job."""
    columns = [f"`{c}` string" for c in feed.columns]
    columns += [f"{LOAD_DATE} date", f"{N_ROWS} bigint", f"{REASONS} int", f"{JOB_ID} bigint"]
    return read_table(spark, root, StructType.fromDDL(", ".join(columns)))


def load_silver(
    spark: SparkSession,
    bronze: DataFrame,
    root: str,
    spec: SilverSpec,
    audit: LoadAudit,
    scope: str = "bucket",
    keep_newer: bool = False,
    keep_snapshots: int = KEEP_SNAPSHOTS,
    quarantine: str | None = None,
) -> LoadResult:
    """Silver: valid rows of a Bronze table, upserted.

    One pass over Bronze gives the rows and all counts. The counts are observed in the stage that
    writes the staged rows, where a retried task is counted once.

    With ``scope="bucket"`` a key is unique in the table, which is stored by a hash of the key: a load
    reads and rewrites the buckets its batch has keys in, in place. ``scope="table"`` keeps the partitions of
    the spec, between which a key may move, so every load writes a new snapshot of the whole table; all but
    the newest ``keep_snapshots`` go, so that readers of the one before can finish. With
    ``scope="partition"`` a key is unique in its partition and the touched ones are rewritten in place. A
    table keeps the scope of its first load; another one fails before anything is written.

    With ``quarantine``, a folder, the same pass over Bronze also yields the rows that are not kept, with
    the reasons, and they are stored there under the job's id; running the job again replaces them.
    """
    if scope not in ("bucket", "table", "partition"):
        raise ValueError(f"unknown load scope: {scope}")
    pre = table_count(spark, root, spec.schema)
    with audit.load(spec.app, spec.name, pre) as outcome:
        require_layout(spark, root, snapshots=scope == "table")
        counted = Observation(f"quality {spec.name}")
        with ExitStack() as stages:
            unique, clean = scope == "bucket", {}
            if quarantine is None:
                clean = clean_names(spec)
                groups = valid_groups(bronze, spec).observe(counted, *quality_totals())
                valid = groups.filter(VALID).select(*bronze_columns(spec.feed), *clean.values())
            else:
                judged = feed_verdicts(bronze, spec.feed).observe(counted, *verdict_totals())
                judged = stages.enter_context(staged(spark, judged, spec.name, root, [REASONS]))
                store_rejected(spark, judged.filter(F.col(REASONS) != 0), quarantine, audit.job_id)
                valid = judged.filter(F.col(REASONS) == 0).select(*bronze_columns(spec.feed))
                if unique:  # one shuffle for the item rows of a key and for its latest row
                    valid = valid.repartition(*[spec.convert[k](F.col(k)) for k in spec.keys])
            batch = blank_partitions_to_null(standardize(valid, spec, clean), spec.partition_by)
            if unique:  # rows are dealt by the clean key
                batch = latest_in_batch(batch, spec.bucketed())
            batch = stages.enter_context(staged(spark, batch, f"{spec.name}_batch", root))
            if scope == "bucket":
                if not batch.isEmpty():
                    merge_partitions(spark, root, spec.bucketed(), batch, keep_newer, unique)
            elif scope == "partition":
                merge_partitions(spark, root, spec, batch, keep_newer)
            else:
                table = read_table(spark, root, spec.schema)
                merged = upsert(
                    table, batch, spec.keys, spec.order_col, scope, keep_newer=keep_newer
                )
                write_snapshot(spark, merged, root, spec.partition_by)
                expire_snapshots(spark, root, keep_snapshots)
        outcome.row_count = table_count(spark, root, spec.schema)
    return LoadResult(spec.name, pre, outcome.row_count, **counted.get)


def load_dimension(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    spec: DimensionSpec,
    as_of: dt.date,
    audit: LoadAudit,
    actor: str = DEFAULT_ACTOR,
    every_key_open: bool = False,
) -> LoadResult:
    """Gold dimension: the change set of a Silver table, applied in place.

    All change rows are open or end on the day before ``as_of``. The record key holds the end date, so only
    that day and the buckets of the changed keys among the open rows can hold rows to replace: nothing else
    is read for the merge or written, neither older history nor the other buckets.
    """
    pre = table_count(spark, root, spec.schema)
    with audit.load(spec.app, spec.name, pre) as outcome:
        dim = read_table(spark, root, spec.schema)
        changes = scd2_changes(
            source.select(*spec.source_columns), dim, spec, as_of, actor, every_key_open
        )
        changes = latest_in_batch(changes, spec.table)
        with staged(spark, changes, spec.name, root) as batch:
            if not batch.isEmpty():
                merge_partitions(spark, root, spec.table, batch, unique=True)
        outcome.row_count = table_count(spark, root, spec.schema)
    return LoadResult(spec.name, pre, outcome.row_count)


def load_fact(
    spark: SparkSession, facts: DataFrame, root: str, spec: TableSpec, audit: LoadAudit
) -> LoadResult:
    """Gold fact: upserted month by month; the month follows from the date key in the record key."""
    pre = table_count(spark, root, spec.schema)
    with audit.load(spec.app, spec.name, pre) as outcome:
        with staged(spark, facts.select(*spec.schema.names), spec.name, root) as batch:
            if not batch.isEmpty():
                merge_partitions(
                    spark, root, spec, blank_partitions_to_null(batch, spec.partition_by)
                )
        outcome.row_count = table_count(spark, root, spec.schema)
    return LoadResult(spec.name, pre, outcome.row_count)
