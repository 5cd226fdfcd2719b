"""The load audit: one typed row when a table load starts and one when it ends."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType, TimestampType

from ..specs import DATE, LONG, STRING, struct
from .tables import empty_table, exists, overwrite_partitions

AUDIT_SCHEMA = struct(
    job_id=LONG,
    job_name=STRING,
    sys_name=STRING,
    app_nm=STRING,
    table_name=STRING,
    event=STRING,
    flag=BooleanType(),
    row_count=LONG,
    attempt=STRING,
    logged_at=TimestampType(),
)
LOGGED_ON = "logged_on"  # the day, in UTC, that the log is partitioned by
_STORED = StructType([*AUDIT_SCHEMA.fields, StructField(LOGGED_ON, DATE)])
START, END = "start", "end"


@dataclass
class LoadOutcome:
    """Filled in by a load while it runs, so that its end row can report the count."""

    row_count: int = 0


@dataclass(frozen=True)
class LoadAudit:
    """Appends audit rows of one job to a Parquet folder, one file a row in a folder for each day."""

    spark: SparkSession
    path: str
    job_id: int
    job_name: str
    sys_name: str

    def _append(
        self, app: str, table: str, event: str, flag: bool | None, rows: int | None, attempt: str | None
    ) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        values = (self.job_id, self.job_name, self.sys_name, app, table, event, flag, rows, attempt, now)
        row = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, AUDIT_SCHEMA)]
        row.append(F.lit(now.date()).alias(LOGGED_ON))
        self.spark.range(0, 1, 1, 1).select(*row).write.mode("append").partitionBy(LOGGED_ON).parquet(self.path)

    def start(self, app: str, table: str, row_count: int, attempt: str | None = None) -> None:
        self._append(app, table, START, None, row_count, attempt)

    def end(
        self, app: str, table: str, flag: bool, row_count: int | None, attempt: str | None = None
    ) -> None:
        self._append(app, table, END, flag, row_count, attempt)

    @contextmanager
    def load(self, app: str, table: str, pre_count: int) -> Iterator[LoadOutcome]:
        """Logs start and end around a load; a failed load logs flag False and still raises."""
        attempt = uuid.uuid4().hex
        self.start(app, table, pre_count, attempt)
        outcome = LoadOutcome()
        try:
            yield outcome
        except Exception:
            self.end(app, table, False, None, attempt)
            raise
        self.end(app, table, True, outcome.row_count, attempt)


def read_audit(
    spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """The log, or the rows of some days of it: only their folders are read. A load that runs past midnight
    has its two rows in two days."""
    if not exists(spark, path):
        return empty_table(spark, AUDIT_SCHEMA)
    log = spark.read.schema(_STORED).parquet(path)
    if since is not None:
        log = log.filter(F.col(LOGGED_ON) >= F.lit(since))
    if until is not None:
        log = log.filter(F.col(LOGGED_ON) <= F.lit(until))
    return log.select(*AUDIT_SCHEMA.names)


def compact_audit(spark: SparkSession, path: str, before: dt.date) -> list[dt.date]:
    """Makes one file of each day before ``before`` that has more; returns those days.

    A load adds two files of one row. Choose a day that no running load writes to. Days are replaced when
    the rewritten ones are whole, so a run that fails leaves the log as it was.
    """
    if not exists(spark, path):
        return []
    log = spark.read.schema(_STORED).parquet(path).filter(F.col(LOGGED_ON) < F.lit(before))
    files = log.groupBy(LOGGED_ON).agg(F.count_distinct("_metadata.file_path").alias("files"))
    days = sorted(r[LOGGED_ON] for r in files.filter("files > 1").collect())
    if days:
        old = log.filter(F.col(LOGGED_ON).isin(days))
        overwrite_partitions(old, path, [LOGGED_ON])
    return days


def reconcile(audit: DataFrame) -> DataFrame:
    """One row per attempt to load a table: counts before and after, rows gained, success.

    Start and end rows meet in one aggregate. A load that failed or never ended shows null counts
    after, whatever other attempts of the job did.
    """
    is_start, is_end = F.col("event") == START, F.col("event") == END
    return (
        audit.groupBy("job_id", "job_name", "sys_name", "app_nm", "table_name", "attempt")
        .agg(
            F.max(F.when(is_start, F.col("row_count"))).alias("pre_count"),
            F.max(F.when(is_end, F.col("row_count"))).alias("post_count"),
            F.coalesce(F.bool_or(F.when(is_end, F.col("flag"))), F.lit(False)).alias("succeeded"),
        )
        .withColumn("rows_gained", F.col("post_count") - F.col("pre_count"))
        .drop("attempt")
    )
