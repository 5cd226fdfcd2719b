"""A lake under one root folder: the loads of ``loads`` with paths, dates and log filled in."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.scd2 import DEFAULT_ACTOR, current
from ..operators.star import date_dim
from ..sources.audit import LoadAudit, read_audit, reconcile
from ..sources.tables import latest_path, read_table, settle_reload, write_snapshot
from ..specs import DIMENSIONS, FACT_ORDER_PAYMENTS, FACT_SALES, FEEDS, SILVER, TableSpec
from . import facts, loads
from .silver import bronze_columns


@dataclass(frozen=True)
class Lakehouse:
    """One run over the lake: all its loads share a date, a job id and an actor."""

    spark: SparkSession
    root: str
    as_of: dt.date
    job_id: int
    job_name: str = "daily"
    sys_name: str = "lakestar"
    actor: str = DEFAULT_ACTOR

    @property
    def audit(self) -> LoadAudit:
        return LoadAudit(
            self.spark, f"{self.root}/audit/load_audit", self.job_id, self.job_name, self.sys_name
        )

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def ingest(self, app: str, source: str, fmt: str = "csv", delimiter: str = ",") -> loads.LoadResult:
        name = FEEDS[app].name
        target = self._path("bronze", name)
        return loads.ingest_feed(
            self.spark,
            source,
            target,
            app,
            name,
            self.as_of,
            self.audit,
            fmt,
            delimiter,
            FEEDS[app].columns,
        )

    def bronze(self, app: str) -> DataFrame:
        feed = FEEDS[app]
        columns = ", ".join(f"`{c}` string" for c in feed.columns)
        root = self._path("bronze", feed.name)
        settle_reload(self.spark, root)
        reader = self.spark.read.schema(f"{columns}, load_date date")
        return reader.parquet(root).select(*bronze_columns(feed))

    def load_silver(self, app: str, scope: str = "bucket", keep_newer: bool = False) -> loads.LoadResult:
        spec = SILVER[app]
        root = self._path("silver", spec.name)
        return loads.load_silver(
            self.spark,
            self.bronze(app),
            root,
            spec,
            self.audit,
            scope,
            keep_newer,
            quarantine=self._path("quarantine", spec.name),
        )

    def rejected(self, app: str) -> DataFrame:
        """Rows that Silver loads did not keep, with their reasons and their jobs."""
        return loads.read_rejected(self.spark, self._path("quarantine", SILVER[app].name), FEEDS[app])

    def silver(self, app: str, columns: tuple[str, ...] | None = None) -> DataFrame:
        spec = SILVER[app]
        return read_table(self.spark, self._path("silver", spec.name), spec.schema, columns)

    def load_dimension(self, app: str, every_key_open: bool = False) -> loads.LoadResult:
        spec = DIMENSIONS[app]
        return loads.load_dimension(
            self.spark,
            self.silver(app, spec.source_columns),
            self._path("gold", spec.name),
            spec,
            self.as_of,
            self.audit,
            self.actor,
            every_key_open,
        )

    def dimension(self, app: str) -> DataFrame:
        spec = DIMENSIONS[app]
        return read_table(self.spark, self._path("gold", spec.name), spec.schema)

    def store_calendar(self, start: dt.date, end: dt.date) -> None:
        days = date_dim(self.spark, start, end).coalesce(1)
        write_snapshot(self.spark, days, self._path("gold", "dim_date"), [])

    def calendar(self) -> DataFrame:
        path = latest_path(self.spark, self._path("gold", "dim_date"))
        if path is None:
            raise LookupError("no calendar stored; call store_calendar first")
        return self.spark.read.parquet(path)

    def _load_fact(self, rows: DataFrame, spec: TableSpec) -> loads.LoadResult:
        return loads.load_fact(self.spark, rows, self._path("gold", spec.name), spec, self.audit)

    def _star(self) -> tuple[DataFrame, ...]:
        apps = ("Customers", "Orders", "Products", "Order_Items")
        return (self.calendar(), *(current(self.dimension(app)) for app in apps))

    def load_sales(self, match_seller: bool = True) -> loads.LoadResult:
        return self._load_fact(facts.fact_sales(*self._star(), self.as_of, match_seller), FACT_SALES)

    def lost_sales(self, match_seller: bool = True) -> DataFrame:
        """Order items that are in no sale, with the first table that has no match for them."""
        return facts.lost_sales(facts.checked_sales(*self._star(), self.as_of, match_seller))

    def load_payments(self) -> loads.LoadResult:
        rows = facts.fact_order_payments(
            self.calendar(),
            current(self.dimension("Orders")),
            self.silver("Order_Payments"),
            self.as_of,
        )
        return self._load_fact(rows, FACT_ORDER_PAYMENTS)

    def fact(self, spec: TableSpec) -> DataFrame:
        return read_table(self.spark, self._path("gold", spec.name), spec.schema)

    def log(self) -> DataFrame:
        return reconcile(read_audit(self.spark, self.audit.path))
