"""Two daily runs of all layers over feeds made from the driver tables, stored as files."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMOKE_DIR, rows
from pyspark.sql import functions as F

from lakestar.operators.scd2 import current
from lakestar.plans.lakehouse import Lakehouse
from lakestar.plans.silver import bronze_columns, feed_counts
from lakestar.specs import DIMENSIONS, FACT_ORDER_PAYMENTS, FACT_SALES, FEEDS, SILVER
from lakestar.verification.feeds import DAY, feed

APPS = ["Customers", "Orders", "Products", "Order_Items", "Order_Payments"]


def as_delivered(spark, app, day):
    """Without the load date, which the load itself sets."""
    return feed(spark, SMOKE_DIR, app, day).select(*FEEDS[app].columns)


def deliver(spark, app, day, path):
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    as_delivered(spark, app, day).write.options(**options).csv(path, header=True, sep="|")


def run(lake: Lakehouse, raw: str) -> dict:
    results = {}
    for app in APPS:
        results["bronze", app] = lake.ingest(app, f"{raw}/{app}", delimiter="|")
        results["silver", app] = lake.load_silver(app)
        if app in DIMENSIONS:
            results["dim", app] = lake.load_dimension(app)
    results["sales"] = lake.load_sales()
    results["payments"] = lake.load_payments()
    return results


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    lakes, results, counts = {}, {}, {}
    for day, as_of in DAY.items():
        raw = f"{base}/raw{day}"
        for app in APPS:
            deliver(spark, app, day, f"{raw}/{app}")
        lake = Lakehouse(spark, f"{base}/lake", as_of, job_id=day)
        if day == 1:
            with pytest.raises(LookupError):
                lake.calendar()
            lake.store_calendar(dt.date(1995, 1, 1), dt.date(2002, 12, 31))
        results[day] = run(lake, raw)
        lakes[day] = lake
        counts[day] = {app: lake.bronze(app).count() for app in APPS}
    return lakes[2], results, counts


def test_bronze_holds_the_delivery(spark, two_days):
    lake, results, counts = two_days
    for app in APPS:
        assert results[2]["bronze", app].post_count == counts[2][app]
        expected = as_delivered(spark, app, 2).withColumn("load_date", F.lit(DAY[2]))
        got = lake.bronze(app).select(*bronze_columns(FEEDS[app]))
        assert rows(got) == rows(expected)


def test_silver_counts_are_those_of_the_feed(two_days):
    lake, results, _ = two_days
    for app in APPS:
        result = results[2]["silver", app]
        expected = feed_counts(lake.bronze(app), FEEDS[app]).collect()[0].asDict()
        assert {k: getattr(result, k) for k in expected} == expected
        assert result.valid + result.invalid_total == result.total


def test_silver_keys_are_unique(two_days):
    lake, _, _ = two_days
    for app in APPS:
        keys = SILVER[app].keys
        assert lake.silver(app).groupBy(*keys).count().filter("count > 1").count() == 0


def test_dimensions_keep_history(two_days):
    lake, results, _ = two_days
    for app in APPS:
        if app not in DIMENSIONS:
            continue
        dim, spec = lake.dimension(app), DIMENSIONS[app]
        assert results[1]["dim", app].pre_count == 0
        assert results[2]["dim", app].post_count == dim.count() > results[1]["dim", app].post_count
        keys = dim.select(*spec.keys).distinct().count()
        assert current(dim).count() == keys == current(dim).select(*spec.keys).distinct().count()
        closed = dim.filter("is_current = 0")
        assert closed.count() > 0 and closed.filter(F.col("eff_end_dt") != F.lit(DAY[1])).count() == 0


def test_facts_hold_each_key_once(two_days):
    lake, _, _ = two_days
    for spec in (FACT_SALES, FACT_ORDER_PAYMENTS):
        fact = lake.fact(spec)
        assert fact.count() > 0
        assert fact.groupBy(*spec.keys).count().filter("count > 1").count() == 0
        assert fact.filter(F.col("load_date") == F.lit(DAY[2])).count() > 0


def test_the_log_reconciles(two_days):
    lake, results, _ = two_days
    log = {(r.job_id, r.table_name): r for r in lake.log().collect()}
    assert len(log) == 2 * (len(APPS) * 3 - 1 + 2) and all(r.succeeded for r in log.values())
    for app in APPS:
        found, result = log[2, SILVER[app].name], results[2]["silver", app]
        assert (found.pre_count, found.post_count) == (result.pre_count, result.post_count)
    assert log[2, "fact_sales"].post_count == lake.fact(FACT_SALES).count()


def test_running_a_day_again_changes_no_dimension(two_days):
    lake, _, _ = two_days
    again = Lakehouse(lake.spark, lake.root, lake.as_of, job_id=3)
    before = rows(again.dimension("Orders"))
    again.load_silver("Orders")
    again.load_dimension("Orders")
    assert rows(again.dimension("Orders")) == before


def test_partition_scoped_silver_load(spark, two_days, tmp_path):
    lake, _, _ = two_days
    other = Lakehouse(spark, str(tmp_path / "lake"), DAY[1], job_id=1)
    for day in (1, 2):
        deliver(spark, "Orders", day, f"{tmp_path}/raw{day}")
        other.ingest("Orders", f"{tmp_path}/raw{day}", delimiter="|")
        other.load_silver("Orders", scope="partition")
    silver = other.silver("Orders")
    keys = SILVER["Orders"].keys
    assert silver.groupBy(*keys, "order_status").count().filter("count > 1").count() == 0
    # An order that moved on is stored under both of its states.
    assert silver.count() > silver.select(*keys).distinct().count()


def test_an_empty_delivery(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_state,seller_state_code\n")
    lake = Lakehouse(spark, str(tmp_path / "lake"), DAY[1], job_id=1)
    assert lake.ingest("Sellers", str(tmp_path / "sellers.csv")).post_count == 0
    result = lake.load_silver("Sellers")
    assert (result.total, result.valid, result.invalid_distinct, result.post_count) == (0, 0, 0, 0)
    assert lake.load_dimension("Sellers").post_count == 0
    assert lake.silver("Sellers").count() == lake.dimension("Sellers").count() == 0
    assert all(r.succeeded for r in lake.log().collect())
