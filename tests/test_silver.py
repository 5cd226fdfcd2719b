from __future__ import annotations

import datetime as dt

import pytest
from conftest import final_plan, rows

from lakestar.operators.quality import dedupe_by_key
from lakestar.plans import silver
from lakestar.plans.silver import feed_counts, silver_latest, silver_transform, valid_rows
from lakestar.specs import FEEDS, LAST_UPDATE, SILVER

D1, D2 = dt.date(2024, 1, 31), dt.date(2024, 2, 1)
AM, PM = "15-01-2024 09:30:00 AM", "15-01-2024 09:30:00 PM"
AT_AM, AT_PM = dt.datetime(2024, 1, 15, 9, 30), dt.datetime(2024, 1, 15, 21, 30)
DAY = dt.date(2024, 1, 15)


def bronze(spark, app, data):
    columns = ", ".join(f"{c} string" for c in FEEDS[app].columns)
    return spark.createDataFrame(data, f"{columns}, load_date date")


def test_every_output_has_its_declared_schema(spark):
    for app, spec in SILVER.items():
        out = silver_transform(bronze(spark, app, []), spec)
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in spec.schema
        ], app


def test_customers(spark):
    df = bronze(
        spark,
        "Customers",
        [
            (" c1 ", " Me@X.Com", "sao PAULO ", "sp", D1),
            (" c1 ", " Me@X.Com", "sao PAULO ", "sp", D1),
            (" c1 ", "old@x.com", "rio", "rj", dt.date(2024, 1, 1)),
            ("C1", None, "rio", "rj", D1),
            (None, "a", "b", "c", D1),
        ],
    )
    assert rows(silver.customers(df)) == [
        ("C1", None, "Rio", "RJ", D1),
        ("C1", "me@x.com", "Sao Paulo", "SP", D1),
    ]
    counts = feed_counts(df, FEEDS["Customers"]).collect()[0].asDict()
    assert counts == {"total": 5, "valid": 2, "invalid_distinct": 2, "invalid_total": 3}
    merged = silver_transform(df, SILVER["Customers"], normalize_keys_first=True)
    assert [r.customer_id for r in merged.collect()] == ["C1"]


def test_orders(spark):
    df = bronze(
        spark,
        "Orders",
        [
            ("o1", "c1", "delivered", AM, PM, "15-01-2024 13:00:00 PM", None, AM, D1),
            ("o2", None, "delivered", AM, AM, AM, AM, AM, D1),
        ],
    )
    assert rows(silver.orders(df)) == [("O1", "C1", "Delivered", AT_AM, AT_PM, None, None, DAY, D1)]


def test_products(spark):
    df = bronze(
        spark,
        "Products",
        [("p1", "s1", "CAMA mesa", "bed BATH", "10.5", "x", "3.0", "12", None, "1", "2", "3", "4.25", D1)],
    )
    assert rows(silver.products(df)) == [
        ("P1", "S1", "Cama Mesa", "Bed Bath", 10.5, None, 3, 12, None, 1.0, 2.0, 3.0, 4.25, D1)
    ]


def test_sellers(spark):
    df = bronze(spark, "Sellers", [(" s1", "rio", " rj ", D1), (None, "x", "y", D1)])
    assert rows(silver.sellers(df)) == [("S1", "Rio", "RJ", D1)]


def test_order_items(spark):
    df = bronze(
        spark,
        "Order_Items",
        [
            ("o1", "1", "p1", "s1", AM, "10.10", "1.00", D1),
            ("o1", "2", "p1", "s1", AM, "10.20", "1.05", D1),
            ("o1", "2", "p1", "s1", AM, "10.20", "1.05", D1),
            ("o1", "3", "p1", "s1", PM, "1", "x", D1),
            ("o2", None, "p1", "s1", "bad", "5", "1", D1),
            ("o3", "1", None, "s1", AM, "5", "1", D1),
        ],
    )
    out = silver.order_items(df)
    assert rows(out) == [
        ("O1", "P1", "S1", AT_AM, 2024, 2, 20.3, 2.05, D1),
        ("O1", "P1", "S1", AT_PM, 2024, 1, 1.0, None, D1),
        ("O2", "P1", "S1", None, None, 0, 5.0, 1.0, D1),
    ]
    # Two ship dates share the record key, so one of them is kept when the table is loaded.
    spec = SILVER["Order_Items"]
    assert dedupe_by_key(out, spec.keys, order_col=LAST_UPDATE).count() == 2


def test_order_payments(spark):
    df = bronze(
        spark,
        "Order_Payments",
        [("o1", "1", "credit_card", "10.5", D1), ("o1", "x", " not_defined ", "-", D1), ("o2", None, "a", "1", D1)],
    )
    assert rows(silver.order_payments(df)) == [
        ("O1", None, "Not Defined", None, D1),
        ("O1", 1, "Credit Card", 10.5, D1),
    ]


def test_order_ratings(spark):
    scores = ["0.9", "1", "5", "5.5", "x", None]
    df = bronze(spark, "Order_Ratings", [(f"r{i}", "o1", s, AM, PM, D1) for i, s in enumerate(scores)])
    assert rows(silver.order_ratings(df)) == [
        ("R1", "O1", 1.0, DAY, AT_PM, D1),
        ("R2", "O1", 5.0, DAY, AT_PM, D1),
    ]


def test_the_score_is_tested_on_the_kept_row_only(spark):
    df = bronze(spark, "Order_Ratings", [("r1", "o1", "3", AM, AM, D1), ("r1", "o1", "9", AM, AM, D2)])
    assert valid_rows(df, FEEDS["Order_Ratings"]).count() == 0
    counts = feed_counts(df, FEEDS["Order_Ratings"]).collect()[0].asDict()
    assert counts == {"total": 2, "valid": 0, "invalid_distinct": 2, "invalid_total": 2}


@pytest.mark.parametrize("app", list(SILVER))
def test_counts_match_the_rows_on_driver_data(spark, app):
    from conftest import SMOKE_DIR

    from lakestar.verification.stages import bronze_table

    df = bronze_table(spark, SMOKE_DIR, app, 2)
    feed = FEEDS[app]
    valid = valid_rows(df, feed)
    counts = feed_counts(df, feed).collect()[0]
    assert counts.valid == valid.count()
    assert counts.invalid_distinct == df.subtract(valid).count()
    assert counts.total == df.count() == counts.valid + counts.invalid_total


@pytest.mark.parametrize("app", list(SILVER))
def test_latest_of_a_delivery_takes_one_shuffle(spark, app):
    feed, spec = FEEDS[app], SILVER[app]
    data = []
    for i in range(60):
        spelled = [f" k{i % 7} ", f"K{i % 7}", "", None][i % 5 % 4]
        row = {c: str(i % 4) if i % 9 else None for c in feed.columns}
        row |= {k: f"{spelled}" if spelled is not None and k != "payment_sequential" else spelled for k in feed.required}
        data.append((*row.values(), [D1, D2, None][i % 3]))
    df = bronze(spark, app, data + data[:20])
    got = silver_latest(df, spec)
    assert rows(got) == rows(dedupe_by_key(silver_transform(df, spec), spec.keys, order_col=LAST_UPDATE))
    plan = final_plan(got)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" not in plan[plan.index("Exchange") :]  # no sort before it


def test_stored_inputs_are_written_as_they_come(spark):
    """No shuffle by turns and no sort by folders: both spill whole rows of a large feed."""
    from conftest import SMOKE_DIR

    from lakestar.verification import stages

    stages._written.clear()
    df = stages.bronze_table(spark, SMOKE_DIR, "Orders", 2)
    assert df.count() == stages.feed(spark, SMOKE_DIR, "Orders", 2).count()
    assert stages.feed(spark, SMOKE_DIR, "Orders", 2).rdd.getNumPartitions() >= len(df.inputFiles())
    dim = stages.dimension(spark, SMOKE_DIR, "Orders", 2)
    assert not any("is_current=" in f for f in dim.inputFiles())


def test_a_silver_table_meets_its_dimension_without_another_shuffle(spark, conf):
    from conftest import SMOKE_DIR

    from lakestar.operators.scd2 import scd2_active
    from lakestar.specs import DIMENSIONS
    from lakestar.verification import stages

    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    source = stages.silver_table(spark, SMOKE_DIR, "Orders", 2)
    stored = stages.dimension(spark, SMOKE_DIR, "Orders", 1)
    plan = final_plan(scd2_active(source, stored, DIMENSIONS["Orders"], stages.DAY[2]))
    assert plan.count("Exchange hashpartitioning") == 2  # one for the delivery, one for the stored versions


def test_valid_rows_are_dealt_before_they_are_sorted(spark):
    df = bronze(spark, "Customers", [("c1", "a", "x", "y", D1), ("c1", "b", "x", "y", D2), (None, "c", "x", "y", D1)])
    got = valid_rows(df, FEEDS["Customers"])
    assert rows(got) == [("c1", "b", "x", "y", D2)]
    plan = final_plan(got)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Sort" not in plan[plan.index("Exchange") :]
