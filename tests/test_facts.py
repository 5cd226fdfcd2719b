from __future__ import annotations

import datetime as dt

from conftest import final_plan, rows
from pyspark.sql import functions as F

from lakestar.operators.star import date_dim, date_dim_covering, join_date, undated
from lakestar.plans.facts import checked_sales, fact_order_payments, fact_sales, lost_sales, monthly_sales_by_category

AS_OF = dt.date(2024, 2, 1)
AT = dt.datetime(2023, 1, 15, 10, 30)


def calendar(spark):
    return date_dim(spark, dt.date(2023, 1, 1), dt.date(2024, 12, 31))


def customers(spark, n=1):
    return spark.createDataFrame(
        [(f"C{i}_skey", "Sao", "SP") for i in range(n)],
        "customer_skey string, customer_state string, customer_state_code string",
    )


def orders(spark, data):
    return spark.createDataFrame(
        data,
        "order_skey string, customer_skey string, order_status string,"
        "order_purchase_timestamp timestamp, order_approved_at timestamp",
    )


def items(spark, data):
    return spark.createDataFrame(
        data,
        "order_skey string, product_skey string, seller_skey string, item_quantity long,"
        "price double, freight_value double",
    )


def products(spark, data):
    return spark.createDataFrame(
        data, "product_skey string, seller_skey string, product_category_name_english string"
    )


def test_calendar(spark):
    days = date_dim(spark, dt.date(2023, 12, 30), dt.date(2024, 1, 1))
    assert rows(days.select("date_skey", "cal_month_name")) == [
        ("20231230", "December"),
        ("20231231", "December"),
        ("20240101", "January"),
    ]
    span = spark.createDataFrame([(AT,), (AT + dt.timedelta(days=2),), (None,)], "ts timestamp")
    assert date_dim_covering(span, "ts").count() == 3
    assert date_dim_covering(span.filter("false"), "ts").count() == 0


def test_date_join_drops_what_undated_reports(spark):
    df = spark.createDataFrame(
        [(1, AT), (2, None), (3, dt.datetime(1999, 1, 1)), (4, dt.datetime(2024, 12, 31, 23, 59, 59))],
        "id int, ts timestamp",
    )
    assert [r.id for r in join_date(df, calendar(spark), "ts").orderBy("id").collect()] == [1, 4]
    assert [r.id for r in undated(df, calendar(spark), "ts").orderBy("id").collect()] == [2, 3]


def test_sales(spark):
    got = fact_sales(
        calendar(spark),
        customers(spark),
        orders(
            spark,
            [
                ("O1_skey", "C0_skey", "Delivered", AT, AT),
                ("O2_skey", "C0_skey", "Shipped", AT, AT),
                ("O3_skey", "C0_skey", "Delivered", None, AT),
            ],
        ),
        products(spark, [("P_skey", "S1_skey", "Toys"), ("P_skey", "S2_skey", "Games")]),
        items(
            spark,
            [
                ("O1_skey", "P_skey", "S1_skey", 2, 10.0, 1.5),
                ("O2_skey", "P_skey", "S1_skey", 1, 5.0, 1.0),
                ("O3_skey", "P_skey", "S1_skey", 1, 5.0, 1.0),
            ],
        ),
        AS_OF,
    )
    row = ("20230115", "C0_skey", "O1_skey", "P_skey", "S1_skey", AT, "January", "Toys", 2, 10.0, 1.5, 11.5, "Sao", "SP", AS_OF)
    assert rows(got) == [row]


def test_joining_by_product_alone_repeats_a_sale_per_seller(spark):
    parts = (
        calendar(spark),
        customers(spark),
        orders(spark, [("O1_skey", "C0_skey", "Delivered", AT, AT)]),
        products(spark, [("P_skey", "S1_skey", "Toys"), ("P_skey", "S2_skey", "Games")]),
        items(spark, [("O1_skey", "P_skey", "S1_skey", 2, 10.0, 1.5)]),
        AS_OF,
    )
    assert fact_sales(*parts).count() == 1
    wide = fact_sales(*parts, match_seller=False)
    assert wide.count() == 2 and {r.seller_skey for r in wide.collect()} == {"S1_skey"}


def test_payments(spark):
    payments = spark.createDataFrame(
        [("O1", 1, "Boleto", 10.5), ("O1", 2, "Voucher", 1.0), ("O9", 1, "Boleto", 1.0)],
        "order_id string, payment_sequential int, payment_type string, payment_value float",
    )
    got = fact_order_payments(
        calendar(spark),
        orders(spark, [("O1_skey", "C0_skey", "Created", AT, AT), ("O9_skey", "C0_skey", "Created", AT, None)]),
        payments,
        AS_OF,
    )
    head = ("20230115", "C0_skey", "O1_skey", "Created", AT, "January")
    assert rows(got) == [(*head, 1, "Boleto", 10.5, AS_OF), (*head, 2, "Voucher", 1.0, AS_OF)]


def test_monthly_totals(spark):
    sales = spark.createDataFrame(
        [("January", "Toys", 1, 0.1), ("January", "Toys", 2, 0.2), ("May", None, 1, 1.0)],
        "order_purchase_month string, product_category_name_english string, sales_quantity long, net_sales_amount double",
    )
    assert rows(monthly_sales_by_category(sales)) == [("January", "Toys", 2, 3, 0.3), ("May", None, 1, 1, 1.0)]


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_a_hot_customer_and_a_hot_product_are_split(spark, conf, tmp_path):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__coalescePartitions__enabled="false",  # one map task cannot be split
        spark__sql__shuffle__partitions="16",
    )
    n = 30000
    ids = spark.range(0, n, 1, 8)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    order = ids.select(
        F.concat(F.lit("O"), "id").alias("order_skey"),
        F.concat(F.lit("C"), hot).alias("customer_skey"),
        F.lit("Delivered").alias("order_status"),
        F.timestamp_add("DAY", (F.col("id") % 365).cast("int"), F.lit(AT)).alias("order_purchase_timestamp"),
    )
    item = ids.select(
        F.concat(F.lit("O"), "id").alias("order_skey"),
        F.concat(F.lit("P"), hot).alias("product_skey"),
        F.lit("S").alias("seller_skey"),
        F.lit(1).cast("long").alias("item_quantity"),
        F.lit(1.0).alias("price"),
        F.lit(0.5).alias("freight_value"),
    )
    thousand = spark.range(1000)
    customer = thousand.select(
        F.concat(F.lit("C"), "id").alias("customer_skey"),
        F.sha2(F.col("id").cast("string"), 256).alias("customer_state"),
        F.lit("SP").alias("customer_state_code"),
    )
    product = thousand.select(
        F.concat(F.lit("P"), "id").alias("product_skey"),
        F.lit("S").alias("seller_skey"),
        F.lit("Toys").alias("product_category_name_english"),
    )
    sales = fact_sales(
        calendar(spark),
        stored(customer, tmp_path / "c"),
        stored(order, tmp_path / "o"),
        stored(product, tmp_path / "p"),
        stored(item, tmp_path / "i"),
        AS_OF,
    )
    assert final_plan(sales).count("skew=true") >= 2
    assert sales.count() == n


def test_small_sides_are_broadcast_and_the_status_filter_is_pushed_down(spark, tmp_path):
    order = stored(orders(spark, [("O1_skey", "C0_skey", "Delivered", AT, AT)]), tmp_path / "o")
    got = fact_sales(
        calendar(spark),
        stored(customers(spark), tmp_path / "c"),
        order,
        stored(products(spark, [("P_skey", "S1_skey", "Toys")]), tmp_path / "p"),
        stored(items(spark, [("O1_skey", "P_skey", "S1_skey", 2, 10.0, 1.5)]), tmp_path / "i"),
        AS_OF,
    )
    plan = final_plan(got)
    assert plan.count("BroadcastHashJoin") == 4
    assert "EqualTo(order_status,Delivered)" in plan
    assert "order_approved_at" not in plan


def test_every_item_is_a_sale_or_lost_somewhere(spark):
    heads = [
        ("O1_skey", "C0_skey", "Delivered", AT, AT),
        ("O2_skey", "C0_skey", "Shipped", AT, AT),
        ("O3_skey", "C0_skey", None, AT, AT),
        ("O4_skey", "C0_skey", "Delivered", None, AT),
        ("O5_skey", "C0_skey", "Delivered", dt.datetime(1999, 1, 1), AT),
        ("O6_skey", "C9_skey", "Delivered", AT, AT),
        ("O7_skey", "C9_skey", "Delivered", None, AT),
    ]
    lines = [(f"O{i}_skey", "P1_skey", "S1_skey", 1, 2.0, 0.5) for i in range(9)]
    lines += [("O1_skey", "P9_skey", "S1_skey", 1, 2.0, 0.5), ("O1_skey", "P1_skey", "S9_skey", 1, 2.0, 0.5), (None, None, None, 1, None, None)]
    star = (
        calendar(spark),
        customers(spark),
        orders(spark, heads),
        products(spark, [("P1_skey", "S1_skey", "toys")]),
        items(spark, lines),
    )
    checked = checked_sales(*star, AS_OF)
    sales = checked.filter("lost_at IS NULL").drop("lost_at")
    assert rows(sales) == rows(fact_sales(*star, AS_OF)) and sales.count() == 1
    lost = sorted((r.order_skey or "", r.product_skey or "", r.seller_skey or "", r.lost_at) for r in lost_sales(checked).collect())
    assert len(lost) + 1 == len(lines)
    assert lost == sorted([
        ("", "", "", "order"),
        ("O0_skey", "P1_skey", "S1_skey", "order"),
        ("O1_skey", "P1_skey", "S9_skey", "product"),
        ("O1_skey", "P9_skey", "S1_skey", "product"),
        ("O2_skey", "P1_skey", "S1_skey", "status"),
        ("O3_skey", "P1_skey", "S1_skey", "status"),
        ("O4_skey", "P1_skey", "S1_skey", "date"),
        ("O5_skey", "P1_skey", "S1_skey", "date"),
        ("O6_skey", "P1_skey", "S1_skey", "customer"),
        ("O7_skey", "P1_skey", "S1_skey", "date"),
        ("O8_skey", "P1_skey", "S1_skey", "order"),
    ])
    # By product alone, the item of another seller is sold too.
    loose = checked_sales(*star, AS_OF, match_seller=False)
    assert rows(loose.filter("lost_at IS NULL").drop("lost_at")) == rows(fact_sales(*star, AS_OF, match_seller=False))
