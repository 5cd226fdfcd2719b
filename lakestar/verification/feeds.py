"""The seven raw feeds, derived from the whole driver tables.

Every driver row becomes at least one feed row; some keys get noise (spaces, null keys, copies,
malformed values), chosen by the key so that it is the same in every run. ``day`` 1 and 2 are two
deliveries: between them some keys go missing, some are new and some change.

The same feeds are spelled out in SQL in ``oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import FEEDS, LOAD_DATE, TIMESTAMP_FORMAT

DAY = {1: dt.date(2024, 1, 31), 2: dt.date(2024, 2, 1)}

BASE, COPY, RESPELLED, MORE = 0, 1, 2, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("k") % n == 0


def _text(number: Column) -> Column:
    return number.cast("decimal(18,2)").cast("string")


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_FORMAT)


def _later(ts: str, seconds: int | Column) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds) if isinstance(seconds, int) else seconds, F.col(ts))


def _with_copies(df: DataFrame, *extra: Column) -> DataFrame:
    """Adds the copy number ``v``: 0, and 1 and more for the keys that are delivered again."""
    copies = F.array_compact(F.array(F.lit(BASE), *extra))
    return df.withColumn("v", F.explode(copies))


def _copy(v: int, n: int) -> Column:
    return F.when(_every(n), F.lit(v))


def _spelled(id_: Column) -> Column:
    """Ids with spaces around them for some keys and for respelled copies."""
    return F.when(
        _every(17) | (F.col("v") == RESPELLED), F.concat(F.lit("  "), id_, F.lit(" "))
    ).otherwise(id_)


def _id(prefix: str, retired: str, number: str, day: int) -> Column:
    """A lower-case id; every tenth key has another id on day 1, which day 2 no longer delivers."""
    key = F.col(number).cast("string")
    if day == 1:
        return F.concat(F.when(_every(10), F.lit(retired)).otherwise(F.lit(prefix)), key)
    return F.concat(F.lit(prefix), key)


def _ref(prefix: str, number: str) -> Column:
    return F.concat(F.lit(prefix), F.col(number).cast("string"))


def _unless(n: int, value: Column) -> Column:
    return F.when(~_every(n), value)


def _on(day: int, wanted: int, then: Column, otherwise: Column) -> Column:
    return then if day == wanted else otherwise


def _load_date(day: int) -> Column:
    """Day 2 delivers some rows under the old date; they are not newer than what is stored."""
    if day == 1:
        return F.lit(DAY[1])
    return F.when(_every(37), F.lit(DAY[1])).otherwise(F.lit(DAY[2]))


def _state(day: int) -> Column:
    name = F.initcap("n_name")
    spaced = F.when(_every(17), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).otherwise(name)
    return F.when(_every(7), F.concat(F.lit("new "), spaced)).otherwise(spaced) if day == 2 else spaced


def customers(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    base = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = _with_copies(
        base.withColumn("k", F.col("c_custkey")), _copy(COPY, 29), _copy(RESPELLED, 31)
    )
    email = F.concat(
        F.when(F.col("v") == RESPELLED, F.lit("alt.")).otherwise(F.lit("")),
        F.col("c_name"),
        F.lit("@Example.com"),
    )
    return rows.select(
        _unless(23, _spelled(_id("c", "r", "c_custkey", day))).alias("customer_id"),
        _on(day, 1, _unless(19, email), _unless(13, email)).alias("customer_email_id"),
        _state(day).alias("customer_state"),
        F.substring("n_name", 1, 2).alias("customer_state_code"),
        _load_date(day).alias(LOAD_DATE),
    )


def orders(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    base = table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey"))
    rows = _with_copies(base, _copy(COPY, 29), _copy(RESPELLED, 31)).withColumn(
        "bought", _later("o_orderdate", (F.col("k") % 86400).cast("int"))
    )
    status = (
        F.when(F.col("v") == RESPELLED, F.lit("shipped"))
        .when(F.lit(day == 2) & _every(7), F.lit("delivered"))
        .when(F.col("o_orderstatus") == "F", F.lit("delivered"))
        .when(F.col("o_orderstatus") == "P", F.lit("shipped"))
        .otherwise(F.lit("created"))
    )
    bought = _stamp(F.col("bought"))
    approved = _stamp(_later("bought", 7200))
    return rows.select(
        _unless(23, _spelled(_id("o", "x", "o_orderkey", day))).alias("order_id"),
        _unless(41, _ref("c", "o_custkey")).alias("customer_id"),
        status.alias("order_status"),
        F.when(_every(43), F.lit("no date")).otherwise(bought).alias("order_purchase_timestamp"),
        _on(day, 1, _unless(13, approved), approved).alias("order_approved_at"),
        _stamp(_later("bought", 2 * 86400)).alias("order_delivered_carrier_date"),
        _on(
            day, 2, _unless(11, _stamp(_later("bought", 7 * 86400))), _stamp(_later("bought", 7 * 86400))
        ).alias("order_delivered_customer_date"),
        _stamp(_later("bought", 10 * 86400)).alias("order_estimated_delivery_date"),
        _load_date(day).alias(LOAD_DATE),
    )


def products(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    # Dealt by the key of the join that follows, which need not deal them again.
    offers = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").repartition("l_partkey").distinct()
    base = offers.join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).withColumn("k", F.col("l_partkey") + F.col("l_suppkey"))
    rows = _with_copies(base, _copy(COPY, 29), _copy(RESPELLED, 31))
    raised = F.when(F.lit(day == 2) & _every(7), F.lit(1)).otherwise(F.lit(0))
    size = F.col("p_size").cast("string")
    return rows.select(
        _unless(23, _spelled(_id("p", "q", "l_partkey", day))).alias("product_id"),
        _ref("s", "l_suppkey").alias("seller_id"),
        F.col("p_type").alias("product_category_name"),
        F.when(_every(17), F.concat(F.lit(" "), F.lower("p_type"))).otherwise(F.col("p_type")).alias(
            "product_category_name_english"
        ),
        _text(F.col("p_retailprice") + raised).alias("price"),
        _on(day, 1, _unless(13, _text(F.col("p_size") * 1.5)), _text(F.col("p_size") * 1.5)).alias(
            "freight_value"
        ),
        F.length("p_name").cast("string").alias("product_name_length"),
        F.when(_every(5), F.concat(size, F.lit(".0"))).otherwise(size).alias(
            "product_description_length"
        ),
        F.when(_every(11), F.lit("x")).otherwise((F.col("p_size") % 6).cast("string")).alias(
            "product_photos_qty"
        ),
        _text(F.col("p_size") * 100.5).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (F.col("p_size") + 1).cast("string").alias("product_height_cm"),
        (F.col("p_size") + 2).cast("string").alias("product_width_cm"),
        _load_date(day).alias(LOAD_DATE),
    )


def sellers(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    base = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    rows = _with_copies(
        base.withColumn("k", F.col("s_suppkey")), _copy(COPY, 29), _copy(RESPELLED, 31)
    )
    return rows.select(
        _unless(23, _spelled(_id("s", "t", "s_suppkey", day))).alias("seller_id"),
        _state(day).alias("seller_state"),
        F.substring("n_name", 1, 2).alias("seller_state_code"),
        _load_date(day).alias(LOAD_DATE),
    )


def order_items(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    base = table(spark, sf_dir, "lineitem").withColumn(
        "k", F.col("l_orderkey") + F.col("l_partkey") + F.col("l_suppkey")
    )
    # Copies: an exact one, one more piece on the same ship date, one more piece a day later.
    rows = _with_copies(base, _copy(COPY, 29), _copy(RESPELLED, 31), _copy(MORE, 41))
    late = F.when(F.col("v") == MORE, F.lit(86400)).otherwise(F.lit(0))
    raised = F.when(F.lit(day == 2) & _every(7), F.lit(1)).otherwise(F.lit(0))
    number = F.col("l_linenumber") + F.when(F.col("v") >= RESPELLED, F.col("v") * 100).otherwise(F.lit(0))
    order_id = _id("o", "x", "l_orderkey", day)
    return rows.select(
        F.when(_every(17), F.concat(F.lit("  "), order_id, F.lit(" "))).otherwise(order_id).alias("order_id"),
        _unless(19, number.cast("string")).alias("order_item_id"),
        _unless(23, _ref("p", "l_partkey")).alias("product_id"),
        _ref("s", "l_suppkey").alias("seller_id"),
        _stamp(F.timestamp_add("SECOND", late, F.col("l_shipdate"))).alias("shipping_limit_date"),
        _text(F.col("l_extendedprice") + raised).alias("price"),
        _text(F.col("l_tax") * 100).alias("freight_value"),
        _load_date(day).alias(LOAD_DATE),
    )


def order_payments(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    base = table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey"))
    rows = _with_copies(base, _copy(COPY, 29), _copy(RESPELLED, 31), _copy(MORE, 5))
    kind = (
        F.when(F.col("k") % 3 == 0, F.lit("credit_card"))
        .when(F.col("k") % 3 == 1, F.lit("boleto"))
        .otherwise(F.lit("debit_card"))
    )
    return rows.select(
        _unless(23, _spelled(_ref("o", "o_orderkey"))).alias("order_id"),
        F.when(F.col("v") == MORE, F.lit("2")).otherwise(F.lit("1")).alias("payment_sequential"),
        F.when(F.col("v") == RESPELLED, F.lit("voucher")).otherwise(kind).alias("payment_type"),
        _text(F.col("o_totalprice")).alias("payment_value"),
        _load_date(day).alias(LOAD_DATE),
    )


def order_ratings(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    base = table(spark, sf_dir, "events").withColumn("k", F.col("event_id"))
    rows = _with_copies(base, _copy(COPY, 29), _copy(RESPELLED, 31))
    given = (F.floor("value") % 7).cast("string")
    score = (
        F.when(_every(53), F.lit("5.5"))
        .when(_every(59), F.lit("x"))
        .when(_every(61), F.lit(None))
        .when(F.lit(day == 2) & _every(7), F.lit("4"))
        .otherwise(given)
    )
    stamp = _stamp(F.col("ts"))
    return rows.select(
        _unless(23, _spelled(_id("g", "h", "event_id", day))).alias("rating_id"),
        _ref("o", "event_id").alias("order_id"),
        score.alias("rating_score"),
        _on(day, 1, _unless(13, stamp), stamp).alias("rating_survey_creation_date"),
        F.when(_every(43), F.lit("no date")).otherwise(stamp).alias("rating_survey_answer_timestamp"),
        _load_date(day).alias(LOAD_DATE),
    )


_MAKERS: dict[str, Callable[[SparkSession, str, int], DataFrame]] = {
    "Customers": customers,
    "Orders": orders,
    "Products": products,
    "Sellers": sellers,
    "Order_Items": order_items,
    "Order_Payments": order_payments,
    "Order_Ratings": order_ratings,
}


def feed(spark: SparkSession, sf_dir: str, app: str, day: int) -> DataFrame:
    """The columns of a feed and its load date, all feed columns strings."""
    return _MAKERS[app](spark, sf_dir, day).select(*FEEDS[app].columns, LOAD_DATE)
