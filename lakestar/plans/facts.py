"""Gold facts: current dimension versions joined into a star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key
from ..operators.star import date_skey, join_date
from ..specs import FACT_ORDER_PAYMENTS, FACT_SALES

DELIVERED = "Delivered"


def fact_sales(
    dates: DataFrame,
    customers: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    items: DataFrame,
    as_of: dt.date,
    match_seller: bool = True,
) -> DataFrame:
    """Delivered sales per order, product and seller; inputs are current dimension versions.

    Orders are cut to the delivered ones and meet the calendar and their customer before the items
    widen them. Every join is an equi-join without a hint: sides that fit are broadcast by size,
    the rest are shuffled, and a hot customer or product sits on the side adaptive execution can
    split.

    Products are unique per product and seller, so both are matched; ``match_seller=False`` joins
    by product alone and repeats a sale once per seller of the product.
    """
    delivered = join_date(
        orders.filter(F.col("order_status") == DELIVERED).select(
            "order_skey", "customer_skey", "order_purchase_timestamp"
        ),
        dates,
        "order_purchase_timestamp",
    )
    buyers = customers.select("customer_skey", "customer_state", "customer_state_code")
    lines = items.select(
        "order_skey", "product_skey", "seller_skey", "item_quantity", "price", "freight_value"
    )
    product_key = ["product_skey", "seller_skey"] if match_seller else ["product_skey"]
    categories = products.select(*product_key, "product_category_name_english")
    return (
        delivered.join(buyers, "customer_skey")
        .join(lines, "order_skey")
        .join(categories, product_key)
        .withColumn("net_sales_amount", F.col("price") + F.col("freight_value"))
        .withColumn("load_date", F.lit(as_of))
        .withColumnsRenamed(
            {
                "cal_month_name": "order_purchase_month",
                "item_quantity": "sales_quantity",
                "price": "net_price",
                "freight_value": "net_freight_value",
            }
        )
        .select(*FACT_SALES.schema.names)
    )


LOST_AT = "lost_at"


def checked_sales(
    dates: DataFrame,
    customers: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    items: DataFrame,
    as_of: dt.date,
    match_seller: bool = True,
) -> DataFrame:
    """Every order item with the columns of the sales fact and ``lost_at``: the first match that it has
    not, of ``order``, ``status`` (the order is not delivered), ``date``, ``customer`` and ``product``. It is
    null for a sale; these are the rows of ``fact_sales``.

    One plan for both: the same joins in the same order, as left joins with a flag for each table.
    """

    def flagged(table: DataFrame, name: str) -> DataFrame:
        return table.withColumn(f"_{name}", F.lit(True))

    heads = orders.select("order_skey", "customer_skey", "order_status", "order_purchase_timestamp")
    heads = heads.withColumn("date_skey", date_skey(F.col("order_purchase_timestamp")))
    heads = heads.join(flagged(dates.select("date_skey", "cal_month_name"), "date"), "date_skey", "left")
    buyers = customers.select("customer_skey", "customer_state", "customer_state_code")
    heads = heads.join(flagged(buyers, "customer"), "customer_skey", "left")
    lines = items.select("order_skey", "product_skey", "seller_skey", "item_quantity", "price", "freight_value")
    product_key = ["product_skey", "seller_skey"] if match_seller else ["product_skey"]
    categories = products.select(*product_key, "product_category_name_english")
    wide = lines.join(flagged(heads, "order"), "order_skey", "left")
    wide = wide.join(flagged(categories, "product"), product_key, "left")
    lost = F.when(F.col("_order").isNull(), "order")
    lost = lost.when(~F.col("order_status").eqNullSafe(DELIVERED), "status")
    for name in ("date", "customer", "product"):
        lost = lost.when(F.col(f"_{name}").isNull(), name)
    return (
        wide.withColumn(LOST_AT, lost)
        .withColumn("net_sales_amount", F.col("price") + F.col("freight_value"))
        .withColumn("load_date", F.lit(as_of))
        .withColumnsRenamed(
            {
                "cal_month_name": "order_purchase_month",
                "item_quantity": "sales_quantity",
                "price": "net_price",
                "freight_value": "net_freight_value",
            }
        )
        .select(*FACT_SALES.schema.names, LOST_AT)
    )


def lost_sales(checked: DataFrame) -> DataFrame:
    """The items of ``checked_sales`` that are no sale."""
    kept = ["order_skey", "product_skey", "seller_skey", "sales_quantity", "net_price", "net_freight_value"]
    return checked.filter(F.col(LOST_AT).isNotNull()).select(*kept, LOST_AT)


def fact_order_payments(
    dates: DataFrame, orders: DataFrame, payments: DataFrame, as_of: dt.date
) -> DataFrame:
    """Payments of all orders by approval day; payments carry the order id, not its key."""
    approved = join_date(
        orders.select("order_skey", "customer_skey", "order_status", "order_approved_at"),
        dates,
        "order_approved_at",
    )
    paid = payments.select(
        surrogate_key(F.col("order_id")).alias("order_skey"),
        "payment_sequential",
        "payment_type",
        "payment_value",
    )
    return (
        approved.join(paid, "order_skey")
        .withColumn("load_date", F.lit(as_of))
        .withColumnsRenamed(
            {
                "order_approved_at": "payment_approved_at",
                "cal_month_name": "order_payment_month",
            }
        )
        .select(*FACT_ORDER_PAYMENTS.schema.names)
    )


def monthly_sales_by_category(sales: DataFrame) -> DataFrame:
    """Sales totals per calendar month name and product category."""
    amount = F.col("net_sales_amount").cast("decimal(18,2)")
    return sales.groupBy("order_purchase_month", "product_category_name_english").agg(
        F.count(F.lit(1)).alias("sales_lines"),
        F.sum("sales_quantity").alias("sales_quantity"),
        F.sum(amount).cast("double").alias("net_sales_amount"),
    )
