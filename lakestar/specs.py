"""Declarative table specs: what each layer reads, keeps unique and stores.

The column names, keys and types below are the contract of the data set: fixed values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from .functions import (
    clean_id,
    clean_label,
    clean_lower,
    clean_title,
    in_range,
    parse_day,
    parse_timestamp,
    skey_name,
    to_float,
    to_int,
)

TIMESTAMP_FORMAT = "dd-MM-yyyy hh:mm:ss a"
BUCKETS = 16
LOAD_DATE = "load_date"
LAST_UPDATE = "last_update_date"

STRING, INT, LONG = StringType(), IntegerType(), LongType()
FLOAT, DOUBLE = FloatType(), DoubleType()
DATE, TIMESTAMP = DateType(), TimestampType()


def struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


@dataclass(frozen=True)
class FeedSpec:
    """One raw feed: all columns are strings, read as they come."""

    app: str
    columns: tuple[str, ...]
    required: tuple[str, ...]
    dedupe_keys: tuple[str, ...]
    # Test on the kept row of each key, for feeds that restrict values.
    accept: Callable[[], Column] | None = None

    @property
    def name(self) -> str:
        return f"bronze_{self.app.lower()}"


@dataclass(frozen=True)
class TableSpec:
    """A stored table: schema, record key, physical partitions and the column that ranks rows."""

    name: str
    app: str
    schema: StructType
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    order_col: str
    # Tables stored in place may be cut further, by a hash of ``bucket_by`` into so many folders: a load
    # rewrites those that hold a key of its batch. Rows that ``bucket_if`` rules out stay together. Choose
    # the number so that a bucket is some hundred megabytes; a table keeps the number of its first load.
    buckets: int = field(default=0, kw_only=True)
    bucket_by: tuple[str, ...] = field(default=(), kw_only=True)
    bucket_if: str = field(default="true", kw_only=True)

    def __post_init__(self) -> None:
        named = {*self.keys, *self.partition_by, *self.bucket_by, self.order_col}
        unknown = named - set(self.schema.names)
        if unknown:
            raise ValueError(f"{self.name}: columns not in the schema: {sorted(unknown)}")
        if not self.keys:
            raise ValueError(f"{self.name}: a record key is required")
        if self.buckets and not self.bucket_by:
            raise ValueError(f"{self.name}: buckets need columns to hash")

    @property
    def layout(self) -> tuple[str, ...]:
        """The folder levels of a table stored in place."""
        return (*self.partition_by, self.bucket_column) if self.buckets else self.partition_by

    @property
    def bucket_column(self) -> str:
        """Holds the number of buckets, so that a table of another number is told apart."""
        return f"bucket_of_{self.buckets}"

    @property
    def key_fixes_partition(self) -> bool:
        """Whether equal keys always lie in the same partition."""
        return set(self.partition_by) <= set(self.keys)


@dataclass(frozen=True)
class SilverSpec(TableSpec):
    feed: FeedSpec
    # Output column -> conversion of the raw column with the same name.
    convert: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)

    def bucketed(self, buckets: int = BUCKETS) -> SilverSpec:
        """The table cut by its record key alone, so that a key never moves to another folder."""
        return replace(self, partition_by=(), buckets=buckets, bucket_by=self.keys)


@dataclass(frozen=True)
class DimensionSpec:
    """A Type-2 dimension over one Silver table."""

    app: str
    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    silver_schema: StructType
    buckets: int = BUCKETS

    @property
    def name(self) -> str:
        return f"dim_{self.app.lower()}"

    @property
    def identity(self) -> tuple[str, ...]:
        return tuple(c for k in self.keys for c in (skey_name(k), k))

    @property
    def schema(self) -> StructType:
        ids = [StructField(c, STRING) for c in self.identity]
        attrs = [StructField(a, self.silver_schema[a].dataType) for a in self.attributes]
        return StructType(ids + attrs + VERSION_COLUMNS.fields)

    @property
    def source_columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.attributes, LAST_UPDATE)

    @property
    def record_key(self) -> tuple[str, ...]:
        return (*self.identity, "eff_end_dt")

    @property
    def table(self) -> TableSpec:
        # The end date is a second partition level under the flag, so that a load rewrites only the
        # one day it closes, however long the history is, and open rows are cut by their business
        # key, so that it rewrites only the buckets it changes.
        return TableSpec(
            name=self.name,
            app=self.app,
            schema=self.schema,
            keys=self.record_key,
            partition_by=("is_current", "eff_end_dt"),
            order_col="eff_start_dt",
            buckets=self.buckets,
            bucket_by=self.keys,
            bucket_if="is_current = 1",
        )


VERSION_COLUMNS = struct(
    eff_start_dt=DATE,
    eff_end_dt=DATE,
    is_current=INT,
    insert_date=DATE,
    inserted_by=STRING,
    update_date=DATE,
    updated_by=STRING,
)

AUDIT_COLUMNS = struct(uuid=STRING, process_id=LONG, load_date=DATE)

CUSTOMERS_FEED = FeedSpec(
    app="Customers",
    columns=("customer_id", "customer_email_id", "customer_state", "customer_state_code"),
    required=("customer_id",),
    dedupe_keys=("customer_id",),
)

ORDERS_FEED = FeedSpec(
    app="Orders",
    columns=(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    required=("order_id", "customer_id"),
    dedupe_keys=("order_id", "customer_id"),
)

PRODUCTS_FEED = FeedSpec(
    app="Products",
    columns=(
        "product_id",
        "seller_id",
        "product_category_name",
        "product_category_name_english",
        "price",
        "freight_value",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    required=("product_id", "seller_id"),
    dedupe_keys=("product_id", "seller_id"),
)

SELLERS_FEED = FeedSpec(
    app="Sellers",
    columns=("seller_id", "seller_state", "seller_state_code"),
    required=("seller_id",),
    dedupe_keys=("seller_id",),
)

ORDER_ITEMS_FEED = FeedSpec(
    app="Order_Items",
    columns=(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    required=("order_id", "product_id", "seller_id"),
    dedupe_keys=("order_id", "order_item_id", "product_id", "seller_id"),
)

ORDER_PAYMENTS_FEED = FeedSpec(
    app="Order_Payments",
    columns=("order_id", "payment_sequential", "payment_type", "payment_value"),
    required=("order_id", "payment_sequential"),
    dedupe_keys=("order_id", "payment_sequential"),
)

ORDER_RATINGS_FEED = FeedSpec(
    app="Order_Ratings",
    columns=(
        "rating_id",
        "order_id",
        "rating_score",
        "rating_survey_creation_date",
        "rating_survey_answer_timestamp",
    ),
    required=("rating_id", "order_id"),
    dedupe_keys=("rating_id", "order_id"),
    accept=lambda: in_range(F.col("rating_score"), 1, 5),
)

_timestamp, _day = parse_timestamp(TIMESTAMP_FORMAT), parse_day(TIMESTAMP_FORMAT)

SILVER: dict[str, SilverSpec] = {
    spec.app: spec
    for spec in (
        SilverSpec(
            name="silver_customers",
            app="Customers",
            schema=struct(
                customer_id=STRING,
                customer_email_id=STRING,
                customer_state=STRING,
                customer_state_code=STRING,
                last_update_date=DATE,
            ),
            keys=("customer_id",),
            partition_by=("customer_state",),
            order_col=LAST_UPDATE,
            feed=CUSTOMERS_FEED,
            convert={
                "customer_id": clean_id,
                "customer_email_id": clean_lower,
                "customer_state": clean_title,
                "customer_state_code": clean_id,
            },
        ),
        SilverSpec(
            name="silver_orders",
            app="Orders",
            schema=struct(
                order_id=STRING,
                customer_id=STRING,
                order_status=STRING,
                order_purchase_timestamp=TIMESTAMP,
                order_approved_at=TIMESTAMP,
                order_delivered_carrier_date=TIMESTAMP,
                order_delivered_customer_date=TIMESTAMP,
                order_estimated_delivery_date=DATE,
                last_update_date=DATE,
            ),
            keys=("order_id", "customer_id"),
            partition_by=("order_status",),
            order_col=LAST_UPDATE,
            feed=ORDERS_FEED,
            convert={
                "order_id": clean_id,
                "customer_id": clean_id,
                "order_status": clean_title,
                "order_purchase_timestamp": _timestamp,
                "order_approved_at": _timestamp,
                "order_delivered_carrier_date": _timestamp,
                "order_delivered_customer_date": _timestamp,
                "order_estimated_delivery_date": _day,
            },
        ),
        SilverSpec(
            name="silver_products",
            app="Products",
            schema=struct(
                product_id=STRING,
                seller_id=STRING,
                product_category_name=STRING,
                product_category_name_english=STRING,
                price=FLOAT,
                freight_value=FLOAT,
                product_name_length=INT,
                product_description_length=INT,
                product_photos_qty=INT,
                product_weight_g=FLOAT,
                product_length_cm=FLOAT,
                product_height_cm=FLOAT,
                product_width_cm=FLOAT,
                last_update_date=DATE,
            ),
            keys=("product_id", "seller_id"),
            partition_by=("product_category_name_english",),
            order_col=LAST_UPDATE,
            feed=PRODUCTS_FEED,
            convert={
                "product_id": clean_id,
                "seller_id": clean_id,
                "product_category_name": clean_title,
                "product_category_name_english": clean_title,
                "price": to_float,
                "freight_value": to_float,
                "product_name_length": to_int,
                "product_description_length": to_int,
                "product_photos_qty": to_int,
                "product_weight_g": to_float,
                "product_length_cm": to_float,
                "product_height_cm": to_float,
                "product_width_cm": to_float,
            },
        ),
        SilverSpec(
            name="silver_sellers",
            app="Sellers",
            schema=struct(
                seller_id=STRING,
                seller_state=STRING,
                seller_state_code=STRING,
                last_update_date=DATE,
            ),
            keys=("seller_id",),
            partition_by=("seller_state",),
            order_col=LAST_UPDATE,
            feed=SELLERS_FEED,
            convert={
                "seller_id": clean_id,
                "seller_state": clean_title,
                "seller_state_code": clean_id,
            },
        ),
        SilverSpec(
            name="silver_order_items",
            app="Order_Items",
            schema=struct(
                order_id=STRING,
                product_id=STRING,
                seller_id=STRING,
                shipping_limit_date=TIMESTAMP,
                shipping_year=INT,
                item_quantity=LONG,
                price=DOUBLE,
                freight_value=DOUBLE,
                last_update_date=DATE,
            ),
            keys=("order_id", "product_id", "seller_id"),
            partition_by=("shipping_year",),
            order_col=LAST_UPDATE,
            feed=ORDER_ITEMS_FEED,
            convert={
                "order_id": clean_id,
                "product_id": clean_id,
                "seller_id": clean_id,
                "shipping_limit_date": _timestamp,
            },
        ),
        SilverSpec(
            name="silver_order_payments",
            app="Order_Payments",
            schema=struct(
                order_id=STRING,
                payment_sequential=INT,
                payment_type=STRING,
                payment_value=FLOAT,
                last_update_date=DATE,
            ),
            keys=("order_id", "payment_sequential"),
            partition_by=("payment_type",),
            order_col=LAST_UPDATE,
            feed=ORDER_PAYMENTS_FEED,
            convert={
                "order_id": clean_id,
                "payment_sequential": to_int,
                "payment_type": clean_label,
                "payment_value": to_float,
            },
        ),
        SilverSpec(
            name="silver_order_ratings",
            app="Order_Ratings",
            schema=struct(
                rating_id=STRING,
                order_id=STRING,
                rating_score=FLOAT,
                rating_survey_creation_date=DATE,
                rating_survey_answer_timestamp=TIMESTAMP,
                last_update_date=DATE,
            ),
            keys=("rating_id", "order_id"),
            partition_by=("rating_score",),
            order_col=LAST_UPDATE,
            feed=ORDER_RATINGS_FEED,
            convert={
                "rating_id": clean_id,
                "order_id": clean_id,
                "rating_score": to_float,
                "rating_survey_creation_date": _day,
                "rating_survey_answer_timestamp": _timestamp,
            },
        ),
    )
}

FEEDS: dict[str, FeedSpec] = {app: spec.feed for app, spec in SILVER.items()}


def _dimension(app: str, keys: tuple[str, ...]) -> DimensionSpec:
    schema = SILVER[app].schema
    attributes = tuple(c for c in schema.names if c not in keys and c != LAST_UPDATE)
    return DimensionSpec(app, keys, attributes, schema)


# Payments have no dimension; their fact reads the Silver table.
DIMENSIONS: dict[str, DimensionSpec] = {
    app: _dimension(app, SILVER[app].keys) for app in SILVER if app != "Order_Payments"
}

FACT_SALES = TableSpec(
    name="fact_sales",
    app="Sales",
    schema=struct(
        date_skey=STRING,
        customer_skey=STRING,
        order_skey=STRING,
        product_skey=STRING,
        seller_skey=STRING,
        order_purchase_timestamp=TIMESTAMP,
        order_purchase_month=STRING,
        product_category_name_english=STRING,
        sales_quantity=LONG,
        net_price=DOUBLE,
        net_freight_value=DOUBLE,
        net_sales_amount=DOUBLE,
        customer_state=STRING,
        customer_state_code=STRING,
        load_date=DATE,
    ),
    keys=("date_skey", "customer_skey", "order_skey", "product_skey", "seller_skey"),
    partition_by=("order_purchase_month",),
    order_col=LOAD_DATE,
)

FACT_ORDER_PAYMENTS = TableSpec(
    name="fact_order_payments",
    app="Order_Payments",
    schema=struct(
        date_skey=STRING,
        customer_skey=STRING,
        order_skey=STRING,
        order_status=STRING,
        payment_approved_at=TIMESTAMP,
        order_payment_month=STRING,
        payment_sequential=INT,
        payment_type=STRING,
        payment_value=FLOAT,
        load_date=DATE,
    ),
    keys=("date_skey", "customer_skey", "order_skey", "payment_sequential"),
    partition_by=("order_payment_month",),
    order_col=LOAD_DATE,
)
