"""The registered queries: one per operator, each over whole driver tables.

Each callable takes a session and the folder of the driver tables. ``oracle`` holds the SQL that
gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ..functions import (
    changed,
    clean_id,
    clean_label,
    clean_lower,
    clean_title,
    in_range,
    parse_day,
    parse_timestamp,
    surrogate_key,
    to_float,
    to_int,
)
from ..operators import scd2
from ..operators.quality import dedupe_by_key, invalid_rows, require_not_null
from ..operators.star import date_dim, date_dim_covering, join_date, undated
from ..operators.upsert import upsert
from ..plans import facts
from ..plans.bronze import add_audit
from ..plans.loads import ingest_feed, load_dimension, load_fact, load_silver, read_rejected
from ..plans.silver import feed_counts, items_rollup, silver_transform, valid_rows
from ..sources.audit import LoadAudit, read_audit, reconcile
from ..sources.feeds import FILE, enabled_specs, read_feed, read_feed_lines
from ..sources.tables import read_table, scratch_path
from ..specs import (
    AUDIT_COLUMNS,
    DIMENSIONS,
    FACT_SALES,
    SILVER,
    TIMESTAMP_FORMAT,
)
from .feeds import DAY, feed, table
from .stages import (
    CALENDAR,
    bronze_table,
    dimension,
    sales_of_day,
    sales_table,
    silver_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Tables whose stored loads have queries of their own: one with a key of two columns, one that is rolled up.
SINKS = ("Products", "Order_Items")


def portable(df: DataFrame) -> DataFrame:
    """32-bit floats as doubles, which every engine prints and hashes alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, FloatType) else f.name
            for f in df.schema
        ]
    )


def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer_csv")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    table(spark, sf_dir, "customer").select(*columns).write.csv(path, header=True, sep="|")
    return read_feed(spark, path, "csv", "|", columns)


def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def bronze_ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "bronze_ingest")
    suppliers = table(spark, sf_dir, "supplier").withColumn(
        "s_acctbal", F.col("s_acctbal").cast("decimal(18,2)")
    )
    suppliers.write.csv(f"{root}/raw", header=True)
    audit = LoadAudit(spark, f"{root}/audit", 1, "bronze", "verification")
    ingest_feed(spark, f"{root}/raw", f"{root}/bronze", "Suppliers", "bronze_suppliers", DAY[2], audit)
    columns = [f"{c} string" for c in suppliers.columns]
    columns += [f"{f.name} {f.dataType.simpleString()}" for f in AUDIT_COLUMNS]
    loaded = spark.read.schema(", ".join(columns)).parquet(f"{root}/bronze")
    return loaded.withColumn("uuid_is_set", F.length("uuid") == 36).drop("uuid")


def ingest_spec_enabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("sys_name"),
            F.col("n_name").alias("app_name"),
            F.col("n_nationkey").alias("load_order"),
            F.lit("raw").alias("inbound_bucket"),
            F.concat(F.lower("r_name"), F.lit("/")).alias("raw_file_path"),
            F.concat(F.lower("n_name"), F.lit(".csv")).alias("raw_file_name"),
            F.lit("csv").alias("raw_file_format"),
            F.lit(",").alias("delimiter"),
            F.concat(F.lit("bronze/"), F.lower("n_name")).alias("bronze_file_path"),
            F.concat(F.lit("bronze_"), F.lower("n_name")).alias("bronze_table_name"),
            (F.length("n_name") > 8).alias("is_enabled"),
            F.lit("Yet_To_Start").alias("job_status"),
        )
    )
    return enabled_specs(specs, "ASIA")


def dq_required_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey") % 11, F.lit(0)).alias("customer_ref"), "o_orderstatus"
    )
    return require_not_null(orders, ["o_orderkey", "customer_ref"])


def dedupe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return dedupe_by_key(lines, ["l_orderkey", "l_linenumber"], order_col="l_shipdate")


def valid_invalid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        feed_counts(bronze_table(spark, sf_dir, app, 2), spec.feed).withColumn("app", F.lit(app))
        for app, spec in SILVER.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def invalid_rows_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze_table(spark, sf_dir, "Order_Items", 2)
    return invalid_rows(rows, valid_rows(rows, SILVER["Order_Items"].feed))


def standardize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" of "), F.col("c_name"), F.lit(" "))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        clean_id(spaced).alias("as_id"),
        clean_lower(spaced).alias("as_lower"),
        clean_title(spaced).alias("as_title"),
    )


def translate_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.lower(F.translate("o_orderpriority", " -", "__"))
    return table(spark, sf_dir, "orders").select("o_orderkey", clean_label(code).alias("label"))


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    order_id = F.concat(F.lit(" o"), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        clean_id(order_id).alias("order_id"),
        surrogate_key(clean_id(order_id)).alias("order_skey"),
        surrogate_key(F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("status_skey"),
    )


def parse_12h_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 13 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format("ts", TIMESTAMP_FORMAT)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_timestamp(TIMESTAMP_FORMAT)(text).alias("parsed_at"),
        parse_day(TIMESTAMP_FORMAT)(text).alias("parsed_day"),
    )


def _event_text(n: int) -> F.Column:
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    return F.when(F.col("event_id") % n == 0, F.lit("x")).otherwise(amount)


def lenient_numeric_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.concat(F.floor("value").cast("string"), F.lit(".0"))
    count = F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(whole)
    return table(spark, sf_dir, "events").select(
        "event_id",
        to_float(_event_text(11)).cast("double").alias("amount"),
        to_int(count).alias("whole"),
    )


def score_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("event_id") % 11 == 0, F.lit("x")).otherwise(
        (F.col("value").cast("decimal(18,2)") % 7).cast("string")
    )
    scored = table(spark, sf_dir, "events").select("event_id", score.alias("score"))
    return scored.filter(in_range(F.col("score"), 1, 5))


def null_safe_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, F.lit("")).when(
            F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")
        ).alias("segment"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("nation"),
    )
    shifted = customers.withColumn("c_custkey", F.col("c_custkey") + 1)
    types = {f.name: f.dataType for f in customers.schema}
    pair = customers.alias("new").join(shifted.alias("old"), "c_custkey")
    return pair.select(
        "c_custkey",
        *[
            changed(f"old.{c}", f"new.{c}", types[c]).alias(f"{c}_changed")
            for c in ("segment", "balance", "nation")
        ],
    )


def rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_partkey") % 5).alias("product_id"),
        (F.col("l_suppkey") % 5).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.year("l_shipdate").alias("shipping_year"),
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("order_item_id"),
        F.col("l_extendedprice").cast("string").alias("price"),
        (F.col("l_tax") * 100).cast("decimal(18,2)").cast("string").alias("freight_value"),
    )
    return items_rollup(items)


def silver(app: str) -> Query:
    return lambda spark, sf_dir: portable(
        silver_transform(bronze_table(spark, sf_dir, app, 2), SILVER[app])
    )


def _order_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders again: some changed, some under a new key, some delivered twice."""
    key = F.col("o_orderkey")
    later = F.when(F.col("take") == 1, F.lit(86400)).otherwise(F.lit(0))
    takes = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        table(spark, sf_dir, "orders")
        .withColumn("take", F.explode(takes))
        .withColumn("o_orderdate", F.timestamp_add("SECOND", later, F.col("o_orderdate")))
        .withColumn("o_totalprice", F.col("o_totalprice") + F.col("take"))
        .withColumn(
            "o_orderstatus", F.when(key % 7 == 0, F.lit("R")).otherwise(F.col("o_orderstatus"))
        )
        .withColumn("o_orderkey", F.when(key % 5 == 0, key + 1_000_000_000_000).otherwise(key))
        .drop("take")
    )


def upsert_orders(scope: str, keep_newer: bool = False) -> Query:
    return lambda spark, sf_dir: upsert(
        table(spark, sf_dir, "orders"),
        _order_batch(spark, sf_dir),
        ["o_orderkey"],
        "o_orderdate",
        scope=scope,
        partition_cols=["o_orderstatus"],
        keep_newer=keep_newer,
    )


def scd2_part(app: str, part: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(
        part(
            silver_table(spark, sf_dir, app, 2),
            dimension(spark, sf_dir, app, 1),
            DIMENSIONS[app],
            DAY[2],
        )
    )


def scd2_applied(app: str) -> Query:
    return lambda spark, sf_dir: portable(
        scd2.scd2_apply(
            dimension(spark, sf_dir, app, 1),
            scd2.scd2_changes(
                silver_table(spark, sf_dir, app, 2),
                dimension(spark, sf_dir, app, 1),
                DIMENSIONS[app],
                DAY[2],
            ),
            DIMENSIONS[app],
        )
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dim_covering(table(spark, sf_dir, "orders"), "o_orderdate")


def date_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return join_date(orders, date_dim(spark, *CALENDAR), "o_orderdate")


def undated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return undated(orders, date_dim(spark, *CALENDAR), "o_orderdate")


def dim_current_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.current(dimension(spark, sf_dir, "Orders", 2))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_of_day(spark, sf_dir, 2)


def fact_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(
        facts.fact_order_payments(
            date_dim(spark, *CALENDAR),
            scd2.current(dimension(spark, sf_dir, "Orders", 2)),
            silver_table(spark, sf_dir, "Order_Payments", 2),
            DAY[2],
        )
    )


def fact_sales_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(
        sales_table(spark, sf_dir, 1),
        sales_table(spark, sf_dir, 2),
        FACT_SALES.keys,
        FACT_SALES.order_col,
        scope="partition",
        partition_cols=FACT_SALES.partition_by,
        together=True,
    )


def monthly_sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.monthly_sales_by_category(fact_sales(spark, sf_dir))


def load_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of real loads of the order tables, then the reconciled log."""
    root = scratch_path(spark, "load_audit")
    silver_spec, dim_spec = SILVER["Orders"], DIMENSIONS["Orders"]
    for day, as_of in DAY.items():
        audit = LoadAudit(spark, f"{root}/audit", day, "daily", "verification")
        bronze = bronze_table(spark, sf_dir, "Orders", day)
        load_silver(spark, bronze, f"{root}/silver", silver_spec, audit)
        source = read_table(spark, f"{root}/silver", silver_spec.schema, dim_spec.source_columns)
        load_dimension(spark, source, f"{root}/dim", dim_spec, as_of, audit)
    return reconcile(read_audit(spark, f"{root}/audit"))


def dimension_sink(app: str) -> Query:
    """Two daily loads of a stored dimension, read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, spec = scratch_path(spark, "dimension_sink"), DIMENSIONS[app]
        for day, as_of in DAY.items():
            audit = LoadAudit(spark, f"{root}/audit", day, "daily", "verification")
            load_dimension(spark, silver_table(spark, sf_dir, app, day), f"{root}/dim", spec, as_of, audit)
        return portable(read_table(spark, f"{root}/dim", spec.schema))

    return query


def silver_sink(app: str) -> Query:
    """Two daily loads of a stored Silver table, read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, spec = scratch_path(spark, "silver_sink"), SILVER[app]
        for day in DAY:
            audit = LoadAudit(spark, f"{root}/audit", day, "daily", "verification")
            load_silver(spark, feed(spark, sf_dir, app, day), f"{root}/silver", spec, audit)
        return portable(read_table(spark, f"{root}/silver", spec.schema))

    return query


def fact_sales_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily loads of the stored sales fact, read back; rows of March have no month."""
    root = scratch_path(spark, "fact_sales_sink")
    for day in DAY:
        audit = LoadAudit(spark, f"{root}/audit", day, "daily", "verification")
        rows = sales_table(spark, sf_dir, day)
        rows = rows.withColumn("order_purchase_month", F.nullif("order_purchase_month", F.lit("March")))
        load_fact(spark, rows, f"{root}/fact", FACT_SALES, audit)
    return read_table(spark, f"{root}/fact", FACT_SALES.schema)


def bronze_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that is delivered on two days, read back from the stored table: the second delivery alone."""
    root = scratch_path(spark, "bronze_reload")
    for day in DAY:
        audit = LoadAudit(spark, f"{root}/audit", day, "daily", "verification")
        sellers = table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 5 != day)
        sellers = sellers.select("s_suppkey", "s_name", F.lit(day).alias("delivery"))
        sellers.write.csv(f"{root}/raw{day}", header=True)
        ingest_feed(spark, f"{root}/raw{day}", f"{root}/bronze", "Suppliers", "bronze_suppliers", DAY[day], audit)
    schema = "s_suppkey string, s_name string, delivery string, load_date date"
    return spark.read.schema(schema).parquet(f"{root}/bronze").select("s_suppkey", "s_name", "delivery", "load_date")


def quarantine(app: str) -> Query:
    """The rows that the loads of two days did not keep, with their reasons."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, spec = scratch_path(spark, "quarantine"), SILVER[app]
        for day in DAY:
            audit = LoadAudit(spark, f"{root}/audit", day, "daily", "verification")
            bronze = feed(spark, sf_dir, app, day)
            load_silver(spark, bronze, f"{root}/silver", spec, audit, quarantine=f"{root}/rejected")
        return read_rejected(spark, f"{root}/rejected", spec.feed)

    return query


def lost_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    def dim(app: str) -> DataFrame:
        return scd2.current(dimension(spark, sf_dir, app, 2))

    apps = ("Customers", "Orders", "Products", "Order_Items")
    star = facts.checked_sales(date_dim(spark, *CALENDAR), *(dim(app) for app in apps), DAY[2])
    return facts.lost_sales(star)


def scan_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delimited feed some of whose lines have a field too many or too few."""
    path, key = scratch_path(spark, "broken_lines"), F.col("o_orderkey")
    fields = [key.cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus"]
    line = F.when(key % 13 == 0, F.concat_ws("|", *fields[:2])).otherwise(F.concat_ws("|", *fields))
    line = F.when(key % 11 == 0, F.concat(line, F.lit("|more"), F.when(key % 13 == 0, "|still").otherwise(""))).otherwise(line)
    table(spark, sf_dir, "orders").select(line).write.text(path)
    return read_feed_lines(spark, path, ["order_id", "customer_id", "status"], "|", header=False).drop(FILE)


def audited_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_audit(table(spark, sf_dir, "orders"), DAY[2]).drop("uuid")


QUERIES: dict[str, Query] = {
    "scan_csv_strings": scan_csv_strings,
    "scan_project": scan_project,
    "bronze_ingest_audit": bronze_ingest_audit,
    "audit_columns": audited_orders,
    "ingest_spec_enabled": ingest_spec_enabled,
    "dq_required_not_null": dq_required_not_null,
    "dedupe_by_key": dedupe_lineitem,
    "valid_invalid_counts": valid_invalid_counts,
    "invalid_rows_except": invalid_rows_except,
    "standardize_strings": standardize_strings,
    "translate_payment_type": translate_payment_type,
    "surrogate_key": surrogate_keys,
    "parse_12h_timestamps": parse_12h_timestamps,
    "lenient_numeric_casts": lenient_numeric_casts,
    "score_range_filter": score_range_filter,
    "null_safe_change": null_safe_change,
    "items_rollup": rollup_lineitem,
    **{spec.name: silver(app) for app, spec in SILVER.items()},
    "upsert_latest_wins": upsert_orders("table"),
    "upsert_keep_newer": upsert_orders("table", keep_newer=True),
    "upsert_partition_scoped": upsert_orders("partition"),
    **{f"scd2_new_{app.lower()}": scd2_part(app, scd2.scd2_new) for app in DIMENSIONS},
    **{f"scd2_active_{app.lower()}": scd2_part(app, scd2.scd2_active) for app in DIMENSIONS},
    **{f"scd2_inactive_{app.lower()}": scd2_part(app, scd2.scd2_inactive) for app in DIMENSIONS},
    **{f"scd2_upsert_{app.lower()}": scd2_part(app, scd2.scd2_changes) for app in DIMENSIONS},
    **{f"scd2_apply_{app.lower()}": scd2_applied(app) for app in DIMENSIONS},
    "date_dim": order_days,
    "date_join": date_join,
    "undated_orders": undated_orders,
    "dim_current_snapshot": dim_current_snapshot,
    "fact_sales": fact_sales,
    "fact_order_payments": fact_order_payments,
    "fact_sales_upsert": fact_sales_upsert,
    "fact_sales_sink": fact_sales_sink,
    "bronze_reload": bronze_reload,
    **{f"dimension_sink_{app.lower()}": dimension_sink(app) for app in SINKS},
    **{f"silver_sink_{app.lower()}": silver_sink(app) for app in SINKS},
    **{f"quarantine_{app.lower()}": quarantine(app) for app in ("Order_Ratings", "Order_Items")},
    "lost_sales": lost_sales,
    "scan_broken_lines": scan_broken_lines,
    "load_audit_log": load_audit_log,
    "monthly_sales_by_category": monthly_sales_by_category,
}
