"""Silver: valid rows, one per key, in clean text and proper types."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, pack, to_money, unpack
from ..operators.quality import (
    DISTINCT_ROWS,
    ROWS,
    VALID,
    dedupe_by_key,
    is_valid,
    key_groups,
    latest_first,
    quality_counts,
    require_not_null,
    verdicts,
)
from ..specs import LAST_UPDATE, LOAD_DATE, SILVER, FeedSpec, SilverSpec


ROW = "_row"


def bronze_columns(feed: FeedSpec) -> list[str]:
    return [*feed.columns, LOAD_DATE]


def valid_rows(bronze: DataFrame, feed: FeedSpec, normalize_keys_first: bool = False) -> DataFrame:
    """Rows with all required columns, latest per key, then the value test of the feed.

    Keys are compared as delivered; two spellings of one id both pass here and meet at the upsert.
    ``normalize_keys_first`` compares them trimmed and in upper case instead.
    """
    rows = require_not_null(bronze.select(*bronze_columns(feed)), feed.required)
    if normalize_keys_first:
        clean = SILVER[feed.app].convert
        for key in feed.dedupe_keys:
            if key in clean:
                rows = rows.withColumn(key, clean[key](F.col(key)).cast("string"))
    # Dealt before they are sorted: a task that reads a large file would hold or spill all its rows for that.
    rows = dedupe_by_key(rows.repartition(*feed.dedupe_keys), feed.dedupe_keys, order_col=LOAD_DATE)
    return rows.filter(feed.accept()) if feed.accept else rows


def valid_groups(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """``valid_rows`` and all other keys, with row counts, for a load that reports them, and their clean keys.

    Rows are dealt once, by the clean key, so that the steps of a load up to its batch need no other shuffle. Rows
    without a required column are dealt by the whole row, as many as they may be; a null key can be several groups.
    """
    feed, clean = spec.feed, clean_names(spec)
    raw = unpack(F.col(ROW), feed.columns)
    made = {c: spec.convert[k](raw[k]) for k, c in clean.items()}
    whole = reduce(and_, [raw[c].isNotNull() for c in feed.required])
    first = clean[spec.keys[0]]
    made[first] = F.when(whole, made[first]).otherwise(F.xxhash64(ROW).cast("string"))
    rows = dealt(bronze, feed, made, {k: raw[k] for k in feed.dedupe_keys})
    groups = key_groups(rows, [*clean.values(), *feed.dedupe_keys], LOAD_DATE)
    accept = feed.accept() if feed.accept else None
    groups = unpacked(groups, feed, *clean.values(), ROWS, DISTINCT_ROWS)
    return groups.withColumn(VALID, is_valid(feed.required, accept))


def feed_verdicts(bronze: DataFrame, feed: FeedSpec) -> DataFrame:
    """Every distinct row of a feed, with the reasons why it is not kept.

    Rows are dealt once, by their key as delivered; those without a required column by the whole row.
    """
    accept = feed.accept() if feed.accept else None
    raw = unpack(F.col(ROW), feed.columns)
    keys = {k: raw[k] for k in feed.dedupe_keys}
    whole = reduce(and_, [raw[c].isNotNull() for c in feed.required])
    spread = {"_spread": F.when(~whole, F.xxhash64(ROW)).otherwise(F.lit(0))}
    rows = unpacked(dealt(bronze, feed, keys | spread, {}), feed, *spread)
    judged = verdicts(rows, [*feed.dedupe_keys, *spread], feed.required, accept, LOAD_DATE, dealt=True)
    return judged.drop(*spread)


def feed_counts(bronze: DataFrame, feed: FeedSpec) -> DataFrame:
    """One row with the total, valid and invalid counts of a feed."""
    accept = feed.accept() if feed.accept else None
    rows = bronze.select(*bronze_columns(feed))
    return quality_counts(rows, feed.dedupe_keys, feed.required, accept, LOAD_DATE)


def items_rollup(items: DataFrame, by_extra: tuple[str, ...] = ()) -> DataFrame:
    """Clean item rows to one row per order, product, seller and ship date.

    The quantity counts non-null item numbers, so it is 0 for rows that carry none.
    """
    return items.groupBy(
        "order_id", "product_id", "seller_id", "shipping_limit_date", "shipping_year", *by_extra
    ).agg(
        F.count("order_item_id").alias("item_quantity"),
        money(F.sum(to_money(F.col("price")))).alias("price"),
        money(F.sum(to_money(F.col("freight_value")))).alias("freight_value"),
    )


def standardize(rows: DataFrame, spec: SilverSpec, clean: Mapping[str, str] | None = None) -> DataFrame:
    """Valid raw rows in the Silver schema; ``clean`` names columns that hold converted ones already."""
    clean = clean or {}
    converted = {
        name: (F.col(clean[name]) if name in clean else make(F.col(name))).alias(name)
        for name, make in spec.convert.items()
    }
    if spec.app == "Order_Items":
        items = rows.select(
            *converted.values(),
            "order_item_id",
            "price",
            "freight_value",
            F.col(LOAD_DATE).alias(LAST_UPDATE),
        ).withColumn("shipping_year", F.year("shipping_limit_date"))
        return items_rollup(items, (LAST_UPDATE,)).select(*spec.schema.names)
    return rows.select(*converted.values(), F.col(LOAD_DATE).alias(LAST_UPDATE))


def silver_transform(
    bronze: DataFrame, spec: SilverSpec, normalize_keys_first: bool = False
) -> DataFrame:
    return standardize(valid_rows(bronze, spec.feed, normalize_keys_first), spec)


def clean_names(spec: SilverSpec) -> dict[str, str]:
    """Columns for the clean keys, next to the keys as delivered."""
    return {k: f"_clean_{k}" for k in spec.keys}


def dealt(bronze: DataFrame, feed: FeedSpec, by: Mapping[str, Column], keys: Mapping[str, Column]) -> DataFrame:
    """The raw rows, packed, dealt by ``by``, with it and ``keys``, which are columns made of the packed row: made
    again behind the shuffle and not sent."""
    rows = bronze.select(pack(feed.columns).alias(ROW), LOAD_DATE).repartition(*by.values())
    return rows.select(*[v.alias(c) for c, v in {**keys, **by}.items()], ROW, LOAD_DATE)


def unpacked(rows: DataFrame, feed: FeedSpec, *kept: str) -> DataFrame:
    """The columns of a feed from packed rows, and those of ``kept``."""
    raw = unpack(F.col(ROW), feed.columns)
    return rows.select(*[c if c in feed.dedupe_keys else v.alias(c) for c, v in raw.items()], LOAD_DATE, *kept)


def silver_latest(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """``silver_transform`` of one delivery, then the latest row per clean key.

    Rows are dealt once, by their clean key. Raw keys, item rows and clean keys are all parts of such a
    group, and their steps use the one sort that puts the rows of a clean key together. Rows are not sorted before
    they are dealt either, since a task that reads a large file would spill them; they are sent and sorted as one
    text. All rows of a clean key meet in one task, as a sorted stream.
    """
    feed, clean = spec.feed, clean_names(spec)
    raw = unpack(F.col(ROW), feed.columns)
    # Said to be there, which they are: a test for it, as joins add, would be carried down into the packed text.
    raw |= {c: F.coalesce(raw[c], F.lit("")) for c in feed.required}
    made = {c: spec.convert[k](raw[k]) for k, c in clean.items()}
    rows = dealt(require_not_null(bronze, feed.required), feed, made, {k: raw[k] for k in feed.dedupe_keys})
    rows = dedupe_by_key(rows, [*clean.values(), *feed.dedupe_keys], order_col=LOAD_DATE)
    rows = unpacked(rows, feed, *clean.values())
    rows = standardize(rows.filter(feed.accept()) if feed.accept else rows, spec, clean)
    ranked = latest_first(rows, spec.keys, LAST_UPDATE)
    top = rows.groupBy(*spec.keys).agg(F.max(F.struct(*ranked)).alias("_top"))
    return top.select(*[F.col(c) if c in spec.keys else F.col(f"_top.{c}").alias(c) for c in rows.columns])


def customers(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER["Customers"])


def orders(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER["Orders"])


def products(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER["Products"])


def sellers(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER["Sellers"])


def order_items(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER["Order_Items"])


def order_payments(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER["Order_Payments"])


def order_ratings(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER["Order_Ratings"])
