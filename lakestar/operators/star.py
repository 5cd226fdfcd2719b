"""Star-schema operators: the calendar and joins to it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _calendar(days: DataFrame) -> DataFrame:
    return days.select(
        date_skey(F.col("cal_date")).alias("date_skey"),
        "cal_date",
        F.date_format("cal_date", "MMMM").alias("cal_month_name"),
    )


def date_skey(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def date_dim(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included.

    Built on ``range``, whose size the optimizer knows exactly; joins against it broadcast as long
    as the calendar fits the session's threshold, and shuffle beyond it.
    """
    days = spark.range((end - start).days + 1)
    return _calendar(days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("cal_date")))


def date_dim_covering(df: DataFrame, column: str) -> DataFrame:
    """The calendar from the first to the last day found in ``column``."""
    span = df.agg(F.min(column).cast("date").alias("a"), F.max(column).cast("date").alias("b"))
    return _calendar(
        span.filter(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("cal_date"))
    )


def join_date(df: DataFrame, dates: DataFrame, ts_column: str) -> DataFrame:
    """Inner join to the calendar day of ``ts_column``; adds date_skey and cal_month_name.

    The key is computed once on the left. Rows with a null timestamp, or with a day outside the
    calendar, drop out; ``undated`` returns those.
    """
    day = dates.select("date_skey", "cal_month_name")
    return df.withColumn("date_skey", date_skey(F.col(ts_column))).join(day, "date_skey", "inner")


def undated(df: DataFrame, dates: DataFrame, ts_column: str) -> DataFrame:
    """The rows ``join_date`` drops."""
    keyed = df.withColumn("date_skey", date_skey(F.col(ts_column)))
    return keyed.join(dates.select("date_skey"), "date_skey", "left_anti").drop("date_skey")
