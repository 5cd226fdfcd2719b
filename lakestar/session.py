"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the skew handling of joins and of writes, and picks broadcasts by
# measured size; a session without it gives the same results, but hot keys stay whole.
RECOMMENDED: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Timestamps with row-group statistics, so that filters on them can skip data.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Call-site capture costs a round trip to the JVM for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder, **overrides: str) -> SparkSession.Builder:
    for name, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(name, value)
    return builder
