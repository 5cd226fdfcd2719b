"""Raw feeds: file scans and the ingest specs that name them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ..specs import STRING, struct

INGEST_SPEC_SCHEMA = struct(
    sys_name=STRING,
    app_name=STRING,
    load_order=IntegerType(),
    inbound_bucket=STRING,
    raw_file_path=STRING,
    raw_file_name=STRING,
    raw_file_format=STRING,
    delimiter=STRING,
    bronze_file_path=STRING,
    bronze_table_name=STRING,
    is_enabled=BooleanType(),
    job_status=STRING,
)
INGEST_SPEC_COLUMNS = tuple(
    c for c in INGEST_SPEC_SCHEMA.names if c not in ("is_enabled", "job_status")
)

FORMATS = ("csv", "json", "parquet", "orc")


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_feed(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    delimiter: str = ",",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A raw feed with every column as a string.

    Delimited files carry a header. With ``columns`` the schema is fixed and the header is checked
    against it; without, the names come from the header. Types are never inferred, so the file is
    not read ahead of the load.
    """
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown feed format {fmt!r}, expected one of {FORMATS}")
    if fmt == "csv":
        reader = spark.read.options(sep=delimiter, header=True)
        if columns is not None:
            reader = reader.schema(string_schema(columns)).option("enforceSchema", False)
        return reader.csv(path)
    if fmt == "json":
        reader = spark.read.option("primitivesAsString", True)
        return (reader.schema(string_schema(columns)) if columns else reader).json(path)
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns or df.columns])


BROKEN, FILE = "broken_line", "file"


def read_feed_lines(
    spark: SparkSession, path: str, columns: Sequence[str], delimiter: str = ",", header: bool = True
) -> DataFrame:
    """A delimited feed with the lines that do not fit it.

    ``broken_line`` holds the whole text of a line with too few or too many fields or an unclosed quote, and
    is null for the others; ``file`` names where it is. Fields of broken lines are as far as they could be
    read. All columns are parsed, whichever are selected, or lines would fit by being read in part.
    """
    reader = spark.read.schema(string_schema([*columns, BROKEN])).options(
        sep=delimiter, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, columnPruning=False
    )
    # Spark refuses to read the broken lines alone; naming another column beside them says the same.
    broken = F.when(F.col(BROKEN).isNotNull() | F.col(columns[0]).isNull(), F.col(BROKEN)).alias(BROKEN)
    return reader.csv(path).select(*columns, broken, F.col("_metadata.file_path").alias(FILE))


def line_counts(lines: DataFrame) -> DataFrame:
    """Rows and broken lines of each file of ``read_feed_lines``."""
    return lines.groupBy(FILE).agg(F.count(F.lit(1)).alias("n_lines"), F.count(BROKEN).alias("n_broken"))


def enabled_specs(specs: DataFrame, sys_name: str) -> DataFrame:
    """Ingest specs of a system that are switched on, in load order."""
    return (
        specs.filter((F.col("sys_name") == sys_name) & F.col("is_enabled"))
        .select(*INGEST_SPEC_COLUMNS)
        .orderBy(F.col("load_order").asc_nulls_last())
    )
