"""Stored tables: partitioned Parquet folders.

Two layouts, told apart on read:

* snapshots, ``<root>/snapshot=<n>/``: a load writes the next folder in full and readers take the
  newest complete one. Nothing that is being read is ever touched.
* in place, ``<root>/<partition>=.../``: a load replaces the partitions it has rows for and leaves
  the others alone. Used where a key cannot move between partitions, which a hash bucket of the key as
  the innermost partition makes true for any table.

Writes are preceded by a rebalance on the partition columns: adaptive execution then cuts a
partition value that holds much of the table into many files and merges the small ones.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.quality import dedupe_by_key
from ..operators.upsert import upsert
from ..specs import TableSpec

SNAPSHOT = "snapshot="
STAGING = "_staging"  # hidden from readers


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def discard(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str, near: str | None = None) -> str:
    """A new folder for intermediate data that every executor sees.

    It lies in the shared folder the cluster names, else in a hidden folder under ``near``, the stored
    table the data is for. Only a session that runs in one process may fall back to the machine's
    temporary folder; any other has to name one of the two.
    """
    unique = f"{name}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/lakestar/{unique}"
    if near:
        return f"{near.rstrip('/')}/{STAGING}/{unique}"
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix='lakestar-')}/{unique}"


def _folders(spark: SparkSession, root: str) -> list[str]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(p) if entry.isDirectory()]
    return [name for name in names if "=" in name]


def _complete_snapshots(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished snapshots; a folder without a success marker is a failed load."""
    return sorted(
        int(name.removeprefix(SNAPSHOT))
        for name in _folders(spark, root)
        if name.startswith(SNAPSHOT) and exists(spark, f"{root}/{name}/_SUCCESS")
    )


def latest_path(spark: SparkSession, root: str) -> str | None:
    """The folder that holds the table now, or None before the first load."""
    complete = _complete_snapshots(spark, root)
    if complete:
        return f"{root}/{SNAPSHOT}{complete[-1]:08d}"
    in_place = any(not name.startswith(SNAPSHOT) for name in _folders(spark, root))
    return root if in_place else None


def require_layout(spark: SparkSession, root: str, snapshots: bool) -> None:
    """Fails, before anything is written, if the table is stored in the other layout.

    A folder of either layout counts, complete or not: two layouts under one root would hide rows of
    one from readers, or make the table unreadable.
    """
    for name in _folders(spark, root):
        if name.startswith(SNAPSHOT) != snapshots:
            stored, asked = ("in place", "snapshots") if snapshots else ("snapshots", "in place")
            raise ValueError(f"{root} is stored as {stored} and cannot be loaded as {asked}")


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows; the optimizer knows from the start, and drops the joins a first load would make with it
    before it infers anything from their conditions."""
    fields = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    return DataFrame(spark._jsparkSession.createDataFrame(spark._jvm.java.util.ArrayList(), fields), spark)


def read_table(
    spark: SparkSession, root: str, schema: StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """A table, or the listed columns of it. Before its first load a table is empty, not missing."""
    path = latest_path(spark, root)
    df = empty_table(spark, schema) if path is None else spark.read.schema(schema).parquet(path)
    return df.select(*(columns or schema.names))


def table_count(spark: SparkSession, root: str, schema: StructType) -> int:
    """Row count of a stored table; answered from the file footers."""
    return read_table(spark, root, schema).count()


def blank_partitions_to_null(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """An empty partition value is stored as null, so it has to be null for key matching too."""
    blank = {
        c: F.nullif(F.col(c), F.lit(""))
        for c in partition_by
        if isinstance(df.schema[c].dataType, StringType)
    }
    return df.withColumns(blank) if blank else df


def _writer(df: DataFrame, partition_by: Sequence[str]):
    if not partition_by:
        return df.write.option("compression", "zstd")
    return df.hint("rebalance", *partition_by).write.option("compression", "zstd").partitionBy(*partition_by)


def _beside(root: str, kind: str) -> str:
    """A folder next to a table, hidden from whoever lists the tables."""
    parent, slash, name = root.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{kind}/{name}"


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, to = _fs(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(_fs(spark, source)[1], to):
        raise OSError(f"could not move {source} to {target}")


def settle_reload(spark: SparkSession, root: str) -> None:
    """Puts a table back whose reload died between its two moves; readers of such tables call it first."""
    old = _beside(root, "replaced")
    if exists(spark, old) and not exists(spark, root):
        _move(spark, old, root)


def write_full_reload(df: DataFrame, root: str, partition_by: Sequence[str]) -> None:
    """Replaces a table that is always delivered whole; rows are written where they were read.

    They are written aside, whatever overwrite mode the session has, and the folders switch when all of
    them are there: a write that fails leaves the stored table as it was, and nothing of the last reload
    stays under another partition. The switch is two moves; ``settle_reload`` undoes the first if the
    driver dies between them. One writer per table at a time.
    """
    spark = df.sparkSession
    settle_reload(spark, root)
    aside, old = _beside(root, "reload"), _beside(root, "replaced")
    for left in (aside, old):  # by a run that died
        discard(spark, left)
    try:
        df.write.mode("error").partitionBy(*partition_by).parquet(aside)
        if exists(spark, root):
            _move(spark, root, old)
        try:
            _move(spark, aside, root)
        except Exception:
            settle_reload(spark, root)
            raise
    finally:
        discard(spark, aside)
    discard(spark, old)


def write_snapshot(spark: SparkSession, df: DataFrame, root: str, partition_by: Sequence[str]) -> str:
    """Writes the next snapshot; readers switch to it when its success marker appears."""
    require_layout(spark, root, snapshots=True)
    complete = _complete_snapshots(spark, root)
    path = f"{root}/{SNAPSHOT}{(complete[-1] + 1 if complete else 1):08d}"
    _writer(df, partition_by).mode("overwrite").parquet(path)
    if not exists(spark, f"{path}/_SUCCESS"):
        raise ValueError("success markers are switched off, so readers could not find the snapshot")
    return path


def expire_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Drops all but the newest ``keep`` complete snapshots; call it when no reader needs them."""
    if keep < 1:
        raise ValueError("at least the newest snapshot has to stay")
    old = [f"{root}/{SNAPSHOT}{n:08d}" for n in _complete_snapshots(spark, root)[:-keep]]
    for path in old:
        discard(spark, path)
    return old


def overwrite_partitions(df: DataFrame, root: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions ``df`` has rows for; it may read the same partitions.

    Tasks write to a staging folder and the swap happens at job commit, so lost executors cost
    retries only.
    """
    _writer(df, partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
        root
    )


# What no value of a type is below.
_LEAST = {
    "string": "''",
    "int": "int('-2147483648')",
    "bigint": "bigint('-9223372036854775808')",
    "date": "date'0001-01-01'",
}


def _as_table(spark: SparkSession, values: Sequence[tuple], schema: StructType) -> DataFrame:
    """A few rows, none of them empty, as a table whose size the optimizer knows."""
    rows = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema, strict=True)]) for row in values])
    return spark.range(1).select(F.inline(rows))


def in_partitions_of(target: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows in the partitions that ``batch`` touches, however many these are.

    A semi join on plain equality whose small side has a filter is what dynamic partition pruning
    takes: the touched folders are found first and only they are listed. Their values are collected, as the
    commit of the write does too: planned on a large batch, the small side would be taken for as large, the
    folders would not be pruned and the target would be shuffled for the semi join. The filter keeps every value
    that is not null. Folders of nulls are told apart by a flag per column, as constants, so that they
    are pruned as partition filters; a batch without nulls reads none of them.
    """
    kinds = dict(target.dtypes)
    values = [tuple(row) for row in batch.select(*partition_by).distinct().collect()]
    fields = StructType([target.schema[c] for c in partition_by])
    parts = []
    for shape in sorted({tuple(v is None for v in row) for row in values}, reverse=True):
        held = target
        found = _as_table(target.sparkSession, [row for row in values if tuple(v is None for v in row) == shape], fields)
        filled = [c for c, null in zip(partition_by, shape, strict=True) if not null]
        for c, null in zip(partition_by, shape, strict=True):
            is_null = F.col(c).isNull()
            held = held.filter(is_null if null else ~is_null)
            found = found.filter(is_null if null else F.expr(f"`{c}` >= {_LEAST[kinds[c]]}"))
        if filled:
            held = held.join(found.select(*filled), filled, "left_semi")
        parts.append(held.select(*target.columns))
    return reduce(DataFrame.unionByName, parts) if parts else target.filter(F.lit(False))


def stored_layout(spark: SparkSession, root: str) -> tuple[str, ...]:
    """The folder levels of a table stored in place, from any of its rows' folders; none if it is empty."""
    levels: list[str] = []
    while folders := _folders(spark, root):
        levels.append(folders[0].split("=")[0])
        root = f"{root}/{folders[0]}"
    return tuple(levels)


def require_levels(spark: SparkSession, root: str, spec: TableSpec) -> None:
    """Fails if the table has other folder levels, another number of buckets for one: its rows would not be
    found where the spec looks for them."""
    stored = stored_layout(spark, root)
    if stored and stored != spec.layout:
        raise ValueError(f"{root} is stored by {stored} and cannot be loaded by {spec.layout}")


def bucketed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the bucket of each row, if the table has buckets; -1 where rows stay together."""
    if not spec.buckets:
        return df
    bucket = F.pmod(F.xxhash64(*spec.bucket_by), F.lit(spec.buckets)).cast("int")
    return df.withColumn(spec.bucket_column, F.when(F.expr(spec.bucket_if), bucket).otherwise(-1))


def latest_in_batch(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of a batch that ``merge_partitions`` would keep; free of a shuffle where they are dealt by some of
    the key."""
    match = [*spec.keys, *(c for c in spec.layout if c not in spec.keys)]
    return dedupe_by_key(bucketed(batch, spec), match, order_col=spec.order_col).select(*batch.columns)


def merge_partitions(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    batch: DataFrame,
    keep_newer: bool = False,
    unique: bool = False,
) -> None:
    """Upserts a stored batch partition by partition, in place.

    ``batch`` is read more than once, so it should be a written table and not a long plan. Partitions, and
    buckets, without a row of the batch are neither read nor written. ``unique`` says that the batch holds one row
    for each key, as ``latest_in_batch`` leaves it: it is then not shuffled to find that out.
    """
    require_layout(spark, root, snapshots=False)
    require_levels(spark, root, spec)
    schema = StructType([*spec.schema.fields, *([StructField(spec.bucket_column, IntegerType())] if spec.buckets else [])])
    batch = bucketed(batch, spec)
    merged = upsert(
        in_partitions_of(read_table(spark, root, schema), batch, spec.layout),
        batch,
        spec.keys,
        spec.order_col,
        scope="partition",
        partition_cols=spec.layout,
        keep_newer=keep_newer,
        unique=unique,
    )
    overwrite_partitions(merged, root, spec.layout)
