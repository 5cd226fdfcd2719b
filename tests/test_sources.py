from __future__ import annotations

import datetime as dt
import tempfile
from dataclasses import replace
from types import SimpleNamespace

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from lakestar.operators.quality import quality_totals
from lakestar.plans.bronze import add_audit
from lakestar.plans.lakehouse import Lakehouse
from lakestar.plans.loads import ingest_from_spec
from lakestar.sources import tables
from lakestar.sources.audit import LoadAudit, compact_audit, read_audit, reconcile
from lakestar.sources.feeds import (
    INGEST_SPEC_COLUMNS,
    INGEST_SPEC_SCHEMA,
    enabled_specs,
    line_counts,
    read_feed,
    read_feed_lines,
)
from lakestar.specs import INT, STRING, TableSpec, struct

AS_OF = dt.date(2024, 2, 1)
SPEC = TableSpec(
    name="t",
    app="T",
    schema=struct(id=STRING, part=STRING, seq=INT),
    keys=("id",),
    partition_by=("part",),
    order_col="seq",
)


def frame(spark, data):
    return spark.createDataFrame(data, "id string, part string, seq int")


def test_delimited_feed(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text('a|b|c\n1||x\n2|""|y\n3\n4|5|6|7\n')
    got = read_feed(spark, str(path), "csv", "|")
    assert got.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    expected = [("1", None, "x"), ("2", None, "y"), ("3", None, None), ("4", "5", "6")]
    assert rows(got) == expected
    assert rows(read_feed(spark, str(path), "CSV", "|", ["a", "b", "c"])) == expected


def test_a_header_that_does_not_match_is_refused(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_feed(spark, str(path), columns=["b", "a"]).collect()


def test_other_feed_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "x"), (2, None, "y")], "a int, b double, c string")
    expected = [("1", "2.5", "x"), ("2", None, "y")]
    for fmt in ("json", "parquet", "orc"):
        path = str(tmp_path / fmt)
        df.write.format(fmt).save(path)
        assert rows(read_feed(spark, path, fmt, columns=["a", "b", "c"])) == expected
        assert rows(read_feed(spark, path, fmt).select("a", "b", "c")) == expected
    with pytest.raises(ValueError, match="unknown feed format"):
        read_feed(spark, "x", "xml")


def test_enabled_specs(spark):
    def spec(system, order, on):
        return (system, f"app{order}", order, "b", "p", "f", "csv", ",", "bp", "bt", on, "new")

    data = [spec("Shop", 3, True), spec("Shop", 1, True), spec("Shop", 2, False), spec("Web", 1, True), spec("Shop", 4, None)]
    got = enabled_specs(spark.createDataFrame(data, INGEST_SPEC_SCHEMA), "Shop")
    assert got.columns == list(INGEST_SPEC_COLUMNS)
    assert [r.app_name for r in got.collect()] == ["app1", "app3"]


def test_audit_columns(spark):
    df = add_audit(spark.range(100), AS_OF)
    assert df.dtypes[1:] == [("uuid", "string"), ("process_id", "bigint"), ("load_date", "date")]
    found = df.collect()
    assert {(r.process_id, r.load_date) for r in found} == {(20240201, AS_OF)}
    assert len({r.uuid for r in found}) == 100


def test_spec_refuses_unknown_columns():
    with pytest.raises(ValueError, match="nope"):
        TableSpec("t", "T", SPEC.schema, ("id",), ("nope",), "seq")


def test_a_table_before_its_first_load_is_empty(spark, tmp_path):
    root = str(tmp_path / "none")
    assert tables.read_table(spark, root, SPEC.schema).schema.names == ["id", "part", "seq"]
    assert tables.table_count(spark, root, SPEC.schema) == 0


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_snapshot(spark, frame(spark, [("a", "p", 1)]), root, ["part"])
    first = tables.read_table(spark, root, SPEC.schema)
    grown = first.unionByName(frame(spark, [("b", None, 2)]))
    tables.write_snapshot(spark, grown, root, ["part"])
    assert rows(first) == [("a", "p", 1)]
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("a", "p", 1), ("b", None, 2)]
    assert rows(tables.read_table(spark, root, SPEC.schema, ["id"])) == [("a",), ("b",)]
    # A folder of a load that did not finish is not read, and the next load replaces it.
    frame(spark, [("z", "p", 9)]).write.parquet(f"{root}/snapshot=00000003")
    tables.discard(spark, f"{root}/snapshot=00000003/_SUCCESS")
    assert tables.table_count(spark, root, SPEC.schema) == 2
    assert tables.write_snapshot(spark, frame(spark, [("c", "p", 3)]), root, ["part"]).endswith("00000003")
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("c", "p", 3)]


def test_expiring_snapshots(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(4):
        tables.write_snapshot(spark, frame(spark, [("a", "p", i)]), root, ["part"])
    assert len(tables.expire_snapshots(spark, root, keep=3)) == 1
    assert len(tables.expire_snapshots(spark, root, keep=1)) == 2
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("a", "p", 3)]
    with pytest.raises(ValueError):
        tables.expire_snapshots(spark, root, keep=0)


def test_ingest_from_a_spec(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "sellers.csv").write_text("seller_id;seller_state;seller_state_code\ns1;rio;RJ\ns2;;\n")
    row = ("Shop", "Sellers", 1, str(tmp_path), "in/", "sellers.csv", "csv", ";", str(tmp_path / "bronze"), "b_sellers", True, "new")
    spec = enabled_specs(spark.createDataFrame([row], INGEST_SPEC_SCHEMA), "Shop").first()
    audit = LoadAudit(spark, str(tmp_path / "audit"), 1, "bronze", "Shop")
    for _ in range(2):  # a full reload: the second run replaces the first
        assert ingest_from_spec(spark, spec, AS_OF, audit, scheme="file://").post_count == 2
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    assert rows(stored.select("seller_id", "seller_state")) == [("s1", "rio"), ("s2", None)]


def test_merging_touches_only_the_partitions_of_the_batch(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.merge_partitions(spark, root, SPEC, frame(spark, [("a", "p", 1), ("b", "p", 1), ("c", "q", 1), ("d", None, 1)]))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "part=q").iterdir()}
    batch = frame(spark, [("a", "p", 2), ("a", "r", 2), ("d", None, 2)])
    tables.merge_partitions(spark, root, SPEC, batch)
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [
        ("a", "p", 2), ("a", "r", 2), ("b", "p", 1), ("c", "q", 1), ("d", None, 2),
    ]
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "part=q").iterdir()}


@pytest.mark.parametrize("null", [True, False])
def test_only_touched_partitions_are_read(spark, tmp_path, null):
    root = str(tmp_path / "t")
    data = [(str(i), f"p{i % 7}" if i % 7 else None, i) for i in range(70)]
    tables.merge_partitions(spark, root, SPEC, frame(spark, data))
    target = tables.read_table(spark, root, SPEC.schema)
    batch = frame(spark, [("x", "p1", 1), ("z", "new", 1)] + [("y", None, 1)] * null)
    found = tables.in_partitions_of(target, batch, ["part"])
    plan = final_plan(found)
    assert "dynamicpruning" in plan.lower()
    assert ("PartitionFilters: [isnull(part" in plan) == null
    assert found.count() == 10 + 10 * null
    assert {r.part for r in found.collect()} == {"p1", None} if null else {"p1"}
    assert tables.in_partitions_of(target, batch.filter("false"), ["part"]).count() == 0


def test_one_layout_per_table(spark, tmp_path):
    snapshots, in_place = str(tmp_path / "s"), str(tmp_path / "i")
    tables.write_snapshot(spark, frame(spark, [("a", "p", 1)]), snapshots, ["part"])
    tables.merge_partitions(spark, in_place, SPEC, frame(spark, [("a", "p", 1)]))
    (tmp_path / "f" / "snapshot=00000001").mkdir(parents=True)  # left by a load that failed
    for root in (snapshots, str(tmp_path / "f")):
        with pytest.raises(ValueError, match="stored as snapshots"):
            tables.merge_partitions(spark, root, SPEC, frame(spark, [("b", "p", 2)]))
    with pytest.raises(ValueError, match="stored as in place"):
        tables.write_snapshot(spark, frame(spark, [("b", "p", 2)]), in_place, ["part"])
    for root in (snapshots, in_place):
        assert rows(tables.read_table(spark, root, SPEC.schema)) == [("a", "p", 1)]


def test_blank_partition_values(spark, tmp_path):
    root = str(tmp_path / "t")
    batch = tables.blank_partitions_to_null(frame(spark, [("a", "", 1)]), ["part"])
    for _ in range(2):
        tables.merge_partitions(spark, root, SPEC, batch)
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("a", None, 1)]


def test_a_partition_with_most_rows_is_written_as_several_files(spark, conf, tmp_path):
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="10k",
    )
    df = spark.range(0, 60000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("part"),
        F.lit(1).alias("seq"),
    )
    root = str(tmp_path / "t")
    tables.overwrite_partitions(df, root, ["part"])
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").glob("part=*")}
    assert len(files) == 6 and files["part=hot"] > 5
    assert tables.table_count(spark, root, SPEC.schema) == 60000


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = tables.scratch_path(spark, "x"), tables.scratch_path(spark, "x")
    assert one.startswith(shared) and one != two


def test_scratch_without_a_shared_folder():
    def session(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))

    assert tables.scratch_path(session("yarn"), "x", "gs://lake/t").startswith("gs://lake/t/_staging/x-")
    assert tables.scratch_path(session("local[4]"), "x").startswith(tempfile.gettempdir())
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="share"):
            tables.scratch_path(session(master), "x")


def test_load_audit(spark, tmp_path):
    path = str(tmp_path / "audit")
    assert read_audit(spark, path).count() == 0
    audit = LoadAudit(spark, path, 7, "daily", "shop")
    with audit.load("Orders", "silver_orders", 10) as outcome:
        outcome.row_count = 12
    with pytest.raises(RuntimeError), audit.load("Sellers", "silver_sellers", 3):
        raise RuntimeError("no space")
    audit.start("Items", "silver_items", 5)
    got = {r.table_name: (r.pre_count, r.post_count, r.succeeded, r.rows_gained) for r in reconcile(read_audit(spark, path)).collect()}
    assert got == {
        "silver_orders": (10, 12, True, 2),
        "silver_sellers": (3, None, False, None),
        "silver_items": (5, None, False, None),
    }


def test_a_failed_retry_is_an_attempt_of_its_own(spark, tmp_path):
    audit = LoadAudit(spark, str(tmp_path / "audit"), 7, "daily", "shop")
    with audit.load("Orders", "silver_orders", 0) as outcome:
        outcome.row_count = 100
    with pytest.raises(RuntimeError), audit.load("Orders", "silver_orders", 100):
        raise RuntimeError("no space")
    got = reconcile(read_audit(spark, audit.path)).collect()
    assert sorted((r.pre_count, r.post_count, r.succeeded) for r in got) == [(0, 100, True), (100, None, False)]


@pytest.mark.parametrize(
    ("text", "delimiter", "ok"),
    [
        ("seller_id,seller_state,seller_state_code\ns1,rio,RJ\n", ",", True),
        ("more,seller_id,seller_state,seller_state_code\nx,s1,rio,RJ\n", ",", True),
        ("seller_id,state,seller_state_code\ns1,rio,RJ\n", ",", False),
        ("seller_id,seller_state\ns1,rio\n", ",", False),
        ("seller_id|seller_state|seller_state_code\ns1|rio|RJ\n", ",", False),
    ],
)
def test_a_delivery_needs_its_columns(spark, tmp_path, text, delimiter, ok):
    (tmp_path / "sellers.csv").write_text(text)
    lake = Lakehouse(spark, str(tmp_path / "lake"), AS_OF, 1)
    if ok:
        assert lake.ingest("Sellers", str(tmp_path / "sellers.csv"), delimiter=delimiter).post_count == 1
    else:
        with pytest.raises(ValueError, match="has no columns"):
            lake.ingest("Sellers", str(tmp_path / "sellers.csv"), delimiter=delimiter)
    assert [r.succeeded for r in lake.log().collect()] == [ok]


def test_silver_keeps_its_scope_and_few_snapshots(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_state,seller_state_code\ns1,rio,RJ\n")
    lake = Lakehouse(spark, str(tmp_path / "lake"), AS_OF, 1)
    lake.ingest("Sellers", str(tmp_path / "sellers.csv"))
    for _ in range(4):
        lake.load_silver("Sellers", "table")
    with pytest.raises(ValueError, match="stored as snapshots"):
        lake.load_silver("Sellers", "partition")
    assert lake.silver("Sellers").count() == 1
    folder = next(tmp_path.glob("lake/silver/*"))
    assert len(list(folder.glob("snapshot=*"))) == 3


def test_a_reload_that_fails_half_way_keeps_the_feed(spark, tmp_path):
    root = str(tmp_path / "bronze" / "feed")
    tables.write_full_reload(frame(spark, [("a", "p", 1), ("b", "q", 2)]), root, ["part"])
    half = spark.range(0, 100, 1, 4).select(
        F.col("id").cast("string").alias("id"),
        F.lit("p").alias("part"),
        F.when(F.col("id") < 90, 1).otherwise(F.raise_error(F.lit("no more"))).cast("int").alias("seq"),
    )
    with pytest.raises(Exception, match="no more"):
        tables.write_full_reload(half, root, ["part"])
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("a", "p", 1), ("b", "q", 2)]
    assert not any((tmp_path / "bronze" / "_reload").iterdir())
    tables.write_full_reload(frame(spark, [("c", "r", 3)]), root, ["part"])
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("c", "r", 3)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_reload_replaces_every_partition_in_any_session(spark, conf, tmp_path, mode):
    conf(spark__sql__sources__partitionOverwriteMode=mode)
    root = str(tmp_path / "feed")
    for day in ("monday", "tuesday"):
        tables.write_full_reload(frame(spark, [(str(i), day, i) for i in range(10)]), root, ["part"])
        got = tables.read_table(spark, root, SPEC.schema)
        assert got.count() == 10 and {r.part for r in got.collect()} == {day}


def test_a_reload_that_died_between_its_moves_is_settled(spark, tmp_path):
    root = str(tmp_path / "feed")
    tables.write_full_reload(frame(spark, [("a", "p", 1)]), root, ["part"])
    (tmp_path / "_replaced").mkdir(exist_ok=True)
    (tmp_path / "feed").rename(tmp_path / "_replaced" / "feed")  # as a driver that dies leaves it
    tables.settle_reload(spark, root)
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("a", "p", 1)]
    (tmp_path / "feed").rename(tmp_path / "_replaced" / "feed")
    tables.write_full_reload(frame(spark, [("b", "p", 1)]), root, ["part"])
    tables.settle_reload(spark, root)
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("b", "p", 1)]


def test_a_table_that_cannot_be_moved_stays(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "feed")
    tables.write_full_reload(frame(spark, [("a", "p", 1)]), root, ["part"])
    moves, move = [], tables._move

    def second_fails(spark, source, target):
        moves.append(target)
        if len(moves) == 2:
            raise OSError("no space")
        move(spark, source, target)

    monkeypatch.setattr(tables, "_move", second_fails)
    with pytest.raises(OSError, match="no space"):
        tables.write_full_reload(frame(spark, [("b", "p", 1)]), root, ["part"])
    assert rows(tables.read_table(spark, root, SPEC.schema)) == [("a", "p", 1)]


BUCKETED = replace(SPEC, partition_by=(), buckets=8, bucket_by=("id",))


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_only_buckets_of_the_batch_are_written(spark, tmp_path):
    root = tmp_path / "t"
    tables.merge_partitions(spark, str(root), BUCKETED, frame(spark, [(str(i), f"p{i % 3}", 1) for i in range(100)]))
    assert len(list(root.glob("bucket_of_8=*"))) == 8
    before = files(root)
    # The partition column is data here: a key that changes it stays one row.
    tables.merge_partitions(spark, str(root), BUCKETED, frame(spark, [("7", "moved", 2), ("7", None, 1)]))
    after = files(root)
    assert len({p.split("bucket_of_8=")[1].split("/")[0] for p in set(before) ^ set(after)}) == 1
    got = {r.id: (r.part, r.seq) for r in tables.read_table(spark, str(root), SPEC.schema).collect()}
    assert len(got) == 100 and got["7"] == ("moved", 2) and got["8"] == ("p2", 1)


def test_only_buckets_of_the_batch_are_read(spark, tmp_path):
    root = str(tmp_path / "t")
    data = frame(spark, [(str(i), None, 1) for i in range(200)])
    tables.merge_partitions(spark, root, BUCKETED, data)
    stored = spark.read.parquet(root)
    batch = tables.bucketed(frame(spark, [("7", None, 2)]), BUCKETED)
    found = tables.in_partitions_of(stored, batch, BUCKETED.layout)
    assert "dynamicpruning" in final_plan(found).lower()
    assert 0 < found.count() < 60


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.merge_partitions(spark, root, BUCKETED, frame(spark, [("a", "p", 1)]))
    assert tables.stored_layout(spark, root) == ("bucket_of_8",)
    for other in (replace(BUCKETED, buckets=16), SPEC):
        with pytest.raises(ValueError, match="cannot be loaded by"):
            tables.merge_partitions(spark, root, other, frame(spark, [("b", "p", 1)]))
    assert tables.table_count(spark, root, SPEC.schema) == 1
    with pytest.raises(ValueError, match="buckets need columns"):
        replace(SPEC, buckets=4)


def test_a_hot_bucket_is_written_as_several_files(spark, conf, tmp_path):
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="10k",
    )
    wide = F.sha2(F.col("id").cast("string"), 512)
    df = spark.range(0, 30000, 1, 8).select(F.lit("same").alias("id"), wide.alias("part"), F.lit(1).alias("seq"))
    root = tmp_path / "t"
    tables.overwrite_partitions(tables.bucketed(df, BUCKETED), str(root), BUCKETED.layout)
    assert len(list(root.rglob("*.parquet"))) > 5


def test_silver_load_by_bucket_leaves_other_buckets_alone(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), AS_OF, 1)
    head = "seller_id,seller_state,seller_state_code\n"
    (tmp_path / "1.csv").write_text(head + "".join(f"s{i},rio,RJ\n" for i in range(200)))
    (tmp_path / "2.csv").write_text(head + "s5,bahia,BA\n")
    lake.ingest("Sellers", str(tmp_path / "1.csv"))
    lake.load_silver("Sellers")
    folder = next(tmp_path.glob("lake/silver/*"))
    before = files(folder)
    lake.ingest("Sellers", str(tmp_path / "2.csv"))
    assert lake.load_silver("Sellers").post_count == 200
    assert len({p.split("bucket_of_")[1].split("/")[0] for p in set(before) ^ set(files(folder))}) == 1
    assert {r.seller_state for r in lake.silver("Sellers").collect()} == {"Rio", "Bahia"}
    with pytest.raises(ValueError, match="cannot be loaded by"):
        lake.load_silver("Sellers", "partition")
    with pytest.raises(ValueError, match="unknown load scope"):
        lake.load_silver("Sellers", "none")


def test_dimension_load_leaves_buckets_without_a_change_alone(spark, tmp_path):
    head = "seller_id,seller_state,seller_state_code\n"
    folder = tmp_path / "lake" / "gold" / "dim_sellers"
    seen = []
    for day, text in enumerate(["".join(f"s{i},rio,RJ\n" for i in range(200)), "s5,bahia,BA\n", "s5,bahia,BA\n"]):
        (tmp_path / "feed.csv").write_text(head + text)
        lake = Lakehouse(spark, str(tmp_path / "lake"), AS_OF + dt.timedelta(days=day), day)
        lake.ingest("Sellers", str(tmp_path / "feed.csv"))
        lake.load_silver("Sellers")
        lake.load_dimension("Sellers")
        seen.append(files(folder))
    changed = {p.split("dim_sellers/")[1].rpartition("/")[0] for p in set(seen[0]) ^ set(seen[1])}
    assert len(changed) == 2  # the bucket of s5 among the open rows, and the day that closed
    assert "is_current=0/eff_end_dt=2024-02-01/bucket_of_16=-1" in changed
    assert seen[1] == seen[2]  # a day without changes writes nothing
    got = lake.dimension("Sellers")
    assert got.count() == 201 and got.filter("seller_id = 'S5'").count() == 2


def test_broken_lines_are_kept_with_their_file(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a|b|c\n1||x\n2|"q|r"|y\n3\n4|5|6|7\n')
    (tmp_path / "2.csv").write_text("a|b|c\n5|6|7\n")
    (tmp_path / "3.csv").write_text("a|b|c\n")
    lines = read_feed_lines(spark, str(tmp_path), ["a", "b", "c"], "|")
    assert rows(lines.drop("file")) == [
        ("1", None, "x", None), ("2", "q|r", "y", None), ("3", None, None, "3"), ("4", "5", "6", "4|5|6|7"), ("5", "6", "7", None),
    ]
    # A selection of columns does not change which lines are broken.
    assert rows(lines.filter("broken_line IS NOT NULL").select("a", "broken_line")) == [("3", "3"), ("4", "4|5|6|7")]
    counts = {r.file.rsplit("/", 1)[1]: (r.n_lines, r.n_broken) for r in line_counts(lines).collect()}
    assert counts == {"1.csv": (4, 2), "2.csv": (1, 0)}


def test_the_log_is_read_by_day_and_compacted(spark, tmp_path, monkeypatch):
    path, days = str(tmp_path / "audit"), [dt.date(2024, 1, d) for d in (1, 2, 3)]

    class Clock(dt.datetime):
        day = days[0]

        @classmethod
        def now(cls, tz=None):
            return cls(cls.day.year, cls.day.month, cls.day.day, 12, tzinfo=tz)

    monkeypatch.setattr("lakestar.sources.audit.dt.datetime", Clock)
    audit = LoadAudit(spark, path, 7, "daily", "shop")
    for Clock.day in days:
        for table in ("one", "two"):
            with audit.load("App", table, 1) as outcome:
                outcome.row_count = 2
    whole = rows(reconcile(read_audit(spark, path)))
    assert len(whole) == 6
    some = read_audit(spark, path, since=days[1], until=days[1])
    assert some.count() == 4 and "logged_on" in final_plan(some).split("PartitionFilters: [")[1].split("]")[0]
    folder = tmp_path / "audit"
    last = files(folder / "logged_on=2024-01-03")
    assert compact_audit(spark, path, before=days[2]) == days[:2]
    assert [len(files(folder / f"logged_on={d}")) for d in days] == [1, 1, 4]
    assert files(folder / "logged_on=2024-01-03") == last
    assert rows(reconcile(read_audit(spark, path))) == whole
    assert compact_audit(spark, path, before=days[2]) == [] == compact_audit(spark, str(tmp_path / "none"), days[0])


def test_what_a_load_does_not_keep_is_stored_with_reasons(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), AS_OF, 1)
    head = "seller_id,seller_state,seller_state_code\n"
    (tmp_path / "1.csv").write_text(head + "s1,rio,RJ\ns1,rio,RJ\ns1,bahia,BA\n,rio,RJ\ns2,,\n")
    lake.ingest("Sellers", str(tmp_path / "1.csv"))
    for _ in range(2):  # running the job again replaces what it stored
        result = lake.load_silver("Sellers")
        found = [(r.seller_id, r.seller_state, r.reasons, r.n_rows, r.job_id) for r in lake.rejected("Sellers").collect()]
        assert sorted(found, key=str) == [("s1", "bahia", 4, 1, 1), ("s1", "rio", 2, 1, 1), (None, "rio", 1, 1, 1)]
        assert (result.total, result.valid, result.invalid_distinct, result.invalid_total) == (5, 2, 2, 3)
    (tmp_path / "2.csv").write_text(head + "s1,rio,RJ\n")
    lake.ingest("Sellers", str(tmp_path / "2.csv"))
    assert lake.load_silver("Sellers").invalid_total == 0
    assert lake.rejected("Sellers").count() == 0


def test_a_load_shuffles_its_feed_once_and_its_batch_not_at_all(spark, tmp_path, conf):
    """Counts, item rows and the latest row of a key share a shuffle; the batch is unique when it is merged."""
    from lakestar.plans.silver import clean_names, standardize, valid_groups
    from lakestar.specs import SILVER

    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spec = SILVER["Order_Items"]
    one = ("o1", "1", "p1", "s1", "01-01-2024 10:00:00 AM", "1.00", "0.50", dt.date(2024, 1, 1))
    data = [one, one, (" O1 ", *one[1:]), (None, *one[1:]), (None, *one[1:]), ("o2", "1", None, *one[3:])]
    bronze = spark.createDataFrame(data, ", ".join(f"{c} string" for c in spec.feed.columns) + ", load_date date")
    groups = valid_groups(bronze, spec)
    assert groups.agg(*quality_totals()).first() == (6, 2, 2, 4)
    clean = clean_names(spec)
    valid = groups.filter("_valid").select(*spec.feed.columns, "load_date", *clean.values())
    batch = tables.latest_in_batch(standardize(valid, spec, clean), spec.bucketed())
    assert [(r.order_id, r.item_quantity) for r in batch.collect()] == [("O1", 2)]
    assert final_plan(batch).count("Exchange hashpartitioning") == 1
    root = str(tmp_path / "t")
    for _ in range(2):
        tables.merge_partitions(spark, root, BUCKETED, frame(spark, [("a", "p", 1), ("b", "q", 1)]), unique=True)
    assert tables.read_table(spark, root, BUCKETED.schema).count() == 2


def test_touched_folders_are_pruned_for_a_batch_too_large_to_broadcast(spark, tmp_path, conf):
    root = str(tmp_path / "t")
    tables.merge_partitions(spark, root, SPEC, frame(spark, [("a", "p", 1), ("b", "q", 1), ("c", None, 1)]))
    conf(spark__sql__autoBroadcastJoinThreshold="20k")
    big = spark.range(3000).selectExpr("cast(id as string) id", "'q' part", "1 seq").repartition(2)
    big.write.parquet(f"{tmp_path}/big")
    batch = spark.read.parquet(f"{tmp_path}/big")
    batch = batch.unionByName(batch).unionByName(batch).unionByName(batch)
    found = tables.in_partitions_of(tables.read_table(spark, root, SPEC.schema), batch, ["part"])
    assert "SortMergeJoin" not in final_plan(found) and [r.id for r in found.collect()] == ["b"]
