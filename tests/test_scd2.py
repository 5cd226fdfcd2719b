from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from lakestar.operators import scd2
from lakestar.sources.tables import empty_table
from lakestar.specs import DIMENSIONS

D0, D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5)
SELLERS = DIMENSIONS["Sellers"]


def source(spark, spec, data):
    types = {f.name: f.dataType.simpleString() for f in spec.silver_schema}
    schema = ", ".join(f"{c} {types[c]}" for c in spec.source_columns)
    return spark.createDataFrame(data, schema)


def first_load(spark, spec, data, as_of=D0):
    return scd2.scd2_changes(source(spark, spec, data), empty_table(spark, spec.schema), spec, as_of)


def load(spark, dim, src, spec, as_of):
    return scd2.scd2_apply(dim, scd2.scd2_changes(src, dim, spec, as_of), spec)


def materialise(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def test_schema_of_every_dimension(spark):
    assert SELLERS.schema.names == [
        "seller_skey",
        "seller_id",
        "seller_state",
        "seller_state_code",
        "eff_start_dt",
        "eff_end_dt",
        "is_current",
        "insert_date",
        "inserted_by",
        "update_date",
        "updated_by",
    ]
    assert {a: len(s.attributes) for a, s in DIMENSIONS.items()} == {
        "Customers": 3,
        "Orders": 6,
        "Products": 11,
        "Sellers": 2,
        "Order_Items": 5,
        "Order_Ratings": 3,
    }
    for spec in DIMENSIONS.values():
        empty = empty_table(spark, spec.schema)
        src = empty_table(spark, spec.silver_schema).select(*spec.source_columns)
        out = scd2.scd2_changes(src, empty, spec, D0)
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in spec.schema
        ]


def test_new_changed_unchanged_and_missing_keys(spark):
    dim = first_load(
        spark, SELLERS, [("A", "Sao", "SP", D0), ("B", "Rio", "RJ", D0), ("C", "Acre", "AC", D0)]
    )
    src = source(spark, SELLERS, [("A", "Sao", "SP", D2), ("B", "Bahia", "BA", D2), ("D", None, "DF", D2)])
    after = load(spark, dim, src, SELLERS, D2)
    got = {
        (r.seller_id, r.eff_start_dt, r.eff_end_dt): (r.seller_state, r.is_current, r.update_date, r.insert_date)
        for r in after.collect()
    }
    assert got == {
        ("A", D0, scd2.OPEN_END): ("Sao", 1, None, D0),
        ("B", D0, D2 - dt.timedelta(days=1)): ("Rio", 0, D2, D0),
        ("B", D2, scd2.OPEN_END): ("Bahia", 1, None, D2),
        ("C", D0, scd2.OPEN_END): ("Acre", 1, None, D0),
        ("D", D2, scd2.OPEN_END): (None, 1, None, D2),
    }
    assert {r.seller_skey for r in after.filter("seller_id = 'B'").collect()} == {"B_skey"}


def test_a_second_change_on_one_day_is_ignored(spark):
    dim = first_load(spark, SELLERS, [("A", "Sao", "SP", D2)], as_of=D2)
    again = source(spark, SELLERS, [("A", "Rio", "RJ", D2)])
    assert scd2.scd2_changes(again, dim, SELLERS, D2).count() == 0


def test_change_in_every_type(spark):
    spec = DIMENSIONS["Order_Ratings"]
    at = dt.datetime(2024, 1, 1, 8)
    base = ("R", "O", 4.0, D0, at, D0)
    dim = first_load(spark, spec, [base])
    variants = [(2, None), (2, 5.0), (3, None), (3, D1), (4, None), (4, at + dt.timedelta(seconds=1))]
    for position, value in variants:
        row = list(base)
        row[position], row[5] = value, D2
        assert scd2.scd2_changes(source(spark, spec, [tuple(row)]), dim, spec, D2).count() == 2
    same = (*base[:5], D2)
    assert scd2.scd2_changes(source(spark, spec, [same]), dim, spec, D2).count() == 0


def test_null_and_empty_text_are_the_same(spark):
    dim = first_load(spark, SELLERS, [("A", None, "SP", D0)])
    assert scd2.scd2_changes(source(spark, SELLERS, [("A", "", "SP", D2)]), dim, SELLERS, D2).count() == 0


def test_a_key_with_closed_versions_only_is_not_new(spark):
    dim = first_load(spark, SELLERS, [("A", "Sao", "SP", D0)]).withColumns(
        {"is_current": F.lit(0), "eff_end_dt": F.lit(D1)}
    )
    src = source(spark, SELLERS, [("A", "Rio", "RJ", D2)])
    assert scd2.scd2_changes(src, dim, SELLERS, D2).count() == 0
    assert scd2.scd2_new(src, dim, SELLERS, D2).count() == 0
    assert scd2.scd2_changes(src, dim, SELLERS, D2, every_key_open=True).count() == 1


def test_null_business_keys_are_kept_as_new(spark):
    dim = first_load(spark, SELLERS, [("A", "Sao", "SP", D0)])
    src = source(spark, SELLERS, [(None, "Rio", "RJ", D2)])
    for change in (scd2.scd2_changes, scd2.scd2_new):
        assert [r.seller_skey for r in change(src, dim, SELLERS, D2).collect()] == [None]


def random_source(rng, day, n=60):
    keys = rng.sample(range(80), n)
    pick = lambda *xs: rng.choice(xs)
    return [(f"S{k}", pick("Sao", "Rio", None, ""), pick("SP", "RJ"), pick(day, D0)) for k in keys]


@pytest.mark.parametrize("seed", [1, 2])
def test_history_over_several_days(spark, seed):
    rng = random.Random(seed)
    dim = materialise(spark, first_load(spark, SELLERS, random_source(rng, D0)))
    for offset in (1, 3, 4):
        as_of = D0 + dt.timedelta(days=offset)
        src = source(spark, SELLERS, random_source(rng, as_of))
        changes = scd2.scd2_changes(src, dim, SELLERS, as_of)
        parts = [part(src, dim, SELLERS, as_of) for part in (scd2.scd2_new, scd2.scd2_active, scd2.scd2_inactive)]
        assert rows(changes) == rows(parts[0].unionByName(parts[1]).unionByName(parts[2]))
        dim = materialise(spark, scd2.scd2_apply(dim, changes, SELLERS))
        # The same delivery on the same day changes nothing.
        assert scd2.scd2_changes(src, dim, SELLERS, as_of).count() == 0
        versions = {}
        for r in dim.collect():
            versions.setdefault(r.seller_id, []).append(r)
        for found in versions.values():
            found.sort(key=lambda r: r.eff_start_dt)
            assert sum(r.is_current for r in found) == 1 and found[-1].is_current == 1
            for old, new in zip(found, found[1:]):
                assert old.eff_end_dt == new.eff_start_dt - dt.timedelta(days=1)
                assert old.eff_start_dt <= old.eff_end_dt


def test_one_join_and_one_shuffle_per_side(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    dim_path, src_path = f"{tmp_path}/dim", f"{tmp_path}/src"
    first_load(spark, SELLERS, [(f"S{i}", "Sao", "SP", D0) for i in range(50)]).write.partitionBy(
        "is_current", "eff_end_dt"
    ).parquet(dim_path)
    source(spark, SELLERS, [(f"S{i}", "Rio", "RJ", D2) for i in range(70)]).write.parquet(src_path)
    dim = spark.read.schema(SELLERS.schema).parquet(dim_path)
    changes = scd2.scd2_changes(spark.read.parquet(src_path), dim, SELLERS, D2)
    plan = final_plan(changes)
    assert plan.count("Join") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert changes.count() == 120
    assert re.search(r"PartitionFilters: \[[^\]]*is_current", final_plan(scd2.current(dim)))


def test_a_hot_source_key_is_split(spark, conf, tmp_path):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__shuffle__partitions="16",
    )
    first_load(spark, SELLERS, [(f"S{i}", "Sao", "SP", D0) for i in range(2000)]).write.parquet(f"{tmp_path}/dim")
    spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("S"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("seller_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("seller_state"),
        F.lit("RJ").alias("seller_state_code"),
        F.lit(D2).alias("last_update_date"),
    ).write.parquet(f"{tmp_path}/src")
    dim = spark.read.schema(SELLERS.schema).parquet(f"{tmp_path}/dim")
    src = spark.read.parquet(f"{tmp_path}/src")
    changes = scd2.scd2_changes(src, dim, SELLERS, D2)
    assert "skew=true" in final_plan(changes)
    known = src.filter(F.substring("seller_id", 2, 9).cast("int") < 2000).count()
    assert changes.count() == 2 * known + (60000 - known)


@pytest.mark.parametrize("as_of", [D0, D1, D2])
def test_a_run_on_or_before_the_stored_start_changes_nothing(spark, as_of):
    dim = materialise(spark, first_load(spark, SELLERS, [("A", "Sao", "SP", D2)], D2))
    src = source(spark, SELLERS, [("A", "Rio", "RJ", dt.date(2024, 1, 20))])
    assert rows(load(spark, dim, src, SELLERS, as_of)) == rows(dim)
    assert scd2.scd2_active(src, dim, SELLERS, as_of).count() == 0
    assert scd2.scd2_inactive(src, dim, SELLERS, as_of).count() == 0
    later = load(spark, dim, src, SELLERS, dt.date(2024, 1, 21)).collect()
    assert all(r.eff_start_dt <= r.eff_end_dt for r in later) and len(later) == 2


def test_applying_changes_shuffles_each_delivery_once(spark, conf):
    """Two days of raw rows are dealt by the business key; join and upsert take them as they are."""
    from conftest import SMOKE_DIR

    from lakestar.verification.queries import QUERIES
    from lakestar.verification.stages import dimension

    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = final_plan(QUERIES["scd2_apply_orders"](spark, SMOKE_DIR))
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 2
    assert not dimension(spark, SMOKE_DIR, "Orders", 2).inputFiles()[0].count("lakestar")
