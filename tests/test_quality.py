from __future__ import annotations

import random

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from lakestar.functions import in_range
from lakestar.operators.quality import (
    COPY,
    NULL_KEY,
    OUT_OF_RANGE,
    SUPERSEDED,
    dedupe_by_key,
    invalid_rows,
    key_groups,
    quality_counts,
    reason_names,
    require_not_null,
    verdict_totals,
    verdicts,
)

SCHEMA = "id string, part string, score string, load_date string"


def random_rows(seed: int, n: int = 300) -> list[tuple]:
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    return [
        (
            pick(None, "a", "b", "c", "hot", "hot", "hot", str(rng.randrange(40))),
            pick(None, "x", "y"),
            pick("0", "1", "3", "5", "9", "x", None),
            pick("d1", "d2", "d3", None),
        )
        for _ in range(n)
    ]


def kept(data: list[tuple]) -> list[tuple]:
    """Brute force: per key, the row that is latest by load_date, then by the other columns."""
    rank = lambda v: (v is not None, v or "")
    best: dict[tuple, tuple] = {}
    for row in data:
        key, order = row[:2], (rank(row[3]), rank(row[2]))
        if key not in best or order > best[key][0]:
            best[key] = (order, row)
    return [row for _, row in best.values()]


def nullable_sort(data):
    return sorted(data, key=lambda t: [(v is not None, str(v)) for v in t])


def test_required_columns(spark):
    df = spark.createDataFrame([("a", "x"), (None, "x"), ("a", None)], "id string, part string")
    assert rows(require_not_null(df, ["id", "part"])) == [("a", "x")]


def test_one_row_per_key_against_brute_force(spark):
    for seed in range(3):
        data = random_rows(seed)
        df = spark.createDataFrame(data, SCHEMA).repartition(7)
        assert rows(dedupe_by_key(df, ["id", "part"])) == nullable_sort(kept(data))
        groups = key_groups(df, ["id", "part"])
        assert rows(groups.select("id", "part", "score", "load_date")) == nullable_sort(kept(data))
        assert groups.agg(F.sum("_rows")).collect()[0][0] == len(data)
        assert groups.agg(F.sum("_distinct_rows")).collect()[0][0] == len(set(data))


def test_explicit_order_comes_first(spark):
    df = spark.createDataFrame([("a", "x", "1", "d1"), ("a", "x", "2", "d2")], SCHEMA)
    first = dedupe_by_key(df, ["id"], order_by=[F.col("score").asc()])
    assert rows(first) == [("a", "x", "1", "d1")]


def test_key_only_frames(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert rows(dedupe_by_key(df, ["id"], order_col=None)) == [("a",), ("b",)]
    assert rows(key_groups(df, ["id"], order_col=None)) == [("a", 2, 1), ("b", 1, 1)]


def test_spellings_of_a_key_both_survive(spark):
    df = spark.createDataFrame([("a1",), (" A1 ",)], "id string")
    assert dedupe_by_key(df, ["id"], order_col=None).count() == 2


def test_counts_of_the_survey_example(spark):
    # Five rows, one valid: a copy of the kept row is not invalid, equal bad rows count once.
    data = [("a", 1), ("a", 1), ("a", 0), (None, 2), (None, 2)]
    df = spark.createDataFrame(data, "id string, load_date int")
    got = quality_counts(df, ["id"], ["id"]).collect()[0].asDict()
    assert got == {"total": 5, "valid": 1, "invalid_distinct": 2, "invalid_total": 4}


def test_counts_against_except(spark):
    for seed in range(3):
        data = random_rows(seed)
        df = spark.createDataFrame(data, SCHEMA)
        accept = in_range(F.col("score"), 1, 5)
        valid = dedupe_by_key(require_not_null(df, ["id", "part"]), ["id", "part"]).filter(accept)
        got = quality_counts(df, ["id", "part"], ["id", "part"], accept).collect()[0].asDict()
        assert got["valid"] == valid.count()
        assert got["total"] == len(data)
        assert got["valid"] + got["invalid_total"] == got["total"]
        assert got["invalid_distinct"] == df.subtract(valid).count()
        assert rows(invalid_rows(df, valid)) == rows(df.subtract(valid))


def test_counts_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    got = quality_counts(df, ["id"], ["id"]).collect()[0].asDict()
    assert set(got.values()) == {0}


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("load_date"),
    )
    result = dedupe_by_key(df, ["k"])
    plan = final_plan(result)
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert result.filter("k = -1").collect()[0]["load_date"] == 2997
    assert result.count() == 2001


def test_groups_hold_nothing_before_the_shuffle(spark):
    """Copies are found behind the first shuffle, by the sort that the rows of a key need anyway."""
    df = spark.createDataFrame(random_rows(6), SCHEMA)
    plan = final_plan(key_groups(df, ["id", "part"]))
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "Sort" not in below and "Aggregate" not in below
    assert plan.count("Exchange hashpartitioning") == 2 and "HashAggregate" not in plan


def test_groups_of_copies_and_null_keys(spark):
    data = [("a", None, None, "1")] * 3 + [("a", None, None, "2"), (None, None, None, None)] + [(None, None, None, "3")] * 2
    df = spark.createDataFrame(data, "id string, part string, load_date string, score string").repartition(3)
    assert rows(key_groups(df, ["id", "part"])) == [
        (None, None, None, "3", 3, 2), ("a", None, None, "2", 4, 2),
    ]


def test_invalid_rows_takes_one_shuffle(spark):
    df = spark.createDataFrame(random_rows(5), SCHEMA)
    plan = final_plan(invalid_rows(df, df.filter("score = '1'")))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def judged(data, accept=None):
    """Brute force: (row, reasons, number of rows) of every distinct row."""
    top, out = {row[:2]: row for row in kept(data) if None not in row[:2]}, []
    for row in set(data):
        n, why = data.count(row), 0
        if None in row[:2]:
            why = NULL_KEY
        elif top[row[:2]] != row:
            why = SUPERSEDED
        if accept and not accept(row):
            why += OUT_OF_RANGE
        out += [(*row, why, n)] if why else [(*row, 0, 1)] + [(*row, COPY, n - 1)] * (n > 1)
    return nullable_sort(out)


def test_verdicts_against_brute_force(spark):
    between = lambda row: row[2] in ("1", "3", "5")
    for seed in range(3):
        data = random_rows(seed)
        data += data[:40]
        df = spark.createDataFrame(data, SCHEMA).repartition(7)
        assert rows(verdicts(df, ["id", "part"], ["id", "part"])) == judged(data)
        got = verdicts(df, ["id", "part"], ["id", "part"], in_range(F.col("score"), 1, 5))
        assert rows(got) == judged(data, between)
        expected = quality_counts(df, ["id", "part"], ["id", "part"], in_range(F.col("score"), 1, 5))
        assert got.agg(*verdict_totals()).collect() == expected.collect()


def test_verdicts_of_nullable_keys_copies_and_nothing(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, "x")], "id string, part string")
    assert rows(verdicts(df, ["id", "part"], ["id"])) == [
        (None, "x", NULL_KEY, 1), ("a", None, 0, 1), ("a", None, COPY, 1), ("a", "x", 0, 1),
    ]
    assert verdicts(df.filter("false"), ["id", "part"], ["id"]).count() == 0
    assert verdicts(df.filter("false"), ["id"], ["id"]).agg(*verdict_totals()).first() == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="outside the key"):
        verdicts(df, ["id"], ["part"])


def test_a_hot_key_is_split_among_tasks(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    key = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, 30000, 1, 8).select(
        key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("d").alias("load_date")
    )
    got = verdicts(df, ["k"], ["k"])
    assert "skew=true" in final_plan(got)
    assert got.filter("reasons = 4").count() == 19999


def test_verdicts_deal_rows_before_copies_are_looked_for(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.createDataFrame([("a", "x", "1", "d"), ("a", "x", "1", "d"), ("a", "x", "2", "d")], SCHEMA).repartition(2)
    got = verdicts(df, ["id", "part"], ["id", "part"])
    assert sorted((r.score, r.reasons, r.n_rows) for r in got.collect()) == [("1", SUPERSEDED, 2), ("2", 0, 1)]
    plan = final_plan(got)
    assert plan.count("REPARTITION_BY_COL") == 2 and "ReusedExchange" in plan  # one shuffle of the rows, used twice
    assert "HashAggregate" not in plan[plan.index("REPARTITION_BY_COL") :].split("Scan")[0]


def test_reasons_in_words(spark):
    df = spark.createDataFrame([(0,), (1,), (12,)], "r int")
    assert [r[0] for r in df.select(reason_names(F.col("r"))).collect()] == [
        [], ["null key"], ["superseded", "out of range"],
    ]


def test_verdicts_of_dealt_rows_need_no_shuffle(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for seed in range(2):
        data = random_rows(seed)
        df = spark.createDataFrame(data + data[:40], SCHEMA).repartition(3, "id")
        got = verdicts(df, ["id", "part"], ["id", "part"], in_range(F.col("score"), 1, 5), dealt=True)
        assert rows(got) == judged(data + data[:40], lambda row: row[2] in ("1", "3", "5"))
        assert final_plan(got).count("Exchange") == 1
