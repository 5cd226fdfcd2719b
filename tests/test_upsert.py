from __future__ import annotations

import random

import pytest
from conftest import final_plan, rows

from lakestar.operators.upsert import upsert

SCHEMA = "id string, part string, seq int, value string"


def random_batch(seed: int, n: int, key=lambda rng: str(rng.randrange(30))) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (
            None if rng.random() < 0.05 else key(rng),
            rng.choice(["p", "q", None]),
            rng.randrange(5),
            str(rng.randrange(1000)),
        )
        for _ in range(n)
    ]


def newest(batch, match):
    best = {}
    rank = lambda v: (v is not None, str(v))
    for row in batch:
        key = tuple(row[i] for i in match)
        order = (row[2], [rank(v) for i, v in enumerate(row) if i not in match and i != 2])
        if key not in best or order > best[key][0]:
            best[key] = (order, row)
    return {k: row for k, (_, row) in best.items()}


def expected(target, batch, scope, keep_newer):
    match = (0, 1) if scope == "partition" else (0,)
    fresh = newest(batch, match)
    key = lambda row: tuple(row[i] for i in match)
    if keep_newer:
        stored = {}
        for row in target:
            stored[key(row)] = max(stored.get(key(row), -1), row[2])
        fresh = {k: r for k, r in fresh.items() if r[2] >= stored.get(k, -1)}
    result = [r for r in target if key(r) not in fresh] + list(fresh.values())
    return sorted(result, key=lambda t: [(v is not None, str(v)) for v in t])


@pytest.mark.parametrize("keep_newer", [False, True])
@pytest.mark.parametrize("scope", ["table", "partition"])
def test_against_brute_force(spark, scope, keep_newer):
    for seed in range(2):
        match = (0, 1) if scope == "partition" else (0,)
        stored = list(newest(random_batch(seed, 40), match).values())
        batch = random_batch(seed + 100, 60)
        got = upsert(
            spark.createDataFrame(stored, SCHEMA),
            spark.createDataFrame(batch, SCHEMA).repartition(5),
            ["id"],
            "seq",
            scope,
            ["part"],
            keep_newer,
        )
        assert rows(got) == expected(stored, batch, scope, keep_newer)


def test_twice_is_once(spark):
    target = spark.createDataFrame(list(newest(random_batch(1, 40), (0,)).values()), SCHEMA)
    batch = spark.createDataFrame(random_batch(2, 40), SCHEMA)
    once = upsert(target, batch, ["id"], "seq")
    assert rows(upsert(once, batch, ["id"], "seq")) == rows(once)


def test_a_row_that_changes_partition(spark):
    target = spark.createDataFrame([("o1", "Shipped", 1, "a")], SCHEMA)
    batch = spark.createDataFrame([("o1", "Delivered", 2, "b")], SCHEMA)
    moved = upsert(target, batch, ["id"], "seq", "table", ["part"])
    assert rows(moved) == [("o1", "Delivered", 2, "b")]
    twice = upsert(target, batch, ["id"], "seq", "partition", ["part"])
    assert twice.count() == 2


def test_wrong_scope(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        upsert(df, df, ["id"], "seq", "galaxy")
    with pytest.raises(ValueError):
        upsert(df, df, ["id"], "seq", "partition")


def test_a_small_batch_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(20000).selectExpr("id", "1 as seq", "'x' as value").write.parquet(f"{tmp_path}/t")
    spark.range(5).selectExpr("id", "2 as seq", "'y' as value").write.parquet(f"{tmp_path}/b")
    got = upsert(
        spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b"), ["id"], "seq"
    )
    plan = final_plan(got)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got.filter("value = 'y'").count() == 5 and got.count() == 20000


def test_a_costly_batch_is_shuffled_once(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.range(2000).selectExpr("id", "1 as seq").write.parquet(f"{tmp_path}/t")
    spark.range(500).selectExpr("id % 400 as id", "2 as seq").write.parquet(f"{tmp_path}/b")
    got = upsert(
        spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b"), ["id"], "seq"
    )
    assert "ReusedExchange" in final_plan(got)
    assert got.count() == 2000


@pytest.mark.parametrize("scope", ["table", "partition"])
def test_one_window_gives_the_rows_of_the_join(spark, conf, scope):
    rng = random.Random(7)
    pick = lambda *xs: rng.choice(xs)
    both = [[(pick(None, "a", "b", str(rng.randrange(9))), pick("p", "q", None), rng.randrange(3), pick("x", None)) for _ in range(60)] for _ in (0, 1)]
    old, new = (spark.createDataFrame(d, "id string, part string, seq int, value string") for d in both)
    expected = upsert(old, new, ["id"], "seq", scope, ["part"])
    assert rows(upsert(old, new, ["id"], "seq", scope, ["part"], together=True)) == rows(expected)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    dealt = [df.repartition(4, "id") for df in (old, new)]
    assert final_plan(upsert(*dealt, ["id"], "seq", scope, ["part"], together=True)).count("Exchange") == 2
    with pytest.raises(ValueError, match="keep_newer"):
        upsert(old, new, ["id"], "seq", scope, ["part"], keep_newer=True, together=True)
