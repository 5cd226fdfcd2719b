from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, FloatType, IntegerType, StringType, TimestampType

from lakestar import functions as L
from lakestar.specs import TIMESTAMP_FORMAT


def values(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def test_session_is_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_clean_text(spark):
    assert values(spark, L.clean_id, [" a1 ", "A1", "", None]) == ["A1", "A1", "", None]
    assert values(spark, L.clean_lower, [" Me@X.com "]) == ["me@x.com"]
    assert values(spark, L.clean_title, ["  SAO paulo "]) == ["Sao Paulo"]
    assert values(spark, L.clean_label, ["credit_card", " debit_card "]) == ["Credit Card", "Debit Card"]


def test_trim_takes_spaces_only(spark):
    assert values(spark, L.clean_id, ["\ta1 "]) == ["\tA1"]


def test_timestamps_on_a_twelve_hour_clock(spark):
    texts = [
        "01-02-2024 01:02:03 AM",
        "01-02-2024 01:02:03 PM",
        "01-02-2024 12:00:00 AM",
        "01-02-2024 12:00:00 PM",
        "01-02-2024 01:02:03 pm",
        "01-02-2024 13:00:00 PM",
        "2024-02-01 01:02:03",
        None,
    ]
    day = dt.datetime(2024, 2, 1)
    at = lambda h, m=0, s=0: day.replace(hour=h, minute=m, second=s)
    assert values(spark, L.parse_timestamp(TIMESTAMP_FORMAT), texts) == [
        at(1, 2, 3),
        at(13, 2, 3),
        at(0),
        at(12),
        at(13, 2, 3),
        None,
        None,
        None,
    ]
    assert values(spark, L.parse_day(TIMESTAMP_FORMAT), texts[:1] + texts[5:]) == [
        dt.date(2024, 2, 1),
        None,
        None,
        None,
    ]


def test_numbers_from_text(spark):
    assert values(spark, L.to_int, ["3", "3.0", "2.7", "x", "", None, "99999999999"]) == [
        3,
        3,
        2,
        None,
        None,
        None,
        None,
    ]
    assert values(spark, L.to_float, ["1.5", "x", None]) == [1.5, None, None]


def test_score_range(spark):
    scores = ["0.9", "1", "5", "5.5", "x", None]
    test = lambda c: L.in_range(c, 1, 5)
    assert values(spark, test, scores) == [False, True, True, False, False, False]


def test_surrogate_key(spark):
    assert values(spark, L.surrogate_key, ["A1", None]) == ["A1_skey", None]
    assert L.skey_name("order_id") == "order_skey"


def test_change_is_null_safe_in_every_type(spark):
    cases = {
        StringType(): [("a", "a", False), ("a", "b", True), (None, "", False), ("", None, False),
                       (None, "a", True), (None, None, False)],
        FloatType(): [(1.0, 1.0, False), (1.0, None, True), (None, 0.0, True), (None, None, False)],
        IntegerType(): [(0, None, True), (2, 2, False), (2, 3, True)],
        DateType(): [(dt.date(2024, 1, 1), None, True), (None, None, False)],
        TimestampType(): [(None, dt.datetime(2024, 1, 1), True), (None, None, False)],
    }
    for dtype, pairs in cases.items():
        name = dtype.simpleString()
        df = spark.createDataFrame(
            [(i, a, b) for i, (a, b, _) in enumerate(pairs)], f"i int, a {name}, b {name}"
        )
        got = df.orderBy("i").select(L.changed("a", "b", dtype)).collect()
        assert [r[0] for r in got] == [c for _, _, c in pairs], name


def test_text_literal(spark):
    for value in ("plain", "it's", "back\\slash", "\\'", ""):
        assert spark.range(1).select(F.expr(L.text_literal(value))).first()[0] == value


def test_money_totals_do_not_depend_on_order(spark):
    df = spark.createDataFrame([("0.005",), ("0.005",), ("1e2",), ("x",), (None,)], "t string")
    assert df.select(L.money(F.sum(L.to_money(F.col("t"))))).collect()[0][0] == 100.01
    tenths = spark.createDataFrame([("0.1",)] * 10, "t string").repartition(5)
    assert tenths.select(L.money(F.sum(L.to_money(F.col("t"))))).collect()[0][0] == 1.0


def test_packed_texts_come_back_and_sort_as_their_columns(spark):
    values = [None, "", "a", "a\x00", "a\x01", "\x00", "\x01", "\x01\x01", "\x01\x00\x02", "\x02", " b ", "é"]
    data = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(data, "a string, b string")
    df = df.unionByName(df.select(F.unhex(F.lit("FF00FE")).cast("string").alias("a"), "b"))
    packed = df.withColumn("p", L.pack(["a", "b"]))
    back = packed.select("a", "b", "p", *[v.alias(f"{c}_2") for c, v in L.unpack(F.col("p"), ["a", "b"]).items()])
    assert back.filter(~(F.col("a").eqNullSafe(F.col("a_2")) & F.col("b").eqNullSafe(F.col("b_2")))).count() == 0
    order = [F.col(c).desc_nulls_last() for c in ("a", "b")]
    by_columns = [r.p for r in packed.orderBy(*order).select(F.hex("p").alias("p")).collect()]
    assert by_columns == [r.p for r in packed.orderBy(F.col("p").desc()).select(F.hex("p").alias("p")).collect()]
