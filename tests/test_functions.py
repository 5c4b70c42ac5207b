from __future__ import annotations

import random
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from quarrystone.functions import dates, text
from quarrystone.functions.money import cents, from_cents, money_sum, percent, round2


def test_round2_is_bit_equal_to_scaling_and_rounding_the_double(spark):
    rng = random.Random(3)
    values = [1.005, 0.285, 2.675, -1.005, 0.125, -0.125, 0.005, -0.005, 0.0, -0.0, 1e15, 123456789.125]
    values += [rng.randint(-(10**6), 10**6) / 1000 for _ in range(20_000)]
    values += [rng.uniform(-(10**5), 10**5) for _ in range(20_000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    ours = {r["i"]: r["r"] for r in df.select("i", round2(F.col("v")).alias("r")).collect()}
    con = duckdb.connect()
    theirs = con.execute("SELECT i, round(v, 2) FROM (SELECT unnest(?) AS v, generate_subscripts(?, 1) - 1 AS i)", [values, values])
    assert {i: r.hex() for i, r in theirs.fetchall()} == {i: r.hex() for i, r in ours.items()}


def test_null_stays_null(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS v").select(
        round2(F.col("v")).alias("r"), cents(F.col("v")).alias("c"), from_cents(F.col("v")).alias("f")
    )
    assert tuple(row.collect()[0]) == (None, None, None)


def test_money_sum_is_exact_and_order_free(spark):
    values = [0.1] * 10 + [1e9 + 0.01, -1e9, 0.29]
    for order in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(5)
        assert df.agg(money_sum(F.col("v"))).collect()[0][0] == 1.3


def test_percent_of_nothing_is_undefined(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 4), (None, 4)], "a int, b int")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [33.33, None, 0.0, None]


def test_weekday_and_quarter_agree_with_the_calendar(spark):
    first = date(1896, 1, 1)
    days = [first + timedelta(days=11 * i) for i in range(8000)]
    df = spark.createDataFrame([(d.isoformat(),) for d in days], "d string")
    weekday = dates.iso_weekday(F.col("d"))
    got = df.select("d", weekday, dates.weekday_name(weekday), dates.quarter_of(dates.month_of(F.col("d")))).collect()
    for d, number, name, quarter in got:
        day = date.fromisoformat(d)
        assert (number, name, quarter) == (day.isoweekday(), day.strftime("%A"), (day.month + 2) // 3)


def test_impossible_date_has_no_weekday(spark):
    df = spark.createDataFrame([("2023-02-30",), (None,)], "d string")
    assert [r[0] for r in df.select(dates.weekday_name(dates.iso_weekday(F.col("d")))).collect()] == [None, None]


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([("  a\t ",)], "x string")
    assert df.select(text.trimmed("x")).collect()[0][0] == "a\t"


def test_blank_numbers_are_null_and_garbage_raises(spark):
    df = spark.createDataFrame([(" 7 ",), ("  ",), (None,)], "x string")
    assert [r[0] for r in df.select(text.whole_number("x")).collect()] == [7, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("7x",)], "x string").select(text.whole_number("x")).collect()
