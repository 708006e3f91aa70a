import math
from datetime import datetime

import pytest
from hypothesis import given, settings as limits, strategies as st
from pyspark.sql import functions as F

from tillstream.functions.event_time import (
    epoch_seconds, event_time, instant_from_wall_clock, instant_from_wall_millis, time_label, to_millis,
    utc_wall_clock, with_event_times, with_watermark,
)
from tillstream.functions.money import basket_amounts, exact_sum, round_half_away
from tillstream.schemas import BASKETS, COMPLETED_SALES
from tests.rows import SALE_S, basket, baskets_df


def test_event_time_cuts_milliseconds_and_rejects_junk(spark, zone):
    df = spark.createDataFrame([("1699165800999",), ("x",), ("",), (None,)], "e string")
    rows = df.select(F.unix_micros(event_time(F.col("e"))), utc_wall_clock(epoch_seconds(F.col("e")))).collect()
    assert [r[0] for r in rows] == [1699165800000000, None, None, None]
    assert rows[0][1] == datetime(2023, 11, 5, 6, 30)


def test_time_label_has_three_digits_and_offset(spark, zone):
    df = spark.createDataFrame([(1699165800007,), (1699165800000,)], "ms long")
    labels = [r[0] for r in df.select(time_label(F.col("ms"), 120)).collect()]
    assert labels == ["2023-11-05T08:30:00.007+02:00", "2023-11-05T08:30:00.000+02:00"]
    assert df.select(time_label(F.col("ms"), -210)).first()[0] == "2023-11-05T03:00:00.007-03:30"


def test_database_wall_clock_becomes_an_instant(spark, zone):
    df = spark.createDataFrame([((SALE_S + 7200) * 1000 + 5,)], "ms long")
    assert df.select(F.unix_millis(instant_from_wall_millis(F.col("ms"), "+02:00"))).first()[0] == SALE_S * 1000 + 5
    clock = utc_wall_clock(F.lit(SALE_S + 7200))
    assert df.select(F.unix_seconds(instant_from_wall_clock(clock, "Africa/Johannesburg"))).first()[0] == SALE_S


def test_instants_are_cut_to_milliseconds(spark):
    df = spark.createDataFrame([(1234567,), (-1,)], "us long")
    got = df.select(F.unix_micros(to_millis(F.timestamp_micros("us")))).collect()
    assert [r[0] for r in got] == [1234000, -1000]


def test_declared_event_times_and_watermark(spark):
    df = baskets_df(spark, basket("a"))
    assert "saleTimestamp_WM" in with_watermark(df, BASKETS).columns
    df = df.withColumn("payTimestamp_Epoc", F.lit("1000"))
    row = with_event_times(df, COMPLETED_SALES).select(F.unix_seconds("payTimestamp_WM"), F.unix_seconds("saleTimestamp_WM"))
    assert tuple(row.first()) == (1, SALE_S)


def test_rounding_is_half_away_from_zero(spark):
    values = [0.125, -0.125, 2.5, -2.675, 1.005, 0.0, 10.994999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = [int(v * 100 + math.copysign(0.5, v)) / 100 for v in values]
    assert [r[0] for r in df.select(round_half_away(F.col("v"))).collect()] == want


def test_amounts_add_up(spark):
    df = spark.range(1, 400).select((F.col("id") * 7.77).alias("gross"))
    rows = df.withColumns(basket_amounts(F.col("gross"))).collect()
    assert all(abs(r.nett + r.vat - r.total) <= 0.01 + 1e-9 for r in rows)


@limits(max_examples=15, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=30), st.randoms())
def test_sum_is_exact_in_any_order(spark, cents, random):
    expected = sum(cents) / 100
    random.shuffle(cents)
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double").repartition(3)
    assert df.agg(exact_sum(F.col("v"))).first()[0] == pytest.approx(expected, abs=1e-9)


def test_sum_of_a_giant_group_does_not_overflow(spark):
    df = spark.range(1000).select(F.lit(9e15).alias("v"))
    assert df.agg(exact_sum(F.col("v"))).first()[0] == 9e18
