import random

from pyspark.sql import functions as F

from tillstream.operators.changes import (
    direct_payments, latest_per_key, live_rows, payments_from_mysql, payments_from_postgres,
)
from tillstream.schemas import PAYMENT_MESSAGE, PAYMENT_ROW_MYSQL, PAYMENT_ROW_POSTGRES, change_envelope
from tests.rows import SALE_S, change, changes_df

KEY, ORDER = ["invoiceNumber"], ["seq"]


def test_newest_change_wins_in_any_arrival_order(spark):
    rows = [change("a", op="I", seq=1, paid=1.0), change("a", op="U", seq=2, paid=2.0), change("b", op="I", seq=3),
            change("b", op="D", seq=4), change("c", op="I", seq=5), change("c", op="D", seq=6),
            change("c", op="I", seq=7, paid=7.0), change("d", op="U", seq=9, paid=9.0), change("d", op="I", seq=8)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = {r.invoiceNumber: r.paid for r in live_rows(changes_df(spark, *rows), KEY, ORDER).collect()}
        assert got == {"a": 2.0, "c": 7.0, "d": 9.0}


def test_replayed_changes_change_nothing(spark):
    df = changes_df(spark, change("a"), change("b", op="D"))
    assert live_rows(df.unionAll(df), KEY, ORDER).collect() == live_rows(df, KEY, ORDER).collect()


def test_versions_of_one_key_are_combined_before_the_shuffle(spark):
    df = changes_df(spark, *(change("a", seq=i) for i in range(50)))
    plan = latest_per_key(df, KEY, ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")


def test_mysql_envelopes(spark, zone):
    row = ("a", "label", "1", 5.5, "t", (SALE_S + 7200) * 1000)
    df = spark.createDataFrame([("c", None, row, 1), ("u", row, row, 2), ("d", row, None, 3), ("r", None, row, 0)],
                               change_envelope(PAYMENT_ROW_MYSQL))
    rows = payments_from_mysql(df, "+02:00").withColumn("created_at", F.unix_seconds("created_at")).collect()
    assert [(r.op, r.seq) for r in rows] == [("I", 1), ("U", 2), ("D", 3), ("I", 0)]
    assert {(r.invoiceNumber, r.paid, r.created_at) for r in rows} == {("a", 5.5, SALE_S)}


def test_postgres_envelopes(spark, zone):
    from decimal import Decimal

    row = ("a", "label", "1", Decimal("5.50"), "t", "2023-11-05T06:30:00.123456Z")
    df = spark.createDataFrame([("d", row, None, 3)], change_envelope(PAYMENT_ROW_POSTGRES))
    got = payments_from_postgres(df).withColumn("created_at", F.unix_millis("created_at")).first()
    assert tuple(got) == ("a", "label", "1", 5.5, "t", SALE_S * 1000 + 123, "D", 3)


def test_direct_payments_have_no_creation_time_unless_stamped(spark):
    df = spark.createDataFrame([("a", "l", "1", 1.0, "t")], PAYMENT_MESSAGE)
    assert direct_payments(df).first().created_at is None
    assert direct_payments(df, stamp=True).first().created_at is not None


def test_unknown_operation_is_not_taken_for_an_insert(spark):
    row = ("a", "label", "1", 5.5, "t", 0)
    df = spark.createDataFrame([("x", row, row, 1)], change_envelope(PAYMENT_ROW_MYSQL))
    assert payments_from_mysql(df, "UTC").first().op is None
