"""Streams against their batch forms, over several micro-batches, restarts and failures."""

import random

import pytest
from pyspark.sql import functions as F

from tillstream.operators.changes import live_rows
from tillstream.operators.completed import completed_changes, sales_completed, sales_completed_within
from tillstream.operators.unnest import collapse_lines, unnest_sales
from tillstream.plans.pipeline import PAYMENT_CHANGE, Pipeline, completed_table
from tillstream.schemas import BASKETS
from tillstream.functions.event_time import with_watermark
from tillstream.session import settings
from tillstream.streaming.flows import counted, finish, read_files, run_metrics, start_append, start_keyed
from tests.rows import SALE_S, STREAMED_BASKET, basket, baskets_df, change, changes_df, item


def epoch(seconds):
    return f"{SALE_S + seconds}500"


class Inbox:
    """A folder that receives one file per batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema
        spark.createDataFrame([], schema).write.parquet(path)

    def add(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return read_files(self.spark, self.path, self.schema, files_per_batch=1)


@pytest.fixture
def inboxes(spark, scratch):
    return Inbox(spark, scratch("baskets"), STREAMED_BASKET), Inbox(spark, scratch("changes"), PAYMENT_CHANGE)


def late_rows(inboxes):
    """Sales far apart in event time; the oldest arrive in the third batch."""
    baskets, changes = inboxes
    for n, start in enumerate((1_000_000, 2_000_000, 0)):
        baskets.add(*(basket(f"{n}-{i}", epoch(start + i)) for i in range(5)))
        changes.add(*(change(f"{n}-{i}", start + i + 30) for i in range(5)))


def joined(spark, stream, scratch, name):
    query = start_append(stream, path := scratch(name), scratch(f"{name}-cp"), name)
    finish(query)
    return {r.invoiceNumber for r in spark.read.schema(stream.schema).parquet(path).collect()}, query


def test_unbounded_join_keeps_late_rows(spark, scratch, inboxes):
    late_rows(inboxes)
    got, query = joined(spark, sales_completed(inboxes[0].stream(), inboxes[1].stream()), scratch, "unbounded")
    assert len(got) == 15
    assert run_metrics(query)["records"] == 30


def test_watermarked_join_drops_late_rows_and_state(spark, scratch, inboxes):
    late_rows(inboxes)
    stream = sales_completed_within(inboxes[0].stream(), inboxes[1].stream(), watermark="0 seconds")
    got, query = joined(spark, stream, scratch, "tight")
    assert got == {f"{n}-{i}" for n in (0, 1) for i in range(5)}
    assert run_metrics(query)["state_rows"] < 15
    patient = sales_completed_within(inboxes[0].stream(), inboxes[1].stream(), watermark="60 days")
    assert len(joined(spark, patient, scratch, "patient")[0]) == 15


def test_declared_watermark_works_on_a_stream(spark, scratch, inboxes):
    inboxes[0].add(basket("a"))
    finish(query := start_append(with_watermark(inboxes[0].stream(), BASKETS), scratch("w"), scratch("w-cp"), "w"))
    assert "watermark" in query.lastProgress.eventTime


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_pipeline_follows_changes_and_equals_a_recompute(spark, scratch, inboxes):
    r = random.Random(3)
    goods = [item(f"p{i}", price=i + 0.5, quantity=q) for i in range(3) for q in (1, 2)]
    baskets, changes = inboxes
    flow = Pipeline.create(spark, scratch("pipeline"))
    seq = 0
    for round_ in range(3):
        baskets.add(*(basket(f"i{round_}-{i}", items=r.choices(goods, k=r.randint(0, 4))) for i in range(6)))
        rows = []
        for _ in range(25):
            seq += 1
            rows.append(change(f"i{r.randrange(3)}-{r.randrange(6)}", r.choice([-1, 5, 5, 5, None]), r.choice("IUUD"), seq))
        r.shuffle(rows)
        changes.add(*rows)
        flow.run_available(baskets.stream(), changes.stream())
        if round_ == 1:
            for table in (flow.payments, flow.completed, flow.unnested):
                table.compact(1)
        all_baskets = spark.read.schema(STREAMED_BASKET).parquet(baskets.path)
        live = live_rows(spark.read.schema(PAYMENT_CHANGE).parquet(changes.path), ["invoiceNumber"], ["seq"])
        done = sales_completed(all_baskets, live)
        assert flow.read_baskets().count() == 6 * (round_ + 1)
        assert rows_of(flow.read_payments()) == rows_of(live)
        assert rows_of(flow.read_completed()) == rows_of(done)
        assert rows_of(flow.read_items()) == rows_of(collapse_lines(unnest_sales(done)))
    assert done.count() > 0


def test_failure_after_the_write_is_repeated_without_effect(spark, scratch, inboxes):
    baskets, changes = inboxes
    for n in range(3):
        baskets.add(basket(f"a{n}"))
        changes.add(change(f"a{n}", seq=n))
    table = completed_table(spark, scratch("completed"))
    stream = completed_changes(baskets.stream(), changes.stream())
    crashed = []

    class Failing:
        def write_segment(self, df, batch_id):
            table.write_segment(df, batch_id)
            if batch_id == 1 and not crashed:
                crashed.append(batch_id)
                raise RuntimeError("lost after the write")

    checkpoint = scratch("completed-cp")
    with pytest.raises(Exception, match="lost after the write"):
        finish(start_keyed(stream, Failing(), checkpoint, "first"))
    finish(start_keyed(completed_changes(baskets.stream(), changes.stream()), Failing(), checkpoint, "second"))
    assert crashed == [1]
    assert sorted(r.invoiceNumber for r in table.read().collect()) == ["a0", "a1", "a2"]
    assert table.changes().count() == 3


def test_order_inside_a_batch_does_not_matter(spark, scratch):
    rows = [change("a", seq=1), change("a", op="U", seq=2, paid=2.0), change("b", seq=3), change("b", op="D", seq=4)]
    b = baskets_df(spark, basket("a"), basket("b"))
    contents = []
    for order in (rows, rows[::-1]):
        table = completed_table(spark, scratch("order"))
        table.write_segment(completed_changes(b, changes_df(spark, *order)), 0)
        contents.append([(r.invoiceNumber, r.paid) for r in table.read().collect()])
    assert contents[0] == contents[1] == [("a", 2.0)]


def test_payment_before_its_basket(spark, scratch, inboxes):
    inboxes[1].add(change("a"))
    stream = sales_completed(inboxes[0].stream(), inboxes[1].stream())
    finish(start_append(stream, path := scratch("early"), cp := scratch("early-cp"), "early"))
    inboxes[0].add(basket("a"))
    finish(start_append(sales_completed(inboxes[0].stream(), inboxes[1].stream()), path, cp, "early"))
    assert spark.read.schema(stream.schema).parquet(path).select(F.col("invoiceNumber")).first()[0] == "a"


def test_run_counts_are_complete_beyond_the_kept_reports(spark, scratch, inboxes):
    for n in range(6):
        inboxes[0].add(*(basket(f"{n}-{i}") for i in range(n + 1)))
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "2"}), counted(spark) as counts:
        query = start_append(inboxes[0].stream(), scratch("counted"), cp := scratch("counted-cp"), "counted")
        finish(query)
        found = counts.of(query)
        assert run_metrics(query)["records"] < 21
        again = start_append(inboxes[0].stream(), scratch("counted"), cp, "counted")  # a restart is a run of its own
        finish(again)
        assert counts.of(again)["records"] == 0
    assert (found["records"], found["batches"]) == (21, 6) and found["records_per_second"] > 0


@pytest.mark.parametrize("bound", [{"files_per_batch": 2}, {"bytes_per_batch": 1}])
def test_no_batch_over_its_bound(spark, scratch, bound):
    path = scratch("bounded")
    spark.range(70).repartition(7).write.parquet(path)
    largest = 2 if "files_per_batch" in bound else 1
    rows = [q.n for q in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    stream = read_files(spark, path, spark.range(1).schema, **bound)
    query = start_append(stream, out := scratch("bounded-out"), scratch("bounded-cp"), "bounded")
    finish(query)
    batches = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert max(batches) <= largest * max(rows) and len(batches) >= 7 // largest
    assert sorted(r.id for r in spark.read.schema(stream.schema).parquet(out).collect()) == list(range(70))


def test_a_batch_has_one_bound(spark, scratch):
    with pytest.raises(ValueError):
        read_files(spark, scratch("none"), spark.range(1).schema, files_per_batch=1, bytes_per_batch=1)
