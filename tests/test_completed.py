import random

import pytest

from tillstream.operators.completed import completed_changes, live_completed, sales_completed, sales_completed_within
from tillstream.operators.changes import live_rows
from tillstream.operators.unnest import collapse_lines, live_unnested, unnest_lines, unnest_sales
from tillstream.schemas import COMPLETED, UNNESTED
from tests.rows import basket, baskets_df, change, changes_df, item

LAGS = {"before": -1, "same": 0, "after": 1, "hour": 3600, "over": 3601, "late": 7200, "unknown": None}


def invoices(df):
    return sorted(r.invoiceNumber for r in df.collect())


@pytest.fixture
def edge(spark):
    baskets = baskets_df(spark, *(basket(k) for k in LAGS), basket("null", epoch=None), basket("junk", epoch="x"),
                         basket("unpaid"))
    changes = changes_df(spark, *(change(k, lag) for k, lag in LAGS.items()), change("null"), change("junk"),
                         change("no basket"))
    return baskets, changes


def test_paid_strictly_after_the_sale(edge):
    assert invoices(sales_completed(*edge)) == ["after", "hour", "late", "over"]


def test_bound_includes_the_full_hour(edge):
    assert invoices(sales_completed_within(*edge)) == ["after", "hour"]
    assert invoices(sales_completed_within(*edge, bound="2 hours")) == ["after", "hour", "late", "over"]


def test_changelog_form_agrees_with_the_join(edge):
    assert invoices(live_completed(completed_changes(*edge))) == ["after", "hour", "late", "over"]


def test_columns_are_those_of_the_table(edge):
    assert sales_completed(*edge).columns == [*COMPLETED.names, "basketPart"]
    assert sales_completed(edge[0].drop("basketPart"), edge[1]).columns == COMPLETED.names


def test_hot_invoices_give_the_same_rows(spark, edge):
    hot = spark.createDataFrame([("after",), ("same",)], "invoiceNumber string")
    live = live_rows(edge[1], ["invoiceNumber"], ["seq"])
    assert invoices(sales_completed(edge[0], live, hot)) == invoices(sales_completed(edge[0], live))
    assert invoices(sales_completed_within(edge[0], live, hot=hot)) == ["after", "hour"]


def test_parts_of_a_basket_meet_the_one_payment(spark, edge):
    """A payment is one row, however many parts its basket comes in."""
    parts = edge[0].unionAll(edge[0].withColumn("basketPart", edge[0].basketPart + 1))
    for join in (sales_completed, sales_completed_within, completed_changes):
        once, both = join(*edge).collect(), join(parts, edge[1]).collect()
        assert sorted(map(str, both)) == sorted(str(x) for p in (0, 1) for x in (type(r)(**{**r.asDict(), "basketPart": p}) for r in once))


def test_revisions_and_deletes_reach_completed_sales_and_items(spark):
    r = random.Random(5)
    goods = [item(f"p{i}", price=i + 0.5, quantity=q) for i in range(4) for q in (1, 2)]
    baskets = [basket(f"i{i}", items=r.choices(goods, k=r.randint(0, 5))) for i in range(30)]
    changes = [change(f"i{r.randrange(30)}", r.choice([-5, 0, 5, 4000, None]), r.choice("IUUD"), seq, float(seq))
               for seq in range(120)]
    b = baskets_df(spark, *baskets)
    r.shuffle(changes)
    c = changes_df(spark, *changes)
    truth = sales_completed(b, live_rows(c, ["invoiceNumber"], ["seq"])).persist()
    log = completed_changes(b, c).persist()
    live = live_completed(log)
    assert live.count() == truth.count() > 0
    assert sorted(map(str, live.select(truth.columns).collect())) == sorted(map(str, truth.collect()))
    items = live_unnested(unnest_sales(log, ["op", "seq"]))
    assert sorted(map(str, items.collect())) == sorted(map(str, collapse_lines(unnest_sales(truth)).collect()))
    truth.unpersist(), log.unpersist()


def test_items_dropped_by_a_later_version_are_gone(spark):
    old = baskets_df(spark, basket("a", items=(item("x"), item("y"))))
    new = baskets_df(spark, basket("a", items=(item("x", price=3.0),)))
    log = unnest_sales(completed_changes(old, changes_df(spark, change("a", seq=1))), ["op", "seq"]).unionAll(
        unnest_sales(completed_changes(new, changes_df(spark, change("a", seq=2, op="U"))), ["op", "seq"]))
    hot = spark.createDataFrame([("a",)], "invoicenumber string")
    for h in (None, hot):
        assert [(r.product, r.subtotal) for r in live_unnested(log, h).collect()] == [("x", 3.0)]


def test_one_valid_copy_of_a_basket_is_enough(spark):
    copies = baskets_df(spark, basket("a"), basket("a", epoch="9999999999000"))
    assert invoices(live_completed(completed_changes(copies, changes_df(spark, change("a"))))) == ["a"]


def completed_of(spark, *rows):
    return sales_completed(baskets_df(spark, *rows), changes_df(spark, *(change(r[0]) for r in rows)))


def test_empty_and_missing_item_arrays_give_no_rows(spark):
    done = completed_of(spark, basket("a"), basket("empty", items=()), basket("none", items=None))
    assert [r.invoicenumber for r in unnest_lines(done).collect()] == ["a"]
    assert unnest_lines(done).columns == UNNESTED.names


def test_last_line_of_a_product_stays(spark):
    done = completed_of(spark, basket("a", items=(item(quantity=5), item("tea"), item(quantity=2))), basket("b"))
    assert unnest_lines(done).count() == 4
    rows = {(r.invoicenumber, r.product): r.subtotal for r in collapse_lines(unnest_sales(done)).collect()}
    assert rows == {("a", "soap"): 20.0, ("a", "tea"): 10.0, ("b", "soap"): 10.0}


def test_last_line_counts_across_parts(spark):
    done = completed_of(spark, basket("a", items=(item(quantity=9),), part=0), basket("a", items=(item(quantity=1),), part=1))
    assert {r.subtotal for r in collapse_lines(unnest_sales(done)).collect()} == {10.0}


def test_items_add_up_to_the_basket(spark):
    from pyspark.sql import functions as F
    from tillstream.plans.entities import Retail
    from tests.conftest import TESTDATA

    r = Retail(spark, TESTDATA)
    sums = unnest_lines(r.completed).groupBy("invoicenumber").agg(F.sum("subtotal").alias("s"))
    amounts = r.completed.select(F.col("invoiceNumber").alias("invoicenumber"), "total", "nett", "vat")
    off = amounts.join(sums, "invoicenumber")
    assert off.where("abs(s - total) > 0.005 or abs(nett + vat - total) > 0.011").count() == 0
    assert off.count() == r.completed.count() > 0
