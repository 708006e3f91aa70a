import pytest
from pyspark.sql import functions as F

from tillstream.operators.lines import (
    assemble_baskets, basket_totals, item_arrays, price_lines, with_gross, with_positions,
)
from tillstream.operators.skew import BUCKETS, SHARE, hot_keys, join_on_unique

ORDER = ["n", "x"]


@pytest.fixture(scope="module")
def lines(spark):
    """One basket with a third of all lines, part of them equal in all columns."""
    giant = spark.range(3000).select(F.lit(7).cast("long").alias("k"), (F.col("id") % 5).alias("n"),
                                     F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("x"))
    rest = spark.range(6000).select((F.col("id") % 1000 + 100).alias("k"), (F.col("id") % 3).alias("n"),
                                    (F.col("id") % 11).alias("x"))
    return giant.unionAll(rest)


def items(lines):
    return price_lines(lines.select("*", F.col("x").cast("string").alias("id"), F.lit("p").alias("name"),
                                    F.lit("b").alias("brand"), F.lit("c").alias("category"),
                                    (F.col("x") + 0.25).alias("price"), F.lit(3).alias("quantity")))


def test_hot_keys_finds_only_the_giant(spark, lines):
    assert [r[0] for r in hot_keys(lines, "k", min_rows=100).collect()] == [7]
    assert hot_keys(lines, "k", min_rows=5000) is None
    assert hot_keys(lines.limit(0), "k") is None
    assert BUCKETS / SHARE == 8192


def test_range_ranking_equals_the_window(spark, lines):
    hot = hot_keys(lines, "k", min_rows=100)
    key = ["k", "n", "x", "pos"]
    plain = with_positions(lines, "k", ORDER)
    ranged = with_positions(lines, "k", ORDER, hot)
    assert sorted(map(tuple, ranged.select(key).collect())) == sorted(map(tuple, plain.select(key).collect()))


def test_range_ranking_uses_many_tasks(spark, lines):
    from tillstream.operators.lines import _positions_by_range

    ranked = _positions_by_range(lines.where("k = 7"), "k", ORDER)
    sizes = ranked.groupBy("pos").count().where("count > 1").count()
    assert sizes == 0
    assert ranked.agg(F.min("pos"), F.max("pos")).first()[:] == (0, 2999)


def test_large_baskets_travel_in_parts(spark, lines):
    hot = hot_keys(lines, "k", min_rows=100)
    placed = with_gross(with_positions(items(lines), "k", ORDER, hot), "k", hot)
    headers = lines.select("k").distinct().withColumn("invoiceNumber", F.col("k").cast("string"))
    baskets = assemble_baskets(headers, placed, "k", hot, max_items=500).persist()
    parts = baskets.where("k = 7").select("basketPart", F.size("basketItems"), "total").orderBy("basketPart").collect()
    assert [(p[0], p[1]) for p in parts] == [(i, 500) for i in range(6)]
    total = basket_totals(items(lines), "k").where("k = 7").first().total
    assert {p[2] for p in parts} == {total}
    assert baskets.where("k <> 7").count() == 1000
    flat = baskets.select("k", F.explode("basketItems").alias("i"))
    assert flat.count() == lines.count()
    whole = assemble_baskets(headers, with_gross(with_positions(items(lines), "k", ORDER), "k"), "k", max_items=10**6)
    joined = baskets.where("k = 7").orderBy("basketPart").select("basketItems").collect()
    assert [i for r in joined for i in r[0]] == whole.where("k = 7").first().basketItems
    baskets.unpersist()


def test_items_keep_line_order(spark):
    lines = items(spark.createDataFrame([(1, 2, 5), (1, 1, 9), (1, 1, 3)], "k long, n long, x long"))
    placed = with_gross(with_positions(lines, "k", ORDER), "k")
    assert [i.id for i in item_arrays(placed, "k").first().basketItems] == ["3", "9", "5"]


def test_join_on_unique_gives_the_plain_join(spark, lines):
    one = lines.select("k").distinct().withColumn("v", F.col("k") * 2)
    hot = hot_keys(lines, "k", min_rows=100)
    split = join_on_unique(lines, one, "k", hot, F.col("x") > 2)
    plain = lines.join(one, "k").where("x > 2")
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_totals_round_once(spark):
    lines = spark.createDataFrame([(1, 0.333, 1), (1, 0.333, 1), (1, 0.333, 1)], "k long, price double, quantity int")
    assert basket_totals(lines, "k").first().total == 1.0
    assert price_lines(lines).agg(F.sum("subtotal")).first()[0] == pytest.approx(0.99)
