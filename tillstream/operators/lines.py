"""Basket lines: positions, subtotals, totals, and assembly into nested baskets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tillstream.functions.money import VAT_RATE, basket_amounts, exact_sum, round_half_away
from tillstream.operators.skew import join_on_unique, split_hot
from tillstream.schemas import ITEM
from tillstream.session import shared_dir

MAX_ITEMS: int | None = None  # lines in one basket document; None: a basket is one document, however large


def price_lines(df: DataFrame, price: str = "price", quantity: str = "quantity") -> DataFrame:
    """Add ``subtotal`` = price x quantity, rounded per line."""
    return df.withColumn("subtotal", round_half_away(F.col(price) * F.col(quantity)))


def gross_amount(over: WindowSpec | None = None) -> Column:
    """Unrounded basket amount: the sum of price x quantity over its lines."""
    return exact_sum(F.col("price") * F.col("quantity"), over)


def basket_totals(lines: DataFrame, key: str, rate: float = VAT_RATE, *measures: Column) -> DataFrame:
    """Total, VAT and nett per basket. Lines are summed unrounded; each figure is rounded once."""
    sums = lines.groupBy(key).agg(gross_amount().alias("gross"), *measures)
    return sums.withColumns(basket_amounts(F.col("gross"), rate)).drop("gross")


def with_positions(lines: DataFrame, key: str, order: list[str], hot: DataFrame | None = None) -> DataFrame:
    """Add ``pos``, the 0-based place of a line in its basket by ``order``.

    Baskets in ``hot`` (see :func:`tillstream.operators.skew.hot_keys`) are too large for one
    window partition and are ranked by a range sort over many tasks instead. Give ``lines`` as a
    plain scan then: rows must come in the same order when a lost task is run again.
    """
    window = Window.partitionBy(key).orderBy(*order)
    pos = (F.row_number().over(window) - 1).cast("bigint")
    if hot is None:
        return lines.withColumn("pos", pos)
    large, rest = split_hot(lines, key, hot)
    return rest.withColumn("pos", pos).unionByName(_positions_by_range(large, key, order))


def with_gross(lines: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Add ``gross``, the unrounded basket amount, to every line. After ``with_positions`` it takes
    no further shuffle, which is cheaper than summing in a second pass and joining the sums."""
    over = Window.partitionBy(key)
    if hot is None:
        return lines.withColumn("gross", gross_amount(over))
    large, rest = split_hot(lines, key, hot)
    sums = large.groupBy(key).agg(gross_amount().alias("gross"))  # one row per hot key
    return rest.withColumn("gross", gross_amount(over)).unionByName(large.join(F.broadcast(sums), key))


def _positions_by_range(lines: DataFrame, key: str, order: list[str]) -> DataFrame:
    # The row number as last sort column lets the range partitioner cut through runs of equal lines.
    # The checkpoint fixes which row is in which piece, so both uses below see the same pieces.
    shared_dir(lines.sparkSession)
    sort = [key, *order, "_tie"]
    pieces = (
        lines.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumns({"_piece": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
        .checkpoint()
    )
    # One row per basket and piece: at most (hot baskets + pieces) rows.
    sizes = pieces.groupBy(key, "_piece").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, "_piece", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        pieces.join(F.broadcast(starts), [key, "_piece"])
        .withColumn("pos", F.col("_row") - F.col("_first") + F.col("_start"))
        .drop("_tie", "_piece", "_row", "_first", "_start")
    )


def item_arrays(lines: DataFrame, key: str, max_items: int | None = MAX_ITEMS) -> DataFrame:
    """``basketItems`` and ``gross`` per basket from lines with ``pos`` and ``gross``.

    A basket is one row (``basketPart`` 0) at every size, as its document is one message. Only a caller
    that asks for parts gets them: at most ``max_items`` lines each, every one with the whole amounts.
    """
    item = F.struct("pos", *(F.col(f.name).cast(f.dataType).alias(f.name) for f in ITEM.fields))
    part = F.lit(0).cast("bigint") if max_items is None else F.call_function("div", F.col("pos"), F.lit(max_items))
    return (
        lines.withColumn("basketPart", part)
        .groupBy(key, "basketPart")
        .agg(F.sort_array(F.collect_list(item)).alias("_items"), F.first("gross").alias("gross"))
        .select(key, "basketPart", "gross", F.transform("_items", lambda i: i.dropFields("pos")).alias("basketItems"))
    )


def assemble_baskets(headers: DataFrame, lines: DataFrame, key: str, hot: DataFrame | None = None,
                     rate: float = VAT_RATE, max_items: int | None = MAX_ITEMS) -> DataFrame:
    """Nested baskets with their amounts: a header row per basket and its lines (with ``pos`` and ``gross``).

    Baskets without lines drop out.
    """
    baskets = join_on_unique(item_arrays(lines, key, max_items), headers, key, hot)
    return baskets.withColumns(basket_amounts(F.col("gross"), rate)).drop("gross")
