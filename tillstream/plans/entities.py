"""The given order tables seen as retail entities: orders are sales, line items are basket lines."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.functions.event_time import millis_to_seconds, time_label
from tillstream.functions.money import VAT_RATE
from tillstream.operators.changes import live_rows
from tillstream.operators.completed import completed_headers, sales_completed
from tillstream.operators.lines import (
    MAX_ITEMS, assemble_baskets, basket_totals, price_lines, with_gross, with_positions,
)
from tillstream.operators.skew import MIN_ROWS, hot_keys
from tillstream.session import scratch_dir

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
OFFSET_MINUTES = 120
STATE_ORDERS = 500_000  # orders whose stream state is one partition


class Retail:
    """Entities over one folder of tables, each built at most once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str, hot_rows: int = MIN_ROWS, max_items: int | None = MAX_ITEMS):
        self.spark, self.sf_dir, self.hot_rows, self.max_items = spark, sf_dir, hot_rows, max_items
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def state_partitions(self) -> int:
        """Partitions of stream state: the session's setting, or fewer while the input has few files and few orders.

        A task with more orders would sort its rows on disk before it gives them to the state.
        """
        files = len(self.table("lineitem").inputFiles())
        wanted = max(files, self.spark.sparkContext.defaultParallelism, self.table("orders").count() // STATE_ORDERS)
        return min(wanted, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def scratch(self, name: str) -> str:
        return scratch_dir(self.spark, name)

    @cached_property
    def hot_orders(self) -> DataFrame | None:
        """Orders with too many lines for one task (a pass over one column)."""
        return hot_keys(self.table("lineitem"), "l_orderkey", self.hot_rows)

    @property
    def hot_invoices(self) -> DataFrame | None:
        hot = self.hot_orders
        return None if hot is None else hot.select(F.col("l_orderkey").cast("string").alias("invoiceNumber"))

    def _with_products(self, lines: DataFrame) -> DataFrame:
        products = self.table("part").select(
            "p_partkey", F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"),
        )
        return lines.join(products, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey").withColumn(
            "quantity", F.col("l_quantity").cast("int"))

    @cached_property
    def lines(self) -> DataFrame:
        """Basket lines with their product and subtotal."""
        lines = self.table("lineitem").select("l_orderkey", *LINE_ORDER)
        return price_lines(self._with_products(lines)).drop(*LINE_ORDER)

    @cached_property
    def placed_lines(self) -> DataFrame:
        """Basket lines under their invoice, with their place in the basket and the basket's gross amount.

        They are dealt by invoice, as payments are joined, so that lines and baskets are shuffled once.
        """
        key, hot = "invoiceNumber", self.hot_invoices
        lines = self.table("lineitem").select(F.col("l_orderkey").cast("string").alias(key), *LINE_ORDER)
        if hot is None:  # what follows from other columns is not shuffled
            placed = with_positions(self._with_products(lines).drop("id", "quantity"), key, LINE_ORDER)
            placed = placed.withColumns({"id": F.col("l_partkey").cast("string"), "quantity": F.col("l_quantity").cast("int")})
        else:  # ranked before the product join: the range sort needs a plain scan as its input
            placed = self._with_products(with_positions(lines, key, LINE_ORDER, hot))
        return price_lines(with_gross(placed, key, hot)).drop(*LINE_ORDER)

    @cached_property
    def sales(self) -> DataFrame:
        """Sale headers; milliseconds are non-zero on purpose, event time must cut them off."""
        day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
        key = F.col("o_orderkey")
        return self.table("orders").select(
            "o_orderkey", "o_custkey",
            (day * 86400000 + key * 7919 % 86400 * 1000 + key % 1000).alias("sale_ms"),
        )

    @cached_property
    def headers(self) -> DataFrame:
        """Basket headers: everything but the item array and the amounts that follow from it."""
        customers = self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        stores = self.table("nation").select("n_nationkey", "n_name")
        key = F.col("o_orderkey")
        return (
            self.sales
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(stores, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "o_orderkey", key.cast("string").alias("invoiceNumber"),
                time_label(F.col("sale_ms"), OFFSET_MINUTES).alias("saleDateTime_Ltz"),
                F.col("sale_ms").cast("string").alias("saleTimestamp_Epoc"),
                (key % 20 + 1).cast("string").alias("terminalPoint"),
                F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")).alias("store"),
                F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                         F.col("c_mktsegment").alias("surname")).alias("clerk"),
            )
        )

    @cached_property
    def totals(self) -> DataFrame:
        """Amounts and number of lines per basket."""
        count = F.count(F.lit(1)).cast("int").alias("n_items")
        return basket_totals(self.lines, "l_orderkey", VAT_RATE, count).withColumnRenamed("l_orderkey", "o_orderkey")

    @cached_property
    def basket_headers(self) -> DataFrame:
        """Baskets without their items: what a join with payments needs. ``n_items`` counts the items."""
        return self.headers.join(self.totals, "o_orderkey").drop("o_orderkey")

    @cached_property
    def completed_headers(self) -> DataFrame:
        """Completed sales after all changes, without their items."""
        return completed_headers(self.basket_headers, self.live_payments)

    @cached_property
    def invoice_lines(self) -> DataFrame:
        """Basket lines under their invoice, with ``place``, which orders the lines of a basket."""
        lines = price_lines(self._with_products(self.table("lineitem").select("l_orderkey", *LINE_ORDER)))
        return lines.select(F.col("l_orderkey").cast("string").alias("invoiceNumber"), "category", "brand", "name", "subtotal",
                            F.struct(*LINE_ORDER).alias("place"))

    @cached_property
    def baskets(self) -> DataFrame:
        """Nested baskets."""
        headers = self.headers.drop("o_orderkey")
        return assemble_baskets(headers, self.placed_lines, "invoiceNumber", self.hot_invoices, max_items=self.max_items)

    @cached_property
    def payments(self) -> DataFrame:
        """First payment of each sale: a tenth is unpaid, some are paid in the sale second or two hours late."""
        totals = self.totals.select("o_orderkey", "total")
        key = F.col("o_orderkey")
        lag = key * 31 % 360
        created = F.when(key % 17 == 0, 0).when(key % 19 == 0, 7200).otherwise(lag + 1)
        pay_ms = F.col("sale_ms") + lag * 1000
        return (
            self.sales.where(key % 10 != 0).join(totals, "o_orderkey")
            .select(
                "o_orderkey", key.cast("string").alias("invoiceNumber"),
                time_label(pay_ms, OFFSET_MINUTES).alias("payDateTime_Ltz"),
                pay_ms.cast("string").alias("payTimestamp_Epoc"), F.col("total").alias("paid"),
                F.concat(F.lit("txn-"), key.cast("string")).alias("finTransactionId"),
                F.timestamp_seconds(millis_to_seconds(F.col("sale_ms")) + created).alias("created_at"),
            )
        )

    @cached_property
    def payment_changes(self) -> DataFrame:
        """Changelog of payments: an insert each, some updates (paid + 1) and some deletes."""
        key = F.col("o_orderkey")
        base = key * 10
        change = F.array_compact(F.array(
            F.struct(F.lit("I").alias("op"), base.alias("seq"), F.col("paid").alias("amount")),
            F.when(key % 23 == 0, F.struct(F.lit("U").alias("op"), (base + 1).alias("seq"),
                                           (F.col("paid") + 1).alias("amount"))),
            F.when(key % 29 == 0, F.struct(F.lit("D").alias("op"), (base + 2).alias("seq"),
                                           F.col("paid").alias("amount"))),
        ))
        return self.payments.withColumn("change", F.explode(change)).select(
            "invoiceNumber", "payDateTime_Ltz", "payTimestamp_Epoc", F.col("change.amount").alias("paid"),
            "finTransactionId", "created_at", F.col("change.op").alias("op"), F.col("change.seq").alias("seq"),
        )

    @cached_property
    def live_payments(self) -> DataFrame:
        """Payments after all changes."""
        return live_rows(self.payment_changes, ["invoiceNumber"], ["seq"])

    @cached_property
    def completed(self) -> DataFrame:
        """Completed sales after all changes."""
        return sales_completed(self.baskets, self.live_payments, self.hot_invoices)


def created_seconds(df: DataFrame) -> DataFrame:
    """``created_at`` as epoch seconds, comparable across engines and time zones."""
    return df.withColumn("created_s", F.unix_seconds("created_at")).drop("created_at")
