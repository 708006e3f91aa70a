"""Baskets joined to their payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.event_time import event_time
from tillstream.operators.changes import live_rows
from tillstream.operators.skew import join_on_unique
from tillstream.schemas import COMPLETED

_SALE_TIME = "_sale_time"


BASKET_ROW = "basketRow"  # number of a stored basket; baskets given without items have it, so that their items can be put back


def _columns(df: DataFrame, *extra: str) -> DataFrame:
    parts = [c for c in ("basketPart", BASKET_ROW) if c in df.columns]
    left = {"basketItems"} if BASKET_ROW in df.columns else set()
    return df.select(*(f.name for f in COMPLETED.fields if f.name not in left), *parts, *extra)


def put_items(completed: DataFrame, baskets: DataFrame) -> DataFrame:
    """Completed sales of baskets without items, with the items of the stored ``baskets`` they came from, told by ``basketRow``.

    Where ``baskets`` is a table dealt by invoice only the completed sales are shuffled.
    """
    items = baskets.select("invoiceNumber", F.col(BASKET_ROW).alias("_row"), "basketItems")
    same = F.col("_row") - F.col(BASKET_ROW) == 0  # no key of the join, which would deal the table anew
    extra = [c for c in completed.columns if c not in COMPLETED.names and c != BASKET_ROW]
    return completed.hint("shuffle_hash").join(items, "invoiceNumber").where(same).select(*COMPLETED.names, *extra)


def _paid_after_sale() -> Column:
    # NULL on either side (no created_at, unreadable sale time) is not true, so nothing completes.
    return F.col("created_at") > F.col(_SALE_TIME)


def with_sale_time(baskets: DataFrame) -> DataFrame:
    return baskets.withColumn(_SALE_TIME, event_time(F.col("saleTimestamp_Epoc")))


def _with_valid_sale_time(baskets: DataFrame) -> DataFrame:
    return with_sale_time(baskets).where(F.col(_SALE_TIME).isNotNull())


def sales_completed(baskets: DataFrame, payments: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Completed sales: basket and payment of one invoice, paid after the sale second.

    Batch or streaming (append). Streaming keeps all unmatched rows as state, like the unbounded
    join it stands for; :func:`sales_completed_within` is the form whose state is evicted.
    ``hot`` (batch, one payment per invoice) names invoices with very many basket rows, see
    ``hot_keys``.
    """
    return _columns(join_on_unique(_with_valid_sale_time(baskets), payments, "invoiceNumber", hot, _paid_after_sale()))


def completed_headers(headers: DataFrame, payments: DataFrame, bound: str | None = None) -> DataFrame:
    """Completed sales of baskets without items, and all columns of both sides (batch).

    A header is small and an invoice has few, so no key is hot; items are joined from their lines afterwards, once.
    """
    joined = _with_valid_sale_time(headers).join(payments, "invoiceNumber").where(_paid_after_sale())
    if bound is not None:
        joined = joined.where(F.col("created_at") <= F.col(_SALE_TIME) + F.expr(f"interval {bound}"))
    return joined.drop(_SALE_TIME)


def header_changes(headers: DataFrame, changes: DataFrame) -> DataFrame:
    """Like :func:`completed_changes`, for baskets without items and any number of changes per payment (batch)."""
    joined = with_sale_time(headers).join(changes, "invoiceNumber")
    holds = F.coalesce((F.col("op") != "D") & _paid_after_sale(), F.lit(False))
    return joined.withColumn("op", F.when(holds, "U").otherwise("D")).drop(_SALE_TIME)


def sales_completed_within(baskets: DataFrame, payments: DataFrame, bound: str = "1 hour",
                           watermark: str | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Completed sales paid at most ``bound`` after the sale.

    With ``watermark`` (the allowed lateness) both streams carry a watermark and the time range
    lets Spark drop state. Rows later than the watermark are lost, so choose it from the sources.
    """
    baskets = _with_valid_sale_time(baskets)
    if watermark is not None:
        baskets = baskets.withWatermark(_SALE_TIME, watermark)
        payments = payments.withWatermark("created_at", watermark)
    in_time = _paid_after_sale() & (F.col("created_at") <= F.col(_SALE_TIME) + F.expr(f"interval {bound}"))
    return _columns(join_on_unique(baskets, payments, "invoiceNumber", hot, in_time))


def completed_changes(baskets: DataFrame, changes: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Changelog of completed sales from baskets and the changelog of payments.

    Every payment change becomes one change of the completed sale: ``U`` when the changed payment
    completes it, ``D`` when it was deleted or no longer does. It keeps the payment's ``seq``, so
    :func:`live_completed` gives the same table in whatever order and batches the inputs came, and
    the stream needs nothing but an insert-only join.

    ``hot`` is for batches whose changes were reduced to the newest per invoice.
    """
    joined = join_on_unique(with_sale_time(baskets), changes, "invoiceNumber", hot)
    holds = F.coalesce((F.col("op") != "D") & _paid_after_sale(), F.lit(False))
    return _columns(joined.withColumn("op", F.when(holds, "U").otherwise("D")), "op", "seq")


COMPLETED_KEY = ["invoiceNumber", "basketPart"]
COMPLETED_ORDER = ["seq", "op"]  # of equal seq, U sorts over D: one valid copy of a basket is enough


def live_completed(changes: DataFrame) -> DataFrame:
    """Current completed sales of a changelog from :func:`completed_changes`."""
    key = [c for c in COMPLETED_KEY if c in changes.columns]
    return live_rows(changes, key, COMPLETED_ORDER)
