"""Small inline baskets and payments."""

from __future__ import annotations

from datetime import datetime, timezone

from tillstream.plans.pipeline import PAYMENT_CHANGE, PART
from tillstream.schemas import BASKET
from pyspark.sql import types as T

STREAMED_BASKET = T.StructType([*BASKET.fields, PART])
SALE_S = 1_699_165_800  # inside the hour that New York has twice


def item(name="soap", price=10.0, quantity=1, brand="B", category="C"):
    return (f"id-{name}", name, brand, category, price, quantity, round(price * quantity, 2))


def basket(invoice, epoch=f"{SALE_S}123", items=(item(),), part=0, store="s1"):
    total = None if items is None else float(sum(i[6] for i in items))
    return (invoice, "label", epoch, "1", 1.0, 1.0, total, (store, f"store {store}"), ("c", "n", "s"),
            None if items is None else list(items), part)


def change(invoice, lag=60, op="I", seq=1, paid=10.0):
    created = None if lag is None else datetime.fromtimestamp(SALE_S + lag, timezone.utc)
    return (invoice, "label", f"{SALE_S + (lag or 0)}000", paid, f"txn-{invoice}", created, op, seq)


def baskets_df(spark, *rows):
    return spark.createDataFrame(list(rows), STREAMED_BASKET)


def changes_df(spark, *rows):
    return spark.createDataFrame(list(rows), PAYMENT_CHANGE)
