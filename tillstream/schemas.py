"""Entity schemas, keys, and the names older files use for the same fields."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


S, D, I, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType()

STORE = _struct(("id", S), ("name", S))
CLERK = _struct(("id", S), ("name", S), ("surname", S))
ITEM = _struct(
    ("id", S), ("name", S), ("brand", S), ("category", S),
    ("price", D), ("quantity", I), ("subtotal", D),
)
BASKET = _struct(
    ("invoiceNumber", S), ("saleDateTime_Ltz", S), ("saleTimestamp_Epoc", S), ("terminalPoint", S),
    ("nett", D), ("vat", D), ("total", D),
    ("store", STORE), ("clerk", CLERK), ("basketItems", T.ArrayType(ITEM)),
)
PAYMENT_MESSAGE = _struct(
    ("invoiceNumber", S), ("payDateTime_Ltz", S), ("payTimestamp_Epoc", S), ("paid", D), ("finTransactionId", S),
)
PAYMENT = T.StructType([*PAYMENT_MESSAGE.fields, T.StructField("created_at", TS)])
COMPLETED = T.StructType([
    *BASKET.fields,
    *(f for f in PAYMENT_MESSAGE.fields if f.name != "invoiceNumber"),
])
UNNESTED = _struct(
    ("invoicenumber", S), ("store_id", S), ("category", S), ("brand", S), ("product", S),
    ("subtotal", D), ("saleDateTime_Ltz", S), ("saleTimestamp_Epoc", S),
)
UNNESTED_KEY = ["invoicenumber", "store_id", "category", "brand", "product"]

# Row images inside a change record. The two databases name and type the columns differently.
PAYMENT_ROW_MYSQL = T.StructType([*PAYMENT_MESSAGE.fields, T.StructField("created_at", T.LongType())])
PAYMENT_ROW_POSTGRES = _struct(
    ("invoicenumber", S), ("paydatetime_ltz", S), ("paytimestamp_epoc", S),
    ("paid", T.DecimalType(10, 2)), ("fintransactionid", S), ("created_at", S),
)
POSTGRES_NAMES = {
    "invoicenumber": "invoiceNumber",
    "paydatetime_ltz": "payDateTime_Ltz",
    "paytimestamp_epoc": "payTimestamp_Epoc",
    "fintransactionid": "finTransactionId",
}

SEED = T.StructType([
    T.StructField("Stores", T.ArrayType(STORE)),
    T.StructField("Clerks", T.ArrayType(_struct(("id", S), ("name", S), ("surname", S), ("storeId", S)))),
    T.StructField("Products", T.ArrayType(
        _struct(("id", S), ("name", S), ("brand", S), ("category", S), ("price", D)))),
])

# Field names found in older files -> field names of the schemas above.
ALIASES = {
    "saleDateTime": "saleDateTime_Ltz",
    "saleTimestamp": "saleTimestamp_Epoc",
    "salesTimetamp_Epoc": "saleTimestamp_Epoc",
    "payDateTime": "payDateTime_Ltz",
    "payTimestamp": "payTimestamp_Epoc",
    "vAT": "vat",
    "storeid": "store_id",
}


def change_envelope(row: T.StructType, source: T.StructType | None = None) -> T.StructType:
    """Change record as log-based capture tools publish it: operation, row before and after, and the ``source`` block.

    Without a source block records carry a number ``seq`` that orders them.
    """
    order = T.StructField("seq", T.LongType()) if source is None else T.StructField("source", source)
    return T.StructType([T.StructField("op", S), T.StructField("before", row), T.StructField("after", row), order])


def avro_schema(schema: T.StructType, name: str, namespace: str = "Sales") -> dict:
    """Avro record schema (as a dict, for ``json.dumps``) of a schema above."""
    simple = {"string": "string", "double": "double", "int": "int", "bigint": "long"}

    def avro_type(t: T.DataType, field_name: str):
        if isinstance(t, T.StructType):
            return {"type": "record", "name": field_name,
                    "fields": [{"name": f.name, "type": avro_type(f.dataType, f.name)} for f in t.fields]}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": avro_type(t.elementType, field_name)}
        if isinstance(t, T.TimestampType):
            return {"type": "long", "logicalType": "timestamp-micros"}
        return simple[t.simpleString()]

    return {"namespace": namespace, **avro_type(schema, name)}


@dataclass(frozen=True)
class TableSpec:
    """Declaration of a table: schema, key, event-time source column, watermark delay."""

    name: str
    schema: T.StructType
    key: list[str] = field(default_factory=list)
    event_time: dict[str, str] = field(default_factory=dict)  # computed column -> epoch column
    watermark: tuple[str, str] | None = None  # computed column, delay


BASKETS = TableSpec("salesbaskets", BASKET, [], {"saleTimestamp_WM": "saleTimestamp_Epoc"},
                    ("saleTimestamp_WM", "0 seconds"))
PAYMENTS = TableSpec("salespayments", PAYMENT, ["invoiceNumber"], {"payTimestamp_WM": "payTimestamp_Epoc"},
                     ("payTimestamp_WM", "0 seconds"))
COMPLETED_SALES = TableSpec("salescompleted", COMPLETED, ["invoiceNumber"],
                            {"payTimestamp_WM": "payTimestamp_Epoc", "saleTimestamp_WM": "saleTimestamp_Epoc"},
                            ("saleTimestamp_WM", "0 seconds"))
UNNESTED_SALES = TableSpec("unnested_sales", UNNESTED, UNNESTED_KEY, {"saleTimestamp_WM": "saleTimestamp_Epoc"},
                           ("saleTimestamp_WM", "0 seconds"))
