"""JSON files: spooled documents, JSON lines, and the seed document of reference data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillstream.operators.skew import join_on_unique
from tillstream.schemas import ALIASES, SEED

DOCUMENT_END = "\n},\n"


def _with_aliases(schema: T.StructType) -> tuple[T.StructType, dict[str, list[str]]]:
    """The schema plus every older name of its fields, and the places of each field in it."""
    older = [T.StructField(old, schema[new].dataType) for old, new in ALIASES.items() if new in schema.names]
    fields = [*schema.fields, *older]
    places = {name: [f"_{i}" for i, f in enumerate(fields) if ALIASES.get(f.name, f.name) == name]
              for name in schema.names}
    return T.StructType(fields), places


def _filled(column: Column, data_type: T.DataType) -> Column:
    """Writers leave zeros and empty strings out of the JSON; put them back."""
    if isinstance(data_type, T.StructType):
        return F.struct(*(_filled(column[f.name], f.dataType).alias(f.name) for f in data_type.fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda x: _filled(x, data_type.elementType))
    if isinstance(data_type, T.StringType):
        return F.coalesce(column, F.lit(""))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(column, F.lit(0).cast(data_type))
    return column


def parse_documents(df: DataFrame, schema: T.StructType, column: str = "value", fill_gaps: bool = True) -> DataFrame:
    """Parse one JSON document per row: fixed schema, older field names accepted, gaps filled.

    Without ``fill_gaps`` what is not in a document is NULL, as in documents of this package's own writers, which leave out
    NULL only.
    """
    filled = _filled if fill_gaps else lambda column, _: column
    wide, places = _with_aliases(schema)
    # Numbered fields, because an older name may differ from the current one in case only.
    numbered = T.StructType([T.StructField(f"_{i}", f.dataType) for i, f in enumerate(wide.fields)])
    doc = F.from_json(F.col(column), wide).cast(numbered)
    return df.select(doc.alias("_doc")).select(*(
        filled(F.coalesce(*(F.col(f"_doc.{place}") for place in places[f.name])), f.dataType).alias(f.name)
        for f in schema.fields
    ))


def read_spool(spark: SparkSession, path: str, schema: T.StructType, fill_gaps: bool = True) -> DataFrame:
    """Read a spool: indented documents, each followed by a comma, which is no valid JSON as a whole.

    The end of a document is the record separator, so files are split over tasks like any text.
    """
    text = spark.read.option("lineSep", DOCUMENT_END).text(path)
    body = F.regexp_replace("value", r"[\s,]*$", "")
    whole = F.when(F.endswith(body, F.lit("\n}")), body).otherwise(F.concat(body, F.lit("\n}")))
    return parse_documents(text.where(body != "").select(whole.alias("value")), schema, fill_gaps=fill_gaps)


def read_documents(spark: SparkSession, path: str, schema: T.StructType, fill_gaps: bool = True) -> DataFrame:
    """Read JSON lines (one document per line)."""
    return parse_documents(spark.read.text(path), schema, fill_gaps=fill_gaps)


def read_seed(spark: SparkSession, path: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """Stores, clerks and products from the seed document(s). Ids are not unique in either of them."""
    doc = spark.read.schema(SEED).option("multiLine", multi_line).json(path)
    return {f.name.lower(): doc.select(F.inline(f.name)) for f in SEED.fields}


def one_per_id(dim: DataFrame) -> DataFrame:
    """One row per id (the smallest by its other columns), for looking rows up without multiplying facts."""
    rest = [c for c in dim.columns if c != "id"]
    return dim.groupBy("id").agg(F.min(F.struct(*rest)).alias("_row")).select("id", "_row.*")


def lookup(facts: DataFrame, dim: DataFrame, on: str, hot: DataFrame | None = None) -> DataFrame:
    """Add the columns of a seed table to rows that name its id in ``on``.

    Seed tables are small as a rule, and Spark broadcasts them while their measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``. Beyond it the rows are shuffled, except those of the
    ids in ``hot`` (see ``hot_keys``).
    """
    return join_on_unique(facts, one_per_id(dim).withColumnRenamed("id", on), on, hot)
