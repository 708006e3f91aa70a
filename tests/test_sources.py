from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillstream.schemas import BASKET, PAYMENT, PAYMENT_MESSAGE, POSTGRES_NAMES, SEED, UNNESTED, UNNESTED_KEY, avro_schema
from tillstream.sinks import catalog, documents, jdbc as out_jdbc, topics as out_topics
from tillstream.sources import jdbc as in_jdbc, spool, topics as in_topics
from tests.rows import basket, baskets_df, change, changes_df, item

DATA = str(Path(__file__).parent / "data")


def test_spool_accepts_older_names_and_fills_gaps(spark):
    rows = {r.invoiceNumber: r for r in spool.read_spool(spark, f"{DATA}/spool_baskets.json", BASKET).collect()}
    assert set(rows) == {"a1", "a2"}
    a1, a2 = rows["a1"], rows["a2"]
    assert (a1.saleTimestamp_Epoc, a1.vat, a1.clerk.surname) == ("1741076430444", 43.86, "")
    assert [(i.name, i.price, i.subtotal) for i in a1.basketItems] == [("Rice 2kg", 12.5, 0.0), ("Sample", 0.0, 0.0)]
    assert (a2.saleTimestamp_Epoc, a2.store.name, a2.total, a2.basketItems) == ("1741076490444", "North, {East}", 0.0, None)


def test_spool_and_document_round_trips(spark, scratch):
    df = baskets_df(spark, basket("a", items=(item('quo"te,\n},\n{'), item("b"))), basket("b", items=()))
    df = df.drop("basketPart").repartition(2)
    path = scratch("spool")
    documents.write_spool(df, path)
    raw = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert raw.count("\n},\n") == 2
    assert sorted(spool.read_spool(spark, path, BASKET).collect()) == sorted(df.collect())
    documents.write_documents(df, scratch_path := scratch("documents"))
    assert sorted(spool.read_documents(spark, scratch_path, BASKET).collect()) == sorted(df.collect())


def test_nulls_zeros_and_empty_texts_of_own_files_stay_apart(spark, scratch):
    from pyspark.sql import functions as F

    df = baskets_df(spark, basket("a"), basket("b", items=None), basket("c", items=(item(price=0.0), ("id", "", None, "C", None, None, 0.0)))).drop("basketPart")
    df = df.withColumns({"vat": F.when(F.col("invoiceNumber") == "a", F.lit(0.0)), "clerk": F.when(F.col("invoiceNumber") != "b", F.col("clerk"))})
    for write, read in ((documents.write_spool, spool.read_spool), (documents.write_documents, spool.read_documents)):
        write(df, path := scratch("nulls"))
        assert sorted(map(str, read(spark, path, BASKET, fill_gaps=False).collect())) == sorted(map(str, df.collect()))


def test_spool_is_split_over_tasks(spark, scratch):
    df = spark.range(20000).select(F.col("id").cast("string").alias("invoiceNumber"), F.lit(1.0).alias("paid"))
    documents.write_spool(df.coalesce(1), path := scratch("spool"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        read = spool.read_spool(spark, path, PAYMENT_MESSAGE)
        assert read.rdd.getNumPartitions() > 4
        assert read.select("invoiceNumber").distinct().count() == read.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_seed_document(spark):
    seed = spool.read_seed(spark, f"{DATA}/seed.json")
    assert {k: v.count() for k, v in seed.items()} == {"stores": 3, "clerks": 1, "products": 3}
    facts = spark.createDataFrame([("p1", 1), ("p2", 2), ("p9", 3)], "product_id string, quantity int")
    rows = spool.lookup(facts, seed["products"], "product_id").collect()
    assert sorted((r.product_id, r.name) for r in rows) == [("p1", "Rice"), ("p2", "Bleach")]


def test_append_topic_round_trip(spark):
    df = baskets_df(spark, basket("a"), basket("b", store="s2")).drop("basketPart")
    messages = out_topics.append_messages(df, F.col("store.name"), out_topics.json_encoder())
    assert sorted(r.key for r in messages.collect()) == ["store s1", "store s2"]
    decoded = in_topics.decode_messages(messages, in_topics.json_decoder(BASKET))
    assert sorted(decoded.collect()) == sorted(df.collect())


def test_keyed_topic_has_tombstones_and_needs_a_record_for_wide_keys(spark):
    df = spark.createDataFrame([("i", "s", "c", "b", "p", 1.0, "l", "1", "U", 1), ("i", "s", "c", "b", "q", 2.0, "l", "1", "D", 2)],
                               [*UNNESTED.names, "op", "seq"])
    with pytest.raises(ValueError, match="one column"):
        out_topics.upsert_messages(df, UNNESTED_KEY, out_topics.json_encoder())
    messages = out_topics.upsert_messages(df, UNNESTED_KEY, out_topics.json_encoder(), out_topics.json_encoder())
    assert [r.value is None for r in messages.orderBy("seq").collect()] == [False, True]
    decoder = in_topics.json_decoder(UNNESTED)
    back = in_topics.decode_upserts(messages.withColumnRenamed("seq", "offset"), UNNESTED, UNNESTED_KEY, decoder, decoder)
    assert [(r.product, r.subtotal, r.op) for r in back.orderBy("seq").collect()] == [("p", 1.0, "U"), ("q", None, "D")]


def test_messages_of_a_batch_are_newest_per_key(spark):
    rows = [("a", "3", 3), ("b", "1", 1), ("a", "1", 1), ("b", None, 4), ("a", "2", 2)]
    sent = out_topics.in_order(spark.createDataFrame(rows, "key string, value string, seq long").repartition(5))
    assert sorted(tuple(x) for x in sent.collect()) == [("a", "3", 3), ("b", None, 4)]


def test_missing_packages_are_named(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        in_topics.read_topic(spark, "broker:1", "t")
    df = spark.createDataFrame([(b"\x00\x00\x00\x00\x01x",)], "value binary")
    with pytest.raises(AnalysisException, match="spark-avro"):
        in_topics.decode_messages(df, in_topics.avro_decoder(BASKET))
    with pytest.raises(AnalysisException, match="spark-avro"):
        rows = changes_df(spark, change("a")).select(*PAYMENT_MESSAGE.names)
        out_topics.append_messages(rows, F.col("invoiceNumber"), out_topics.avro_encoder(PAYMENT_MESSAGE, 1))


def test_avro_schema_mirrors_the_fields():
    record = avro_schema(BASKET, "SalesBasket")
    assert [f["name"] for f in record["fields"]] == BASKET.names
    items = next(f for f in record["fields"] if f["name"] == "basketItems")["type"]["items"]
    assert {f["name"]: f["type"] for f in items["fields"]}["quantity"] == "int"
    assert avro_schema(PAYMENT, "P")["fields"][-1]["type"]["logicalType"] == "timestamp-micros"


def test_jdbc_options(spark, monkeypatch):
    """The write is checked up to the JDBC call; no database is started."""
    from pyspark.sql import DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: calls.append((a, k, self._df.columns)))
    out_jdbc.write_payments(changes_df(spark, change("a")), "jdbc:x", {"user": "u"}, batch_size=10)
    (args, kwargs, columns), = calls
    assert args == ("jdbc:x", "salespayments") and columns == PAYMENT_MESSAGE.names
    assert kwargs == {"mode": "append", "properties": {"batchsize": "10", "user": "u"}}
    assert in_jdbc.snapshot_bounds("2024-01-01", "2024-02-01", 4)["numPartitions"] == "4"
    assert set(POSTGRES_NAMES.values()) < set(PAYMENT.names) and SEED.names == ["Stores", "Clerks", "Products"]


def test_tables_are_written_by_name(spark, scratch):
    from tillstream.schemas import UNNESTED_SALES

    db = "till_by_name"
    catalog.create_database(spark, db, scratch("db"))
    catalog.create_database(spark, db)
    catalog.create_table(spark, f"{db}.t", UNNESTED_SALES)
    row = spark.createDataFrame([("i", "s", "c", "product", "brand", 1.0, "l", "1")],
                                ["invoicenumber", "store_id", "category", "product", "brand", *UNNESTED.names[5:]])
    catalog.insert_by_name(row, f"{db}.t")
    got = spark.table(f"{db}.t").first()
    assert (got.brand, got["product"]) == ("brand", "product")
    conf = catalog.lakehouse_conf("lake", "some.Catalog", "s3a://b/", endpoint="http://e")
    assert conf["spark.sql.catalog.lake.warehouse"] == "s3a://b/" and "spark.hadoop.fs.s3a.endpoint" in conf
    spark.sql(f"DROP DATABASE {db} CASCADE")


@pytest.mark.parametrize("spooled", [False, True])
def test_compressed_documents_are_small_and_read_back_whole(spark, scratch, spooled):
    rows = [basket(f"i{n}", items=[item(f"p{k}", price=k + 0.5) for k in range(n % 5)]) for n in range(200)]
    baskets = spark.createDataFrame([r[:len(BASKET)] for r in rows], BASKET).coalesce(2)
    write, read = (documents.write_spool, spool.read_spool) if spooled else (documents.write_documents, spool.read_documents)
    sizes = {}
    for compression in ("none", "gzip"):
        write(baskets, path := scratch(compression), compression=compression)
        assert sorted(map(str, read(spark, path, BASKET, fill_gaps=False).collect())) == sorted(map(str, baskets.collect()))
        sizes[compression] = sum(f.stat().st_size for f in Path(path).glob("part-*"))
    assert sizes["gzip"] * 5 < sizes["none"]
