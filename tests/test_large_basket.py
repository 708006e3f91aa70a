"""One basket with 20,000 lines: still one row in every query, as in the SQL."""

import pytest

from tests.check_oracle import TABLES, compare

NAMES = ["basket_assembly", "sales_completed", "sales_completed_1h", "ctas_completed", "json_spool_roundtrip", "export_baskets"]


@pytest.fixture(scope="module")
def folder(spark):
    from pyspark.sql import functions as F
    from tillstream.session import scratch_dir

    source, path = "/root/testdata/sf0.01", scratch_dir(spark, "large").removeprefix("file:")
    for name in TABLES:
        df = spark.read.parquet(f"{source}/{name}.parquet")
        if name == "lineitem":
            df = df.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, 3).otherwise(F.col("l_orderkey")).cast("bigint"))
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_large_basket_equals_sql(spark, folder):
    con = connect_folder(folder)
    assert {n: compare(spark, con, folder, n) for n in NAMES} == dict.fromkeys(NAMES)


def connect_folder(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    return con
