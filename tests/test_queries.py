"""Registered queries against their SQL, and the same queries on heavily skewed tables."""

import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.check_oracle import compare, connect
from tests.conftest import TESTDATA
from tillstream.operators.changes import latest_per_key
from tillstream.operators.completed import completed_changes, live_completed
from tillstream.operators.unnest import collapse_lines, unnest_lines, unnest_sales
from tillstream.plans import queries
from tillstream.plans.entities import Retail
from tillstream.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(ORACLE)
    assert set(queries.QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["invoicenumber", "store_id", "category", "brand", "product", "subtotal",
                          "saleDateTime_Ltz", "saleTimestamp_Epoc"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, TESTDATA, name) is None


@pytest.mark.parametrize("name", ["epoch_event_time", "cdc_normalize", "cdc_normalize_pg", "sales_completed_1h"])
def test_session_zone_changes_nothing(spark, con, zone, name):
    assert compare(spark, con, TESTDATA, name) is None


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """One order holds a third of the lines, one part half of them, one customer half of the orders."""
    path = tmp_path_factory.mktemp("skewed")
    for name in ("nation", "customer", "part"):
        shutil.copyfile(f"{TESTDATA}/{name}.parquet", path / f"{name}.parquet")
    sql = duckdb.connect()
    sql.execute(f"""copy (select * replace (case when o_orderkey % 2 = 0 then 1 else o_custkey end as o_custkey)
                          from '{TESTDATA}/orders.parquet') to '{path}/orders.parquet'""")
    sql.execute(f"""
        copy (select * exclude (n) replace (case when n % 3 = 0 then 3 else l_orderkey end as l_orderkey,
                                            case when n % 2 = 0 then 1 else l_partkey end as l_partkey)
              from (select *, row_number() over () as n from '{TESTDATA}/lineitem.parquet'))
        to '{path}/lineitem.parquet'""")
    con = duckdb.connect()
    for name in ("nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"create view {name} as select * from '{path}/{name}.parquet'")
    return str(path), con


def same(df, con, name):
    want = con.execute(ORACLE[name] if name in ORACLE else name)
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall())


def test_skewed_tables_give_the_same_rows(spark, skewed):
    path, con = skewed
    r = Retail(spark, path, hot_rows=500, max_items=100)
    assert [k[0] for k in r.hot_orders.collect()] == [3]
    assert r.baskets.where("invoiceNumber = '3'").count() > 10
    same(unnest_lines(r.completed), con, "unnested_sales")
    same(collapse_lines(unnest_sales(r.completed)), con, "unnested_sales_upsert")
    log = completed_changes(r.baskets, latest_per_key(r.payment_changes, ["invoiceNumber"], ["seq"]), r.hot_invoices)
    same(collapse_lines(unnest_sales(live_completed(log))), con, "unnested_sales_upsert")
    flat = r.completed.groupBy("invoiceNumber").agg(
        F.first("total").alias("total"), F.sum(F.size("basketItems")).cast("int").alias("n_items"))
    want = con.execute(f'select "invoiceNumber", total, n_items from ({ORACLE["sales_completed"]})').fetchall()
    assert sorted(map(tuple, flat.collect())) == sorted(want)


def test_rows_of_a_hot_invoice_are_not_shuffled_to_one_task(spark, skewed):
    r = Retail(spark, skewed[0], hot_rows=500, max_items=100)
    plan = r.completed._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan



def test_skewed_streams_give_the_same_rows(spark, skewed):
    path, con = skewed
    r = Retail(spark, path, hot_rows=500, max_items=100)
    same(queries.stream_unnested_sales(r), con, "stream_unnested_sales")
    same(queries.pipeline_end_to_end(r).where("table_name = 'unnested_sales'"), con,
         f"select * from ({ORACLE['pipeline_end_to_end']}) where table_name = 'unnested_sales'")
