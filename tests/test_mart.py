"""The mart derived by Spark equals the one DuckDB derives from the same text."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom.sources import domains as D
from starloom.sources import mart as M
from starloom.sources.views import Mart


@pytest.mark.parametrize("table", M.MART_TABLES)
def test_mart_table_parity(spark, duck_small, table):
    df = Mart(spark, SF_SMALL).table(table)
    aggs = ["count(*) AS n"] + [f"count({c}) AS c_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in df.columns]
    sql = f"SELECT {', '.join(aggs)} FROM {table}"
    df.createOrReplaceTempView("parity_tmp")
    got = [str(x) for x in spark.sql(sql.replace(f"FROM {table}", "FROM parity_tmp")).collect()[0]]
    want = [str(x) for x in duck_small.execute(M.oracle(sql)).fetchall()[0]]
    assert got == want


def test_mart_types(spark):
    m = Mart(spark, SF_SMALL)
    types = dict(m.store_sales.dtypes)
    assert types["ss_sales_price"] == "decimal(7,2)"
    assert types["ss_item_sk"] == "bigint"
    assert dict(m.date_dim.dtypes)["d_date"] == "date"


def test_domains_hold_query_literals(spark):
    m = Mart(spark, SF_SMALL)
    stores = {r[0] for r in m.store.select("s_store_name").distinct().collect()}
    assert "ese" in stores
    reasons = {r[0] for r in m.reason.select("r_reason_desc").collect()}
    assert "Did not like the warranty" in reasons
    assert {"orchid", "chiffon", "lace"} <= set(D.COLORS)
    cal = m.date_dim.agg(F.min("d_date"), F.max("d_date"), F.min("d_month_seq")).collect()[0]
    assert str(cal[0]) == "1990-01-01" and str(cal[1]) == "2005-12-31"
    # 2001-01 has month sequence 1212, the literal the queries use
    assert m.date_dim.where("d_year = 2001 AND d_moy = 1").select("d_month_seq").distinct().collect()[0][0] == 1212


def test_weekday_alignment(spark):
    m = Mart(spark, SF_SMALL)
    row = m.date_dim.where(F.col("d_date") == F.lit("2000-01-02").cast("date")).collect()[0]
    assert row["d_day_name"] == "Sunday" and row["d_dow"] == 0


def test_returns_are_subsets_of_sales(spark):
    m = Mart(spark, SF_SMALL)
    orphan = m.store_returns.join(m.store_sales, (F.col("sr_item_sk") == F.col("ss_item_sk"))
                                  & (F.col("sr_ticket_number") == F.col("ss_ticket_number")), "left_anti")
    assert orphan.count() == 0
    # (item, ticket) may repeat (the source repeats some order/part pairs), so
    # the invariant is: each return has a sale line with at least its quantity
    uncovered = m.store_returns.join(m.store_sales, (F.col("sr_item_sk") == F.col("ss_item_sk"))
                                     & (F.col("sr_ticket_number") == F.col("ss_ticket_number"))
                                     & (F.col("sr_return_quantity") <= F.col("ss_quantity")), "left_anti")
    assert uncovered.count() == 0
