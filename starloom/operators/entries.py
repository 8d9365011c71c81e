"""Operator-level entries: each relational operator and scalar function of the
survey (R1-R50, F1-F26), the data tests (T1, T2) and the loader (S1, S2)
exercised on whole tables, each with an independent DuckDB formulation.

R/F entries read the driver's own tables; T and S entries read the mart
that Spark derives from them.  Money columns of the driver tables are
doubles with two decimals; they are summed as decimal(15,2) so that both
engines add exactly, then reported as double.
"""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import c, dbl, nz_div, safe_div, top
from ..oracle import ORACLE
from ..oracle.registry import ob
from ..plans.graph import run_models
from ..sources import catalog, loader
from ..sources import mart as M
from ..sources.views import Mart
from . import datatests as T
from . import relational as R

OPERATOR_QUERIES: dict = {}
OPERATOR_ORACLE: dict = {}


def _entry(name: str, sql: str | None, mart_sql: bool = False):
    def deco(fn):
        OPERATOR_QUERIES[name] = fn
        if sql is not None:
            OPERATOR_ORACLE[name] = M.oracle(sql) if mart_sql else sql.strip() + "\n"
        return fn
    return deco


def _src(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def dec(col) -> "F.Column":
    """Money double with two decimals as exact decimal(15,2)."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(15,2)")


def _day(col):
    return F.col(col).cast("date")


# --------------------------------------------------------------------------
# Projection with aliases, star projection, filter,
# BETWEEN, ORDER BY and LIMIT (a top-k report)
# --------------------------------------------------------------------------
@_entry("r01_r05_r44_top_discounted_lines", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS qty,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DOUBLE) AS disc_price
FROM (SELECT * FROM lineitem) l
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'
  AND l_quantity BETWEEN 10 AND 20
{ob("disc_price DESC", "l_orderkey, l_linenumber, l_partkey, qty")}
""")
def r01_top_discounted_lines(spark, sf_dir):
    li = R.select_all(_src(spark, sf_dir, "lineitem"))
    out = (li.where(_day("l_shipdate").between(F.lit("1996-01-01").cast("date"), F.lit("1996-03-31").cast("date"))
                    & c("l_quantity").between(10, 20))
           .select("l_orderkey", "l_linenumber", "l_partkey", c("l_quantity").cast("int").alias("qty"),
                   dbl(dec("l_extendedprice") * (1 - dec("l_discount"))).alias("disc_price")))
    return top(out, 100, "-disc_price")


# OR, IN list, inequality, NULL test, LIKE
@_entry("r04_r09_order_predicates", f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders,
       count(CASE WHEN o_orderpriority LIKE '1-%' THEN 1 END) AS n_like
FROM orders
WHERE (o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus = 'P')
  AND o_custkey <> o_orderkey AND o_orderdate IS NOT NULL
GROUP BY o_orderstatus, o_orderpriority
{ob("o_orderstatus, o_orderpriority", "n_orders, n_like", None)}
""")
def r04_order_predicates(spark, sf_dir):
    o = _src(spark, sf_dir, "orders")
    f = R.where_any(o, c("o_orderpriority").isin("1-URGENT", "2-HIGH"), c("o_orderstatus") == "P")
    f = f.where((c("o_custkey") != c("o_orderkey")) & c("o_orderdate").isNotNull())
    out = f.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count(F.when(c("o_orderpriority").like("1-%"), 1)).alias("n_like"))
    return top(out, None, "o_orderstatus", "o_orderpriority")


# Implicit and explicit inner joins, fact-to-fact join, GROUP BY
@_entry("r10_r28_revenue_by_nation", f"""
SELECT r_name, n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))))
       AS DOUBLE) AS revenue, count(*) AS n_lines
FROM lineitem, orders, customer, nation JOIN region ON n_regionkey = r_regionkey
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
GROUP BY r_name, n_name
{ob("r_name, n_name", "revenue, n_lines", None)}
""")
def r10_revenue_by_nation(spark, sf_dir):
    li, o = _src(spark, sf_dir, "lineitem"), _src(spark, sf_dir, "orders")
    cu, n, r = _src(spark, sf_dir, "customer"), _src(spark, sf_dir, "nation"), _src(spark, sf_dir, "region")
    j = (li.join(o, c("l_orderkey") == c("o_orderkey")).join(cu, c("o_custkey") == c("c_custkey"))
         .join(n, c("c_nationkey") == c("n_nationkey")).join(r, c("n_regionkey") == c("r_regionkey")))
    out = j.groupBy("r_name", "n_name").agg(
        dbl(F.sum(dec("l_extendedprice") * (1 - dec("l_discount")))).alias("revenue"),
        F.count(F.lit(1)).alias("n_lines"))
    return top(out, None, "r_name", "n_name")


# Left outer join, COALESCE
@_entry("r12_f03_unsold_parts_by_brand", f"""
SELECT p_brand, count(*) AS n_parts, count(CASE WHEN q IS NULL THEN 1 END) AS n_unsold,
       CAST(sum(coalesce(q, 0)) AS BIGINT) AS qty
FROM part LEFT JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem
                     WHERE l_returnflag = 'R' GROUP BY l_partkey) s ON p_partkey = s.l_partkey
GROUP BY p_brand
{ob("p_brand", "n_parts, n_unsold, qty", None)}
""")
def r12_unsold_parts(spark, sf_dir):
    p, li = _src(spark, sf_dir, "part"), _src(spark, sf_dir, "lineitem")
    s = (li.where(c("l_returnflag") == "R").groupBy("l_partkey")
         .agg(F.sum("l_quantity").cast("long").alias("q")))
    j = p.join(s, c("p_partkey") == c("l_partkey"), "left")
    out = j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts"),
                                   F.count(F.when(c("q").isNull(), 1)).alias("n_unsold"),
                                   F.sum(F.coalesce("q", F.lit(0))).cast("long").alias("qty"))
    return top(out, None, "p_brand")


# Full outer join (NULL keys never match)
@_entry("r13_rich_customers_vs_poor_suppliers", f"""
SELECT coalesce(a.k, b.k) AS nationkey, a.n_customers, b.n_suppliers
FROM (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey) a
FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier WHERE s_acctbal < 0
                 GROUP BY s_nationkey) b ON a.k = b.k
{ob("nationkey", "n_customers, n_suppliers", None)}
""")
def r13_full_join(spark, sf_dir):
    a = (_src(spark, sf_dir, "customer").where(c("c_acctbal") > 9000)
         .groupBy(c("c_nationkey").alias("ka")).agg(F.count(F.lit(1)).alias("n_customers")))
    b = (_src(spark, sf_dir, "supplier").where(c("s_acctbal") < 0)
         .groupBy(c("s_nationkey").alias("kb")).agg(F.count(F.lit(1)).alias("n_suppliers")))
    out = a.join(b, c("ka") == c("kb"), "full").select(F.coalesce("ka", "kb").alias("nationkey"),
                                                        "n_customers", "n_suppliers")
    return top(out, None, "nationkey")


# Keyless cross join with an uncorrelated scalar, global aggregate
@_entry("r14_r25_segment_share", f"""
SELECT c_mktsegment, n, n * 100.0 / total AS pct
FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment) s,
     (SELECT count(*) AS total FROM customer) t
{ob("c_mktsegment", "n, pct", None)}
""")
def r14_segment_share(spark, sf_dir):
    cu = _src(spark, sf_dir, "customer")
    per = cu.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    total = R.scalar(cu.agg(F.count(F.lit(1)).alias("total")), "total")
    out = R.cross_join(per, total).select("c_mktsegment", "n", (c("n") * 100.0 / c("total")).alias("pct"))
    return top(out, None, "c_mktsegment")


# Self join on a shifted key, guarded ratio
@_entry("r15_f02_yearly_growth", f"""
WITH y AS (SELECT CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER) AS yr,
                  sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
           FROM orders GROUP BY year(CAST(o_orderdate AS DATE)))
SELECT a.yr AS yr1, b.yr AS yr2, CAST(a.total AS DOUBLE) AS total1, CAST(b.total AS DOUBLE) AS total2,
       CASE WHEN a.total > 0 THEN CAST(b.total AS DOUBLE) / CAST(a.total AS DOUBLE) END AS growth
FROM y a JOIN y b ON b.yr = a.yr + 1
{ob("yr1", "yr2, total1, total2, growth", None)}
""")
def r15_yearly_growth(spark, sf_dir):
    o = _src(spark, sf_dir, "orders")
    y = o.groupBy(F.year(_day("o_orderdate")).alias("yr")).agg(F.sum(dec("o_totalprice")).alias("total"))
    j = R.self_join(y, [], "yr", 1)
    out = j.select("yr1", "yr2", dbl("total1").alias("total1"), dbl("total2").alias("total2"),
                   safe_div(c("total2"), c("total1")).alias("growth"))
    return top(out, None, "yr1")


# Equi join with a theta residual, date + n days
@_entry("r17_f08_late_shipments", f"""
SELECT o_orderpriority, count(*) AS n_late
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 AND CAST(l_shipdate AS DATE) > CAST(o_orderdate AS DATE) + 100
GROUP BY o_orderpriority
{ob("o_orderpriority", "n_late", None)}
""")
def r17_late_shipments(spark, sf_dir):
    li, o = _src(spark, sf_dir, "lineitem"), _src(spark, sf_dir, "orders")
    j = li.join(o, (c("l_orderkey") == c("o_orderkey")) & (_day("l_shipdate") > F.date_add(_day("o_orderdate"), 100)))
    return top(j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_late")), None, "o_orderpriority")


# Role-playing dimension (nation as customer nation and supplier nation)
@_entry("r18_cross_region_lines", f"""
SELECT cn.n_regionkey AS cust_region, sn.n_regionkey AS supp_region, count(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey
WHERE cn.n_regionkey <> sn.n_regionkey
GROUP BY cn.n_regionkey, sn.n_regionkey
{ob("cust_region, supp_region", "n_lines", None)}
""")
def r18_cross_region(spark, sf_dir):
    n = _src(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cn, sn = R.role(n, "cn"), R.role(n, "sn")
    j = (_src(spark, sf_dir, "lineitem").join(_src(spark, sf_dir, "orders"), c("l_orderkey") == c("o_orderkey"))
         .join(_src(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
         .join(_src(spark, sf_dir, "supplier"), c("l_suppkey") == c("s_suppkey"))
         .join(cn, c("c_nationkey") == c("cn_n_nationkey")).join(sn, c("s_nationkey") == c("sn_n_nationkey"))
         .where(c("cn_n_regionkey") != c("sn_n_regionkey")))
    out = j.groupBy(c("cn_n_regionkey").alias("cust_region"), c("sn_n_regionkey").alias("supp_region")) \
        .agg(F.count(F.lit(1)).alias("n_lines"))
    return top(out, None, "cust_region", "supp_region")


# EXISTS / NOT EXISTS as semi and anti joins
@_entry("r19_r20_customers_with_without_orders", f"""
SELECT c_mktsegment,
       count(CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
                  THEN 1 END) AS with_orders,
       count(CASE WHEN NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
                  THEN 1 END) AS without_orders
FROM customer
GROUP BY c_mktsegment
{ob("c_mktsegment", "with_orders, without_orders", None)}
""")
def r19_semi_anti(spark, sf_dir):
    cu = _src(spark, sf_dir, "customer")
    o = _src(spark, sf_dir, "orders").where(c("o_orderstatus") == "F").select("o_custkey")
    w = R.semi_join(cu, o, c("c_custkey") == c("o_custkey")).groupBy("c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("with_orders"))
    wo = R.anti_join(cu, o, c("c_custkey") == c("o_custkey")).groupBy(c("c_mktsegment").alias("seg")) \
        .agg(F.count(F.lit(1)).alias("without_orders"))
    segs = cu.select("c_mktsegment").distinct()
    out = (segs.join(w, "c_mktsegment", "left").join(wo, c("c_mktsegment") == c("seg"), "left")
           .select("c_mktsegment", F.coalesce("with_orders", F.lit(0)).alias("with_orders"),
                   F.coalesce("without_orders", F.lit(0)).alias("without_orders")))
    return top(out, None, "c_mktsegment")


# EXISTS under OR
@_entry("r21_urgent_or_returning_customers", f"""
SELECT c_mktsegment, count(*) AS n
FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
   OR EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
              WHERE o_custkey = c_custkey AND l_returnflag = 'R' AND l_quantity = 50)
GROUP BY c_mktsegment
{ob("c_mktsegment", "n", None)}
""")
def r21_exists_any(spark, sf_dir):
    o = _src(spark, sf_dir, "orders")
    urgent = o.where(c("o_orderpriority") == "1-URGENT").select("o_custkey")
    returned = (o.join(_src(spark, sf_dir, "lineitem").where((c("l_returnflag") == "R") & (c("l_quantity") == 50)),
                       c("l_orderkey") == c("o_orderkey")).select("o_custkey"))
    cu = R.exists_any(_src(spark, sf_dir, "customer"), "c_custkey", urgent, returned)
    return top(cu.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), None, "c_mktsegment")


# IN (subquery), and IN (subquery) under OR
@_entry("r22_r23_big_or_returned_parts", f"""
SELECT p_brand, count(*) AS n
FROM part
WHERE p_size > 45 OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)
GROUP BY p_brand
{ob("p_brand", "n", None)}
""")
def r22_in_or(spark, sf_dir):
    returned = _src(spark, sf_dir, "lineitem").where((c("l_returnflag") == "R") & (c("l_quantity") > 49))
    p = R.in_or(_src(spark, sf_dir, "part"), c("p_size") > 45, "p_partkey", returned, "l_partkey")
    return top(p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), None, "p_brand")


# Correlated group average (decorrelated), cast to decimal
@_entry("r24_f04_parts_above_type_average", f"""
SELECT p_partkey, p_type, CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS DOUBLE) AS price
FROM part p1
WHERE CAST(p_retailprice AS DECIMAL(15,2)) > 1.05 * (SELECT avg(CAST(p_retailprice AS DECIMAL(15,2)))
                                                   FROM part p2 WHERE p2.p_type = p1.p_type)
{ob("p_partkey", "p_type, price", None)}
""")
def r24_group_avg(spark, sf_dir):
    p = _src(spark, sf_dir, "part").select("p_partkey", "p_type", dec("p_retailprice").alias("pr"))
    out = R.compare_to_group_avg(p, "p_type", "pr", 21, 20).select("p_partkey", "p_type", dbl("pr").alias("price"))
    return top(out, None, "p_partkey")


# CTE reused, derived table, HAVING, aggregate of aggregates
@_entry("r30_r35_heavy_customers", """
WITH per_cust AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
                  FROM orders GROUP BY o_custkey HAVING count(*) > 12)
SELECT count(*) AS n_customers, CAST(max(total) AS DOUBLE) AS max_total,
       CAST(sum(n) AS DOUBLE) / count(n) AS avg_orders,
       (SELECT count(*) FROM per_cust WHERE total > 2000000) AS n_big
FROM (SELECT * FROM per_cust) d
""")
def r30_heavy_customers(spark, sf_dir):
    per = (_src(spark, sf_dir, "orders").groupBy("o_custkey")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(dec("o_totalprice")).alias("total")).where(c("n") > 12))
    return per.agg(F.count(F.lit(1)).alias("n_customers"), dbl(F.max("total")).alias("max_total"),
                   (dbl(F.sum("n")) / F.count("n")).alias("avg_orders"),
                   F.count(F.when(c("total") > 2000000, 1)).alias("n_big"))


# DISTINCT and group-only
@_entry("r31_r32_status_priority_pairs", f"""
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders
{ob("o_orderstatus, o_orderpriority", "o_orderstatus", None)}
""")
def r31_distinct(spark, sf_dir):
    o = _src(spark, sf_dir, "orders")
    return top(o.select("o_orderstatus", "o_orderpriority").distinct(), None, "o_orderstatus", "o_orderpriority")


# ROLLUP with GROUPING
@_entry("r33_r34_flag_status_rollup", f"""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS n,
       CAST(grouping(l_returnflag) AS BIGINT) AS g_flag, CAST(grouping(l_linestatus) AS BIGINT) AS g_status
FROM lineitem
GROUP BY ROLLUP (l_returnflag, l_linestatus)
{ob("l_returnflag, l_linestatus", "qty, n, g_flag, g_status", None)}
""")
def r33_rollup(spark, sf_dir):
    li = _src(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus",
                                               c("l_quantity").cast("long").alias("qty"), F.lit(1).alias("n"))
    out = R.rollup_agg(li, ["l_returnflag", "l_linestatus"], ["qty", "n"]) \
        .select("l_returnflag", "l_linestatus", "qty", c("n").cast("long").alias("n"),
                c("g_l_returnflag").alias("g_flag"), c("g_l_linestatus").alias("g_status"))
    return top(out, None, "l_returnflag", "l_linestatus")


_PRIOS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


# Conditional pivot
@_entry("r36_priority_pivot_by_nation", f"""
SELECT n_name, {", ".join(f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(15,2)) END) AS DOUBLE) AS p{i}" for i, p in enumerate(_PRIOS, 1))}
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
{ob("n_name", "p1", None)}
""")
def r36_pivot(spark, sf_dir):
    j = (_src(spark, sf_dir, "orders").join(_src(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
         .join(_src(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"))
         .withColumn("amt", dec("o_totalprice")))
    p = R.pivot_sum(j, "n_name", "o_orderpriority", _PRIOS, "amt", [f"p{i}" for i in range(1, 6)])
    return top(p.select("n_name", *[dbl(f"p{i}").alias(f"p{i}") for i in range(1, 6)]), None, "n_name")


# Window aggregate over a grouped result
@_entry("r37_segment_share_in_nation", f"""
SELECT c_nationkey, c_mktsegment, CAST(bal AS DOUBLE) AS bal,
       CAST(bal AS DOUBLE) * 100 / CAST(sum(bal) OVER (PARTITION BY c_nationkey) AS DOUBLE) AS share
FROM (SELECT c_nationkey, c_mktsegment, sum(CAST(c_acctbal AS DECIMAL(15,2))) AS bal FROM customer
      GROUP BY c_nationkey, c_mktsegment) g
{ob("c_nationkey, c_mktsegment", "bal, share", None)}
""")
def r37_share(spark, sf_dir):
    g = _src(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.sum(dec("c_acctbal")).alias("b"))
    out = R.share_of(g, "c_nationkey", "b").select("c_nationkey", "c_mktsegment", dbl("b").alias("bal"), "share")
    return top(out, None, "c_nationkey", "c_mktsegment")


# Rank and top-n per group
@_entry("r38_r40_top_customers_per_nation", f"""
SELECT * FROM (
  SELECT c_nationkey, c_custkey, CAST(total AS DOUBLE) AS total,
         CAST(rank() OVER (PARTITION BY c_nationkey ORDER BY total DESC) AS BIGINT) AS rk
  FROM (SELECT c_nationkey, c_custkey, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, c_custkey) g) r
WHERE rk <= 3
{ob("c_nationkey, rk, c_custkey", "total", None)}
""")
def r38_top_customers(spark, sf_dir):
    g = (_src(spark, sf_dir, "orders").join(_src(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
         .groupBy("c_nationkey", "c_custkey").agg(F.sum(dec("o_totalprice")).alias("t")))
    out = R.top_n_per_group(g, "c_nationkey", c("t").desc_nulls_last(), 3)
    return top(out.select("c_nationkey", "c_custkey", dbl("t").alias("total"), c("rk").cast("long").alias("rk")),
               None, "c_nationkey", "rk", "c_custkey")


# Running frame
@_entry("r39_running_monthly_revenue", f"""
SELECT yr, mo, CAST(total AS DOUBLE) AS total,
       CAST(sum(total) OVER (PARTITION BY yr ORDER BY mo ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS running
FROM (SELECT CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER) AS yr,
             CAST(month(CAST(o_orderdate AS DATE)) AS INTEGER) AS mo,
             sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
      FROM orders GROUP BY 1, 2) m
{ob("yr, mo", "total, running", None)}
""")
def r39_running(spark, sf_dir):
    o = _src(spark, sf_dir, "orders")
    m = o.groupBy(F.year(_day("o_orderdate")).alias("yr"), F.month(_day("o_orderdate")).alias("mo")) \
        .agg(F.sum(dec("o_totalprice")).alias("t"))
    out = R.running(m, "yr", "mo", "t").select("yr", "mo", dbl("t").alias("total"), dbl("running").alias("running"))
    return top(out, None, "yr", "mo")


# Neighbouring periods
@_entry("r41_neighbour_months", f"""
WITH m AS (SELECT o_orderpriority,
                  CAST(year(CAST(o_orderdate AS DATE)) * 12 + month(CAST(o_orderdate AS DATE)) AS INTEGER) AS ym,
                  count(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY ym) AS rn FROM m)
SELECT a.o_orderpriority, a.ym, a.n, p.n AS psum, x.n AS nsum
FROM r a JOIN r p ON a.o_orderpriority = p.o_orderpriority AND a.rn = p.rn + 1
JOIN r x ON a.o_orderpriority = x.o_orderpriority AND a.rn = x.rn - 1
{ob("o_orderpriority, ym", "n, psum, nsum", None)}
""")
def r41_neighbours(spark, sf_dir):
    o = _src(spark, sf_dir, "orders")
    m = o.groupBy("o_orderpriority", (F.year(_day("o_orderdate")) * 12 + F.month(_day("o_orderdate"))).alias("ym")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return top(R.neighbours(m, "o_orderpriority", "ym", "n"), None, "o_orderpriority", "ym")


# ORDER BY ordinal
@_entry("r43_nations_by_customers", """
SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey ORDER BY 2 DESC, 1 LIMIT 10
""")
def r43_ordinal(spark, sf_dir):
    g = _src(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    # ORDER BY 2 DESC, 1: positions resolved to the output columns
    second, first = g.columns[1], g.columns[0]
    return top(g, 10, "-" + second, first)


# UNION ALL with channel tags, UNION
@_entry("r45_r46_r49_people_by_nation", f"""
SELECT channel, count(*) AS n_rows, count(DISTINCT k) AS n_keys FROM (
  SELECT 'customer' AS channel, c_nationkey AS k FROM customer
  UNION ALL SELECT 'supplier', s_nationkey FROM supplier) u GROUP BY channel
UNION ALL
SELECT 'both distinct', count(*), count(*) FROM (
  SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) d
{ob("channel", "n_rows, n_keys", None)}
""")
def r45_unions(spark, sf_dir):
    cu = R.tag_channel(_src(spark, sf_dir, "customer").select(c("c_nationkey").alias("k")), "customer")
    su = R.tag_channel(_src(spark, sf_dir, "supplier").select(c("s_nationkey").alias("k")), "supplier")
    per = R.union_all([cu, su]).groupBy("channel").agg(F.count(F.lit(1)).alias("n_rows"),
                                                       F.countDistinct("k").alias("n_keys"))
    d = R.union_distinct([cu.select("k"), su.select("k")]).agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.lit("both distinct").alias("channel"), "n_rows", c("n_rows").alias("n_keys"))
    return top(per.unionByName(d), None, "channel")


# INTERSECT and EXCEPT (NULLs equal)
@_entry("r47_r48_nation_sets", f"""
SELECT 'intersect' AS op, k FROM (
  SELECT c_nationkey AS k FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 9900
  INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) i
UNION ALL
SELECT 'except', k FROM (
  SELECT c_nationkey AS k FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 9900
  EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) e
{ob("op, k", "k", None)}
""")
def r47_sets(spark, sf_dir):
    a = (_src(spark, sf_dir, "customer").where((c("c_mktsegment") == "AUTOMOBILE") & (c("c_acctbal") > 9900))
         .select(c("c_nationkey").alias("k")))
    b = _src(spark, sf_dir, "supplier").where(c("s_acctbal") > 5000).select(c("s_nationkey").alias("k"))
    out = (R.intersect(a, b).select(F.lit("intersect").alias("op"), "k")
           .unionByName(R.except_(a, b).select(F.lit("except").alias("op"), "k")))
    return top(out, None, "op", "k")


# Join keys repeated in every OR branch, factored into one equi join
@_entry("r50_factored_or_join", """
SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DOUBLE)
       AS revenue
FROM lineitem, part
WHERE (p_partkey = l_partkey AND p_brand IN ('Brand#1', 'Brand#2') AND l_quantity BETWEEN 1 AND 11
       AND p_size BETWEEN 1 AND 5)
   OR (p_partkey = l_partkey AND p_brand IN ('Brand#12', 'Brand#13') AND l_quantity BETWEEN 10 AND 20
       AND p_size BETWEEN 1 AND 10)
   OR (p_partkey = l_partkey AND p_brand IN ('Brand#23', 'Brand#24') AND l_quantity BETWEEN 20 AND 30
       AND p_size BETWEEN 1 AND 15)
""")
def r50_factored(spark, sf_dir):
    li, p = _src(spark, sf_dir, "lineitem"), _src(spark, sf_dir, "part")
    q, s, b = c("l_quantity"), c("p_size"), c("p_brand")
    branches = ((b.isin("Brand#1", "Brand#2") & q.between(1, 11) & s.between(1, 5))
                | (b.isin("Brand#12", "Brand#13") & q.between(10, 20) & s.between(1, 10))
                | (b.isin("Brand#23", "Brand#24") & q.between(20, 30) & s.between(1, 15)))
    j = li.join(p, c("l_partkey") == c("p_partkey")).where(branches)
    return j.agg(dbl(F.sum(dec("l_extendedprice") * (1 - dec("l_discount")))).alias("revenue"))


# CASE, guarded ratio, substr, concat,
# upper, abs, arithmetic, literal columns, quoted output names
@_entry("f01_f26_customer_expressions", f"""
SELECT c_custkey,
       CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
       CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS seg_code,
       substr(c_name, 10, 9) AS name_tail, upper(c_mktsegment) || '/' || c_name AS label,
       CAST(abs(CAST(c_acctbal AS DECIMAL(15,2))) AS DOUBLE) AS abs_bal,
       CAST(CAST(c_acctbal AS DECIMAL(15,2)) * 2 - 100 AS DOUBLE) AS arith,
       CASE WHEN c_nationkey > 0 THEN CAST(c_custkey AS DOUBLE) / c_nationkey END AS ratio,
       'cust' AS kind, 7 AS seven, c_nationkey + 1 AS "nation #"
FROM customer
{ob("c_custkey", "band", None)}
""")
def f01_expressions(spark, sf_dir):
    cu = _src(spark, sf_dir, "customer")
    bal = dec("c_acctbal")
    out = cu.select(
        "c_custkey",
        F.when(c("c_acctbal") < 0, "debt").when(c("c_acctbal") < 5000, "low").otherwise("high").alias("band"),
        F.when(c("c_mktsegment") == "BUILDING", 1).when(c("c_mktsegment") == "MACHINERY", 2).otherwise(0)
        .alias("seg_code"),
        F.substring("c_name", 10, 9).alias("name_tail"),
        F.concat(F.upper("c_mktsegment"), F.lit("/"), c("c_name")).alias("label"),
        dbl(F.abs(bal)).alias("abs_bal"), dbl(bal * 2 - 100).alias("arith"),
        safe_div(c("c_custkey"), c("c_nationkey")).alias("ratio"),
        F.lit("cust").alias("kind"), F.lit(7).alias("seven"), (c("c_nationkey") + 1).alias("nation #"))
    return top(out, None, "c_custkey")


# Casts to date (also from an unpadded string), date + int, day lags
@_entry("f05_f10_shipping_lag_buckets", f"""
SELECT o_orderpriority,
       count(CASE WHEN CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) <= 30 THEN 1 END) AS lag_30,
       count(CASE WHEN CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) > 30 THEN 1 END) AS lag_more,
       count(CASE WHEN CAST(o_orderdate AS DATE) >= CAST('1997-1-01' AS DATE) THEN 1 END) AS since_1997,
       count(CASE WHEN CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) + 10 THEN 1 END) AS within_10
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderpriority
{ob("o_orderpriority", "lag_30", None)}
""")
def f05_dates(spark, sf_dir):
    j = _src(spark, sf_dir, "lineitem").join(_src(spark, sf_dir, "orders"), c("l_orderkey") == c("o_orderkey"))
    lag = F.datediff(_day("l_shipdate"), _day("o_orderdate"))
    out = j.groupBy("o_orderpriority").agg(
        F.count(F.when(lag <= 30, 1)).alias("lag_30"), F.count(F.when(lag > 30, 1)).alias("lag_more"),
        F.count(F.when(_day("o_orderdate") >= F.lit("1997-1-01").cast("date"), 1)).alias("since_1997"),
        F.count(F.when(_day("l_shipdate") < F.date_add(_day("o_orderdate"), 10), 1)).alias("within_10"))
    return top(out, None, "o_orderpriority")


# Cast to int with rounding, round to 2 places
@_entry("f06_f14_spend_segments", f"""
SELECT segment, count(*) AS n, CAST(round(CAST(avg_spend AS DECIMAL(18,4)), 2) AS DOUBLE) AS avg_rounded
FROM (SELECT CAST(CAST(total AS DOUBLE) / 100000 AS INTEGER) AS segment, total,
             CAST(sum(total) OVER (PARTITION BY CAST(CAST(total AS DOUBLE) / 100000 AS INTEGER)) AS DOUBLE)
               / count(total) OVER (PARTITION BY CAST(CAST(total AS DOUBLE) / 100000 AS INTEGER)) AS avg_spend
      FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total FROM orders GROUP BY o_custkey) t) s
GROUP BY segment, avg_spend
{ob("segment", "n, avg_rounded", None)}
""")
def f06_segments(spark, sf_dir):
    t = _src(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(dec("o_totalprice")).alias("total"))
    # cast(x as int) rounds half to even in the reference engine: rint first
    s = t.withColumn("segment", F.rint(dbl("total") / 100000).cast("int"))
    out = s.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), (F.sum("total").cast("double") / F.count("total")).alias("avg_spend")) \
        .select("segment", "n", dbl(F.round(c("avg_spend").cast("decimal(18,4)"), 2)).alias("avg_rounded"))
    return top(out, None, "segment")


# SUM, AVG, COUNT(*), COUNT(col), COUNT(DISTINCT), MAX, STDDEV_SAMP, coefficient of variation
@_entry("f17_f24_aggregates_by_flag", f"""
SELECT l_returnflag,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS sum_price,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(l_quantity) AS avg_qty,
       count(*) AS n, count(l_tax) AS n_tax, count(DISTINCT l_suppkey) AS n_suppliers,
       max(l_quantity) AS max_qty, round(stddev_samp(l_quantity), 6) AS sd_qty,
       round(stddev_samp(l_quantity) / avg(l_quantity), 6) AS cov_qty
FROM lineitem GROUP BY l_returnflag
{ob("l_returnflag", "n", None)}
""")
def f17_aggregates(spark, sf_dir):
    li = _src(spark, sf_dir, "lineitem")
    out = li.groupBy("l_returnflag").agg(
        dbl(F.sum(dec("l_extendedprice"))).alias("sum_price"),
        (dbl(F.sum(c("l_quantity").cast("long"))) / F.count("l_quantity")).alias("avg_qty"),
        F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("n_tax"),
        F.countDistinct("l_suppkey").alias("n_suppliers"), F.max("l_quantity").alias("max_qty"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("sd_qty"),
        F.round(nz_div(F.stddev_samp("l_quantity"), F.avg("l_quantity")), 6).alias("cov_qty"))
    return top(out, None, "l_returnflag")


# --------------------------------------------------------------------------
# Data tests over the mart; S1 S2: the loader on mart data
# --------------------------------------------------------------------------
_SOURCE_COUNTS = {  # mart table -> count query over the driver tables
    "store_sales": "SELECT count(*) FROM src_lineitem l JOIN src_orders o ON l.l_orderkey = o.o_orderkey",
    "catalog_sales": "SELECT count(*) FROM src_lineitem l JOIN src_orders o ON l.l_orderkey = o.o_orderkey "
                     "WHERE l.l_linestatus = 'F'",
    "web_sales": "SELECT count(*) FROM src_lineitem l JOIN src_orders o ON l.l_orderkey = o.o_orderkey "
                 "WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "store_returns": "SELECT count(*) FROM src_lineitem l JOIN src_orders o ON l.l_orderkey = o.o_orderkey "
                     "WHERE l.l_returnflag = 'R'",
    "item": "SELECT count(*) FROM src_part",
    "customer": "SELECT count(*) FROM src_customer",
    "customer_address": "SELECT count(*) FROM src_customer",
    "store": "SELECT count(*) FROM src_nation",
    "warehouse": "SELECT count(*) FROM src_region",
    "date_dim": f"SELECT {M.CAL_DAYS}",
    "time_dim": "SELECT 86400",
    "inventory": f"SELECT {M.INVENTORY_WEEKS} * count(*) FROM src_lineitem l JOIN src_orders o "
                 "ON l.l_orderkey = o.o_orderkey",
}


def _t1_sql() -> str:
    parts = [f"SELECT '{t}' AS table_name, CAST(({q}) AS BIGINT) AS expected_rows, "
             f"(SELECT count(*) FROM {t}) AS actual_rows" for t, q in sorted(_SOURCE_COUNTS.items())]
    return "\nUNION ALL\n".join(parts)


@_entry("t1_mart_row_counts", _t1_sql(), mart_sql=True)
def t1_row_counts(spark, sf_dir):
    mart = Mart(spark, sf_dir)
    mart.table("store_sales")  # registers the source views
    checks = {}
    for t, q in _SOURCE_COUNTS.items():
        expected = spark.sql(q.replace("src_lineitem", mart.names["src_lineitem"])
                             .replace("src_orders", mart.names["src_orders"])
                             .replace("src_part", mart.names["src_part"])
                             .replace("src_customer", mart.names["src_customer"])
                             .replace("src_nation", mart.names["src_nation"])
                             .replace("src_region", mart.names["src_region"]))
        checks[t] = (mart.table(t), expected)
    return T.row_count_report(checks)


_UNIQUE = {"date_dim": "d_date_sk", "time_dim": "t_time_sk", "item": "i_item_sk", "customer": "c_customer_sk",
           "customer_address": "ca_address_sk", "customer_demographics": "cd_demo_sk",
           "household_demographics": "hd_demo_sk", "store": "s_store_sk", "warehouse": "w_warehouse_sk",
           "promotion": "p_promo_sk", "reason": "r_reason_sk", "call_center": "cc_call_center_sk",
           "web_site": "web_site_sk", "web_page": "wp_web_page_sk", "ship_mode": "sm_ship_mode_sk",
           "income_band": "ib_income_band_sk", "catalog_page": "cp_catalog_page_sk"}


@_entry("t2_mart_unique_keys", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS duplicate_keys FROM "
    f"(SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1) d" for t, k in sorted(_UNIQUE.items())),
    mart_sql=True)
def t2_unique_keys(spark, sf_dir):
    mart = Mart(spark, sf_dir)
    parts = [T.expect_unique(mart.table(t), k).agg(F.count(F.lit(1)).alias("duplicate_keys"))
             .select(F.lit(t).alias("table_name"), "duplicate_keys") for t, k in sorted(_UNIQUE.items())]
    return R.union_all(parts)


def _raw_dir(spark: SparkSession, sf_dir: str) -> str:
    # the shared folder the cluster names in spark.checkpoint.dir (a scratch
    # folder is set only when the session has none)
    from ..session import ensure_checkpoint_dir

    return os.path.join(ensure_checkpoint_dir(spark), "raw-" + Mart(spark, sf_dir).suffix)


def _compared(table: str) -> list[tuple[str, str]]:
    """The raw table's columns that the mart has, with their types."""
    have = set(re.findall(r"AS (\w+)", M.table_sql(table, M.SPARK, {"mart_base": "mart_base"})))
    return [(n, t) for n, t in catalog.columns(table) if n in have]


def _raw_sql(table: str) -> str:
    return "SELECT " + ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if t.startswith("DECIMAL") else n for n, t in _compared(table)) + f" FROM {table}"


def _raw_columns(df, table: str):
    return df.select(*[dbl(n).alias(n) if t.startswith("DECIMAL") else F.col(n) for n, t in _compared(table)])


@_entry("s1_raw_store_sales_roundtrip", _raw_sql("store_sales"), mart_sql=True)
def s1_roundtrip(spark, sf_dir):
    """store_sales written as a raw pipe-delimited extract and bulk-loaded back, all columns; the extract is written when the query is called."""
    path = loader.dat_path(_raw_dir(spark, sf_dir), "store_sales")
    loader.write_dat(Mart(spark, sf_dir).store_sales, "store_sales", path)
    return _raw_columns(loader.load_dat(spark, path, "store_sales"), "store_sales")


@_entry("s2_raw_gzip_returns_roundtrip", _raw_sql("store_returns"), mart_sql=True)
def s2_roundtrip(spark, sf_dir):
    """store_returns as a gzipped extract, read by position and cast, all columns; the extract is written when the query is called."""
    path = loader.dat_path(_raw_dir(spark, sf_dir), "store_returns", compressed=True)
    loader.write_dat(Mart(spark, sf_dir).store_returns, "store_returns", path, compressed=True)
    return _raw_columns(loader.load_dat(spark, path, "store_returns", cast=True), "store_returns")


@_entry("s2_raw_reject_channel", "SELECT CASE WHEN wr_return_quantity % 5 = 0 THEN 'wr_return_quantity: many' WHEN wr_return_quantity % 7 = 0 THEN '26 fields' END AS reason, "
        "COUNT(*) AS n, CAST(SUM(wr_order_number) AS BIGINT) AS orders FROM web_returns GROUP BY 1", mart_sql=True)
def s2_rejects(spark, sf_dir):
    """web_returns as raw lines, some with a word for a quantity and some with a field too many: every line is either loaded or rejected with its reason."""
    q = F.col("wr_return_quantity")
    lines = loader.to_lines(Mart(spark, sf_dir).web_returns, "web_returns").select(
        "wr_order_number", F.when(q % 5 == 0, F.regexp_replace("value", r"^((?:[^|]*\|){14})[^|]*", "$1many"))
        .when(q % 7 == 0, F.concat("value", F.lit("|"))).otherwise(F.col("value")).alias("value"))
    parsed = loader.parse_lines(lines, "web_returns")
    order = F.get(F.split("_line", r"\|"), F.lit(13)).cast("long")
    return parsed.groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum(order).alias("orders"))


_CATALOG_TABLES = ("store", "warehouse", "store_returns")


@_entry("s5_catalog_load_twice", " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in _CATALOG_TABLES), mart_sql=True)
def s5_catalog_load(spark, sf_dir):
    """Raw extracts loaded twice into catalog tables, which are made if absent; counts read from the catalog.  The loads run when the query is called."""
    raw, mart = _raw_dir(spark, sf_dir), Mart(spark, sf_dir)
    database = "starloom_" + mart.suffix
    for t in _CATALOG_TABLES:
        loader.write_dat(mart.table(t), t, loader.dat_path(raw, t))
    for _ in range(2):
        names = loader.load_tables(spark, raw, database, _CATALOG_TABLES, location=raw + "-tables")
    counts = [spark.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for n, t in zip(names, _CATALOG_TABLES)]
    return reduce(lambda a, b: a.unionByName(b), counts)


_PRESENT, _ABSENT = ("store", "web_returns"), ("call_center", "ship_mode")


@_entry("s3_preflight", " UNION ALL ".join([f"SELECT '{t}' AS table_name, FALSE AS missing, COUNT(*) AS n FROM {t}" for t in _PRESENT]
                                           + [f"SELECT '{t}', TRUE, 0" for t in _ABSENT]), mart_sql=True)
def s3_preflight(spark, sf_dir):
    """Which raw extracts are missing, found before anything is read, and the rows loaded from those that are there; two of
    the four are written when the query is called."""
    raw, mart = _raw_dir(spark, sf_dir) + "-preflight", Mart(spark, sf_dir)
    for t in _PRESENT:
        loader.write_dat(mart.table(t), t, loader.dat_path(raw, t))
    missing = loader.missing_inputs(spark, raw, _PRESENT + _ABSENT)
    rows = [loader.load_dat(spark, loader.dat_path(raw, t), t).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(t).alias("table_name"), F.lit(False).alias("missing"), "n") for t in _PRESENT if t not in missing]
    gone = spark.createDataFrame([(t, True, 0) for t in missing], "table_name string, missing boolean, n long")
    return R.union_all([*rows, gone])


@_entry("s4_overwrite_twice", "SELECT wr_reason_sk, COUNT(*) AS n, CAST(SUM(wr_return_amt) AS DOUBLE) AS amount FROM web_returns GROUP BY wr_reason_sk", mart_sql=True)
def s4_overwrite(spark, sf_dir):
    """web_returns written over its own earlier copy, the first of other rows: the table holds one copy of the last rows.  The
    writes run when the query is called."""
    mart, path = Mart(spark, sf_dir), os.path.join(_raw_dir(spark, sf_dir) + "-overwrite", "web_returns")
    for rows in (mart.web_returns.where("wr_return_quantity > 5"), mart.web_returns, mart.web_returns):
        loader.write_table(rows, path)
    return spark.read.parquet(path).groupBy("wr_reason_sk").agg(F.count(F.lit(1)).alias("n"), dbl(F.sum("wr_return_amt")).alias("amount"))


# key columns of the audit: the catalog's, and the customer's own id, by which q04, q11 and q74 name a customer
_AUDIT_KEYS = {**{t: k for t, k in catalog.PRIMARY_KEYS.items() if t in M.MART_TABLES}, "customer_by_id": ("c_customer_id",)}
# literal counts of the tables whose size does not follow the input
_AUDIT_COUNTS = {"date_dim": M.CAL_DAYS, "time_dim": 86400}


def _audit_sql() -> str:
    parts = []
    for name, key in sorted(_AUDIT_KEYS.items()):
        table, cols = name.removesuffix("_by_id"), ", ".join(key)
        broken = " OR ".join(f"{k} IS NULL" for k in key)
        parts.append(f"SELECT '{name}' AS table_name, CAST({_AUDIT_COUNTS.get(name, 'NULL')} AS BIGINT) AS expected_rows, "
                     f"(SELECT COUNT(*) FROM {table}) AS actual_rows, (SELECT COUNT(*) FROM (SELECT {cols} FROM {table} "
                     f"WHERE NOT ({broken}) GROUP BY {cols} HAVING COUNT(*) > 1) d) AS duplicate_keys, "
                     f"(SELECT COUNT(*) FROM {table} WHERE {broken}) AS null_keys")
    return "\nUNION ALL\n".join(parts)


@_entry("t1_t2_audit", _audit_sql(), mart_sql=True)
def t1_t2_audit(spark, sf_dir):
    """Row count, repeated and NULL keys of every mart table, facts by their composite keys, one pass for each key (customer has two)."""
    mart = Mart(spark, sf_dir)
    return T.audit({name: mart.table(name.removesuffix("_by_id")) for name in _AUDIT_KEYS}, _AUDIT_KEYS, _AUDIT_COUNTS)


_SHARING = {"q03": "sum_agg", "q42": "total_sales", "q52": "ext_price", "q55": "ext_price"}


@_entry("s9_models_in_order", "\nUNION ALL\n".join(
    f"SELECT '{q}' AS model, COUNT(*) AS n, ROUND(SUM({v}), 2) AS total FROM ({ORACLE[q]}) m" for q, v in sorted(_SHARING.items())),
    mart_sql=True)
def s9_models(spark, sf_dir):
    """Four models written after the tables they share, each of these derived and written once; rows and sums read
    from the written models.  The writes run when the query is called."""
    frames = run_models(Mart(spark, sf_dir), sorted(_SHARING), _raw_dir(spark, sf_dir) + "-models")
    return R.union_all([frames[q].agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(v), 2).alias("total"))
                        .select(F.lit(q).alias("model"), "n", "total") for q, v in sorted(_SHARING.items())])


_STATE_SALES = ("SELECT s_state, d_year, COUNT(*) AS n, CAST(SUM(ss_net_paid) AS DOUBLE) AS paid FROM {0}store_sales JOIN {0}store ON ss_store_sk = s_store_sk "
                "JOIN {0}date_dim ON ss_sold_date_sk = d_date_sk WHERE ss_quantity > 10 GROUP BY s_state, d_year")


@_entry("s7_sql_over_views", _STATE_SALES.format(""), mart_sql=True)
def s7_views(spark, sf_dir):
    """SQL text over the registered views of the mart tables, which are derived when they are read."""
    mart = Mart(spark, sf_dir)
    prefix = f"v_{mart.suffix}_"
    mart.register_views(prefix)
    return spark.sql(_STATE_SALES.format(prefix))


@_entry("s6_parquet_scan", _STATE_SALES.format(""), mart_sql=True)
def s6_parquet(spark, sf_dir):
    """The same over tables loaded as parquet files, filter and columns pushed into the scan.  The files are written when the query is called."""
    mart, out, tables = Mart(spark, sf_dir), _raw_dir(spark, sf_dir) + "-parquet", ("store_sales", "store", "date_dim")
    for t in tables:
        loader.write_table(mart.table(t), os.path.join(out, t))
    t = loader.load_parquet(spark, out, tables)
    return (t["store_sales"].where("ss_quantity > 10").join(t["store"], c("ss_store_sk") == c("s_store_sk"))
            .join(t["date_dim"], c("ss_sold_date_sk") == c("d_date_sk")).groupBy("s_state", "d_year")
            .agg(F.count(F.lit(1)).alias("n"), dbl(F.sum("ss_net_paid")).alias("paid")))
