"""The retail mart: 24 star-schema tables derived from the driver tables.

The driver ships TPC-H-like tables (lineitem, orders, customer, part,
supplier, nation, region).  The analytical queries are written against a
retail star schema (store/catalog/web sales and returns, inventory and
17 dimensions), so this module derives that schema deterministically
from the driver tables:

* every lineitem row joined to its order is one sale line; the store
  channel holds all lines, the catalog channel the lines whose status
  is 'F', the web channel the lines of urgent / high-priority orders;
  returns are the lines flagged 'R' in each channel;
* inventory holds four weekly snapshots per sale line;
* item, customer and customer_address grow with part and customer;
  store comes from nation, warehouse from region;
* the small, fixed-size dimensions (calendar, clock, demographics,
  promotions, ...) are generated from a number range.

Each table is one SELECT in a portable SQL subset that Spark SQL and
DuckDB both accept; the few differences live in :class:`Dialect`.  Spark
runs it lazily over the parquet files (no data passes through the driver
and nothing is materialised unless :func:`starloom.sources.views.materialize_mart`
is called); the DuckDB oracle prepends the same text as CTEs.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from . import domains as D

CAL_START = _dt.date(1990, 1, 1)
CAL_DAYS = (_dt.date(2006, 1, 1) - CAL_START).days
# surrogate key of CAL_START; key 2415022 is 1900-01-02 as in the TPC-DS calendar
SK0 = 2415022 + (CAL_START - _dt.date(1900, 1, 2)).days
# order dates (1995-2001) move forward 518 days = 74 whole weeks, so sales
# fall between mid 1996 and early 2003 and weekdays stay aligned
DATE_SHIFT = 518
N_CDEMO = 39200
N_HDEMO = 7200
N_PROMO = 300
N_STORE = 25          # one per nation
N_WAREHOUSE = 5       # one per region
N_CALL_CENTER = 6
N_WEB_SITE = 30
N_WEB_PAGE = 60
N_SHIP_MODE = 20
N_REASON = 75
N_CATALOG_PAGE = 100
N_INCOME_BAND = 20
INVENTORY_WEEKS = 4

SOURCE_TABLES = ("lineitem", "orders", "customer", "part", "nation", "region")


@dataclass(frozen=True)
class Dialect:
    name: str

    def numbers(self, n: int) -> str:
        col = "id" if self.name == "spark" else "range"
        return f"(SELECT CAST({col} AS BIGINT) AS n FROM range(0, {n}))"

    def add_days(self, date_sql: str, n_sql: str) -> str:
        if self.name == "spark":
            return f"date_add({date_sql}, CAST({n_sql} AS INT))"
        return f"({date_sql} + CAST({n_sql} AS INTEGER))"

    def days_since_start(self, date_sql: str) -> str:
        start = f"DATE '{CAL_START.isoformat()}'"
        if self.name == "spark":
            return f"datediff({date_sql}, {start})"
        return f"CAST(({date_sql} - {start}) AS INTEGER)"

    def repartition_hint(self, col: str) -> str:
        """Spark: hash-distribute by ``col`` (the join key that follows).

        At scale this is the distribution the sort-merge join needs anyway;
        for small single-file inputs it spreads the derivation over all
        cores instead of one scan task.  DuckDB gets nothing.
        """
        return f"/*+ REPARTITION({col}) */ " if self.name == "spark" else ""

    def idiv(self, a: str, b: str) -> str:
        if self.name == "spark":
            return f"(({a}) div ({b}))"
        return f"(({a}) // ({b}))"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")


def _pick(values, index_sql: str) -> str:
    """CASE expression mapping 0..len-1 to the listed strings."""
    arms = " ".join(
        "WHEN {} THEN '{}'".format(i, v.replace("'", "''")) for i, v in enumerate(values)
    )
    return f"CASE ({index_sql}) % {len(values)} {arms} END"


def _money(cents_sql: str) -> str:
    # decimal(12,0) * decimal(2,2) stays within 18 digits, so Spark keeps the
    # compact long representation instead of BigDecimal arithmetic
    return f"CAST(CAST(({cents_sql}) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(7,2))"


def _key(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


def _nullable(cond: str, sql: str) -> str:
    return f"CASE WHEN {cond} THEN NULL ELSE {sql} END"


# ---------------------------------------------------------------------------
# table texts; {placeholders} are view names filled in per engine
# ---------------------------------------------------------------------------

def _base(d: Dialect) -> str:
    dv = d.idiv
    return f"""
SELECT k, p, su, cu, prio, lstat, rflag, qty, h, dn, tpct,
       w, lp, sp, cp,
       qty * w AS ext_w, qty * lp AS ext_l, qty * sp AS ext_s,
       qty * sp - cp AS np,
       {dv('(qty * sp - cp) * tpct', '100')} AS tax,
       {dv(f'qty * lp * ({dv("h", "17")} % 12)', '100')} AS ship
FROM (
  SELECT k, p, su, cu, prio, lstat, rflag, qty, h, dn, tpct, w, lp, sp,
         CASE WHEN {dv('h', '11')} % 5 = 0
              THEN {dv(f'qty * sp * ({dv("h", "13")} % 40)', '100')} ELSE 0 END AS cp
  FROM (
    SELECT k, p, su, cu, prio, lstat, rflag, qty, h, dn, tpct, w, lp,
           lp - {dv(f'lp * (dpct * 4 + {dv("h", "7")} % 21)', '100')} AS sp
    FROM (
      SELECT k, p, su, cu, prio, lstat, rflag, qty, h, dn, tpct, dpct, w,
             w + {dv('w * (h % 201)', '100')} AS lp
      FROM (
        SELECT l.l_orderkey AS k, l.l_partkey AS p, l.l_suppkey AS su,
               o.o_custkey AS cu, o.o_orderpriority AS prio,
               l.l_linestatus AS lstat, l.l_returnflag AS rflag,
               CAST(l.l_quantity AS BIGINT) AS qty,
               l.l_orderkey * 1000003 + l.l_partkey * 7919 + l.l_linenumber * 104729 AS h,
               CAST({d.days_since_start('CAST(o.o_orderdate AS DATE)')} + {DATE_SHIFT} AS BIGINT) AS dn,
               CAST(FLOOR(l.l_tax * 100 + 0.5) AS BIGINT) AS tpct,
               CAST(FLOOR(l.l_discount * 100 + 0.5) AS BIGINT) AS dpct,
               100 + CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS BIGINT) % 9901 AS w
        FROM (SELECT {d.repartition_hint('l_orderkey')}* FROM {{src_lineitem}}) l
        JOIN {{src_orders}} o ON l.l_orderkey = o.o_orderkey
      ) a
    ) b
  ) c
) e
"""


def _neighbour(cu: str = "cu") -> str:
    # the address of the customer with the adjacent key (cu xor 1)
    return f"({cu} + 2 - 2 * ({cu} % 2))"


def _store_sales(d: Dialect) -> str:
    dv = d.idiv
    return f"""
SELECT {_key(f'{SK0} + dn')} AS ss_sold_date_sk,
       {_key(f"{dv('h', '7')} % 86400")} AS ss_sold_time_sk,
       {_key('p + 1')} AS ss_item_sk,
       {_key(_nullable('h % 53 = 7', 'cu + 1'))} AS ss_customer_sk,
       {_key(_nullable('h % 59 = 11', f"1 + {dv('h', '3')} % {N_CDEMO}"))} AS ss_cdemo_sk,
       {_key(_nullable('h % 61 = 13', f"1 + {dv('h', '5')} % {N_HDEMO}"))} AS ss_hdemo_sk,
       {_key(f"CASE WHEN h % 67 = 17 THEN NULL WHEN h % 4 = 0 THEN {_neighbour()} ELSE cu + 1 END")} AS ss_addr_sk,
       {_key(_nullable('h % 71 = 19', f'1 + su % {N_STORE}'))} AS ss_store_sk,
       {_key(_nullable('h % 73 = 23', f"1 + {dv('h', '19')} % {N_PROMO}"))} AS ss_promo_sk,
       {_key('k + 1')} AS ss_ticket_number,
       CAST(qty AS INT) AS ss_quantity,
       {_money('w')} AS ss_wholesale_cost,
       {_money('lp')} AS ss_list_price,
       {_money('sp')} AS ss_sales_price,
       {_money('ext_l - ext_s')} AS ss_ext_discount_amt,
       {_money('ext_s')} AS ss_ext_sales_price,
       {_money('ext_w')} AS ss_ext_wholesale_cost,
       {_money('ext_l')} AS ss_ext_list_price,
       {_money('tax')} AS ss_ext_tax,
       {_money('cp')} AS ss_coupon_amt,
       {_money('np')} AS ss_net_paid,
       {_money('np + tax')} AS ss_net_paid_inc_tax,
       {_money('np - ext_w')} AS ss_net_profit
FROM {{mart_base}}
"""


def _cat_lag(d: Dialect) -> str:
    return f"(CASE WHEN h % 3 = 0 THEN 0 ELSE {d.idiv('h', '23')} % 45 END)"


def _web_lag(d: Dialect) -> str:
    return f"(CASE WHEN h % 3 = 1 THEN 0 ELSE {d.idiv('h', '97')} % 30 END)"


CATALOG_FILTER = "lstat = 'F'"
WEB_FILTER = "prio IN ('1-URGENT', '2-HIGH')"
RETURN_FILTER = "rflag = 'R'"


def _catalog_sales(d: Dialect) -> str:
    dv = d.idiv
    lag = _cat_lag(d)
    return f"""
SELECT {_key(f'{SK0} + dn + {lag}')} AS cs_sold_date_sk,
       {_key(f"{dv('h', '31')} % 86400")} AS cs_sold_time_sk,
       {_key(f"{SK0} + dn + {lag} + 1 + {dv('h', '29')} % 150")} AS cs_ship_date_sk,
       {_key(_nullable('h % 83 = 31', 'cu + 1'))} AS cs_bill_customer_sk,
       {_key(f"1 + {dv('h', '43')} % {N_CDEMO}")} AS cs_bill_cdemo_sk,
       {_key(f"1 + {dv('h', '47')} % {N_HDEMO}")} AS cs_bill_hdemo_sk,
       {_key(f"CASE WHEN h % 6 = 1 THEN {_neighbour()} ELSE cu + 1 END")} AS cs_bill_addr_sk,
       {_key(f"CASE WHEN h % 5 = 0 THEN {_neighbour()} ELSE cu + 1 END")} AS cs_ship_customer_sk,
       {_key(f"1 + {dv('h', '3')} % {N_CDEMO}")} AS cs_ship_cdemo_sk,
       {_key(f"1 + {dv('h', '5')} % {N_HDEMO}")} AS cs_ship_hdemo_sk,
       {_key(f"CASE WHEN h % 89 = 37 THEN NULL WHEN h % 7 = 2 THEN {_neighbour()} ELSE cu + 1 END")} AS cs_ship_addr_sk,
       {_key(f"1 + {dv('h', '53')} % {N_CALL_CENTER}")} AS cs_call_center_sk,
       {_key(f"1 + {dv('h', '59')} % {N_CATALOG_PAGE}")} AS cs_catalog_page_sk,
       {_key(f"1 + {dv('h', '37')} % {N_SHIP_MODE}")} AS cs_ship_mode_sk,
       {_key(_nullable('h % 79 = 29', f"1 + {dv('h', '41')} % {N_WAREHOUSE}"))} AS cs_warehouse_sk,
       {_key('p + 1')} AS cs_item_sk,
       {_key(f"1 + {dv('h', '61')} % {N_PROMO}")} AS cs_promo_sk,
       {_key('k + 1')} AS cs_order_number,
       CAST(qty AS INT) AS cs_quantity,
       {_money('w')} AS cs_wholesale_cost,
       {_money('lp')} AS cs_list_price,
       {_money('sp')} AS cs_sales_price,
       {_money('ext_l - ext_s')} AS cs_ext_discount_amt,
       {_money('ext_s')} AS cs_ext_sales_price,
       {_money('ext_w')} AS cs_ext_wholesale_cost,
       {_money('ext_l')} AS cs_ext_list_price,
       {_money('tax')} AS cs_ext_tax,
       {_money('cp')} AS cs_coupon_amt,
       {_money('ship')} AS cs_ext_ship_cost,
       {_money('np')} AS cs_net_paid,
       {_money('np + tax')} AS cs_net_paid_inc_tax,
       {_money('np + ship')} AS cs_net_paid_inc_ship,
       {_money('np + ship + tax')} AS cs_net_paid_inc_ship_tax,
       {_money('np - ext_w')} AS cs_net_profit
FROM {{mart_base}}
WHERE {CATALOG_FILTER}
"""


def _web_sales(d: Dialect) -> str:
    dv = d.idiv
    lag = _web_lag(d)
    return f"""
SELECT {_key(f'{SK0} + dn + {lag}')} AS ws_sold_date_sk,
       {_key(f"{dv('h', '67')} % 86400")} AS ws_sold_time_sk,
       {_key(f"{SK0} + dn + {lag} + 1 + {dv('h', '71')} % 150")} AS ws_ship_date_sk,
       {_key('p + 1')} AS ws_item_sk,
       {_key(_nullable('h % 97 = 43', 'cu + 1'))} AS ws_bill_customer_sk,
       {_key(f"1 + {dv('h', '43')} % {N_CDEMO}")} AS ws_bill_cdemo_sk,
       {_key(f"1 + {dv('h', '47')} % {N_HDEMO}")} AS ws_bill_hdemo_sk,
       {_key(f"CASE WHEN h % 6 = 1 THEN {_neighbour()} ELSE cu + 1 END")} AS ws_bill_addr_sk,
       {_key(f"CASE WHEN h % 5 = 0 THEN {_neighbour()} ELSE cu + 1 END")} AS ws_ship_customer_sk,
       {_key(f"1 + {dv('h', '3')} % {N_CDEMO}")} AS ws_ship_cdemo_sk,
       {_key(f"1 + {dv('h', '5')} % {N_HDEMO}")} AS ws_ship_hdemo_sk,
       {_key(f"CASE WHEN h % 7 = 2 THEN {_neighbour()} ELSE cu + 1 END")} AS ws_ship_addr_sk,
       {_key(_nullable('h % 101 = 41', f"1 + {dv('h', '101')} % {N_WEB_PAGE}"))} AS ws_web_page_sk,
       {_key(f"1 + {dv('h', '103')} % {N_WEB_SITE}")} AS ws_web_site_sk,
       {_key(f"1 + {dv('h', '37')} % {N_SHIP_MODE}")} AS ws_ship_mode_sk,
       {_key(f"1 + {dv('h', '41')} % {N_WAREHOUSE}")} AS ws_warehouse_sk,
       {_key(f"1 + {dv('h', '61')} % {N_PROMO}")} AS ws_promo_sk,
       {_key('k + 1')} AS ws_order_number,
       CAST(qty AS INT) AS ws_quantity,
       {_money('w')} AS ws_wholesale_cost,
       {_money('lp')} AS ws_list_price,
       {_money('sp')} AS ws_sales_price,
       {_money('ext_l - ext_s')} AS ws_ext_discount_amt,
       {_money('ext_s')} AS ws_ext_sales_price,
       {_money('ext_w')} AS ws_ext_wholesale_cost,
       {_money('ext_l')} AS ws_ext_list_price,
       {_money('tax')} AS ws_ext_tax,
       {_money('cp')} AS ws_coupon_amt,
       {_money('ship')} AS ws_ext_ship_cost,
       {_money('np')} AS ws_net_paid,
       {_money('np + tax')} AS ws_net_paid_inc_tax,
       {_money('np + ship')} AS ws_net_paid_inc_ship,
       {_money('np + ship + tax')} AS ws_net_paid_inc_ship_tax,
       {_money('np - ext_w')} AS ws_net_profit
FROM {{mart_base}}
WHERE {WEB_FILTER}
"""


def _return_money(d: Dialect, prefix: str, amt_name: str) -> str:
    """Return quantity and amounts; rq <= sold quantity."""
    dv = d.idiv
    rq = f"(1 + {dv('h', '127')} % qty)"
    ra = f"({rq} * sp)"
    cash = dv(f"{ra} * ({dv('h', '137')} % 101)", "100")
    rev = dv(f"({ra} - {cash}) * ({dv('h', '139')} % 101)", "100")
    fee = f"(50 + {dv('h', '131')} % 9951)"
    rtax = dv(f"{ra} * tpct", "100")
    loss = dv(f"{ra} * ({dv('h', '149')} % 30)", "100")
    last = "sr_store_credit" if prefix == "sr" else (
        "cr_store_credit" if prefix == "cr" else "wr_account_credit")
    return f"""
       CAST({rq} AS INT) AS {prefix}_return_quantity,
       {_money(ra)} AS {prefix}_{amt_name},
       {_money(rtax)} AS {prefix}_return_tax,
       {_money(f'{ra} + {rtax}')} AS {prefix}_return_amt_inc_tax,
       {_money(fee)} AS {prefix}_fee,
       {_money(dv(f'{rq} * lp * 3', '100'))} AS {prefix}_return_ship_cost,
       {_money(cash)} AS {prefix}_refunded_cash,
       {_money(rev)} AS {prefix}_reversed_charge,
       {_money(f'{ra} - {cash} - {rev}')} AS {last},
       {_money(f"{fee} + {loss}")} AS {prefix}_net_loss"""


def _store_returns(d: Dialect) -> str:
    dv = d.idiv
    return f"""
SELECT {_key(f"{SK0} + dn + 1 + {dv('h', '109')} % 120")} AS sr_returned_date_sk,
       {_key(f"{dv('h', '113')} % 86400")} AS sr_return_time_sk,
       {_key('p + 1')} AS sr_item_sk,
       {_key(_nullable('h % 53 = 7', 'cu + 1'))} AS sr_customer_sk,
       {_key(f"CASE WHEN h % 2 = 0 THEN 1 + (cu * 7) % {N_CDEMO} ELSE 1 + {dv('h', '3')} % {N_CDEMO} END")} AS sr_cdemo_sk,
       {_key(f"1 + {dv('h', '5')} % {N_HDEMO}")} AS sr_hdemo_sk,
       {_key('cu + 1')} AS sr_addr_sk,
       {_key(_nullable('h % 71 = 19', f'1 + su % {N_STORE}'))} AS sr_store_sk,
       {_key(f"1 + {dv('h', '113')} % {N_REASON}")} AS sr_reason_sk,
       {_key('k + 1')} AS sr_ticket_number,{_return_money(d, 'sr', 'return_amt')}
FROM {{mart_base}}
WHERE {RETURN_FILTER}
"""


def _catalog_returns(d: Dialect) -> str:
    dv = d.idiv
    lag = _cat_lag(d)
    return f"""
SELECT {_key(f"{SK0} + dn + {lag} + 1 + {dv('h', '109')} % 120")} AS cr_returned_date_sk,
       {_key(f"{dv('h', '113')} % 86400")} AS cr_returned_time_sk,
       {_key('p + 1')} AS cr_item_sk,
       {_key('cu + 1')} AS cr_refunded_customer_sk,
       {_key(f"CASE WHEN h % 9 = 4 THEN {_neighbour()} ELSE cu + 1 END")} AS cr_returning_customer_sk,
       {_key(f"1 + {dv('h', '43')} % {N_CDEMO}")} AS cr_returning_cdemo_sk,
       {_key(f"1 + {dv('h', '47')} % {N_HDEMO}")} AS cr_returning_hdemo_sk,
       {_key('cu + 1')} AS cr_returning_addr_sk,
       {_key(f"1 + {dv('h', '53')} % {N_CALL_CENTER}")} AS cr_call_center_sk,
       {_key(f"1 + {dv('h', '59')} % {N_CATALOG_PAGE}")} AS cr_catalog_page_sk,
       {_key(f"1 + {dv('h', '37')} % {N_SHIP_MODE}")} AS cr_ship_mode_sk,
       {_key(f"1 + {dv('h', '41')} % {N_WAREHOUSE}")} AS cr_warehouse_sk,
       {_key(f"1 + {dv('h', '113')} % {N_REASON}")} AS cr_reason_sk,
       {_key('k + 1')} AS cr_order_number,{_return_money(d, 'cr', 'return_amount')}
FROM {{mart_base}}
WHERE {CATALOG_FILTER} AND {RETURN_FILTER}
"""


def _web_returns(d: Dialect) -> str:
    dv = d.idiv
    lag = _web_lag(d)
    return f"""
SELECT {_key(f"{SK0} + dn + {lag} + 1 + {dv('h', '109')} % 120")} AS wr_returned_date_sk,
       {_key(f"{dv('h', '113')} % 86400")} AS wr_returned_time_sk,
       {_key('p + 1')} AS wr_item_sk,
       {_key('cu + 1')} AS wr_refunded_customer_sk,
       {_key(f"1 + {dv('h', '43')} % {N_CDEMO}")} AS wr_refunded_cdemo_sk,
       {_key(f"1 + {dv('h', '47')} % {N_HDEMO}")} AS wr_refunded_hdemo_sk,
       {_key('cu + 1')} AS wr_refunded_addr_sk,
       {_key(f"CASE WHEN h % 9 = 4 THEN {_neighbour()} ELSE cu + 1 END")} AS wr_returning_customer_sk,
       {_key(f"CASE WHEN h % 3 = 0 THEN 1 + {dv('h', '3')} % {N_CDEMO} ELSE 1 + {dv('h', '43')} % {N_CDEMO} END")} AS wr_returning_cdemo_sk,
       {_key(f"1 + {dv('h', '47')} % {N_HDEMO}")} AS wr_returning_hdemo_sk,
       {_key(f"CASE WHEN h % 4 = 3 THEN {_neighbour()} ELSE cu + 1 END")} AS wr_returning_addr_sk,
       {_key(_nullable('h % 101 = 41', f"1 + {dv('h', '101')} % {N_WEB_PAGE}"))} AS wr_web_page_sk,
       {_key(f"1 + {dv('h', '113')} % {N_REASON}")} AS wr_reason_sk,
       {_key('k + 1')} AS wr_order_number,{_return_money(d, 'wr', 'return_amt')}
FROM {{mart_base}}
WHERE {WEB_FILTER} AND {RETURN_FILTER}
"""


def _inventory(d: Dialect) -> str:
    dv = d.idiv
    return f"""
SELECT {_key(f'{SK0} + dn - (dn + 1) % 7 + 7 * j.n')} AS inv_date_sk,
       {_key('p + 1')} AS inv_item_sk,
       {_key(f"1 + {dv('h', '41')} % {N_WAREHOUSE}")} AS inv_warehouse_sk,
       CAST(CASE WHEN p % 7 = 0
                 THEN CASE WHEN j.n = 0 THEN 900 + {dv('h', '151')} % 100
                           ELSE ({dv('h', '157')} + j.n) % 20 END
                 ELSE ({dv('h', '163')} + j.n * 211) % 1000 END AS INT) AS inv_quantity_on_hand
FROM {{mart_base}} CROSS JOIN {d.numbers(INVENTORY_WEEKS)} j
"""


def _date_dim(d: Dialect) -> str:
    day_name = _pick(D.DAY_NAMES, "(n + 1) % 7")
    return f"""
SELECT CAST({SK0} + n AS BIGINT) AS d_date_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS d_date_id,
       d_date,
       CAST(year(d_date) AS INT) AS d_year,
       CAST(month(d_date) AS INT) AS d_moy,
       CAST(day(d_date) AS INT) AS d_dom,
       CAST(quarter(d_date) AS INT) AS d_qoy,
       CAST((n + 1) % 7 AS INT) AS d_dow,
       {day_name} AS d_day_name,
       CAST({d.idiv('n + 1', '7')} + 5165 AS INT) AS d_week_seq,
       CAST((year(d_date) - 1900) * 12 + month(d_date) - 1 AS INT) AS d_month_seq,
       CAST((year(d_date) - 1900) * 4 + quarter(d_date) - 1 AS INT) AS d_quarter_seq,
       CAST(year(d_date) AS STRING) || 'Q' || CAST(quarter(d_date) AS STRING) AS d_quarter_name,
       CASE WHEN (n + 1) % 7 IN (0, 6) THEN 'Y' ELSE 'N' END AS d_weekend,
       CAST(year(d_date) AS INT) AS d_fy_year
FROM (SELECT n, {d.add_days(f"DATE '{CAL_START.isoformat()}'", 'n')} AS d_date
      FROM {d.numbers(CAL_DAYS)} x) c
"""


def _time_dim(d: Dialect) -> str:
    dv = d.idiv
    hour = dv("n", "3600")
    meal = " ".join(
        f"WHEN {hour} BETWEEN {lo} AND {hi} THEN '{name}'" for name, (lo, hi) in D.MEAL_TIMES.items()
    )
    return f"""
SELECT CAST(n AS BIGINT) AS t_time_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS t_time_id,
       CAST(n AS INT) AS t_time,
       CAST({hour} AS INT) AS t_hour,
       CAST({dv('n', '60')} % 60 AS INT) AS t_minute,
       CAST(n % 60 AS INT) AS t_second,
       CASE WHEN {hour} < 12 THEN 'AM' ELSE 'PM' END AS t_am_pm,
       CASE {meal} ELSE NULL END AS t_meal_time
FROM {d.numbers(86400)} x
"""


def _item(d: Dialect) -> str:
    dv = d.idiv
    pk = "p_partkey"
    brand_ix = f"{dv(pk, '3')} % {len(D.BRANDS)}"
    class_ix = f"{dv(pk, '7')} % {len(D.CLASSES)}"
    return f"""
SELECT CAST({pk} + 1 AS BIGINT) AS i_item_sk,
       'AAAAAAAA' || lpad(CAST({pk} AS STRING), 20, '0') AS i_item_id,
       p_name AS i_item_desc,
       {_money(f'100 + ({pk} * 7919) % 9900')} AS i_current_price,
       {_money(f'50 + ({pk} * 104729) % 5000')} AS i_wholesale_cost,
       CAST(1001001 + {brand_ix} AS INT) AS i_brand_id,
       {_pick(D.BRANDS, brand_ix)} AS i_brand,
       CAST(1 + {class_ix} AS INT) AS i_class_id,
       {_pick(D.CLASSES, class_ix)} AS i_class,
       CAST(1 + {pk} % {len(D.CATEGORIES)} AS INT) AS i_category_id,
       {_pick(D.CATEGORIES, f'{pk}')} AS i_category,
       CAST(1 + {pk} % 1000 AS INT) AS i_manufact_id,
       'manufact#' || CAST(1 + {pk} % 1000 AS STRING) AS i_manufact,
       {_pick(D.SIZES, dv(pk, '13'))} AS i_size,
       {_pick(D.COLORS, dv(pk, '5'))} AS i_color,
       {_pick(D.UNITS, dv(pk, '17'))} AS i_units,
       CAST(1 + {dv(pk, '11')} % 100 AS INT) AS i_manager_id,
       p_name || ' #' || CAST({pk} AS STRING) AS i_product_name
FROM {{src_part}}
"""


def _customer(d: Dialect) -> str:
    dv = d.idiv
    c = "c_custkey"
    first = _pick(D.FIRST_NAMES, dv(c, '3'))
    last = _pick(D.LAST_NAMES, dv(c, '2'))
    return f"""
SELECT CAST({c} + 1 AS BIGINT) AS c_customer_sk,
       'AAAAAAAA' || lpad(CAST({c} AS STRING), 20, '0') AS c_customer_id,
       CAST(1 + ({c} * 7) % {N_CDEMO} AS BIGINT) AS c_current_cdemo_sk,
       CAST(1 + ({c} * 13) % {N_HDEMO} AS BIGINT) AS c_current_hdemo_sk,
       CAST({c} + 1 AS BIGINT) AS c_current_addr_sk,
       CAST({SK0 + 3000} + ({c} * 17) % 2000 AS BIGINT) AS c_first_shipto_date_sk,
       CAST({SK0 + 3000} + ({c} * 19) % 2000 AS BIGINT) AS c_first_sales_date_sk,
       {_pick(D.SALUTATIONS, c)} AS c_salutation,
       {first} AS c_first_name,
       {last} AS c_last_name,
       CASE WHEN {c} % 2 = 0 THEN 'Y' ELSE 'N' END AS c_preferred_cust_flag,
       CAST(1 + {c} % 28 AS INT) AS c_birth_day,
       CAST(1 + {dv(c, '5')} % 12 AS INT) AS c_birth_month,
       CAST(1924 + {dv(c, '3')} % 69 AS INT) AS c_birth_year,
       {_pick(D.COUNTRIES, 'c_nationkey')} AS c_birth_country,
       CASE WHEN {c} % 10 = 3 THEN NULL ELSE 'login' || CAST({c} AS STRING) END AS c_login,
       {first} || '.' || {last} || '@' || c_mktsegment || '.com' AS c_email_address,
       CAST({SK0 + 4000} + ({c} * 23) % 1000 AS INT) AS c_last_review_date
FROM {{src_customer}}
"""


def _customer_address(d: Dialect) -> str:
    dv = d.idiv
    c = "c_custkey"
    return f"""
SELECT CAST({c} + 1 AS BIGINT) AS ca_address_sk,
       'AAAAAAAA' || lpad(CAST({c} AS STRING), 20, '0') AS ca_address_id,
       CAST(1 + ({c} * 37) % 999 AS STRING) AS ca_street_number,
       {_pick(D.STREET_NAMES, dv(c, '4'))} AS ca_street_name,
       {_pick(D.STREET_TYPES, dv(c, '9'))} AS ca_street_type,
       'Suite ' || CAST(({c} * 7) % 500 AS STRING) AS ca_suite_number,
       {_pick(D.CITIES, c)} AS ca_city,
       {_pick(D.COUNTIES, dv(c, '3'))} AS ca_county,
       {_pick(D.STATES, dv(c, '5'))} AS ca_state,
       {_pick(D.ZIPS, dv(c, '7'))} AS ca_zip,
       'United States' AS ca_country,
       CAST(-5 - {c} % 4 AS DECIMAL(5,2)) AS ca_gmt_offset,
       {_pick(D.LOCATION_TYPES, dv(c, '11'))} AS ca_location_type
FROM {{src_customer}}
"""


def _customer_demographics(d: Dialect) -> str:
    dv = d.idiv
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS cd_demo_sk,
       {_pick(D.GENDERS, 'n')} AS cd_gender,
       {_pick(D.MARITAL, dv('n', '2'))} AS cd_marital_status,
       {_pick(D.EDUCATION, dv('n', '10'))} AS cd_education_status,
       CAST(500 * (1 + {dv('n', '70')} % 20) AS INT) AS cd_purchase_estimate,
       {_pick(D.CREDIT, dv('n', '1400'))} AS cd_credit_rating,
       CAST({dv('n', '5600')} % 7 AS INT) AS cd_dep_count,
       CAST({dv('n', '3')} % 7 AS INT) AS cd_dep_employed_count,
       CAST({dv('n', '17')} % 7 AS INT) AS cd_dep_college_count
FROM {d.numbers(N_CDEMO)} x
"""


def _household_demographics(d: Dialect) -> str:
    dv = d.idiv
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS hd_demo_sk,
       CAST(1 + n % {N_INCOME_BAND} AS BIGINT) AS hd_income_band_sk,
       {_pick(D.BUY_POTENTIAL, dv('n', '20'))} AS hd_buy_potential,
       CAST({dv('n', '120')} % 10 AS INT) AS hd_dep_count,
       CAST({dv('n', '1200')} % 6 - 1 AS INT) AS hd_vehicle_count
FROM {d.numbers(N_HDEMO)} x
"""


def _income_band(d: Dialect) -> str:
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS ib_income_band_sk,
       CAST(CASE WHEN n = 0 THEN 0 ELSE n * 10000 + 1 END AS INT) AS ib_lower_bound,
       CAST((n + 1) * 10000 AS INT) AS ib_upper_bound
FROM {d.numbers(N_INCOME_BAND)} x
"""


def _store(d: Dialect) -> str:
    dv = d.idiv
    s = "n_nationkey"
    return f"""
SELECT CAST({s} + 1 AS BIGINT) AS s_store_sk,
       'AAAAAAAA' || lpad(CAST({s} AS STRING), 20, '0') AS s_store_id,
       {_pick(D.STORE_NAMES, s)} AS s_store_name,
       CAST(200 + ({s} * 37) % 100 AS INT) AS s_number_employees,
       CAST(5000 + ({s} * 311) % 4000 AS INT) AS s_floor_space,
       CAST(1 + {s} % 10 AS INT) AS s_market_id,
       CAST(1 + {s} % 6 AS INT) AS s_company_id,
       {_pick(D.COMPANY_NAMES, s)} AS s_company_name,
       CAST(1 + ({s} * 53) % 999 AS STRING) AS s_street_number,
       {_pick(D.STREET_NAMES, dv(s, '2'))} AS s_street_name,
       {_pick(D.STREET_TYPES, s)} AS s_street_type,
       'Suite ' || CAST(({s} * 13) % 300 AS STRING) AS s_suite_number,
       {_pick(D.CITIES, dv(s, '2'))} AS s_city,
       CASE WHEN {s} % 3 = 2 THEN 'Ziebach County' ELSE 'Williamson County' END AS s_county,
       CASE WHEN {s} % 5 = 4 THEN 'GA' ELSE 'TN' END AS s_state,
       {_pick(D.ZIPS, s)} AS s_zip,
       'United States' AS s_country,
       CAST(-5 - {s} % 3 AS DECIMAL(5,2)) AS s_gmt_offset
FROM {{src_nation}}
"""


def _warehouse(d: Dialect) -> str:
    w = "r_regionkey"
    return f"""
SELECT CAST({w} + 1 AS BIGINT) AS w_warehouse_sk,
       'AAAAAAAA' || lpad(CAST({w} AS STRING), 20, '0') AS w_warehouse_id,
       {_pick(D.WAREHOUSE_NAMES, w)} AS w_warehouse_name,
       CAST(100000 + ({w} * 179731) % 900000 AS INT) AS w_warehouse_sq_ft,
       {_pick(D.CITIES, w)} AS w_city,
       {_pick(D.COUNTIES, w)} AS w_county,
       {_pick(D.STATES, f'{w} * 3')} AS w_state,
       'United States' AS w_country
FROM {{src_region}}
"""


def _call_center(d: Dialect) -> str:
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS cc_call_center_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS cc_call_center_id,
       {_pick(D.CALL_CENTER_NAMES, 'n')} AS cc_name,
       {_pick(D.FIRST_NAMES, 'n * 5')} || ' ' || {_pick(D.LAST_NAMES, 'n * 3')} AS cc_manager,
       CASE WHEN n % 2 = 0 THEN 'Williamson County' ELSE 'Bronx County' END AS cc_county
FROM {d.numbers(N_CALL_CENTER)} x
"""


def _web_site(d: Dialect) -> str:
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS web_site_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS web_site_id,
       'site_' || CAST(n % 10 AS STRING) AS web_name,
       {_pick(D.COMPANY_NAMES, 'n')} AS web_company_name
FROM {d.numbers(N_WEB_SITE)} x
"""


def _web_page(d: Dialect) -> str:
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS wp_web_page_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS wp_web_page_id,
       CAST(4000 + (n * 97) % 3000 AS INT) AS wp_char_count
FROM {d.numbers(N_WEB_PAGE)} x
"""


def _ship_mode(d: Dialect) -> str:
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS sm_ship_mode_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS sm_ship_mode_id,
       {_pick(D.SHIP_TYPES, 'n')} AS sm_type,
       {_pick(D.CARRIERS, 'n')} AS sm_carrier
FROM {d.numbers(N_SHIP_MODE)} x
"""


def _promotion(d: Dialect) -> str:
    dv = d.idiv
    yn = lambda bit: f"CASE WHEN {dv('n', str(bit))} % 2 = 0 THEN 'N' ELSE 'Y' END"
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS p_promo_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS p_promo_id,
       {yn(1)} AS p_channel_dmail,
       {yn(2)} AS p_channel_email,
       {yn(4)} AS p_channel_catalog,
       {yn(8)} AS p_channel_tv,
       {yn(16)} AS p_channel_radio,
       {yn(32)} AS p_channel_press,
       {yn(64)} AS p_channel_event
FROM {d.numbers(N_PROMO)} x
"""


def _reason(d: Dialect) -> str:
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS r_reason_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS r_reason_id,
       {_pick(D.REASONS, 'n')} AS r_reason_desc
FROM {d.numbers(N_REASON)} x
"""


def _catalog_page(d: Dialect) -> str:
    return f"""
SELECT CAST(n + 1 AS BIGINT) AS cp_catalog_page_sk,
       'AAAAAAAA' || lpad(CAST(n AS STRING), 20, '0') AS cp_catalog_page_id
FROM {d.numbers(N_CATALOG_PAGE)} x
"""


def _dbgen_version(d: Dialect) -> str:
    return "SELECT 'mart-1' AS dv_version, DATE '2000-01-01' AS dv_create_date FROM " + d.numbers(1) + " x"


# name -> (builder, dependencies)
_TABLES = {
    "mart_base": (_base, ("src_lineitem", "src_orders")),
    "store_sales": (_store_sales, ("mart_base",)),
    "catalog_sales": (_catalog_sales, ("mart_base",)),
    "web_sales": (_web_sales, ("mart_base",)),
    "store_returns": (_store_returns, ("mart_base",)),
    "catalog_returns": (_catalog_returns, ("mart_base",)),
    "web_returns": (_web_returns, ("mart_base",)),
    "inventory": (_inventory, ("mart_base",)),
    "date_dim": (_date_dim, ()),
    "time_dim": (_time_dim, ()),
    "item": (_item, ("src_part",)),
    "customer": (_customer, ("src_customer",)),
    "customer_address": (_customer_address, ("src_customer",)),
    "customer_demographics": (_customer_demographics, ()),
    "household_demographics": (_household_demographics, ()),
    "income_band": (_income_band, ()),
    "store": (_store, ("src_nation",)),
    "warehouse": (_warehouse, ("src_region",)),
    "call_center": (_call_center, ()),
    "web_site": (_web_site, ()),
    "web_page": (_web_page, ()),
    "ship_mode": (_ship_mode, ()),
    "promotion": (_promotion, ()),
    "reason": (_reason, ()),
    "catalog_page": (_catalog_page, ()),
    "dbgen_version": (_dbgen_version, ()),
}

MART_TABLES = tuple(n for n in _TABLES if n != "mart_base")
FACT_TABLES = (
    "store_sales", "store_returns", "catalog_sales", "catalog_returns",
    "web_sales", "web_returns", "inventory",
)


def table_sql(name: str, dialect: Dialect, names: dict[str, str]) -> str:
    """SELECT text of one mart table with view names substituted."""
    builder, deps = _TABLES[name]
    return builder(dialect).format(**{dep: names[dep] for dep in deps})


def dependencies(name: str) -> tuple[str, ...]:
    return _TABLES[name][1]


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def oracle_prefix(query_sql: str) -> str:
    """WITH-clause defining every mart table a DuckDB query mentions.

    Driver views are first copied to ``src_*`` names so that mart CTEs
    named like a driver table (``customer``) may shadow them.
    """
    words = set(_WORD.findall(query_sql))
    needed: list[str] = []

    def visit(n):
        if n in needed or n.startswith("src_"):
            return
        for dep in _TABLES[n][1]:
            visit(dep)
        needed.append(n)

    for n in _TABLES:
        if n in words:
            visit(n)
    srcs = sorted({dep for n in needed for dep in _TABLES[n][1] if dep.startswith("src_")})
    names = {s: s for s in srcs}
    names["mart_base"] = "mart_base"
    ctes = [f"{s} AS (SELECT * FROM {s[4:]})" for s in srcs]
    ctes += [f"{n} AS ({table_sql(n, DUCKDB, names)})" for n in needed]
    return "WITH " + ",\n".join(ctes) + "\n" if ctes else ""


def oracle(query_sql: str) -> str:
    """Full DuckDB text: mart CTEs followed by the query.

    ``query_sql`` may itself start with ``WITH``; its CTEs are appended
    to the mart's.
    """
    body = query_sql.strip()
    prefix = oracle_prefix(body)
    if not prefix:
        return body
    if body[:4].upper() == "WITH":
        return prefix.rstrip() + ",\n" + body[4:].lstrip()
    return prefix + body
