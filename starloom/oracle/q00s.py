"""Oracle SQL for q01-q09."""

from ..plans.q08_zips import Q08_ZIPS
from .registry import ob, register

_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_SHORT = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]

register(q01=f"""
WITH ctr AS (
  SELECT sr_customer_sk AS cust, sr_store_sk AS store, sum(sr_fee) AS total
  FROM store_returns JOIN date_dim ON sr_returned_date_sk = d_date_sk
  WHERE d_year = 2000
  GROUP BY sr_customer_sk, sr_store_sk),
per_store AS (SELECT store, sum(total) AS st, count(total) AS sc FROM ctr GROUP BY store)
SELECT c_customer_id
FROM ctr
JOIN per_store p ON ctr.store = p.store
JOIN store ON s_store_sk = ctr.store
JOIN customer ON c_customer_sk = ctr.cust
WHERE s_state = 'TN' AND ctr.total * p.sc * 10 > p.st * 12
{ob("c_customer_id", "c_customer_id")}
""")

_pivot = ",\n  ".join(f"sum(CASE WHEN d_day_name = '{d}' THEN price END) AS {s}_sales"
                      for d, s in zip(_DAYS, _SHORT))
_ratios = ",\n  ".join(f"round(CAST(y.{s}_sales AS DOUBLE) / nullif(CAST(z.{s}_sales AS DOUBLE), 0), 2) "
                       f"AS {s}_sales_ratio" for s in _SHORT)
register(q02=f"""
WITH sales AS (
  SELECT ws_sold_date_sk AS sold, ws_ext_sales_price AS price FROM web_sales
  UNION ALL
  SELECT cs_sold_date_sk, cs_ext_sales_price FROM catalog_sales),
weekly AS (
  SELECT d_week_seq,
  {_pivot}
  FROM sales JOIN date_dim ON sold = d_date_sk
  GROUP BY d_week_seq),
y AS (SELECT w.* FROM weekly w JOIN date_dim d ON d.d_week_seq = w.d_week_seq WHERE d.d_year = 2001),
z AS (SELECT w.* FROM weekly w JOIN date_dim d ON d.d_week_seq = w.d_week_seq WHERE d.d_year = 2002)
SELECT y.d_week_seq AS d_week_seq1,
  {_ratios}
FROM y JOIN z ON y.d_week_seq = z.d_week_seq - 53
{ob("d_week_seq1", "d_week_seq1," + ",".join(s + "_sales_ratio" for s in _SHORT), None)}
""")

register(q03=f"""
SELECT d_year, i_brand_id AS brand_id, i_brand AS brand, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS sum_agg
FROM store_sales
JOIN date_dim ON d_date_sk = ss_sold_date_sk
JOIN item ON ss_item_sk = i_item_sk
WHERE i_manufact_id = 436 AND d_moy = 12
GROUP BY d_year, i_brand, i_brand_id
{ob("d_year, sum_agg DESC, brand_id", "brand")}
""")


def _yt(fact, cust, date, p):
    return f"""
  SELECT c_customer_id, c_first_name, c_last_name, c_email_address,
         CAST(sum(CASE WHEN d_year = 2001 THEN {p}_ext_list_price - {p}_ext_wholesale_cost
                       - {p}_ext_discount_amt + {p}_ext_sales_price END) AS DOUBLE) / 2 AS y1,
         CAST(sum(CASE WHEN d_year = 2002 THEN {p}_ext_list_price - {p}_ext_wholesale_cost
                       - {p}_ext_discount_amt + {p}_ext_sales_price END) AS DOUBLE) / 2 AS y2
  FROM {fact} JOIN date_dim ON {date} = d_date_sk JOIN customer ON {cust} = c_customer_sk
  WHERE d_year IN (2001, 2002)
  GROUP BY c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country,
           c_login, c_email_address"""


register(q04=f"""
WITH s AS ({_yt("store_sales", "ss_customer_sk", "ss_sold_date_sk", "ss")}),
ca AS ({_yt("catalog_sales", "cs_bill_customer_sk", "cs_sold_date_sk", "cs")}),
w AS ({_yt("web_sales", "ws_bill_customer_sk", "ws_sold_date_sk", "ws")})
SELECT s.c_customer_id AS customer_id, s.c_first_name AS customer_first_name,
       s.c_last_name AS customer_last_name, s.c_email_address AS customer_email_address
FROM s JOIN ca ON s.c_customer_id = ca.c_customer_id JOIN w ON s.c_customer_id = w.c_customer_id
WHERE s.y1 > 0 AND ca.y1 > 0 AND w.y1 > 0
  AND ca.y2 / ca.y1 > s.y2 / s.y1 AND ca.y2 / ca.y1 > w.y2 / w.y1
{ob("customer_id, customer_first_name, customer_last_name, customer_email_address", "customer_id")}
""")


def _sr(sales_sel, ret_sel, dim, dim_key, dim_id):
    return f"""
  SELECT {dim_id} AS oid, sum(sales) AS sales, sum(profit) AS profit,
         sum(returns) AS returns, sum(loss) AS loss
  FROM (
    {sales_sel}
    UNION ALL
    {ret_sel}
  ) u
  JOIN date_dim ON date_sk = d_date_sk
  JOIN {dim} ON outlet = {dim_key}
  WHERE d_date BETWEEN DATE '1998-08-04' AND DATE '1998-08-18'
  GROUP BY {dim_id}"""


_Z = "CAST(0 AS DECIMAL(7,2))"
register(q05=f"""
WITH ssr AS ({_sr(f"SELECT ss_store_sk AS outlet, ss_sold_date_sk AS date_sk, ss_ext_sales_price AS sales, "
                  f"ss_net_profit AS profit, {_Z} AS returns, {_Z} AS loss FROM store_sales",
                  f"SELECT sr_store_sk, sr_returned_date_sk, {_Z}, {_Z}, sr_return_amt, sr_net_loss "
                  f"FROM store_returns", "store", "s_store_sk", "s_store_id")}),
csr AS ({_sr(f"SELECT cs_catalog_page_sk AS outlet, cs_sold_date_sk AS date_sk, cs_ext_sales_price AS sales, "
             f"cs_net_profit AS profit, {_Z} AS returns, {_Z} AS loss FROM catalog_sales",
             f"SELECT cr_catalog_page_sk, cr_returned_date_sk, {_Z}, {_Z}, cr_return_amount, cr_net_loss "
             f"FROM catalog_returns", "catalog_page", "cp_catalog_page_sk", "cp_catalog_page_id")}),
wsr AS ({_sr(f"SELECT ws_web_site_sk AS outlet, ws_sold_date_sk AS date_sk, ws_ext_sales_price AS sales, "
             f"ws_net_profit AS profit, {_Z} AS returns, {_Z} AS loss FROM web_sales",
             f"SELECT ws.ws_web_site_sk, wr_returned_date_sk, {_Z}, {_Z}, wr_return_amt, wr_net_loss "
             f"FROM web_returns LEFT JOIN web_sales ws ON wr_item_sk = ws.ws_item_sk "
             f"AND wr_order_number = ws.ws_order_number", "web_site", "web_site_sk", "web_site_id")}),
x AS (
  SELECT 'store channel' AS channel, 'store' || oid AS id, sales, returns, profit - loss AS profit FROM ssr
  UNION ALL
  SELECT 'catalog channel', 'catalog_page' || oid, sales, returns, profit - loss FROM csr
  UNION ALL
  SELECT 'web channel', 'web_site' || oid, sales, returns, profit - loss FROM wsr)
SELECT channel, id, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(returns) AS DOUBLE) AS returns,
       CAST(sum(profit) AS DOUBLE) AS profit
FROM x
GROUP BY ROLLUP (channel, id)
{ob("channel, id", "channel, id, sales, returns, profit")}
""")

register(q06=f"""
WITH cat AS (SELECT i_category AS cat, sum(i_current_price) AS ps, count(i_current_price) AS pc
             FROM item GROUP BY i_category),
hot AS (SELECT i_item_sk FROM item JOIN cat ON i_category = cat
        WHERE i_current_price * pc * 10 > ps * 12)
SELECT ca_state AS state, count(*) AS cnt
FROM store_sales
JOIN date_dim ON ss_sold_date_sk = d_date_sk
JOIN hot ON ss_item_sk = hot.i_item_sk
JOIN customer ON ss_customer_sk = c_customer_sk
JOIN customer_address ON c_current_addr_sk = ca_address_sk
WHERE d_month_seq = (SELECT DISTINCT d_month_seq FROM date_dim WHERE d_year = 2000 AND d_moy = 2)
GROUP BY ca_state
HAVING count(*) >= 10
{ob("cnt, state", "state, cnt")}
""")

register(q07=f"""
SELECT i_item_id,
       CAST(sum(ss_quantity) AS DOUBLE) / count(ss_quantity) AS agg1,
       CAST(sum(ss_list_price) AS DOUBLE) / count(ss_list_price) AS agg2,
       CAST(sum(ss_coupon_amt) AS DOUBLE) / count(ss_coupon_amt) AS agg3,
       CAST(sum(ss_sales_price) AS DOUBLE) / count(ss_sales_price) AS agg4
FROM store_sales
JOIN customer_demographics ON ss_cdemo_sk = cd_demo_sk
JOIN date_dim ON ss_sold_date_sk = d_date_sk
JOIN item ON ss_item_sk = i_item_sk
JOIN promotion ON ss_promo_sk = p_promo_sk
WHERE cd_gender = 'F' AND cd_marital_status = 'W' AND cd_education_status = 'Primary'
  AND (p_channel_email = 'N' OR p_channel_event = 'N') AND d_year = 1998
GROUP BY i_item_id
{ob("i_item_id", "i_item_id, agg1, agg2, agg3, agg4")}
""")

_ZIPS = ", ".join(f"'{z}'" for z in Q08_ZIPS)
register(q08=f"""
WITH v1 AS (
  SELECT substr(ca_zip, 1, 5) AS zip FROM customer_address
  WHERE substr(ca_zip, 1, 5) IN ({_ZIPS})
  INTERSECT
  SELECT zip FROM (
    SELECT substr(ca_zip, 1, 5) AS zip, count(*) AS cnt
    FROM customer_address JOIN customer ON ca_address_sk = c_current_addr_sk
    WHERE c_preferred_cust_flag = 'Y'
    GROUP BY substr(ca_zip, 1, 5)
    HAVING count(*) > 10) a)
SELECT s_store_name, CAST(sum(ss_net_profit) AS DOUBLE) AS total_net_profit
FROM store_sales
JOIN date_dim ON ss_sold_date_sk = d_date_sk
JOIN store ON ss_store_sk = s_store_sk
JOIN v1 ON substr(s_zip, 1, 2) = substr(v1.zip, 1, 2)
WHERE d_qoy = 1 AND d_year = 2002
GROUP BY s_store_name
{ob("s_store_name", "s_store_name, total_net_profit")}
""")


def _bucket(lo, hi, th, i):
    rng = f"ss_quantity BETWEEN {lo} AND {hi}"
    return (f"CASE WHEN (SELECT count(*) FROM store_sales WHERE {rng}) > {th}\n"
            f"  THEN (SELECT CAST(sum(ss_ext_discount_amt) AS DOUBLE) / nullif(count(ss_ext_discount_amt), 0)"
            f" FROM store_sales WHERE {rng})\n"
            f"  ELSE (SELECT CAST(sum(ss_net_profit) AS DOUBLE) / nullif(count(ss_net_profit), 0)"
            f" FROM store_sales WHERE {rng}) END AS bucket{i}")


register(q09="SELECT " + ",\n".join(
    _bucket(lo, lo + 19, th, i + 1)
    for i, (lo, th) in enumerate(zip(range(1, 101, 20), (25437, 22746, 9387, 10098, 18213))))
    + "\nFROM reason WHERE r_reason_sk = 1\n")
