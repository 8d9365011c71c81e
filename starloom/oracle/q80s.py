"""Oracle SQL for q81-q99."""

from .q30s import stock_sold_sql
from .registry import ob, register

_Q81_OUT = ("c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, "
            "ca_street_type, ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, ca_gmt_offset, "
            "ca_location_type, ctr_total_return")
register(q81=f"""
WITH ctr AS (
  SELECT cr_returning_customer_sk AS cust, ca_state AS st, sum(cr_return_amt_inc_tax) AS total
  FROM catalog_returns JOIN date_dim ON cr_returned_date_sk = d_date_sk
  JOIN customer_address ON cr_returning_addr_sk = ca_address_sk
  WHERE d_year = 1998
  GROUP BY cr_returning_customer_sk, ca_state)
SELECT c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, ca_street_type,
       ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, CAST(ca_gmt_offset AS DOUBLE) AS ca_gmt_offset,
       ca_location_type, CAST(ctr1.total AS DOUBLE) AS ctr_total_return
FROM ctr ctr1
JOIN customer ON ctr1.cust = c_customer_sk
JOIN customer_address ON ca_address_sk = c_current_addr_sk
WHERE ca_state = 'IL'
  AND ctr1.total * (SELECT count(total) FROM ctr ctr2 WHERE ctr2.st = ctr1.st) * 10
      > (SELECT sum(total) FROM ctr ctr2 WHERE ctr2.st = ctr1.st) * 12
{ob(_Q81_OUT, _Q81_OUT)}
""")

register(q82=stock_sold_sql("store_sales", "ss_item_sk", 30, "437, 129, 727, 663", "2002-05-30", "2002-07-29"))


def _ret_items(returns, p, name):
    return f"""
  SELECT i_item_id AS item_id, CAST(sum({p}_return_quantity) AS BIGINT) AS {name}
  FROM {returns} JOIN item ON {p}_item_sk = i_item_sk JOIN date_dim ON {p}_returned_date_sk = d_date_sk
  WHERE d_date IN (SELECT d_date FROM date_dim WHERE d_week_seq IN (
                     SELECT d_week_seq FROM date_dim
                     WHERE d_date IN (DATE '1998-01-02', DATE '1998-10-15', DATE '1998-11-10')))
  GROUP BY i_item_id"""


_TOT = "CAST(sr_item_qty + cr_item_qty + wr_item_qty AS DOUBLE)"
register(q83=f"""
WITH sr AS ({_ret_items("store_returns", "sr", "sr_item_qty")}),
cr AS ({_ret_items("catalog_returns", "cr", "cr_item_qty")}),
wr AS ({_ret_items("web_returns", "wr", "wr_item_qty")})
SELECT sr.item_id, sr_item_qty, CAST(sr_item_qty AS DOUBLE) / {_TOT} / 3.0 * 100 AS sr_dev,
       cr_item_qty, CAST(cr_item_qty AS DOUBLE) / {_TOT} / 3.0 * 100 AS cr_dev,
       wr_item_qty, CAST(wr_item_qty AS DOUBLE) / {_TOT} / 3.0 * 100 AS wr_dev,
       {_TOT} / 3.0 AS average
FROM sr JOIN cr ON sr.item_id = cr.item_id JOIN wr ON sr.item_id = wr.item_id
{ob("item_id, sr_item_qty", "sr_dev, cr_item_qty, cr_dev, wr_item_qty, wr_dev, average")}
""")

register(q84=f"""
SELECT c_customer_id AS customer_id,
       coalesce(c_last_name, '') || ', ' || coalesce(c_first_name, '') AS customername
FROM customer, customer_address, customer_demographics, household_demographics, income_band, store_returns
WHERE ca_city = 'Hopewell' AND c_current_addr_sk = ca_address_sk
  AND ib_lower_bound >= 32287 AND ib_upper_bound <= 82287
  AND ib_income_band_sk = hd_income_band_sk AND cd_demo_sk = c_current_cdemo_sk
  AND hd_demo_sk = c_current_hdemo_sk AND sr_cdemo_sk = cd_demo_sk
{ob("customer_id", "customername")}
""")

register(q85=f"""
WITH people(marital, education, low, high) AS (
  VALUES ('M', '4 yr Degree', 100, 150), ('D', 'Primary', 50, 100), ('U', 'Advanced Degree', 150, 200)),
places(state, least, most) AS (
  VALUES ('KY', 100, 200), ('GA', 100, 200), ('NM', 100, 200), ('MT', 150, 300), ('OR', 150, 300), ('IN', 150, 300),
         ('WI', 50, 250), ('MO', 50, 250), ('WV', 50, 250))
SELECT substr(r_reason_desc, 1, 20) AS reason_desc_substr,
       CAST(sum(ws_quantity) AS DOUBLE) / count(ws_quantity) AS avg_ws_quantity,
       CAST(sum(wr_refunded_cash) AS DOUBLE) / count(wr_refunded_cash) AS avg_wr_refunded_cash,
       CAST(sum(wr_fee) AS DOUBLE) / count(wr_fee) AS avg_wr_fee
FROM web_returns
JOIN reason ON r_reason_sk = wr_reason_sk
JOIN customer_demographics payer ON payer.cd_demo_sk = wr_refunded_cdemo_sk
JOIN customer_demographics giver ON giver.cd_demo_sk = wr_returning_cdemo_sk
JOIN customer_address ON ca_address_sk = wr_refunded_addr_sk AND ca_country = 'United States'
JOIN web_sales ON ws_order_number = wr_order_number AND ws_item_sk = wr_item_sk
JOIN web_page ON wp_web_page_sk = ws_web_page_sk
JOIN date_dim ON d_date_sk = ws_sold_date_sk AND d_year = 1998
JOIN people ON marital = payer.cd_marital_status AND marital = giver.cd_marital_status
           AND education = payer.cd_education_status AND education = giver.cd_education_status
           AND ws_sales_price BETWEEN low AND high
JOIN places ON state = ca_state AND ws_net_profit BETWEEN least AND most
GROUP BY r_reason_desc
{ob("reason_desc_substr, avg_ws_quantity, avg_wr_refunded_cash, avg_wr_fee", "reason_desc_substr")}
""")

register(q86=f"""
WITH paid AS (
  SELECT i_category, i_class, ws_net_paid
  FROM date_dim JOIN web_sales ON ws_sold_date_sk = d_date_sk JOIN item ON i_item_sk = ws_item_sk
  WHERE d_month_seq >= 1212 AND d_month_seq < 1224),
levels AS (
  SELECT i_category, i_class, sum(ws_net_paid) AS total, 0 AS level FROM paid GROUP BY i_category, i_class
  UNION ALL
  SELECT i_category, NULL, sum(ws_net_paid), 1 FROM paid GROUP BY i_category
  UNION ALL
  SELECT NULL, NULL, sum(ws_net_paid), 2 FROM paid)
SELECT CAST(total AS DOUBLE) AS total_sum, i_category, i_class, CAST(level AS BIGINT) AS lochierarchy,
       CAST(rank() OVER (PARTITION BY level, CASE level WHEN 0 THEN i_category END ORDER BY total DESC) AS BIGINT) AS rank_within_parent
FROM levels
{ob("lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN i_category END, rank_within_parent",
    "total_sum, i_category, i_class")}
""")


def _visits(fact, buyer, day):
    return f"""
  SELECT c_last_name, c_first_name, d_date
  FROM customer JOIN {fact} ON {buyer} = c_customer_sk JOIN date_dim ON d_date_sk = {day}
  WHERE d_month_seq >= 1212 AND d_month_seq < 1224"""


register(q87=f"""
WITH elsewhere AS ({_visits("web_sales", "ws_bill_customer_sk", "ws_sold_date_sk")}
  UNION{_visits("catalog_sales", "cs_bill_customer_sk", "cs_sold_date_sk")}),
stores_only AS ({_visits("store_sales", "ss_customer_sk", "ss_sold_date_sk")}
  EXCEPT SELECT * FROM elsewhere)
SELECT count(*) AS cool_cust_count FROM stores_only
""")

_SLOTS = (("h8_30_to_9", 8, ">= 30"), ("h9_to_9_30", 9, "< 30"), ("h9_30_to_10", 9, ">= 30"),
          ("h10_to_10_30", 10, "< 30"), ("h10_30_to_11", 10, ">= 30"), ("h11_to_11_30", 11, "< 30"),
          ("h11_30_to_12", 11, ">= 30"), ("h12_to_12_30", 12, "< 30"))
register(q88="SELECT * FROM " + ",\n".join(f"""
(SELECT count(*) AS {name}
 FROM store_sales JOIN household_demographics ON ss_hdemo_sk = hd_demo_sk
 JOIN time_dim ON ss_sold_time_sk = t_time_sk JOIN store ON ss_store_sk = s_store_sk
 WHERE t_hour = {h} AND t_minute {cond}
   AND ((hd_dep_count = 3 AND hd_vehicle_count <= 5) OR (hd_dep_count = 0 AND hd_vehicle_count <= 2)
        OR (hd_dep_count = 1 AND hd_vehicle_count <= 3))
   AND s_store_name = 'ese') s{i}""" for i, (name, h, cond) in enumerate(_SLOTS, 1)))

_Q89_OUT = "i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, sum_sales, avg_monthly_sales"
register(q89=f"""
SELECT * FROM (
  SELECT i_category, i_class, i_brand, s_store_name, s_company_name, d_moy,
         CAST(sum(ss_sales_price) AS DOUBLE) AS sum_sales,
         CAST(sum(sum(ss_sales_price)) OVER (PARTITION BY i_category, i_brand, s_store_name, s_company_name) AS DOUBLE)
           / count(sum(ss_sales_price)) OVER (PARTITION BY i_category, i_brand, s_store_name, s_company_name)
           AS avg_monthly_sales
  FROM store_sales JOIN item ON ss_item_sk = i_item_sk JOIN date_dim ON ss_sold_date_sk = d_date_sk
  JOIN store ON ss_store_sk = s_store_sk
  WHERE d_year IN (2000)
    AND ((i_category IN ('Home', 'Books', 'Electronics') AND i_class IN ('wallpaper', 'parenting', 'musical'))
      OR (i_category IN ('Shoes', 'Jewelry', 'Men') AND i_class IN ('womens', 'birdal', 'pants')))
  GROUP BY i_category, i_class, i_brand, s_store_name, s_company_name, d_moy) tmp1
WHERE CASE WHEN avg_monthly_sales <> 0 THEN abs(sum_sales - avg_monthly_sales) / avg_monthly_sales END > 0.1
{ob("sum_sales - avg_monthly_sales, s_store_name", _Q89_OUT)}
""")


def _hours(lo):
    return f"""
  SELECT count(*) AS n FROM web_sales
  JOIN household_demographics ON ws_ship_hdemo_sk = hd_demo_sk
  JOIN time_dim ON ws_sold_time_sk = t_time_sk
  JOIN web_page ON ws_web_page_sk = wp_web_page_sk
  WHERE t_hour BETWEEN {lo} AND {lo + 1} AND hd_dep_count = 8 AND wp_char_count BETWEEN 5000 AND 5200"""


register(q90=f"""
SELECT CAST(am.n AS DOUBLE) / nullif(CAST(pm.n AS DOUBLE), 0) AS am_pm_ratio
FROM ({_hours(6)}) am, ({_hours(14)}) pm
""")

register(q91="""
SELECT cc_call_center_id AS Call_Center, cc_name AS Call_Center_Name, cc_manager AS Manager,
       CAST(sum(cr_net_loss) AS DOUBLE) AS Returns_Loss
FROM call_center, catalog_returns, date_dim, customer, customer_address, customer_demographics,
     household_demographics
WHERE cr_call_center_sk = cc_call_center_sk AND cr_returned_date_sk = d_date_sk
  AND cr_returning_customer_sk = c_customer_sk AND cd_demo_sk = c_current_cdemo_sk
  AND hd_demo_sk = c_current_hdemo_sk AND ca_address_sk = c_current_addr_sk
  AND d_year = 1999 AND d_moy = 11
  AND ((cd_marital_status = 'M' AND cd_education_status = 'Unknown')
    OR (cd_marital_status = 'W' AND cd_education_status = 'Advanced Degree'))
  AND hd_buy_potential LIKE '0-500%' AND ca_gmt_offset = -7
GROUP BY cc_call_center_id, cc_name, cc_manager, cd_marital_status, cd_education_status
ORDER BY Returns_Loss DESC
""")

from .q30s import excess_discount_sql  # noqa: E402

register(q92=excess_discount_sql("web_sales", "ws", 269, "1998-03-18", "1998-06-16")
         .replace('"excess discount amount"', '"Excess Discount Amount"'))

register(q93=f"""
SELECT ss_customer_sk, CAST(sum(act_sales) AS DOUBLE) AS sumsales
FROM (SELECT ss_item_sk, ss_ticket_number, ss_customer_sk,
             CASE WHEN sr_return_quantity IS NOT NULL THEN (ss_quantity - sr_return_quantity) * ss_sales_price
                  ELSE ss_quantity * ss_sales_price END AS act_sales
      FROM store_sales LEFT JOIN store_returns ON sr_item_sk = ss_item_sk AND sr_ticket_number = ss_ticket_number,
           reason
      WHERE sr_reason_sk = r_reason_sk AND r_reason_desc = 'Did not like the warranty') t
GROUP BY ss_customer_sk
{ob("sumsales, ss_customer_sk", "ss_customer_sk")}
""")

register(q94="""
SELECT count(DISTINCT ws1.ws_order_number) AS "order count",
       CAST(sum(ws1.ws_ext_ship_cost) AS DOUBLE) AS "total shipping cost",
       CAST(sum(ws1.ws_net_profit) AS DOUBLE) AS "total net profit"
FROM web_sales ws1
JOIN date_dim ON ws1.ws_ship_date_sk = d_date_sk
JOIN customer_address ON ws1.ws_ship_addr_sk = ca_address_sk
JOIN web_site ON ws1.ws_web_site_sk = web_site_sk
WHERE d_date BETWEEN DATE '1999-05-01' AND DATE '1999-06-30' AND ca_state = 'TX' AND web_company_name = 'pri'
  AND EXISTS (SELECT 1 FROM web_sales ws2
              WHERE ws1.ws_order_number = ws2.ws_order_number AND ws1.ws_warehouse_sk <> ws2.ws_warehouse_sk)
  AND NOT EXISTS (SELECT 1 FROM web_returns wr1 WHERE ws1.ws_order_number = wr1.wr_order_number)
""")

register(q95="""
WITH ws_wh AS (
  SELECT ws1.ws_order_number, ws1.ws_warehouse_sk AS wh1, ws2.ws_warehouse_sk AS wh2
  FROM web_sales ws1 JOIN web_sales ws2 ON ws1.ws_order_number = ws2.ws_order_number
  WHERE ws1.ws_warehouse_sk <> ws2.ws_warehouse_sk)
SELECT count(DISTINCT ws1.ws_order_number) AS "order count",
       CAST(sum(ws1.ws_ext_ship_cost) AS DOUBLE) AS "total shipping cost",
       CAST(sum(ws1.ws_net_profit) AS DOUBLE) AS "total net profit"
FROM web_sales ws1
JOIN date_dim ON ws1.ws_ship_date_sk = d_date_sk
JOIN customer_address ON ws1.ws_ship_addr_sk = ca_address_sk
JOIN web_site ON ws1.ws_web_site_sk = web_site_sk
WHERE d_date BETWEEN DATE '1999-05-01' AND DATE '1999-06-30' AND ca_state = 'TX' AND web_company_name = 'pri'
  AND ws1.ws_order_number IN (SELECT ws_order_number FROM ws_wh)
  AND ws1.ws_order_number IN (SELECT wr_order_number FROM web_returns JOIN ws_wh
                              ON wr_order_number = ws_wh.ws_order_number)
""")

register(q96="""
SELECT count(*) AS store_sales_count
FROM store_sales JOIN household_demographics ON ss_hdemo_sk = hd_demo_sk
JOIN time_dim ON ss_sold_time_sk = t_time_sk JOIN store ON ss_store_sk = s_store_sk
WHERE t_hour = 8 AND t_minute >= 30 AND hd_dep_count = 5 AND s_store_name = 'ese'
""")

register(q97="""
WITH ssci AS (SELECT ss_customer_sk AS customer_sk, ss_item_sk AS item_sk
              FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk
              WHERE d_month_seq BETWEEN 1212 AND 1223 GROUP BY ss_customer_sk, ss_item_sk),
csci AS (SELECT cs_bill_customer_sk AS customer_sk, cs_item_sk AS item_sk
         FROM catalog_sales JOIN date_dim ON cs_sold_date_sk = d_date_sk
         WHERE d_month_seq BETWEEN 1212 AND 1223 GROUP BY cs_bill_customer_sk, cs_item_sk)
SELECT CAST(sum(CASE WHEN ssci.customer_sk IS NOT NULL AND csci.customer_sk IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS store_only,
       CAST(sum(CASE WHEN ssci.customer_sk IS NULL AND csci.customer_sk IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS catalog_only,
       CAST(sum(CASE WHEN ssci.customer_sk IS NOT NULL AND csci.customer_sk IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS store_and_catalog
FROM ssci FULL OUTER JOIN csci ON ssci.customer_sk = csci.customer_sk AND ssci.item_sk = csci.item_sk
""")

from .q10s import class_share_sql  # noqa: E402
from .q60s import ship_lag_sql  # noqa: E402

register(q98=class_share_sql("store_sales", "ss_item_sk", "ss_sold_date_sk", "ss_ext_sales_price",
                             "'Jewelry', 'Sports', 'Books'", "2001-01-12", "2001-02-11", None))
register(q99=ship_lag_sql("catalog_sales", "cs", "call_center", "call_center_sk", "cc_call_center_sk", "cc_name"))
