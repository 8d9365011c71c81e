"""Oracle SQL for q30-q39."""

from .registry import ob, register

_CUST = ("c_customer_id, c_salutation, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_day, "
         "c_birth_month, c_birth_year, c_birth_country, c_login, c_email_address, c_last_review_date")

register(q30=f"""
WITH ctr AS (
  SELECT wr_returning_customer_sk AS cust, ca_state AS st, sum(wr_return_amt) AS total
  FROM web_returns JOIN date_dim ON wr_returned_date_sk = d_date_sk
  JOIN customer_address ON wr_returning_addr_sk = ca_address_sk
  WHERE d_year = 2002
  GROUP BY wr_returning_customer_sk, ca_state)
SELECT {_CUST}, CAST(ctr1.total AS DOUBLE) AS ctr_total_return
FROM ctr ctr1
JOIN customer ON ctr1.cust = c_customer_sk
JOIN customer_address ON ca_address_sk = c_current_addr_sk
WHERE ca_state = 'IL'
  AND ctr1.total * (SELECT count(total) FROM ctr ctr2 WHERE ctr2.st = ctr1.st) * 10
      > (SELECT sum(total) FROM ctr ctr2 WHERE ctr2.st = ctr1.st) * 12
{ob(_CUST + ", ctr_total_return", "ctr_total_return")}
""")

register(q31=f"""
WITH ss AS (
  SELECT ca_county, d_qoy, d_year, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS store_sales
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk JOIN customer_address ON ss_addr_sk = ca_address_sk
  GROUP BY ca_county, d_qoy, d_year),
ws AS (
  SELECT ca_county, d_qoy, d_year, CAST(sum(ws_ext_sales_price) AS DOUBLE) AS web_sales
  FROM web_sales JOIN date_dim ON ws_sold_date_sk = d_date_sk
  JOIN customer_address ON ws_bill_addr_sk = ca_address_sk
  GROUP BY ca_county, d_qoy, d_year)
SELECT ss1.ca_county, ss1.d_year,
       ws2.web_sales / ws1.web_sales AS web_q1_q2_increase,
       ss2.store_sales / ss1.store_sales AS store_q1_q2_increase,
       ws3.web_sales / ws2.web_sales AS web_q2_q3_increase,
       ss3.store_sales / ss2.store_sales AS store_q2_q3_increase
FROM ss ss1
JOIN ss ss2 ON ss1.ca_county = ss2.ca_county
JOIN ss ss3 ON ss2.ca_county = ss3.ca_county
JOIN ws ws1 ON ss1.ca_county = ws1.ca_county
JOIN ws ws2 ON ws1.ca_county = ws2.ca_county
JOIN ws ws3 ON ws1.ca_county = ws3.ca_county
WHERE ss1.d_qoy = 1 AND ss1.d_year = 2000 AND ss2.d_qoy = 2 AND ss2.d_year = 2000
  AND ss3.d_qoy = 3 AND ss3.d_year = 2000 AND ws1.d_qoy = 1 AND ws1.d_year = 2000
  AND ws2.d_qoy = 2 AND ws2.d_year = 2000 AND ws3.d_qoy = 3 AND ws3.d_year = 2000
  AND CASE WHEN ws1.web_sales > 0 THEN ws2.web_sales / ws1.web_sales END
      > CASE WHEN ss1.store_sales > 0 THEN ss2.store_sales / ss1.store_sales END
  AND CASE WHEN ws2.web_sales > 0 THEN ws3.web_sales / ws2.web_sales END
      > CASE WHEN ss2.store_sales > 0 THEN ss3.store_sales / ss2.store_sales END
{ob("d_year", "ca_county, web_q1_q2_increase, store_q1_q2_increase, web_q2_q3_increase, store_q2_q3_increase", None)}
""")


def excess_discount_sql(fact, p, manufact, start, end):
    return f"""
SELECT CAST(sum({p}_ext_discount_amt) AS DOUBLE) AS "excess discount amount"
FROM {fact} f
JOIN item ON i_item_sk = f.{p}_item_sk
JOIN date_dim ON d_date_sk = f.{p}_sold_date_sk
WHERE i_manufact_id = {manufact}
  AND d_date BETWEEN DATE '{start}' AND DATE '{end}'
  AND f.{p}_ext_discount_amt * (
        SELECT count(x.{p}_ext_discount_amt) FROM {fact} x JOIN date_dim d2 ON d2.d_date_sk = x.{p}_sold_date_sk
        WHERE x.{p}_item_sk = i_item_sk AND d2.d_date BETWEEN DATE '{start}' AND DATE '{end}') * 10
      > (SELECT sum(x.{p}_ext_discount_amt) FROM {fact} x JOIN date_dim d2 ON d2.d_date_sk = x.{p}_sold_date_sk
         WHERE x.{p}_item_sk = i_item_sk AND d2.d_date BETWEEN DATE '{start}' AND DATE '{end}') * 13
"""


register(q32=excess_discount_sql("catalog_sales", "cs", 269, "1998-03-18", "1998-06-16"))


def channel_revenue_sql(key, item_filter, year, moy, gmt, order):
    parts = []
    for fact, p, addr in (("store_sales", "ss", "ss_addr_sk"), ("catalog_sales", "cs", "cs_bill_addr_sk"),
                          ("web_sales", "ws", "ws_bill_addr_sk")):
        parts.append(f"""
  SELECT {key}, sum({p}_ext_sales_price) AS total_sales
  FROM {fact} JOIN date_dim ON {p}_sold_date_sk = d_date_sk
  JOIN customer_address ON {addr} = ca_address_sk
  JOIN item ON {p}_item_sk = i_item_sk
  WHERE {key} IN (SELECT {key} FROM item WHERE {item_filter})
    AND d_year = {year} AND d_moy = {moy} AND ca_gmt_offset = {gmt}
  GROUP BY {key}""")
    return f"""
SELECT {key}, CAST(sum(total_sales) AS DOUBLE) AS total_sales
FROM ({" UNION ALL ".join(parts)}) u
GROUP BY {key}
{ob(order, key + ", total_sales")}
"""


register(q33=channel_revenue_sql("i_manufact_id", "i_category IN ('Books')", 1999, 3, -5, "total_sales"))


def ticket_sql(dom, potentials, years, ratio_cond):
    return f"""
  SELECT ss_ticket_number, ss_customer_sk, count(*) AS cnt
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk
  JOIN store ON ss_store_sk = s_store_sk
  JOIN household_demographics ON ss_hdemo_sk = hd_demo_sk
  WHERE ({dom}) AND hd_buy_potential IN ({potentials}) AND hd_vehicle_count > 0
    AND {ratio_cond}
    AND d_year IN ({years}) AND s_county IN ('Williamson County')
  GROUP BY ss_ticket_number, ss_customer_sk"""


_Q34_OUT = "c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number, cnt"
register(q34=f"""
SELECT {_Q34_OUT}
FROM ({ticket_sql("d_dom BETWEEN 1 AND 3 OR d_dom BETWEEN 25 AND 28", "'>10000', 'Unknown'", "1998, 1999, 2000",
                  "CASE WHEN hd_vehicle_count > 0 THEN hd_dep_count / hd_vehicle_count END > 1.2")}) dn
JOIN customer ON ss_customer_sk = c_customer_sk
WHERE cnt BETWEEN 15 AND 20
{ob("c_last_name, c_first_name, c_salutation, c_preferred_cust_flag DESC, ss_ticket_number", _Q34_OUT, None)}
""")


def _dep(col, i):
    return (f"{col}, count(*) AS cnt{i}, CAST(sum({col}) AS DOUBLE) / count({col}) AS aggone{i}, "
            f"max({col}) AS aggtwo{i}, CAST(sum({col}) AS BIGINT) AS aggthree{i}")


_Q35_KEYS = ("ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, "
             "cd_dep_college_count")
register(q35=f"""
SELECT ca_state, cd_gender, cd_marital_status,
       {_dep("cd_dep_count", 1)}, {_dep("cd_dep_employed_count", 2)}, {_dep("cd_dep_college_count", 3)}
FROM customer cu
JOIN customer_address ON cu.c_current_addr_sk = ca_address_sk
JOIN customer_demographics ON cd_demo_sk = cu.c_current_cdemo_sk
WHERE EXISTS (SELECT 1 FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk
              WHERE ss_customer_sk = cu.c_customer_sk AND d_year = 1999 AND d_qoy < 4)
  AND (EXISTS (SELECT 1 FROM web_sales JOIN date_dim ON ws_sold_date_sk = d_date_sk
               WHERE ws_bill_customer_sk = cu.c_customer_sk AND d_year = 1999 AND d_qoy < 4)
       OR EXISTS (SELECT 1 FROM catalog_sales JOIN date_dim ON cs_sold_date_sk = d_date_sk
                  WHERE cs_ship_customer_sk = cu.c_customer_sk AND d_year = 1999 AND d_qoy < 4))
GROUP BY {_Q35_KEYS}
{ob(_Q35_KEYS, "cnt1, aggone1, aggtwo1, aggthree1, cnt2, aggone2, aggtwo2, aggthree2, cnt3, aggone3, aggtwo3, aggthree3")}
""")

register(q36=f"""
SELECT gross_margin, i_category, i_class, lochierarchy, rank_within_parent FROM (
  SELECT CAST(sum(ss_net_profit) AS DOUBLE) / CAST(sum(ss_ext_sales_price) AS DOUBLE) AS gross_margin,
         i_category, i_class,
         CAST(grouping(i_category) + grouping(i_class) AS BIGINT) AS lochierarchy,
         rank() OVER (PARTITION BY grouping(i_category) + grouping(i_class),
                                   CASE WHEN grouping(i_class) = 0 THEN i_category END
                      ORDER BY CAST(sum(ss_net_profit) AS DOUBLE) / CAST(sum(ss_ext_sales_price) AS DOUBLE)
                      ) AS rank_within_parent
  FROM store_sales
  JOIN date_dim d1 ON d1.d_date_sk = ss_sold_date_sk
  JOIN item ON i_item_sk = ss_item_sk
  JOIN store ON s_store_sk = ss_store_sk
  WHERE d1.d_year = 2000 AND s_state IN ('TN')
  GROUP BY ROLLUP (i_category, i_class)) r
{ob("lochierarchy DESC, CASE WHEN lochierarchy = 0 THEN i_category END, rank_within_parent",
    "gross_margin, i_category, i_class")}
""")


def stock_sold_sql(fact, item_col, price_lo, manufacts, start, end):
    return f"""
SELECT i_item_id, i_item_desc, CAST(i_current_price AS DOUBLE) AS i_current_price
FROM item
JOIN inventory ON inv_item_sk = i_item_sk
JOIN date_dim ON d_date_sk = inv_date_sk
JOIN {fact} ON {item_col} = i_item_sk
WHERE i_current_price BETWEEN {price_lo} AND {price_lo + 30}
  AND d_date BETWEEN DATE '{start}' AND DATE '{end}'
  AND i_manufact_id IN ({manufacts}) AND inv_quantity_on_hand BETWEEN 100 AND 500
GROUP BY i_item_id, i_item_desc, i_current_price
{ob("i_item_id", "i_item_desc, i_current_price")}
"""


register(q37=stock_sold_sql("catalog_sales", "cs_item_sk", 22, "678, 964, 918, 849", "2001-06-02", "2001-08-01"))

register(q38="""
SELECT count(*) AS hot_cust_count FROM (
  SELECT DISTINCT c_last_name, c_first_name, d_date
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk JOIN customer ON ss_customer_sk = c_customer_sk
  WHERE d_month_seq BETWEEN 1212 AND 1223
  INTERSECT
  SELECT DISTINCT c_last_name, c_first_name, d_date
  FROM catalog_sales JOIN date_dim ON cs_sold_date_sk = d_date_sk
  JOIN customer ON cs_bill_customer_sk = c_customer_sk
  WHERE d_month_seq BETWEEN 1212 AND 1223
  INTERSECT
  SELECT DISTINCT c_last_name, c_first_name, d_date
  FROM web_sales JOIN date_dim ON ws_sold_date_sk = d_date_sk JOIN customer ON ws_bill_customer_sk = c_customer_sk
  WHERE d_month_seq BETWEEN 1212 AND 1223) hot
""")


def _q39(extra):
    out = "w_warehouse_sk, i_item_sk, d_moy, mean, cov, w_warehouse_sk2, i_item_sk2, d_moy2, mean2, cov2"
    return f"""
WITH inv AS (
  SELECT w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy, stdev, mean,
         CASE mean WHEN 0 THEN NULL ELSE stdev / mean END AS cov
  FROM (SELECT w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy,
               stddev_samp(inv_quantity_on_hand) AS stdev, avg(inv_quantity_on_hand) AS mean
        FROM inventory JOIN item ON inv_item_sk = i_item_sk
        JOIN warehouse ON inv_warehouse_sk = w_warehouse_sk
        JOIN date_dim ON inv_date_sk = d_date_sk
        WHERE d_year = 1998
        GROUP BY w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy) foo
  WHERE CASE mean WHEN 0 THEN 0 ELSE stdev / mean END > 1)
SELECT inv1.w_warehouse_sk, inv1.i_item_sk, inv1.d_moy, inv1.mean, round(inv1.cov, 6) AS cov,
       inv2.w_warehouse_sk AS w_warehouse_sk2, inv2.i_item_sk AS i_item_sk2, inv2.d_moy AS d_moy2,
       inv2.mean AS mean2, round(inv2.cov, 6) AS cov2
FROM inv inv1 JOIN inv inv2 ON inv1.i_item_sk = inv2.i_item_sk AND inv1.w_warehouse_sk = inv2.w_warehouse_sk
WHERE inv1.d_moy = 4 AND inv2.d_moy = 5 {extra}
{ob("w_warehouse_sk, i_item_sk, d_moy, mean, cov, d_moy2, mean2, cov2", out, None)}
"""


register(q39a=_q39(""), q39b=_q39("AND inv1.cov > 1.5"))
