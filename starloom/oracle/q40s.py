"""Oracle SQL for q40-q49."""

from .registry import ob, register

register(q40=f"""
SELECT w_state, i_item_id,
       CAST(sum(CASE WHEN d_date < DATE '1998-04-08' THEN cs_sales_price - coalesce(cr_refunded_cash, 0)
                     ELSE 0 END) AS DOUBLE) AS sales_before,
       CAST(sum(CASE WHEN d_date >= DATE '1998-04-08' THEN cs_sales_price - coalesce(cr_refunded_cash, 0)
                     ELSE 0 END) AS DOUBLE) AS sales_after
FROM catalog_sales
LEFT JOIN catalog_returns ON cs_order_number = cr_order_number AND cs_item_sk = cr_item_sk
JOIN warehouse ON cs_warehouse_sk = w_warehouse_sk
JOIN item ON i_item_sk = cs_item_sk
JOIN date_dim ON cs_sold_date_sk = d_date_sk
WHERE i_current_price BETWEEN 0.99 AND 1.49
  AND d_date BETWEEN DATE '1998-03-09' AND DATE '1998-05-08'
GROUP BY w_state, i_item_id
{ob("w_state, i_item_id", "sales_before, sales_after")}
""")

_COMBOS = (
    ("Women", ("orchid", "papaya"), ("Pound", "Lb"), ("petite", "medium")),
    ("Women", ("burlywood", "navy"), ("Bundle", "Each"), ("N/A", "extra large")),
    ("Men", ("bisque", "azure"), ("N/A", "Tsp"), ("small", "large")),
    ("Men", ("chocolate", "cornflower"), ("Bunch", "Gross"), ("petite", "medium")),
    ("Women", ("salmon", "midnight"), ("Oz", "Box"), ("petite", "medium")),
    ("Women", ("snow", "steel"), ("Carton", "Tbl"), ("N/A", "extra large")),
    ("Men", ("purple", "gainsboro"), ("Dram", "Unknown"), ("small", "large")),
    ("Men", ("metallic", "forest"), ("Gram", "Ounce"), ("petite", "medium")),
)
_combo_sql = "\n     OR ".join(
    f"(i_category = '{cat}' AND (i_color = '{a}' OR i_color = '{b}') AND (i_units = '{u1}' OR i_units = '{u2}')"
    f" AND (i_size = '{s1}' OR i_size = '{s2}'))"
    for cat, (a, b), (u1, u2), (s1, s2) in _COMBOS)
register(q41=f"""
SELECT DISTINCT i_product_name
FROM item i1
WHERE i_manufact_id BETWEEN 742 AND 782
  AND (SELECT count(*) FROM item WHERE i_manufact = i1.i_manufact AND ({_combo_sql})) > 0
{ob("i_product_name", "i_product_name")}
""")

register(q42=f"""
SELECT d_year, i_category_id, i_category, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS total_sales
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN item ON ss_item_sk = i_item_sk
WHERE i_manager_id = 1 AND d_moy = 12 AND d_year = 1998
GROUP BY d_year, i_category_id, i_category
{ob("total_sales DESC, d_year, i_category_id, i_category", "total_sales")}
""")

_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_SHORT = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]
_wk = ", ".join(f"CAST(sum(CASE WHEN d_day_name = '{d}' THEN ss_sales_price END) AS DOUBLE) AS {s}_sales"
                for d, s in zip(_DAYS, _SHORT))
_wk_cols = ", ".join(f"{s}_sales" for s in _SHORT)
register(q43=f"""
SELECT s_store_name, s_store_id, {_wk}
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk
WHERE s_gmt_offset = -5 AND d_year = 1998
GROUP BY s_store_name, s_store_id
{ob("s_store_name, s_store_id, " + _wk_cols, _wk_cols)}
""")

register(q44=f"""
WITH base AS (SELECT sum(ss_net_profit) AS bs, count(ss_net_profit) AS bn
              FROM store_sales WHERE ss_store_sk = 2 AND ss_hdemo_sk IS NULL GROUP BY ss_store_sk),
v AS (SELECT ss_item_sk AS item_sk, CAST(sum(ss_net_profit) AS DOUBLE) / count(ss_net_profit) AS rank_col
      FROM store_sales WHERE ss_store_sk = 2
      GROUP BY ss_item_sk
      HAVING sum(ss_net_profit) * (SELECT bn FROM base) * 10 > (SELECT bs FROM base) * 9 * count(ss_net_profit)),
asc_r AS (SELECT * FROM (SELECT item_sk, rank() OVER (ORDER BY rank_col) AS rnk FROM v) a WHERE rnk < 11),
desc_r AS (SELECT * FROM (SELECT item_sk, rank() OVER (ORDER BY rank_col DESC) AS rnk FROM v) d WHERE rnk < 11)
SELECT CAST(asc_r.rnk AS BIGINT) AS rnk, i1.i_product_name AS best_performing, i2.i_product_name AS worst_performing
FROM asc_r JOIN desc_r ON asc_r.rnk = desc_r.rnk
JOIN item i1 ON i1.i_item_sk = asc_r.item_sk
JOIN item i2 ON i2.i_item_sk = desc_r.item_sk
{ob("rnk", "best_performing, worst_performing")}
""")

register(q45=f"""
SELECT ca_zip, ca_county, CAST(sum(ws_sales_price) AS DOUBLE) AS total_sales
FROM web_sales
JOIN customer ON ws_bill_customer_sk = c_customer_sk
JOIN customer_address ON c_current_addr_sk = ca_address_sk
JOIN item ON ws_item_sk = i_item_sk
JOIN date_dim ON ws_sold_date_sk = d_date_sk
WHERE (substr(ca_zip, 1, 5) IN ('85669', '86197', '88274', '83405', '86475', '85392', '85460', '80348', '81792')
       OR i_item_id IN (SELECT i_item_id FROM item WHERE i_item_sk IN (2, 3, 5, 7, 11, 13, 17, 19, 23, 29)))
  AND d_qoy = 2 AND d_year = 2000
GROUP BY ca_zip, ca_county
{ob("ca_zip, ca_county", "total_sales")}
""")


def ticket_city_sql(select_aggs, dow, years, hd_cond, out_cols, order):
    return f"""
SELECT {out_cols}
FROM (
  SELECT ss_ticket_number, ss_customer_sk, ca_city AS bought_city, {select_aggs}
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk
  JOIN store ON ss_store_sk = s_store_sk
  JOIN household_demographics ON ss_hdemo_sk = hd_demo_sk
  JOIN customer_address ON ss_addr_sk = ca_address_sk
  WHERE ({hd_cond}) AND {dow} AND d_year IN ({years}) AND s_city IN ('Midway', 'Fairview')
  GROUP BY ss_ticket_number, ss_customer_sk, ss_addr_sk, ca_city) dn
JOIN customer ON ss_customer_sk = c_customer_sk
JOIN customer_address cur ON c_current_addr_sk = cur.ca_address_sk
WHERE cur.ca_city <> bought_city
{ob(order, out_cols)}
"""


register(q46=ticket_city_sql(
    "CAST(sum(ss_coupon_amt) AS DOUBLE) AS amt, CAST(sum(ss_net_profit) AS DOUBLE) AS profit",
    "d_dow IN (6, 0)", "1999, 2000, 2001", "hd_dep_count = 5 OR hd_vehicle_count = 3",
    "c_last_name, c_first_name, cur.ca_city AS ca_city, bought_city, ss_ticket_number, amt, profit",
    "c_last_name, c_first_name, ca_city, bought_city, ss_ticket_number"))


def monthly_deviation_sql(fact, p, outlet_join, outlet_cols, item_filter="TRUE"):
    keys = f"i_category, i_brand, {outlet_cols}"
    names = [k.strip() for k in keys.split(",")]
    lag_on = " AND ".join(f"v1.{k} = lg.{k}" for k in names)
    lead_on = " AND ".join(f"v1.{k} = ld.{k}" for k in names)
    return f"""
WITH v1 AS (
  SELECT {keys}, d_year, d_moy, sum({p}_sales_price) AS sum_sales,
         CAST(sum(sum({p}_sales_price)) OVER (PARTITION BY {keys}, d_year) AS DOUBLE)
           / count(sum({p}_sales_price)) OVER (PARTITION BY {keys}, d_year) AS avg_monthly_sales,
         rank() OVER (PARTITION BY {keys} ORDER BY d_year, d_moy) AS rn
  FROM {fact} JOIN item ON {p}_item_sk = i_item_sk JOIN date_dim ON {p}_sold_date_sk = d_date_sk
  {outlet_join}
  WHERE ({item_filter}) AND (d_year = 2000 OR (d_year = 1999 AND d_moy = 12) OR (d_year = 2001 AND d_moy = 1))
  GROUP BY {keys}, d_year, d_moy),
v2 AS (
  SELECT v1.*, CAST(lg.sum_sales AS DOUBLE) AS psum, CAST(ld.sum_sales AS DOUBLE) AS nsum
  FROM v1 JOIN v1 lg ON {lag_on} AND v1.rn = lg.rn + 1
  JOIN v1 ld ON {lead_on} AND v1.rn = ld.rn - 1)
"""


register(q47=monthly_deviation_sql("store_sales", "ss", "JOIN store ON ss_store_sk = s_store_sk",
                                   "s_store_name, s_company_name") + f"""
SELECT i_category, i_brand, d_year, d_moy, avg_monthly_sales, CAST(sum_sales AS DOUBLE) AS sum_sales, psum, nsum
FROM v2
WHERE d_year = 2000 AND avg_monthly_sales > 0
  AND CASE WHEN avg_monthly_sales > 0
           THEN abs(CAST(sum_sales AS DOUBLE) - avg_monthly_sales) / avg_monthly_sales END > 0.1
ORDER BY CAST(sum_sales AS DOUBLE) - avg_monthly_sales NULLS LAST, nsum NULLS LAST, i_category NULLS LAST,
         i_brand NULLS LAST, d_year NULLS LAST, d_moy NULLS LAST, avg_monthly_sales NULLS LAST,
         sum_sales NULLS LAST, psum NULLS LAST, s_store_name NULLS LAST, s_company_name NULLS LAST
LIMIT 100
""")

register(q48="""
WITH people(marital, education, low, high) AS (
  VALUES ('M', '4 yr Degree', 100, 150), ('D', 'Primary', 50, 100), ('U', 'Advanced Degree', 150, 200)),
places(state, least, most) AS (
  VALUES ('KY', 0, 2000), ('GA', 0, 2000), ('NM', 0, 2000), ('MT', 150, 3000), ('OR', 150, 3000), ('IN', 150, 3000),
         ('WI', 50, 25000), ('MO', 50, 25000), ('WV', 50, 25000))
SELECT CAST(sum(ss_quantity) AS BIGINT) AS total_quantity
FROM store_sales
JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year = 1998
JOIN store ON s_store_sk = ss_store_sk
JOIN customer_demographics ON cd_demo_sk = ss_cdemo_sk
JOIN customer_address ON ca_address_sk = ss_addr_sk AND ca_country = 'United States'
JOIN people ON marital = cd_marital_status AND education = cd_education_status AND ss_sales_price BETWEEN low AND high
JOIN places ON state = ca_state AND ss_net_profit BETWEEN least AND most
""")


def _ranks(ch, sales, p, returns, rp, tk, rtk, amt):
    return f"""
  SELECT '{ch}' AS channel, item, return_ratio, return_rank, currency_rank FROM (
    SELECT item, return_ratio, CAST(rank() OVER (ORDER BY return_ratio) AS BIGINT) AS return_rank,
           CAST(rank() OVER (ORDER BY currency_ratio) AS BIGINT) AS currency_rank
    FROM (
      SELECT s.{p}_item_sk AS item,
             CAST(sum(coalesce(r.{rp}_return_quantity, 0)) AS DOUBLE)
               / CAST(sum(coalesce(s.{p}_quantity, 0)) AS DOUBLE) AS return_ratio,
             CAST(sum(coalesce(r.{amt}, 0)) AS DOUBLE) / CAST(sum(coalesce(s.{p}_net_paid, 0)) AS DOUBLE)
               AS currency_ratio
      FROM {sales} s LEFT JOIN {returns} r ON s.{tk} = r.{rtk} AND s.{p}_item_sk = r.{rp}_item_sk
      JOIN date_dim ON s.{p}_sold_date_sk = d_date_sk
      WHERE r.{amt} > 10000 AND s.{p}_net_profit > 1 AND s.{p}_net_paid > 0 AND s.{p}_quantity > 0
        AND d_year = 2000 AND d_moy = 12
      GROUP BY s.{p}_item_sk) x) y
  WHERE return_rank <= 10 OR currency_rank <= 10"""


register(q49=f"""
SELECT channel, item, return_ratio, return_rank, currency_rank FROM (
{_ranks("web", "web_sales", "ws", "web_returns", "wr", "ws_order_number", "wr_order_number", "wr_return_amt")}
  UNION
{_ranks("catalog", "catalog_sales", "cs", "catalog_returns", "cr", "cs_order_number", "cr_order_number", "cr_return_amount")}
  UNION
{_ranks("store", "store_sales", "ss", "store_returns", "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt")}
) x
{ob("channel, return_rank, currency_rank, item", "return_ratio")}
""")
