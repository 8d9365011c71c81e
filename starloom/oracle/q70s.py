"""Oracle SQL for q75-q80."""

from .registry import ob, register


def _detail(sales, p, returns, rp, key, rkey, ramt):
    return f"""
    SELECT d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id,
           {p}_quantity - coalesce({rp}_return_quantity, 0) AS sales_cnt,
           {p}_ext_sales_price - coalesce({ramt}, 0.0) AS sales_amt
    FROM {sales} JOIN item ON i_item_sk = {p}_item_sk JOIN date_dim ON d_date_sk = {p}_sold_date_sk
    LEFT JOIN {returns} ON {key} = {rkey} AND {p}_item_sk = {rp}_item_sk
    WHERE i_category = 'Sports'"""


_Q75_OUT = ("prev_year, year, i_brand_id, i_class_id, i_category_id, i_manufact_id, prev_yr_cnt, curr_yr_cnt, "
            "sales_cnt_diff, sales_amt_diff")
register(q75=f"""
WITH all_sales AS (
  SELECT d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id,
         CAST(sum(sales_cnt) AS BIGINT) AS sales_cnt, sum(sales_amt) AS sales_amt
  FROM ({_detail("catalog_sales", "cs", "catalog_returns", "cr", "cs_order_number", "cr_order_number", "cr_return_amount")}
    UNION{_detail("store_sales", "ss", "store_returns", "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt")}
    UNION{_detail("web_sales", "ws", "web_returns", "wr", "ws_order_number", "wr_order_number", "wr_return_amt")}) d
  GROUP BY d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id)
SELECT p.d_year AS prev_year, cy.d_year AS year, cy.i_brand_id, cy.i_class_id, cy.i_category_id, cy.i_manufact_id,
       p.sales_cnt AS prev_yr_cnt, cy.sales_cnt AS curr_yr_cnt, cy.sales_cnt - p.sales_cnt AS sales_cnt_diff,
       CAST(cy.sales_amt - p.sales_amt AS DOUBLE) AS sales_amt_diff
FROM all_sales cy JOIN all_sales p
  ON cy.i_brand_id = p.i_brand_id AND cy.i_class_id = p.i_class_id AND cy.i_category_id = p.i_category_id
 AND cy.i_manufact_id = p.i_manufact_id
WHERE cy.d_year = 2002 AND p.d_year = 2001 AND p.sales_cnt > 0 AND cy.sales_cnt * 10 < p.sales_cnt * 9
{ob("sales_cnt_diff, sales_amt_diff", _Q75_OUT)}
""")


def _nk(ch, fact, p, col):
    return f"""
  SELECT '{ch}' AS channel, '{col}' AS col_name, d_year, d_qoy, i_category, {p}_ext_sales_price AS ext_sales_price
  FROM {fact} JOIN item ON {p}_item_sk = i_item_sk JOIN date_dim ON {p}_sold_date_sk = d_date_sk
  WHERE {col} IS NULL"""


register(q76=f"""
SELECT channel, col_name, d_year, d_qoy, i_category, count(*) AS sales_cnt,
       CAST(sum(ext_sales_price) AS DOUBLE) AS sales_amt
FROM ({_nk("store", "store_sales", "ss", "ss_addr_sk")} UNION ALL{_nk("web", "web_sales", "ws", "ws_web_page_sk")}
      UNION ALL{_nk("catalog", "catalog_sales", "cs", "cs_warehouse_sk")}) foo
GROUP BY channel, col_name, d_year, d_qoy, i_category
{ob("channel, col_name, d_year, d_qoy, i_category", "sales_cnt, sales_amt")}
""")

_WIN = "d_date BETWEEN DATE '1998-08-04' AND DATE '1998-09-03'"
register(q77=f"""
WITH ss AS (SELECT s_store_sk, sum(ss_ext_sales_price) AS sales, sum(ss_net_profit) AS profit
            FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk JOIN store ON ss_store_sk = s_store_sk
            WHERE {_WIN} GROUP BY s_store_sk),
sr AS (SELECT s_store_sk, sum(sr_return_amt) AS returns, sum(sr_net_loss) AS profit_loss
       FROM store_returns JOIN date_dim ON sr_returned_date_sk = d_date_sk JOIN store ON sr_store_sk = s_store_sk
       WHERE {_WIN} GROUP BY s_store_sk),
cs AS (SELECT cs_call_center_sk, sum(cs_ext_sales_price) AS sales, sum(cs_net_profit) AS profit
       FROM catalog_sales JOIN date_dim ON cs_sold_date_sk = d_date_sk WHERE {_WIN} GROUP BY cs_call_center_sk),
cr AS (SELECT cr_call_center_sk, sum(cr_return_amount) AS returns, sum(cr_net_loss) AS profit_loss
       FROM catalog_returns JOIN date_dim ON cr_returned_date_sk = d_date_sk WHERE {_WIN} GROUP BY cr_call_center_sk),
ws AS (SELECT wp_web_page_sk, sum(ws_ext_sales_price) AS sales, sum(ws_net_profit) AS profit
       FROM web_sales JOIN date_dim ON ws_sold_date_sk = d_date_sk JOIN web_page ON ws_web_page_sk = wp_web_page_sk
       WHERE {_WIN} GROUP BY wp_web_page_sk),
wr AS (SELECT wp_web_page_sk, sum(wr_return_amt) AS returns, sum(wr_net_loss) AS profit_loss
       FROM web_returns JOIN date_dim ON wr_returned_date_sk = d_date_sk
       JOIN web_page ON wr_web_page_sk = wp_web_page_sk
       WHERE {_WIN} GROUP BY wp_web_page_sk)
SELECT channel, id, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(returns) AS DOUBLE) AS returns,
       CAST(sum(profit) AS DOUBLE) AS profit
FROM (
  SELECT 'store channel' AS channel, ss.s_store_sk AS id, sales, coalesce(returns, 0) AS returns,
         profit - coalesce(profit_loss, 0) AS profit
  FROM ss LEFT JOIN sr ON ss.s_store_sk = sr.s_store_sk
  UNION ALL
  SELECT 'catalog channel', cs_call_center_sk, sales, returns, profit - profit_loss FROM cs, cr
  UNION ALL
  SELECT 'web channel', ws.wp_web_page_sk, sales, coalesce(returns, 0), profit - coalesce(profit_loss, 0)
  FROM ws LEFT JOIN wr ON ws.wp_web_page_sk = wr.wp_web_page_sk) x
GROUP BY ROLLUP (channel, id)
{ob("channel, id", "sales, returns, profit")}
""")


def _unret(sales, p, cust, returns, rp, key, rkey):
    return f"""
  SELECT d_year AS {p}_sold_year, {p}_item_sk, {cust} AS {p}_customer_sk, sum({p}_quantity) AS {p}_qty,
         sum({p}_wholesale_cost) AS {p}_wc, sum({p}_sales_price) AS {p}_sp
  FROM {sales} LEFT JOIN {returns} ON {rkey} = {key} AND {p}_item_sk = {rp}_item_sk
  JOIN date_dim ON {p}_sold_date_sk = d_date_sk
  WHERE {rkey} IS NULL
  GROUP BY d_year, {p}_item_sk, {cust}"""


_OTHER = "(coalesce(ws_qty, 0) + coalesce(cs_qty, 0))"
register(q78=f"""
WITH ws AS ({_unret("web_sales", "ws", "ws_bill_customer_sk", "web_returns", "wr", "ws_order_number", "wr_order_number")}),
cs AS ({_unret("catalog_sales", "cs", "cs_bill_customer_sk", "catalog_returns", "cr", "cs_order_number", "cr_order_number")}),
ss AS ({_unret("store_sales", "ss", "ss_customer_sk", "store_returns", "sr", "ss_ticket_number", "sr_ticket_number")})
SELECT ss_sold_year, ss_item_sk, ss_customer_sk,
       ((200 * ss_qty + {_OTHER}) // (2 * {_OTHER})) / 100.0 AS ratio,
       CAST(ss_qty AS BIGINT) AS store_qty, CAST(ss_wc AS DOUBLE) AS store_wholesale_cost,
       CAST(ss_sp AS DOUBLE) AS store_sales_price, CAST({_OTHER} AS BIGINT) AS other_chan_qty,
       CAST(coalesce(ws_wc, 0) + coalesce(cs_wc, 0) AS DOUBLE) AS other_chan_wholesale_cost,
       CAST(coalesce(ws_sp, 0) + coalesce(cs_sp, 0) AS DOUBLE) AS other_chan_sales_price
FROM ss
LEFT JOIN ws ON ws_sold_year = ss_sold_year AND ws_item_sk = ss_item_sk AND ws_customer_sk = ss_customer_sk
LEFT JOIN cs ON cs_sold_year = ss_sold_year AND cs_item_sk = ss_item_sk AND cs_customer_sk = ss_customer_sk
WHERE (coalesce(ws_qty, 0) > 0 OR coalesce(cs_qty, 0) > 0) AND ss_sold_year = 2000
{ob("ss_sold_year, ss_item_sk, ss_customer_sk, store_qty DESC, store_wholesale_cost DESC, store_sales_price DESC, "
    "other_chan_qty, other_chan_wholesale_cost, other_chan_sales_price, ratio", "ratio")}
""")

register(q79=f"""
SELECT c_last_name, c_first_name, substr(s_city, 1, 30) AS s_city_substr, ss_ticket_number, amt, profit
FROM (
  SELECT ss_ticket_number, ss_customer_sk, s_city, CAST(sum(ss_coupon_amt) AS DOUBLE) AS amt,
         CAST(sum(ss_net_profit) AS DOUBLE) AS profit
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk JOIN store ON ss_store_sk = s_store_sk
  JOIN household_demographics ON ss_hdemo_sk = hd_demo_sk
  WHERE (hd_dep_count = 8 OR hd_vehicle_count > 0) AND d_dow = 1 AND d_year IN (1998, 1999, 2000)
    AND s_number_employees BETWEEN 200 AND 295
  GROUP BY ss_ticket_number, ss_customer_sk, ss_addr_sk, s_city) ms
JOIN customer ON ss_customer_sk = c_customer_sk
{ob("c_last_name, c_first_name, s_city_substr, profit", "ss_ticket_number, amt")}
""")


def _q80(sales, p, returns, rp, key, rkey, ramt, outlet, outlet_sk, outlet_id, p_outlet, name, prefix):
    return f"""
  SELECT '{name}' AS channel, '{prefix}' || {outlet_id} AS id, sum({p}_ext_sales_price) AS sales,
         sum(coalesce({ramt}, 0)) AS returns, sum({p}_net_profit - coalesce({rp}_net_loss, 0)) AS profit
  FROM {sales} LEFT JOIN {returns} ON {p}_item_sk = {rp}_item_sk AND {key} = {rkey}
  JOIN date_dim ON {p}_sold_date_sk = d_date_sk
  JOIN {outlet} ON {p}_{p_outlet} = {outlet_sk}
  JOIN item ON {p}_item_sk = i_item_sk
  JOIN promotion ON {p}_promo_sk = p_promo_sk
  WHERE {_WIN} AND i_current_price > 50 AND p_channel_tv = 'N'
  GROUP BY {outlet_id}"""


register(q80=f"""
SELECT channel, id, CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(returns) AS DOUBLE) AS returns,
       CAST(sum(profit) AS DOUBLE) AS profit
FROM ({_q80("store_sales", "ss", "store_returns", "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt",
            "store", "s_store_sk", "s_store_id", "store_sk", "store channel", "store")}
  UNION ALL{_q80("catalog_sales", "cs", "catalog_returns", "cr", "cs_order_number", "cr_order_number",
                 "cr_return_amount", "catalog_page", "cp_catalog_page_sk", "cp_catalog_page_id", "catalog_page_sk",
                 "catalog channel", "catalog_page")}
  UNION ALL{_q80("web_sales", "ws", "web_returns", "wr", "ws_order_number", "wr_order_number", "wr_return_amt",
                 "web_site", "web_site_sk", "web_site_id", "web_site_sk", "web channel", "web_site")}) x
GROUP BY ROLLUP (channel, id)
{ob("channel, id", "sales, returns, profit")}
""")
