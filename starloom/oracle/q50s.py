"""Oracle SQL for q50-q59."""

from .q30s import channel_revenue_sql
from .q40s import monthly_deviation_sql
from .registry import ob, register

_ADDR = ("s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number, "
         "s_city, s_county, s_state, s_zip")


def lag_sql(a, b):
    d = f"({a} - {b})"
    return ", ".join([
        f'CAST(sum(CASE WHEN {d} <= 30 THEN 1 ELSE 0 END) AS BIGINT) AS "30 days"',
        f'CAST(sum(CASE WHEN {d} > 30 AND {d} <= 60 THEN 1 ELSE 0 END) AS BIGINT) AS "31-60 days"',
        f'CAST(sum(CASE WHEN {d} > 60 AND {d} <= 90 THEN 1 ELSE 0 END) AS BIGINT) AS "61-90 days"',
        f'CAST(sum(CASE WHEN {d} > 90 AND {d} <= 120 THEN 1 ELSE 0 END) AS BIGINT) AS "91-120 days"',
        f'CAST(sum(CASE WHEN {d} > 120 THEN 1 ELSE 0 END) AS BIGINT) AS ">120 days"'])


register(q50=f"""
SELECT {_ADDR}, {lag_sql("sr_returned_date_sk", "ss_sold_date_sk")}
FROM store_sales
JOIN store_returns ON ss_ticket_number = sr_ticket_number AND ss_item_sk = sr_item_sk
                  AND ss_customer_sk = sr_customer_sk
JOIN store ON ss_store_sk = s_store_sk
JOIN date_dim d1 ON ss_sold_date_sk = d1.d_date_sk
JOIN date_dim d2 ON sr_returned_date_sk = d2.d_date_sk
WHERE d2.d_year = 2000 AND d2.d_moy = 9
GROUP BY {_ADDR}
{ob(_ADDR, _ADDR)}
""")

register(q51=f"""
WITH web_v1 AS (
  SELECT ws_item_sk AS item_sk, d_date,
         sum(sum(ws_sales_price)) OVER (PARTITION BY ws_item_sk ORDER BY d_date
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cume_sales
  FROM web_sales JOIN date_dim ON ws_sold_date_sk = d_date_sk
  WHERE d_month_seq BETWEEN 1212 AND 1223 AND ws_item_sk IS NOT NULL
  GROUP BY ws_item_sk, d_date),
store_v1 AS (
  SELECT ss_item_sk AS item_sk, d_date,
         sum(sum(ss_sales_price)) OVER (PARTITION BY ss_item_sk ORDER BY d_date
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cume_sales
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk
  WHERE d_month_seq BETWEEN 1212 AND 1223 AND ss_item_sk IS NOT NULL
  GROUP BY ss_item_sk, d_date)
SELECT item_sk, d_date, CAST(web_sales AS DOUBLE) AS web_sales, CAST(store_sales AS DOUBLE) AS store_sales,
       CAST(web_cumulative AS DOUBLE) AS web_cumulative, CAST(store_cumulative AS DOUBLE) AS store_cumulative
FROM (
  SELECT item_sk, d_date, web_sales, store_sales,
         max(web_sales) OVER (PARTITION BY item_sk ORDER BY d_date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS web_cumulative,
         max(store_sales) OVER (PARTITION BY item_sk ORDER BY d_date
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS store_cumulative
  FROM (SELECT CASE WHEN w.item_sk IS NOT NULL THEN w.item_sk ELSE s.item_sk END AS item_sk,
               CASE WHEN w.d_date IS NOT NULL THEN w.d_date ELSE s.d_date END AS d_date,
               w.cume_sales AS web_sales, s.cume_sales AS store_sales
        FROM web_v1 w FULL OUTER JOIN store_v1 s ON w.item_sk = s.item_sk AND w.d_date = s.d_date) x) y
WHERE web_cumulative > store_cumulative
{ob("item_sk, d_date", "web_sales, store_sales, web_cumulative, store_cumulative")}
""")

register(q52=f"""
SELECT d_year, i_brand_id AS brand_id, i_brand AS brand, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS ext_price
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN item ON ss_item_sk = i_item_sk
WHERE i_manager_id = 1 AND d_moy = 12 AND d_year = 1998
GROUP BY d_year, i_brand, i_brand_id
{ob("d_year, ext_price DESC, brand_id", "brand")}
""")


def period_deviation_sql(key, period, item_filter, avg_name):
    return f"""
SELECT {key}, sum_sales, {avg_name} FROM (
  SELECT {key}, CAST(sum(ss_sales_price) AS DOUBLE) AS sum_sales,
         CAST(sum(sum(ss_sales_price)) OVER (PARTITION BY {key}) AS DOUBLE)
           / count(sum(ss_sales_price)) OVER (PARTITION BY {key}) AS {avg_name}
  FROM store_sales JOIN item ON ss_item_sk = i_item_sk JOIN date_dim ON ss_sold_date_sk = d_date_sk
  JOIN store ON ss_store_sk = s_store_sk
  WHERE d_month_seq IN (1212, 1213, 1214, 1215, 1216, 1217, 1218, 1219, 1220, 1221, 1222, 1223)
    AND ({item_filter})
  GROUP BY {key}, {period}) t
WHERE CASE WHEN {avg_name} > 0 THEN abs(sum_sales - {avg_name}) / {avg_name} END > 0.1
"""


Q53_ITEMS = """(i_category IN ('Books', 'Children', 'Electronics')
         AND i_class IN ('personal', 'portable', 'reference', 'self-help')
         AND i_brand IN ('scholaramalgamalg #14', 'scholaramalgamalg #7', 'exportiunivamalg #9',
                         'scholaramalgamalg #9'))
      OR (i_category IN ('Women', 'Music', 'Men')
         AND i_class IN ('accessories', 'classical', 'fragrances', 'pants')
         AND i_brand IN ('amalgimporto #1', 'edu packscholar #1', 'exportiimporto #1', 'importoamalg #1'))"""

register(q53=period_deviation_sql("i_manufact_id", "d_qoy", Q53_ITEMS, "avg_quarterly_sales")
         + ob("avg_quarterly_sales, sum_sales, i_manufact_id", "i_manufact_id"))

register(q54=f"""
WITH month AS (SELECT min(d_month_seq) AS seq FROM date_dim WHERE d_year = 1999 AND d_moy = 3),
remote AS (
  SELECT ws_bill_customer_sk AS buyer, ws_item_sk AS item, ws_sold_date_sk AS day FROM web_sales
  UNION ALL
  SELECT cs_bill_customer_sk, cs_item_sk, cs_sold_date_sk FROM catalog_sales),
chosen AS (
  SELECT c_customer_sk, c_current_addr_sk FROM customer
  WHERE c_customer_sk IN (
    SELECT buyer FROM remote
    JOIN date_dim ON d_date_sk = day AND d_year = 1999 AND d_moy = 3
    JOIN item ON i_item_sk = item AND i_class = 'consignment' AND i_category = 'Jewelry')),
spent AS (
  SELECT c_customer_sk, sum(ss_ext_sales_price) AS total
  FROM chosen
  JOIN customer_address ON ca_address_sk = c_current_addr_sk
  JOIN store ON s_state = ca_state AND s_county = ca_county
  JOIN store_sales ON ss_customer_sk = c_customer_sk
  JOIN date_dim ON d_date_sk = ss_sold_date_sk
  CROSS JOIN month
  WHERE d_month_seq > seq AND d_month_seq <= seq + 3
  GROUP BY c_customer_sk)
SELECT segment, count(*) AS num_customers, segment * 50 AS segment_base
FROM (SELECT CAST(CAST(total AS DOUBLE) / 50 AS INTEGER) AS segment FROM spent) x
GROUP BY segment
{ob("segment, num_customers", "segment_base")}
""")

register(q55=f"""
SELECT i_brand_id AS brand_id, i_brand AS brand, CAST(sum(ss_ext_sales_price) AS DOUBLE) AS ext_price
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN item ON ss_item_sk = i_item_sk
WHERE i_manager_id = 36 AND d_moy = 12 AND d_year = 2001
GROUP BY i_brand, i_brand_id
{ob("ext_price DESC, brand_id", "brand")}
""")

register(q56=channel_revenue_sql("i_item_id", "i_color IN ('orchid', 'chiffon', 'lace')", 2000, 1, -8,
                                 "total_sales, i_item_id"))

register(q57=monthly_deviation_sql("catalog_sales", "cs", "JOIN call_center ON cc_call_center_sk = cs_call_center_sk",
                                   "cc_name") + """
SELECT cc_name, d_year, d_moy, avg_monthly_sales, CAST(sum_sales AS DOUBLE) AS sum_sales, psum, nsum
FROM v2
WHERE d_year = 2000 AND avg_monthly_sales > 0
  AND CASE WHEN avg_monthly_sales > 0
           THEN abs(CAST(sum_sales AS DOUBLE) - avg_monthly_sales) / avg_monthly_sales END > 0.1
ORDER BY CAST(sum_sales AS DOUBLE) - avg_monthly_sales NULLS LAST, nsum NULLS LAST, cc_name NULLS LAST,
         d_year NULLS LAST, d_moy NULLS LAST, avg_monthly_sales NULLS LAST, sum_sales NULLS LAST,
         psum NULLS LAST, i_category NULLS LAST, i_brand NULLS LAST
LIMIT 100
""")


def _week_items(fact, p, name):
    return f"""
  SELECT i_item_id AS item_id, sum({p}_ext_sales_price) AS {name}
  FROM {fact} JOIN item ON {p}_item_sk = i_item_sk JOIN date_dim ON {p}_sold_date_sk = d_date_sk
  WHERE d_date IN (SELECT d_date FROM date_dim
                   WHERE d_week_seq = (SELECT d_week_seq FROM date_dim WHERE d_date = DATE '1998-02-19'))
  GROUP BY i_item_id"""


_Q58_OUT = "item_id, ss_item_rev, ss_dev, cs_item_rev, cs_dev, ws_item_rev, ws_dev, average"
_AVG = "((CAST(ss_rev AS DOUBLE) + CAST(cs_rev AS DOUBLE) + CAST(ws_rev AS DOUBLE)) / 3)"
register(q58=f"""
WITH ss AS ({_week_items("store_sales", "ss", "ss_rev")}),
cs AS ({_week_items("catalog_sales", "cs", "cs_rev")}),
ws AS ({_week_items("web_sales", "ws", "ws_rev")})
SELECT ss.item_id, CAST(ss_rev AS DOUBLE) AS ss_item_rev, CAST(ss_rev AS DOUBLE) / {_AVG} * 100 AS ss_dev,
       CAST(cs_rev AS DOUBLE) AS cs_item_rev, CAST(cs_rev AS DOUBLE) / {_AVG} * 100 AS cs_dev,
       CAST(ws_rev AS DOUBLE) AS ws_item_rev, CAST(ws_rev AS DOUBLE) / {_AVG} * 100 AS ws_dev,
       {_AVG} AS average
FROM ss JOIN cs ON ss.item_id = cs.item_id JOIN ws ON ss.item_id = ws.item_id
WHERE ss_rev BETWEEN 0.9 * cs_rev AND 1.1 * cs_rev AND ss_rev BETWEEN 0.9 * ws_rev AND 1.1 * ws_rev
  AND cs_rev BETWEEN 0.9 * ss_rev AND 1.1 * ss_rev AND cs_rev BETWEEN 0.9 * ws_rev AND 1.1 * ws_rev
  AND ws_rev BETWEEN 0.9 * ss_rev AND 1.1 * ss_rev AND ws_rev BETWEEN 0.9 * cs_rev AND 1.1 * cs_rev
{ob("item_id, ss_item_rev", _Q58_OUT)}
""")

_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_SHORT = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]
_pv = ", ".join(f"sum(CASE WHEN d_day_name = '{d}' THEN ss_sales_price END) AS {s}_sales" for d, s in zip(_DAYS, _SHORT))
_ratio = ", ".join(f"CAST(y.{s}_sales AS DOUBLE) / nullif(CAST(x.{s}_sales AS DOUBLE), 0) AS {s}_sales_ratio"
                   for s in _SHORT)
register(q59=f"""
WITH wss AS (
  SELECT d_week_seq, ss_store_sk, {_pv}
  FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk
  GROUP BY d_week_seq, ss_store_sk),
y AS (SELECT s_store_name, s_store_id, w.* FROM wss w JOIN store ON ss_store_sk = s_store_sk
      JOIN date_dim d ON d.d_week_seq = w.d_week_seq WHERE d_month_seq BETWEEN 1185 AND 1196),
x AS (SELECT s_store_name, s_store_id, w.* FROM wss w JOIN store ON ss_store_sk = s_store_sk
      JOIN date_dim d ON d.d_week_seq = w.d_week_seq WHERE d_month_seq BETWEEN 1197 AND 1208)
SELECT y.s_store_name AS s_store_name1, y.s_store_id AS s_store_id1, y.d_week_seq AS d_week_seq1, {_ratio}
FROM y JOIN x ON y.s_store_id = x.s_store_id AND y.d_week_seq = x.d_week_seq - 52
{ob("s_store_name1, s_store_id1, d_week_seq1", ", ".join(s + "_sales_ratio" for s in _SHORT))}
""")
