"""Query models q75-q80 (q67-q74 live with q60s)."""

from pyspark.sql import functions as F

from ..functions import c, dbl, dsum, lsum, top
from ..operators.relational import cascaded_rollup
from .registry import model

_KEYS = ["d_year", "i_brand_id", "i_class_id", "i_category_id", "i_manufact_id"]


@model
def q75(t, category="Sports", year=2002, limit=100):
    """Brand lines whose yearly count net of returns fell below 90% of the previous year."""
    items = t.item.where(c("i_category") == category) \
        .select("i_item_sk", "i_brand_id", "i_class_id", "i_category_id", "i_manufact_id")
    dates = t.date_dim.where(c("d_year").isin(year - 1, year)).select("d_date_sk", "d_year")
    parts = []
    for sales, p, returns, rp, key, rkey, ramt in (
            (t.catalog_sales, "cs", t.catalog_returns, "cr", "cs_order_number", "cr_order_number", "cr_return_amount"),
            (t.store_sales, "ss", t.store_returns, "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt"),
            (t.web_sales, "ws", t.web_returns, "wr", "ws_order_number", "wr_order_number", "wr_return_amt")):
        r = returns.select(rkey, f"{rp}_item_sk", f"{rp}_return_quantity", ramt)
        d = (sales.join(items, c(f"{p}_item_sk") == c("i_item_sk"))
             .join(dates, c(f"{p}_sold_date_sk") == c("d_date_sk"))
             .join(r, (c(key) == c(rkey)) & (c(f"{p}_item_sk") == c(f"{rp}_item_sk")), "left")
             .select(*_KEYS,
                     (c(f"{p}_quantity") - F.coalesce(c(f"{rp}_return_quantity"), F.lit(0))).alias("sales_cnt"),
                     (c(f"{p}_ext_sales_price") - F.coalesce(c(ramt), F.lit(0))).alias("sales_amt")))
        parts.append(d)
    # UNION (not UNION ALL): identical detail rows across channels count once
    detail = parts[0].union(parts[1]).union(parts[2]).distinct()
    # both years in one aggregate; a line needs rows in each of them
    now, before = c("d_year") == year, c("d_year") == year - 1
    j = detail.groupBy(*_KEYS[1:]).agg(
        F.max("d_year").alias("d_year"), F.min("d_year").alias("prev_year"),
        lsum(F.when(now, c("sales_cnt"))).alias("sales_cnt"), F.sum(F.when(now, c("sales_amt"))).alias("sales_amt"),
        lsum(F.when(before, c("sales_cnt"))).alias("prev_yr_cnt"), F.sum(F.when(before, c("sales_amt"))).alias("prev_amt"))
    j = j.dropna(subset=list(_KEYS[1:])).where((c("d_year") == year) & (c("prev_year") == year - 1))
    # cnt / prev_cnt < 0.9 with exact integers
    j = j.where((c("prev_yr_cnt") > 0) & (c("sales_cnt") * 10 < c("prev_yr_cnt") * 9))
    out = j.select("prev_year", c("d_year").alias("year"), "i_brand_id", "i_class_id", "i_category_id",
                   "i_manufact_id", "prev_yr_cnt", c("sales_cnt").alias("curr_yr_cnt"),
                   (c("sales_cnt") - c("prev_yr_cnt")).alias("sales_cnt_diff"),
                   dbl(c("sales_amt") - c("prev_amt")).alias("sales_amt_diff"))
    return top(out, limit, "sales_cnt_diff", "sales_amt_diff")


def _null_key_sales(t, fact, p, null_col, channel):
    return (fact.where(c(null_col).isNull())
            .join(t.date_dim.select("d_date_sk", "d_year", "d_qoy"), c(f"{p}_sold_date_sk") == c("d_date_sk"))
            .join(t.item.select("i_item_sk", "i_category"), c(f"{p}_item_sk") == c("i_item_sk"))
            .select(F.lit(channel).alias("channel"), F.lit(null_col).alias("col_name"), "d_year", "d_qoy",
                    "i_category", c(f"{p}_ext_sales_price").alias("ext_sales_price")))


@model
def q76(t, limit=100):
    """Sales rows with a missing key, per channel, year, quarter and category."""
    u = (_null_key_sales(t, t.store_sales, "ss", "ss_addr_sk", "store")
         .unionByName(_null_key_sales(t, t.web_sales, "ws", "ws_web_page_sk", "web"))
         .unionByName(_null_key_sales(t, t.catalog_sales, "cs", "cs_warehouse_sk", "catalog")))
    out = (u.groupBy("channel", "col_name", "d_year", "d_qoy", "i_category")
           .agg(F.count(F.lit(1)).alias("sales_cnt"), dsum("ext_sales_price").alias("sales_amt")))
    return top(out, limit, "channel", "col_name", "d_year", "d_qoy", "i_category")


def _window(t, start, days):
    lo = F.lit(start).cast("date")
    return t.date_dim.where(c("d_date").between(lo, F.date_add(lo, days))).select("d_date_sk")


@model
def q77(t, start="1998-08-04", days=30, limit=100):
    """Sales, returns and profit per channel outlet over 30 days, with subtotals."""
    dates = _window(t, start, days)

    def agg(fact, date_col, key, m1, m2, n1, n2, dim=None):
        f = fact.join(dates, c(date_col) == c("d_date_sk"))
        if dim is not None:
            f = f.join(dim[0], c(key) == c(dim[1]))
            key = dim[1]
        return f.groupBy(c(key).alias("id")).agg(F.sum(m1).alias(n1), F.sum(m2).alias(n2))

    stores = t.store.select("s_store_sk")
    pages = t.web_page.select("wp_web_page_sk")
    ss = agg(t.store_sales, "ss_sold_date_sk", "ss_store_sk", "ss_ext_sales_price", "ss_net_profit",
             "sales", "profit", (stores, "s_store_sk"))
    sr = agg(t.store_returns, "sr_returned_date_sk", "sr_store_sk", "sr_return_amt", "sr_net_loss",
             "returns", "profit_loss", (stores, "s_store_sk")).withColumnRenamed("id", "rid")
    cs = agg(t.catalog_sales, "cs_sold_date_sk", "cs_call_center_sk", "cs_ext_sales_price", "cs_net_profit",
             "sales", "profit")
    cr = agg(t.catalog_returns, "cr_returned_date_sk", "cr_call_center_sk", "cr_return_amount", "cr_net_loss",
             "returns", "profit_loss").drop("id")
    ws = agg(t.web_sales, "ws_sold_date_sk", "ws_web_page_sk", "ws_ext_sales_price", "ws_net_profit",
             "sales", "profit", (pages, "wp_web_page_sk"))
    wr = agg(t.web_returns, "wr_returned_date_sk", "wr_web_page_sk", "wr_return_amt", "wr_net_loss",
             "returns", "profit_loss", (pages, "wp_web_page_sk")).withColumnRenamed("id", "rid")
    zero = F.lit(0)
    store = ss.join(sr, c("id") == c("rid"), "left").select(
        F.lit("store channel").alias("channel"), "id", "sales", F.coalesce("returns", zero).alias("returns"),
        (c("profit") - F.coalesce("profit_loss", zero)).alias("profit"))
    # the catalog pair has no join key: every call center's sales meet every
    # call center's returns (a cross join of two per-call-center aggregates)
    # both sides hold one row per call center, a dimension of fixed small size,
    # so the broadcast is bounded
    catalog = cs.crossJoin(F.broadcast(cr)).select(F.lit("catalog channel").alias("channel"), "id", "sales", "returns",
                                      (c("profit") - c("profit_loss")).alias("profit"))
    web = ws.join(wr, c("id") == c("rid"), "left").select(
        F.lit("web channel").alias("channel"), "id", "sales", F.coalesce("returns", zero).alias("returns"),
        (c("profit") - F.coalesce("profit_loss", zero)).alias("profit"))
    money = ("sales", "returns", "profit")
    rolled = cascaded_rollup(store.unionByName(catalog).unionByName(web), ["channel", "id"], *[F.sum(x).alias(x) for x in money])
    out = rolled.select("channel", "id", *[dbl(x).alias(x) for x in money])
    return top(out, limit, "channel", "id")


@model
def q78(t, year=2000, limit=100):
    """Unreturned store purchases vs the same customer's other channels, per item and year."""
    dates = t.date_dim.select("d_date_sk", "d_year")

    def unreturned(sales, p, cust, returns, key, rkey, rp):
        r = returns.select(c(rkey).alias("rk"), c(f"{rp}_item_sk").alias("ri"))
        return (sales.join(r, (c(key) == c("rk")) & (c(f"{p}_item_sk") == c("ri")), "left_anti")
                .join(dates, c(f"{p}_sold_date_sk") == c("d_date_sk"))
                .groupBy(c("d_year").alias(f"{p}_sold_year"), c(f"{p}_item_sk").alias(f"{p}_item"),
                         c(cust).alias(f"{p}_customer"))
                .agg(lsum(f"{p}_quantity").alias(f"{p}_qty"), F.sum(f"{p}_wholesale_cost").alias(f"{p}_wc"),
                     F.sum(f"{p}_sales_price").alias(f"{p}_sp")))

    ws = unreturned(t.web_sales, "ws", "ws_bill_customer_sk", t.web_returns, "ws_order_number", "wr_order_number",
                    "wr")
    cs = unreturned(t.catalog_sales, "cs", "cs_bill_customer_sk", t.catalog_returns, "cs_order_number",
                    "cr_order_number", "cr")
    ss = unreturned(t.store_sales, "ss", "ss_customer_sk", t.store_returns, "ss_ticket_number", "sr_ticket_number",
                    "sr").where(c("ss_sold_year") == year)
    j = (ss.join(ws, (c("ws_sold_year") == c("ss_sold_year")) & (c("ws_item") == c("ss_item"))
                 & (c("ws_customer") == c("ss_customer")), "left")
         .join(cs, (c("cs_sold_year") == c("ss_sold_year")) & (c("cs_item") == c("ss_item"))
               & (c("cs_customer") == c("ss_customer")), "left")
         .where((F.coalesce("ws_qty", F.lit(0)) > 0) | (F.coalesce("cs_qty", F.lit(0)) > 0)))
    other_qty = F.coalesce("ws_qty", F.lit(0)) + F.coalesce("cs_qty", F.lit(0))
    # round(store / other, 2) half up, in exact integers
    ratio = (F.expr("(200 * ss_qty + (coalesce(ws_qty, 0) + coalesce(cs_qty, 0))) div "
                    "(2 * (coalesce(ws_qty, 0) + coalesce(cs_qty, 0)))") / 100.0)
    out = j.select(c("ss_sold_year"), c("ss_item").alias("ss_item_sk"), c("ss_customer").alias("ss_customer_sk"),
                   ratio.alias("ratio"), c("ss_qty").alias("store_qty"), dbl("ss_wc").alias("store_wholesale_cost"),
                   dbl("ss_sp").alias("store_sales_price"), other_qty.alias("other_chan_qty"),
                   dbl(F.coalesce("ws_wc", F.lit(0)) + F.coalesce("cs_wc", F.lit(0))).alias("other_chan_wholesale_cost"),
                   dbl(F.coalesce("ws_sp", F.lit(0)) + F.coalesce("cs_sp", F.lit(0))).alias("other_chan_sales_price"))
    return top(out, limit, "ss_sold_year", "ss_item_sk", "ss_customer_sk", "-store_qty", "-store_wholesale_cost",
               "-store_sales_price", "other_chan_qty", "other_chan_wholesale_cost", "other_chan_sales_price", "ratio")


@model
def q79(t, dep=8, dow=1, years=(1998, 1999, 2000), emp_lo=200, emp_hi=295, limit=100):
    """Monday tickets in mid-sized stores: coupon amount and profit per customer."""
    days = t.date_dim.where((c("d_dow") == dow) & c("d_year").isin(*years)).select("d_date_sk")
    ms = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
          .join(t.store.where(c("s_number_employees").between(emp_lo, emp_hi)).select("s_store_sk", "s_city"),
                c("ss_store_sk") == c("s_store_sk"))
          .join(t.household_demographics.where((c("hd_dep_count") == dep) | (c("hd_vehicle_count") > 0))
                .select("hd_demo_sk"), c("ss_hdemo_sk") == c("hd_demo_sk"))
          .groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "s_city")
          .agg(dsum("ss_coupon_amt").alias("amt"), dsum("ss_net_profit").alias("profit")))
    out = ms.join(t.customer, c("ss_customer_sk") == c("c_customer_sk")).select(
        "c_last_name", "c_first_name", F.substring("s_city", 1, 30).alias("s_city_substr"), "ss_ticket_number",
        "amt", "profit")
    return top(out, limit, "c_last_name", "c_first_name", "s_city_substr", "profit")


@model
def q80(t, start="1998-08-04", days=30, min_price=50, limit=100):
    """Sales, returns and profit per outlet over 30 days for pricier items without TV promotion."""
    dates = _window(t, start, days)
    items = t.item.where(c("i_current_price") > min_price).select("i_item_sk")
    promos = t.promotion.where(c("p_channel_tv") == "N").select("p_promo_sk")

    def channel(sales, p, returns, rp, key, rkey, ramt, outlet_dim, outlet_key, outlet_col, out_key, name, prefix):
        r = returns.select(c(rkey).alias("rk"), c(f"{rp}_item_sk").alias("ri"), c(ramt).alias("ramt"),
                           c(f"{rp}_net_loss").alias("rloss"))
        j = (sales.join(dates, c(f"{p}_sold_date_sk") == c("d_date_sk"))
             .join(items, c(f"{p}_item_sk") == c("i_item_sk"))
             .join(promos, c(f"{p}_promo_sk") == c("p_promo_sk"))
             .join(outlet_dim.select(outlet_key, outlet_col), c(f"{p}_{out_key}") == c(outlet_key))
             .join(r, (c(f"{p}_item_sk") == c("ri")) & (c(key) == c("rk")), "left"))
        g = j.groupBy(outlet_col).agg(
            F.sum(f"{p}_ext_sales_price").alias("sales"), F.sum(F.coalesce("ramt", F.lit(0))).alias("returns"),
            F.sum(c(f"{p}_net_profit") - F.coalesce("rloss", F.lit(0))).alias("profit"))
        return g.select(F.lit(name).alias("channel"), F.concat(F.lit(prefix), c(outlet_col)).alias("id"),
                        "sales", "returns", "profit")

    u = (channel(t.store_sales, "ss", t.store_returns, "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt",
                 t.store, "s_store_sk", "s_store_id", "store_sk", "store channel", "store")
         .unionByName(channel(t.catalog_sales, "cs", t.catalog_returns, "cr", "cs_order_number", "cr_order_number",
                              "cr_return_amount", t.catalog_page, "cp_catalog_page_sk", "cp_catalog_page_id",
                              "catalog_page_sk", "catalog channel", "catalog_page"))
         .unionByName(channel(t.web_sales, "ws", t.web_returns, "wr", "ws_order_number", "wr_order_number",
                              "wr_return_amt", t.web_site, "web_site_sk", "web_site_id", "web_site_sk",
                              "web channel", "web_site")))
    money = ("sales", "returns", "profit")
    rolled = cascaded_rollup(u, ["channel", "id"], *[F.sum(x).alias(x) for x in money])
    out = rolled.select("channel", "id", *[dbl(x).alias(x) for x in money])
    return top(out, limit, "channel", "id")
