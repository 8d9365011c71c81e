"""Query models q81-q99."""

from pyspark.sql import functions as F

from ..functions import c, davg, dbl, lsum, top
from ..operators.relational import pinned
from .q30s import items_in_stock_and_sold
from .q60s import ranked_two_level
from .registry import model

_ADDR_OUT = ("ca_street_number", "ca_street_name", "ca_street_type", "ca_suite_number", "ca_city", "ca_county",
             "ca_state", "ca_zip", "ca_country", "ca_gmt_offset", "ca_location_type")


@model
def q81(t, year=1998, state="IL", limit=100):
    """Catalog-return customers above 1.2x their state's average, with their address."""
    days = t.date_dim.where(c("d_year") == year).select("d_date_sk")
    ctr = (t.catalog_returns.join(days, c("cr_returned_date_sk") == c("d_date_sk"))
           .join(t.customer_address.select(c("ca_address_sk").alias("ra_sk"), c("ca_state").alias("ctr_state")),
                 c("cr_returning_addr_sk") == c("ra_sk"))
           .groupBy(c("cr_returning_customer_sk").alias("cust"), "ctr_state")
           .agg(F.sum("cr_return_amt_inc_tax").alias("total")))
    per_state = ctr.groupBy("ctr_state").agg(F.sum("total").alias("st"), F.count("total").alias("sc"))
    out = (ctr.join(per_state, "ctr_state").where(c("total") * c("sc") * 10 > c("st") * 12)
           .join(t.customer, c("cust") == c("c_customer_sk"))
           .join(t.customer_address.where(c("ca_state") == state), c("c_current_addr_sk") == c("ca_address_sk"))
           .select("c_customer_id", "c_salutation", "c_first_name", "c_last_name",
                   *[dbl(x).alias(x) if x == "ca_gmt_offset" else c(x) for x in _ADDR_OUT],
                   dbl("total").alias("ctr_total_return")))
    return top(out, limit, "c_customer_id", "c_salutation", "c_first_name", "c_last_name", *_ADDR_OUT,
               "ctr_total_return")


@model
def q82(t, price_lo=30, manufacts=(437, 129, 727, 663), start="2002-05-30", days=60, limit=100):
    """Items in stock (100-500 units) within 60 days and sold in stores, in a price band."""
    return items_in_stock_and_sold(t, t.store_sales, "ss_item_sk", price_lo, manufacts, start, days, limit)


@model
def q83(t, dates=("1998-01-02", "1998-10-15", "1998-11-10"), limit=100):
    """Returned quantities per item in three weeks, across channels, with shares."""
    weeks = t.date_dim.where(c("d_date").isin(*[F.lit(d).cast("date") for d in dates])) \
        .select(c("d_week_seq").alias("wk")).distinct()
    days = t.date_dim.join(weeks, c("d_week_seq") == c("wk"), "left_semi").select("d_date_sk")

    def qty(returns, p, name):
        return (returns.join(days, c(f"{p}_returned_date_sk") == c("d_date_sk"))
                .join(t.item.select("i_item_sk", "i_item_id"), c(f"{p}_item_sk") == c("i_item_sk"))
                .groupBy(c("i_item_id").alias(f"{p}_id")).agg(lsum(f"{p}_return_quantity").alias(name)))

    sr = qty(t.store_returns, "sr", "sr_item_qty")
    cr = qty(t.catalog_returns, "cr", "cr_item_qty")
    wr = qty(t.web_returns, "wr", "wr_item_qty")
    j = sr.join(cr, c("sr_id") == c("cr_id")).join(wr, c("sr_id") == c("wr_id"))
    total = dbl(c("sr_item_qty") + c("cr_item_qty") + c("wr_item_qty"))
    out = j.select(c("sr_id").alias("item_id"), "sr_item_qty",
                   (dbl("sr_item_qty") / total / 3.0 * 100).alias("sr_dev"), "cr_item_qty",
                   (dbl("cr_item_qty") / total / 3.0 * 100).alias("cr_dev"), "wr_item_qty",
                   (dbl("wr_item_qty") / total / 3.0 * 100).alias("wr_dev"), (total / 3.0).alias("average"))
    return top(out, limit, "item_id", "sr_item_qty")


@model
def q84(t, city="Hopewell", income_lo=32287, width=50000, limit=100):
    """Customers of one city and income range, one row per store return of their demographic."""
    bands = t.income_band.where((c("ib_lower_bound") >= income_lo) & (c("ib_upper_bound") <= income_lo + width))
    hd = t.household_demographics.join(bands, c("hd_income_band_sk") == c("ib_income_band_sk")).select("hd_demo_sk")
    cust = (t.customer.join(t.customer_address.where(c("ca_city") == city).select("ca_address_sk"),
                            c("c_current_addr_sk") == c("ca_address_sk"))
            .join(hd, c("c_current_hdemo_sk") == c("hd_demo_sk"))
            .join(t.customer_demographics.select("cd_demo_sk"), c("c_current_cdemo_sk") == c("cd_demo_sk")))
    out = (cust.join(t.store_returns.select("sr_cdemo_sk"), c("sr_cdemo_sk") == c("cd_demo_sk"))
           .select(c("c_customer_id").alias("customer_id"),
                   F.concat(F.coalesce("c_last_name", F.lit("")), F.lit(", "),
                            F.coalesce("c_first_name", F.lit(""))).alias("customername")))
    return top(out, limit, "customer_id")


@model
def q85(t, year=1998, limit=100):
    """Web return averages per reason under OR-ed demographic, price, address and profit bands."""
    cd1 = t.customer_demographics.select(c("cd_demo_sk").alias("cd1_sk"), c("cd_marital_status").alias("m1"),
                                         c("cd_education_status").alias("e1"))
    cd2 = t.customer_demographics.select(c("cd_demo_sk").alias("cd2_sk"), c("cd_marital_status").alias("m2"),
                                         c("cd_education_status").alias("e2"))
    sold = pinned(t.web_sales
                  .join(t.date_dim.where(c("d_year") == year).select("d_date_sk"), c("ws_sold_date_sk") == c("d_date_sk"))
                  .join(t.web_page.select("wp_web_page_sk"), c("ws_web_page_sk") == c("wp_web_page_sk"))
                  .select("ws_item_sk", "ws_order_number", "ws_quantity", "ws_sales_price", "ws_net_profit"),
                  "ws_sales_price", "ws_net_profit")
    j = (sold
         .join(t.web_returns, (c("ws_item_sk") == c("wr_item_sk")) & (c("ws_order_number") == c("wr_order_number")))
         .join(cd1, c("wr_refunded_cdemo_sk") == c("cd1_sk"))
         .join(cd2, c("wr_returning_cdemo_sk") == c("cd2_sk"))
         .join(t.customer_address.where(c("ca_country") == "United States"),
               c("wr_refunded_addr_sk") == c("ca_address_sk"))
         .join(t.reason, c("wr_reason_sk") == c("r_reason_sk")))
    price, profit = c("ws_sales_price"), c("ws_net_profit")
    same = (c("m1") == c("m2")) & (c("e1") == c("e2"))
    demo = same & (((c("m1") == "M") & (c("e1") == "4 yr Degree") & price.between(100, 150))
                   | ((c("m1") == "D") & (c("e1") == "Primary") & price.between(50, 100))
                   | ((c("m1") == "U") & (c("e1") == "Advanced Degree") & price.between(150, 200)))
    geo = ((c("ca_state").isin("KY", "GA", "NM") & profit.between(100, 200))
           | (c("ca_state").isin("MT", "OR", "IN") & profit.between(150, 300))
           | (c("ca_state").isin("WI", "MO", "WV") & profit.between(50, 250)))
    out = (j.where(demo & geo).groupBy("r_reason_desc")
           .agg(davg("ws_quantity").alias("avg_ws_quantity"), davg("wr_refunded_cash").alias("avg_wr_refunded_cash"),
                davg("wr_fee").alias("avg_wr_fee"))
           .select(F.substring("r_reason_desc", 1, 20).alias("reason_desc_substr"), "avg_ws_quantity",
                   "avg_wr_refunded_cash", "avg_wr_fee"))
    return top(out, limit, "reason_desc_substr", "avg_ws_quantity", "avg_wr_refunded_cash", "avg_wr_fee")


@model
def q86(t, month_seq=1212, limit=100):
    """Web net paid by category and class with subtotals, ranked inside the parent."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    j = (t.web_sales.join(days, c("ws_sold_date_sk") == c("d_date_sk"))
         .join(t.item.select("i_item_sk", "i_category", "i_class"), c("ws_item_sk") == c("i_item_sk")))
    return ranked_two_level(j, "i_category", "i_class", "ws_net_paid", "total_sum", True, limit)


def _name_days(t, fact, date_col, cust_col, month_seq):
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk", "d_date")
    return (fact.join(days, c(date_col) == c("d_date_sk"))
            .join(t.customer, c(cust_col) == c("c_customer_sk"))
            .select("c_last_name", "c_first_name", "d_date"))


@model
def q87(t, month_seq=1212):
    """Number of (name, date) pairs seen in stores but neither in catalog nor web."""
    s = _name_days(t, t.store_sales, "ss_sold_date_sk", "ss_customer_sk", month_seq)
    cs = _name_days(t, t.catalog_sales, "cs_sold_date_sk", "cs_bill_customer_sk", month_seq)
    ws = _name_days(t, t.web_sales, "ws_sold_date_sk", "ws_bill_customer_sk", month_seq)
    return s.subtract(cs).subtract(ws).agg(F.count(F.lit(1)).alias("cool_cust_count"))


Q88_SLOTS = (("h8_30_to_9", 8, True), ("h9_to_9_30", 9, False), ("h9_30_to_10", 9, True),
             ("h10_to_10_30", 10, False), ("h10_30_to_11", 10, True), ("h11_to_11_30", 11, False),
             ("h11_30_to_12", 11, True), ("h12_to_12_30", 12, False))


@model
def q88(t, store_name="ese", slots=Q88_SLOTS):
    """Store sale counts in eight half-hour slots, one row."""
    hd = t.household_demographics.where(
        ((c("hd_dep_count") == 3) & (c("hd_vehicle_count") <= 5))
        | ((c("hd_dep_count") == 0) & (c("hd_vehicle_count") <= 2))
        | ((c("hd_dep_count") == 1) & (c("hd_vehicle_count") <= 3))).select("hd_demo_sk")
    hours = sorted({h for _, h, _ in slots})
    times = t.time_dim.where(c("t_hour").isin(*hours)).select("t_time_sk", "t_hour", "t_minute")
    j = (t.store_sales.join(hd, c("ss_hdemo_sk") == c("hd_demo_sk"))
         .join(times, c("ss_sold_time_sk") == c("t_time_sk"))
         .join(t.store.where(c("s_store_name") == store_name).select("s_store_sk"), c("ss_store_sk") == c("s_store_sk")))
    # the eight scalar counts in one scan
    counts = [F.count(F.when((c("t_hour") == h) & ((c("t_minute") >= 30) if late else (c("t_minute") < 30)), 1))
              .alias(name) for name, h, late in slots]
    return j.agg(*counts)


@model
def q89(t, year=2000, limit=100):
    """Store brand months deviating more than 10% from the brand's monthly mean."""
    from pyspark.sql import Window as W

    items = ((c("i_category").isin("Home", "Books", "Electronics") & c("i_class").isin("wallpaper", "parenting", "musical"))
             | (c("i_category").isin("Shoes", "Jewelry", "Men") & c("i_class").isin("womens", "birdal", "pants")))
    days = t.date_dim.where(c("d_year") == year).select("d_date_sk", "d_moy")
    g = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
         .join(t.item.where(items), c("ss_item_sk") == c("i_item_sk"))
         .join(t.store.select("s_store_sk", "s_store_name", "s_company_name"), c("ss_store_sk") == c("s_store_sk"))
         .groupBy("i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy")
         .agg(F.sum("ss_sales_price").alias("s")))
    w = W.partitionBy("i_category", "i_brand", "s_store_name", "s_company_name")
    v = g.select("i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy",
                 dbl("s").alias("sum_sales"),
                 (F.sum("s").over(w).cast("double") / F.count("s").over(w)).alias("avg_monthly_sales"))
    out = v.where(F.when(c("avg_monthly_sales") != 0,
                         F.abs(c("sum_sales") - c("avg_monthly_sales")) / c("avg_monthly_sales")) > 0.1)
    return top(out, limit, (c("sum_sales") - c("avg_monthly_sales")).asc_nulls_last(), "s_store_name")


@model
def q90(t, am_hour=6, pm_hour=14, dep=8, chars_lo=5000, chars_hi=5200):
    """Ratio of morning to evening web sales for one household type and page size."""
    hd = t.household_demographics.where(c("hd_dep_count") == dep).select("hd_demo_sk")
    pages = t.web_page.where(c("wp_char_count").between(chars_lo, chars_hi)).select("wp_web_page_sk")
    times = t.time_dim.where(c("t_hour").between(am_hour, am_hour + 1) | c("t_hour").between(pm_hour, pm_hour + 1)) \
        .select("t_time_sk", "t_hour")
    j = (t.web_sales.join(hd, c("ws_ship_hdemo_sk") == c("hd_demo_sk"))
         .join(pages, c("ws_web_page_sk") == c("wp_web_page_sk"))
         .join(times, c("ws_sold_time_sk") == c("t_time_sk")))
    # both counts in one scan
    counts = j.agg(F.count(F.when(c("t_hour").between(am_hour, am_hour + 1), 1)).alias("amc"),
                   F.count(F.when(c("t_hour").between(pm_hour, pm_hour + 1), 1)).alias("pmc"))
    return counts.select((dbl("amc") / F.when(c("pmc") != 0, dbl("pmc"))).alias("am_pm_ratio"))


@model
def q91(t, year=1999, moy=11, gmt=-7, potential_prefix="0-500"):
    """Call-center return losses for some demographics in one month."""
    cd = t.customer_demographics.where(
        ((c("cd_marital_status") == "M") & (c("cd_education_status") == "Unknown"))
        | ((c("cd_marital_status") == "W") & (c("cd_education_status") == "Advanced Degree")))
    hd = t.household_demographics.where(c("hd_buy_potential").like(potential_prefix + "%")).select("hd_demo_sk")
    days = t.date_dim.where((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk")
    j = (t.catalog_returns.join(days, c("cr_returned_date_sk") == c("d_date_sk"))
         .join(t.call_center, c("cr_call_center_sk") == c("cc_call_center_sk"))
         .join(t.customer, c("cr_returning_customer_sk") == c("c_customer_sk"))
         .join(cd, c("c_current_cdemo_sk") == c("cd_demo_sk"))
         .join(hd, c("c_current_hdemo_sk") == c("hd_demo_sk"))
         .join(t.customer_address.where(c("ca_gmt_offset") == gmt).select("ca_address_sk"),
               c("c_current_addr_sk") == c("ca_address_sk")))
    out = (j.groupBy("cc_call_center_id", "cc_name", "cc_manager", "cd_marital_status", "cd_education_status")
           .agg(F.sum("cr_net_loss").alias("loss"))
           .select(c("cc_call_center_id").alias("Call_Center"), c("cc_name").alias("Call_Center_Name"),
                   c("cc_manager").alias("Manager"), dbl("loss").alias("Returns_Loss")))
    return top(out, None, "-Returns_Loss")


@model
def q92(t, manufact=269, start="1998-03-18", days=90):
    """Web discounts above 1.3x the item's 90-day average."""
    from .q30s import excess_discount

    return excess_discount(t, t.web_sales, "ws", manufact, start, days) \
        .withColumnRenamed("excess discount amount", "Excess Discount Amount")


@model
def q93(t, reason="Did not like the warranty", limit=100):
    """Store sales net of returns for one return reason, per customer."""
    reasons = t.reason.where(c("r_reason_desc") == reason).select("r_reason_sk")
    # the filter on the returns side turns the outer join into an inner one
    r = (t.store_returns.join(reasons, c("sr_reason_sk") == c("r_reason_sk"))
         .select("sr_item_sk", "sr_ticket_number", "sr_return_quantity"))
    j = t.store_sales.join(r, (c("sr_item_sk") == c("ss_item_sk")) & (c("sr_ticket_number") == c("ss_ticket_number")))
    act = F.when(c("sr_return_quantity").isNotNull(),
                 (c("ss_quantity") - c("sr_return_quantity")) * c("ss_sales_price")) \
        .otherwise(c("ss_quantity") * c("ss_sales_price"))
    out = j.groupBy("ss_customer_sk").agg(dbl(F.sum(act)).alias("sumsales"))
    return top(out, limit, "sumsales", "ss_customer_sk")


@model
def q94(t, start="1999-05-01", days=60, state="TX", company="pri"):
    """Web orders from several warehouses, never returned: count, ship cost, profit."""
    from .q10s import multi_warehouse_unreturned

    site = t.web_site.where(c("web_company_name") == company).select("web_site_sk")
    return multi_warehouse_unreturned(t, t.web_sales, "ws", t.web_returns, "wr", "ws_ship_date_sk", "ws_ship_addr_sk",
                                      (site, c("ws_web_site_sk") == c("web_site_sk")), start, days, state,
                                      returned=False)


@model
def q95(t, start="1999-05-01", days=60, state="TX", company="pri"):
    """Web orders from several warehouses that were returned: count, ship cost, profit."""
    lo = F.lit(start).cast("date")
    dates = t.date_dim.where(c("d_date").between(lo, F.date_add(lo, days))).select("d_date_sk")
    base = (t.web_sales.join(dates, c("ws_ship_date_sk") == c("d_date_sk"))
            .join(t.customer_address.where(c("ca_state") == state).select("ca_address_sk"),
                  c("ws_ship_addr_sk") == c("ca_address_sk"))
            .join(t.web_site.where(c("web_company_name") == company).select("web_site_sk"),
                  c("ws_web_site_sk") == c("web_site_sk"))
            .join(t.web_returns.select(c("wr_order_number").alias("ro")), c("ws_order_number") == c("ro"), "left_semi"))
    # orders owning two lines from different warehouses, found by one aggregation
    # per order that the other filters leave, not by a self-join of its line pairs
    orders = base.select(c("ws_order_number").alias("co")).distinct()
    multi = (t.web_sales.select(c("ws_order_number").alias("mo"), "ws_warehouse_sk").join(orders, c("mo") == c("co"), "left_semi")
             .groupBy("mo").agg(F.min("ws_warehouse_sk").alias("wmin"), F.max("ws_warehouse_sk").alias("wmax"))
             .where(c("wmin") < c("wmax")).select("mo"))
    base = base.join(multi, c("ws_order_number") == c("mo"), "left_semi")
    return base.agg(F.countDistinct("ws_order_number").alias("order count"),
                    dbl(F.sum("ws_ext_ship_cost")).alias("total shipping cost"),
                    dbl(F.sum("ws_net_profit")).alias("total net profit"))


@model
def q96(t, hour=8, dep=5, store_name="ese"):
    """Store sales in one half hour for one household type and store name."""
    return (t.store_sales
            .join(t.household_demographics.where(c("hd_dep_count") == dep).select("hd_demo_sk"),
                  c("ss_hdemo_sk") == c("hd_demo_sk"))
            .join(t.time_dim.where((c("t_hour") == hour) & (c("t_minute") >= 30)).select("t_time_sk"),
                  c("ss_sold_time_sk") == c("t_time_sk"))
            .join(t.store.where(c("s_store_name") == store_name).select("s_store_sk"),
                  c("ss_store_sk") == c("s_store_sk"))
            .agg(F.count(F.lit(1)).alias("store_sales_count")))


@model
def q97(t, month_seq=1212):
    """Customer/item pairs bought in store only, catalog only, or both."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    ssci = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
            .select(c("ss_customer_sk").alias("s_cust"), c("ss_item_sk").alias("s_item")).distinct())
    csci = (t.catalog_sales.join(days, c("cs_sold_date_sk") == c("d_date_sk"))
            .select(c("cs_bill_customer_sk").alias("c_cust"), c("cs_item_sk").alias("c_item")).distinct())
    j = ssci.join(csci, (c("s_cust") == c("c_cust")) & (c("s_item") == c("c_item")), "full")
    s_in, c_in = c("s_cust").isNotNull(), c("c_cust").isNotNull()
    return j.agg(lsum(F.when(s_in & ~c_in, 1).otherwise(0)).alias("store_only"),
                 lsum(F.when(~s_in & c_in, 1).otherwise(0)).alias("catalog_only"),
                 lsum(F.when(s_in & c_in, 1).otherwise(0)).alias("store_and_catalog"))


@model
def q98(t, categories=("Jewelry", "Sports", "Books"), start="2001-01-12", days=30):
    """Store item revenue and share of its class over 30 days, all rows."""
    from .q10s import class_share

    return class_share(t, t.store_sales, "ss_item_sk", "ss_sold_date_sk", "ss_ext_sales_price",
                       categories, start, days, None)


@model
def q99(t, month_seq=1212, limit=100):
    """Catalog shipping lag buckets per warehouse, ship mode and call center."""
    from .q60s import ship_lag_report

    return ship_lag_report(t, t.catalog_sales, "cs", month_seq,
                           t.call_center.select("cc_call_center_sk", "cc_name"), "call_center_sk", "cc_name", limit)
