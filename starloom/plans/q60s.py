"""Query models q60-q74."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import c, dbl, dsum, lsum, top
from ..operators.relational import cascaded_rollup
from .q00s import customer_years
from .q30s import channel_item_revenue
from .q50s import _q53_items, lag_buckets, period_deviation
from .registry import model

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


@model
def q60(t, category="Children", year=1999, moy=9, gmt=-6, limit=100):
    """Item revenue across channels for one category and time zone."""
    return channel_item_revenue(t, "i_item_id", c("i_category") == category, year, moy, gmt,
                                ("i_item_id", "total_sales"), limit)


@model
def q61(t, gmt=-7, category="Books", year=1999, moy=11, limit=100):
    """Share of promoted store sales in one month, category and time zone."""
    days = t.date_dim.where((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk")
    base = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
            .join(t.store.where(c("s_gmt_offset") == gmt).select("s_store_sk"), c("ss_store_sk") == c("s_store_sk"))
            .join(t.customer.select("c_customer_sk", "c_current_addr_sk"), c("ss_customer_sk") == c("c_customer_sk"))
            .join(t.customer_address.where(c("ca_gmt_offset") == gmt).select("ca_address_sk"),
                  c("c_current_addr_sk") == c("ca_address_sk"))
            .join(t.item.where(c("i_category") == category).select("i_item_sk"), c("ss_item_sk") == c("i_item_sk")))
    promo = t.promotion.where((c("p_channel_dmail") == "Y") | (c("p_channel_email") == "Y")
                              | (c("p_channel_tv") == "Y")).select("p_promo_sk")
    # one pass: the promoted part is a conditional sum
    sums = base.join(promo, c("ss_promo_sk") == c("p_promo_sk"), "left").agg(
        dsum(F.when(c("p_promo_sk").isNotNull(), c("ss_ext_sales_price"))).alias("promotions"),
        dsum("ss_ext_sales_price").alias("total"))
    out = sums.select(
        "promotions", "total", (c("promotions") / c("total") * 100).alias("promotional_pct"))
    return top(out, limit, "promotions", "total")


def ship_lag_report(t, fact, p, month_seq, outlet_dim, outlet_key, outlet_col, limit=100):
    """Shipping lag buckets per warehouse, ship mode and outlet (q62, q99)."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    j = (fact.join(days, c(f"{p}_ship_date_sk") == c("d_date_sk"))
         .join(t.warehouse, c(f"{p}_warehouse_sk") == c("w_warehouse_sk"))
         .join(t.ship_mode, c(f"{p}_ship_mode_sk") == c("sm_ship_mode_sk"))
         .join(outlet_dim, c(f"{p}_{outlet_key}") == c(outlet_dim.columns[0])))
    keys = [F.substring("w_warehouse_name", 1, 20).alias("w_warehouse_name_substr"), "sm_type", outlet_col]
    out = j.groupBy(*keys).agg(*lag_buckets(c(f"{p}_ship_date_sk") - c(f"{p}_sold_date_sk")))
    return top(out, limit, "w_warehouse_name_substr", "sm_type", outlet_col)


@model
def q62(t, month_seq=1212, limit=100):
    """Web shipping lag buckets per warehouse, ship mode and site."""
    return ship_lag_report(t, t.web_sales, "ws", month_seq, t.web_site.select("web_site_sk", "web_name"),
                           "web_site_sk", "web_name", limit)


@model
def q63(t, month_seq=1212, limit=100):
    """Manager monthly sales deviating more than 10% from their mean."""
    v = period_deviation(t, "i_manager_id", "d_moy", month_seq, _q53_items(), "avg_monthly_sales")
    return top(v.select("i_manager_id", "sum_sales", "avg_monthly_sales"), limit,
               "i_manager_id", "avg_monthly_sales", "sum_sales")


Q64_COLORS = ("maroon", "burnished", "dim", "steel", "navajo", "chocolate")


@model
def q64(t, colors=Q64_COLORS, price=35, year=2000):
    """Items bought at the same store in consecutive years by customers whose marital status changed."""
    refund = c("cr_refunded_cash") + c("cr_reversed_charge") + c("cr_store_credit")
    cs_ui = (t.catalog_sales.join(t.catalog_returns, (c("cs_item_sk") == c("cr_item_sk"))
                                  & (c("cs_order_number") == c("cr_order_number")))
             .groupBy(c("cs_item_sk").alias("ui_item"))
             .agg(F.sum("cs_ext_list_price").alias("sale"), F.sum(refund).alias("refund"))
             .where(c("sale") > c("refund") * 2).select("ui_item"))
    items = t.item.where(c("i_color").isin(*colors) & c("i_current_price").between(price, price + 10)
                         & c("i_current_price").between(price + 1, price + 15)).select("i_item_sk", "i_product_name")
    d = t.date_dim.select("d_date_sk", "d_year")
    cd1 = t.customer_demographics.select(c("cd_demo_sk").alias("cd1_sk"), c("cd_marital_status").alias("m1"))
    cd2 = t.customer_demographics.select(c("cd_demo_sk").alias("cd2_sk"), c("cd_marital_status").alias("m2"))
    hd1 = t.household_demographics.select(c("hd_demo_sk").alias("hd1_sk"), c("hd_income_band_sk").alias("ib1"))
    hd2 = t.household_demographics.select(c("hd_demo_sk").alias("hd2_sk"), c("hd_income_band_sk").alias("ib2"))
    ib = t.income_band.select("ib_income_band_sk")
    ad = t.customer_address.select("ca_address_sk", "ca_street_number", "ca_street_name", "ca_city", "ca_zip")
    ad1 = ad.select(*[c(x).alias(f"b_{x[3:]}") for x in ad.columns])
    ad2 = ad.select(*[c(x).alias(f"c_{x[3:]}") for x in ad.columns])
    cust = t.customer.select("c_customer_sk", "c_current_cdemo_sk", "c_current_hdemo_sk", "c_current_addr_sk",
                             "c_first_sales_date_sk", "c_first_shipto_date_sk")
    # filters of small dimensions first, then the fact-to-fact join
    j = (t.store_sales
         .join(items, c("ss_item_sk") == c("i_item_sk"))
         .join(cs_ui, c("ss_item_sk") == c("ui_item"), "left_semi")
         .join(t.store_returns.select("sr_item_sk", "sr_ticket_number"),
               (c("ss_item_sk") == c("sr_item_sk")) & (c("ss_ticket_number") == c("sr_ticket_number")))
         .join(t.store.select("s_store_sk", "s_store_name", "s_zip"), c("ss_store_sk") == c("s_store_sk"))
         .join(d.select(c("d_date_sk").alias("d1"), c("d_year").alias("syear")), c("ss_sold_date_sk") == c("d1"))
         .join(cust, c("ss_customer_sk") == c("c_customer_sk"))
         .join(cd1, c("ss_cdemo_sk") == c("cd1_sk"))
         .join(cd2, c("c_current_cdemo_sk") == c("cd2_sk"))
         .where(c("m1") != c("m2"))
         .join(t.promotion.select("p_promo_sk"), c("ss_promo_sk") == c("p_promo_sk"))
         .join(hd1, c("ss_hdemo_sk") == c("hd1_sk"))
         .join(hd2, c("c_current_hdemo_sk") == c("hd2_sk"))
         .join(ib.select(c("ib_income_band_sk").alias("ib1_sk")), c("ib1") == c("ib1_sk"))
         .join(ib.select(c("ib_income_band_sk").alias("ib2_sk")), c("ib2") == c("ib2_sk"))
         .join(ad1, c("ss_addr_sk") == c("b_address_sk"))
         .join(ad2, c("c_current_addr_sk") == c("c_address_sk"))
         .join(d.select(c("d_date_sk").alias("d2"), c("d_year").alias("fsyear")), c("c_first_sales_date_sk") == c("d2"))
         .join(d.select(c("d_date_sk").alias("d3"), c("d_year").alias("s2year")),
               c("c_first_shipto_date_sk") == c("d3")))
    keys = ["i_product_name", "i_item_sk", "s_store_name", "s_zip", "b_street_number", "b_street_name", "b_city",
            "b_zip", "c_street_number", "c_street_name", "c_city", "c_zip", "syear", "fsyear", "s2year"]
    cross = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), F.sum("ss_wholesale_cost").alias("s1"),
                                 F.sum("ss_list_price").alias("s2"), F.sum("ss_coupon_amt").alias("s3"))
    a = cross.where(c("syear") == year)
    b = cross.where(c("syear") == year + 1).select(
        c("i_item_sk").alias("item2"), c("s_store_name").alias("store2"), c("s_zip").alias("zip2"),
        c("s1").alias("b_s1"), c("s2").alias("b_s2"), c("s3").alias("b_s3"), c("syear").alias("syear2"),
        c("cnt").alias("cnt2"))
    out = (a.join(b, (c("i_item_sk") == c("item2")) & (c("s_store_name") == c("store2")) & (c("s_zip") == c("zip2")))
           .where(c("cnt2") <= c("cnt"))
           .select(c("i_product_name").alias("product_name"), c("s_store_name").alias("store_name"),
                   c("s_zip").alias("store_zip"), "b_street_number", "b_street_name", "b_city", "b_zip",
                   "c_street_number", "c_street_name", "c_city", "c_zip", "syear", "cnt",
                   dbl("s1").alias("s11"), dbl("s2").alias("s21"), dbl("s3").alias("s31"),
                   dbl("b_s1").alias("s12"), dbl("b_s2").alias("s22"), dbl("b_s3").alias("s32"),
                   "syear2", "cnt2"))
    return top(out, None, "product_name", "store_name", "cnt2", "s11", "s12")


@model
def q65(t, month_seq=1212, share_tenths=1, limit=100):
    """Store items whose revenue is at most 10% of the store's average item revenue."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    sc = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
          .groupBy("ss_store_sk", "ss_item_sk").agg(F.sum("ss_sales_price").alias("revenue")))
    sb = sc.groupBy(c("ss_store_sk").alias("sb_store")).agg(F.sum("revenue").alias("rs"),
                                                            F.count("revenue").alias("rn"))
    out = (sc.join(sb, c("ss_store_sk") == c("sb_store"))
           .where(c("revenue") * c("rn") * 10 <= c("rs") * share_tenths)
           .join(t.store, c("ss_store_sk") == c("s_store_sk"))
           .join(t.item, c("ss_item_sk") == c("i_item_sk"))
           .select("s_store_name", "i_item_desc", dbl("revenue").alias("revenue"),
                   dbl("i_current_price").alias("i_current_price"), dbl("i_wholesale_cost").alias("i_wholesale_cost"),
                   "i_brand"))
    return top(out, limit, "s_store_name", "i_item_desc")


_W_COLS = ("w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country")


def _warehouse_months(t, fact, p, price, net, days, times, modes):
    j = (fact.join(days, c(f"{p}_sold_date_sk") == c("d_date_sk"))
         .join(times, c(f"{p}_sold_time_sk") == c("t_time_sk"))
         .join(modes, c(f"{p}_ship_mode_sk") == c("sm_ship_mode_sk"))
         .join(t.warehouse, c(f"{p}_warehouse_sk") == c("w_warehouse_sk")))
    aggs = []
    for i, m in enumerate(MONTHS, 1):
        aggs.append(F.sum(F.when(c("d_moy") == i, c(price) * c(f"{p}_quantity")).otherwise(0)).alias(f"{m}_sales"))
    for i, m in enumerate(MONTHS, 1):
        aggs.append(F.sum(F.when(c("d_moy") == i, c(net) * c(f"{p}_quantity")).otherwise(0)).alias(f"{m}_net"))
    g = j.groupBy(*_W_COLS, c("d_year").alias("year")).agg(*aggs)
    # per square foot in double per channel row, summed after the union
    return g.select(*_W_COLS, "year", *[c(f"{m}_sales") for m in MONTHS],
                    *[(dbl(f"{m}_sales") / c("w_warehouse_sq_ft")).alias(f"{m}_psf") for m in MONTHS],
                    *[c(f"{m}_net") for m in MONTHS])


@model
def q66(t, year=2002, time_lo=49530, carriers=("DIAMOND", "AIRBORNE"), limit=100):
    """Warehouse monthly sales and per-square-foot figures for web and catalog."""
    days = t.date_dim.where(c("d_year") == year).select("d_date_sk", "d_year", "d_moy")
    times = t.time_dim.where(c("t_time").between(time_lo, time_lo + 28800)).select("t_time_sk")
    modes = t.ship_mode.where(c("sm_carrier").isin(*carriers)).select("sm_ship_mode_sk")
    web = _warehouse_months(t, t.web_sales, "ws", "ws_sales_price", "ws_net_paid_inc_tax", days, times, modes)
    cat = _warehouse_months(t, t.catalog_sales, "cs", "cs_ext_sales_price", "cs_net_paid_inc_ship_tax",
                            days, times, modes)
    u = web.unionByName(cat).withColumn("ship_carriers", F.lit(",".join(carriers)))
    out = (u.groupBy(*_W_COLS, "ship_carriers", "year")
           .agg(*[dsum(f"{m}_sales").alias(f"{m}_sales") for m in MONTHS],
                *[F.sum(f"{m}_psf").alias(f"{m}_sales_per_sq_foot") for m in MONTHS],
                *[dsum(f"{m}_net").alias(f"{m}_net") for m in MONTHS]))
    return top(out, limit, "w_warehouse_name")


@model
def q67(t, month_seq=1212, n=100, limit=100):
    """Top sales per category over eight-level subtotals."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)) \
        .select("d_date_sk", "d_year", "d_qoy", "d_moy")
    keys = ["i_category", "i_class", "i_brand", "i_product_name", "d_year", "d_qoy", "d_moy", "s_store_id"]
    sales = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
             .join(t.store.select("s_store_sk", "s_store_id"), c("ss_store_sk") == c("s_store_sk"))
             .join(t.item, c("ss_item_sk") == c("i_item_sk")))
    rolled = cascaded_rollup(sales, keys, F.sum(F.coalesce(c("ss_sales_price") * c("ss_quantity"), F.lit(0))).alias("sumsales"))
    # rank <= n per category plans as a window group limit, applied per
    # partition before the shuffle as well
    w = W.partitionBy("i_category").orderBy(c("sumsales").desc_nulls_last())
    ranked = rolled.select(*keys, "sumsales", F.rank().over(w).alias("rk")).where(c("rk") <= n)
    out = ranked.select(*keys, dbl("sumsales").alias("sumsales"), c("rk").cast("long").alias("rk"))
    return top(out, limit, *keys, "sumsales", "rk")


@model
def q68(t, years=(1999, 2000, 2001), cities=("Midway", "Fairview"), dep=5, vehicles=3, limit=100):
    """Tickets of the first two days of a month bought away from home."""
    from .q40s import ticket_city

    j = ticket_city(t, c("d_dom").between(1, 2), years, cities,
                    (c("hd_dep_count") == dep) | (c("hd_vehicle_count") == vehicles),
                    [dsum("ss_ext_sales_price").alias("extended_price"), dsum("ss_ext_list_price").alias("list_price"),
                     dsum("ss_ext_tax").alias("extended_tax")])
    out = j.select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "extended_price",
                   "extended_tax", "list_price")
    return top(out, limit, "c_last_name", "ss_ticket_number")


def _buyers_in(t, fact, cust_col, date_col, cond):
    days = t.date_dim.where(cond).select("d_date_sk")
    return fact.join(days, c(date_col) == c("d_date_sk")).select(c(cust_col).alias("buyer"))


@model
def q69(t, states=("CO", "IL", "MN"), year=1999, moy=1, months=3, limit=100):
    """Demographics of customers buying in store but neither by web nor by catalog."""
    cond = (c("d_year") == year) & c("d_moy").between(moy, moy + months - 1)
    store = _buyers_in(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk", cond)
    web = _buyers_in(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk", cond)
    cat = _buyers_in(t, t.catalog_sales, "cs_ship_customer_sk", "cs_sold_date_sk", cond)
    cust = (t.customer.join(store, c("c_customer_sk") == c("buyer"), "left_semi")
            .join(web, c("c_customer_sk") == c("buyer"), "left_anti")
            .join(cat, c("c_customer_sk") == c("buyer"), "left_anti"))
    keys = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating"]
    g = (cust.join(t.customer_address.where(c("ca_state").isin(*states)), c("c_current_addr_sk") == c("ca_address_sk"))
         .join(t.customer_demographics, c("c_current_cdemo_sk") == c("cd_demo_sk"))
         .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    out = g.select("cd_gender", "cd_marital_status", "cd_education_status", c("n").alias("cnt1"),
                   "cd_purchase_estimate", c("n").alias("cnt2"), "cd_credit_rating", c("n").alias("cnt3"))
    return top(out, limit, *keys)


def ranked_two_level(j, a, b, measure, measure_name, order_desc, limit=100):
    """Rollup of (a, b) with a rank of each row inside its parent (q36, q70, q86)."""
    g = cascaded_rollup(j, [a, b], F.sum(measure).alias("m")).withColumn("lochierarchy", c("_level").cast("long"))
    parent = F.when(c("lochierarchy") == 0, c(a))
    order = c("m").desc_nulls_last() if order_desc else c("m").asc_nulls_last()
    w = W.partitionBy("lochierarchy", parent).orderBy(order)
    out = g.select(dbl("m").alias(measure_name), a, b, "lochierarchy",
                   F.rank().over(w).cast("long").alias("rank_within_parent"))
    return top(out, limit, "-lochierarchy", F.when(c("lochierarchy") == 0, c(a)).asc_nulls_last(),
               "rank_within_parent")


@model
def q70(t, month_seq=1212, top_states=5, limit=100):
    """Net profit by state and county with subtotals, ranked inside the parent."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    sales = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
             .join(t.store.select("s_store_sk", "s_state", "s_county"), c("ss_store_sk") == c("s_store_sk")))
    # the ranking is partitioned by the grouping key, so every state ranks first;
    # the shape is kept as written
    per_state = sales.groupBy("s_state").agg(F.sum("ss_net_profit").alias("p"))
    ranked = per_state.select(c("s_state").alias("top_state"),
                              F.rank().over(W.partitionBy("s_state").orderBy(c("p").desc_nulls_last())).alias("r"))
    states = ranked.where(c("r") <= top_states).select("top_state")
    j = sales.join(states, c("s_state") == c("top_state"), "left_semi")
    return ranked_two_level(j, "s_state", "s_county", "ss_net_profit", "total_sum", True, limit)


@model
def q71(t, manager=1, moy=12, year=2000, meals=("breakfast", "dinner")):
    """Brand revenue by hour and minute at breakfast or dinner across channels."""
    days = t.date_dim.where((c("d_moy") == moy) & (c("d_year") == year)).select("d_date_sk")
    u = None
    for table, p in (("web_sales", "ws"), ("catalog_sales", "cs"), ("store_sales", "ss")):
        part = (getattr(t, table).join(days, c(f"{p}_sold_date_sk") == c("d_date_sk"))
                .select(c(f"{p}_ext_sales_price").alias("ext_price"), c(f"{p}_item_sk").alias("sold_item_sk"),
                        c(f"{p}_sold_time_sk").alias("time_sk")))
        u = part if u is None else u.unionByName(part)
    out = (u.join(t.item.where(c("i_manager_id") == manager), c("sold_item_sk") == c("i_item_sk"))
           .join(t.time_dim.where(c("t_meal_time").isin(*meals)), c("time_sk") == c("t_time_sk"))
           .groupBy("i_brand", "i_brand_id", "t_hour", "t_minute").agg(dsum("ext_price").alias("ext_price"))
           .select(c("i_brand_id").alias("brand_id"), c("i_brand").alias("brand"), "t_hour", "t_minute", "ext_price"))
    return top(out, None, "-ext_price", "brand_id")


@model
def q72(t, buy_potential="1001-5000", year=2001, marital="M", lag_days=5, limit=100):
    """Catalog lines short of stock in the week of sale, by promotion presence."""
    d1 = t.date_dim.where(c("d_year") == year).select(c("d_date_sk").alias("d1_sk"), c("d_week_seq").alias("wk"),
                                                      c("d_date").alias("d1_date"))
    cs = (t.catalog_sales
          .join(t.household_demographics.where(c("hd_buy_potential") == buy_potential).select("hd_demo_sk"),
                c("cs_bill_hdemo_sk") == c("hd_demo_sk"))
          .join(t.customer_demographics.where(c("cd_marital_status") == marital).select("cd_demo_sk"),
                c("cs_bill_cdemo_sk") == c("cd_demo_sk"))
          .join(d1, c("cs_sold_date_sk") == c("d1_sk"))
          .join(t.date_dim.select(c("d_date_sk").alias("d3_sk"), c("d_date").alias("d3_date")),
                c("cs_ship_date_sk") == c("d3_sk"))
          .where(c("d3_date") > F.date_add(c("d1_date"), lag_days)))
    # the week of the snapshot is part of the equi-join key, so inventory
    # rows meet only the sales of their own item and week
    # and only snapshots of the year's weeks are read and shuffled
    weeks = d1.select(c("wk").alias("d_week_seq"))
    d2 = t.date_dim.join(weeks, "d_week_seq", "left_semi").select(c("d_date_sk").alias("d2_sk"), c("d_week_seq").alias("inv_wk"))
    inv = t.inventory.join(d2, c("inv_date_sk") == c("d2_sk"))
    j = (cs.join(inv, (c("cs_item_sk") == c("inv_item_sk")) & (c("wk") == c("inv_wk"))
                 & (c("inv_quantity_on_hand") < c("cs_quantity")))
         .join(t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), c("inv_warehouse_sk") == c("w_warehouse_sk"))
         .join(t.item.select("i_item_sk", "i_item_desc"), c("cs_item_sk") == c("i_item_sk"))
         .join(t.promotion.select("p_promo_sk"), c("cs_promo_sk") == c("p_promo_sk"), "left")
         .join(t.catalog_returns.select("cr_item_sk", "cr_order_number"),
               (c("cr_item_sk") == c("cs_item_sk")) & (c("cr_order_number") == c("cs_order_number")), "left"))
    out = (j.groupBy("i_item_desc", "w_warehouse_name", c("wk").alias("d_week_seq"))
           .agg(lsum(F.when(c("p_promo_sk").isNull(), 1).otherwise(0)).alias("no_promo"),
                lsum(F.when(c("p_promo_sk").isNotNull(), 1).otherwise(0)).alias("promo"),
                F.count(F.lit(1)).alias("total_cnt")))
    return top(out, limit, "-total_cnt", "i_item_desc", "w_warehouse_name", "d_week_seq")


@model
def q73(t, years=(1998, 1999, 2000), lo=1, hi=5):
    """Tickets with one to five lines on the first two days of a month."""
    from .q30s import ticket_counts

    dj = ticket_counts(t, c("d_dom").between(1, 2), (">10000", "Unknown"), 1, years, ("Williamson County",))
    out = (dj.where(c("cnt").between(lo, hi)).join(t.customer, c("ss_customer_sk") == c("c_customer_sk"))
           .select("c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag", "ss_ticket_number", "cnt"))
    return top(out, None, "-cnt", "c_last_name")


@model
def q74(t, year=2001, limit=100):
    """Customers whose web growth on the largest payment beats store growth."""
    y1, y2 = year, year + 1
    largest = lambda x: dbl(F.max(x))
    s = customer_years(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk", c("ss_net_paid"), y1, y2, "s", largest)
    w = customer_years(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk", c("ws_net_paid"), y1, y2, "w", largest)
    out = (s.join(w, "customer_sk")
           .where((c("s1") > 0) & (c("w1") > 0) & (c("w2") / c("w1") > c("s2") / c("s1")))
           .join(t.customer, c("customer_sk") == c("c_customer_sk"))
           .select(c("c_customer_id").alias("customer_id"), c("c_first_name").alias("customer_first_name"),
                   c("c_last_name").alias("customer_last_name")))
    return top(out, limit, "customer_first_name", "customer_id", "customer_last_name")
