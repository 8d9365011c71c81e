"""Query models q40-q49."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import c, davg, dbl, dsum, lsum, top
from ..operators.relational import global_rank, pinned, shared, top_ranks
from .q00s import WEEKDAYS, WEEKDAY_NAMES
from .registry import model


@model
def q40(t, pivot="1998-04-08", days=30, price_lo=0.99, price_hi=1.49, limit=100):
    """Catalog sales net of refunds before/after a date, per warehouse state and item."""
    p = F.lit(pivot).cast("date")
    dates = t.date_dim.where(c("d_date").between(F.date_sub(p, days), F.date_add(p, days))) \
        .select("d_date_sk", "d_date")
    sales = (t.catalog_sales.join(dates, c("cs_sold_date_sk") == c("d_date_sk"))
             .join(t.item.where(c("i_current_price").between(price_lo, price_hi)), c("cs_item_sk") == c("i_item_sk"))
             .join(t.warehouse, c("cs_warehouse_sk") == c("w_warehouse_sk")))
    ret = t.catalog_returns.select("cr_order_number", "cr_item_sk", "cr_refunded_cash")
    j = sales.join(ret, (c("cs_order_number") == c("cr_order_number")) & (c("cs_item_sk") == c("cr_item_sk")), "left")
    net = c("cs_sales_price") - F.coalesce(c("cr_refunded_cash"), F.lit(0))
    out = (j.groupBy("w_state", "i_item_id")
           .agg(dsum(F.when(c("d_date") < p, net).otherwise(0)).alias("sales_before"),
                dsum(F.when(c("d_date") >= p, net).otherwise(0)).alias("sales_after")))
    return top(out, limit, "w_state", "i_item_id")


# (category, colours, units, sizes) of the eight attribute combinations
Q41_COMBOS = (
    ("Women", ("orchid", "papaya"), ("Pound", "Lb"), ("petite", "medium")),
    ("Women", ("burlywood", "navy"), ("Bundle", "Each"), ("N/A", "extra large")),
    ("Men", ("bisque", "azure"), ("N/A", "Tsp"), ("small", "large")),
    ("Men", ("chocolate", "cornflower"), ("Bunch", "Gross"), ("petite", "medium")),
    ("Women", ("salmon", "midnight"), ("Oz", "Box"), ("petite", "medium")),
    ("Women", ("snow", "steel"), ("Carton", "Tbl"), ("N/A", "extra large")),
    ("Men", ("purple", "gainsboro"), ("Dram", "Unknown"), ("small", "large")),
    ("Men", ("metallic", "forest"), ("Gram", "Ounce"), ("petite", "medium")),
)


@model
def q41(t, manufact_lo=742, combos=Q41_COMBOS, limit=100):
    """Product names of manufacturers that make at least one item of the listed kinds."""
    cond = None
    for cat, colors, units, sizes in combos:
        one = ((c("i_category") == cat) & c("i_color").isin(*colors) & c("i_units").isin(*units)
               & c("i_size").isin(*sizes))
        cond = one if cond is None else cond | one
    makers = t.item.where(cond).select(c("i_manufact").alias("m"))
    out = (t.item.where(c("i_manufact_id").between(manufact_lo, manufact_lo + 40))
           .join(makers, c("i_manufact") == c("m"), "left_semi")
           .select("i_product_name").distinct())
    return top(out, limit, "i_product_name")


def brand_or_category_revenue(t, group, manager, moy, year):
    days = t.date_dim.where((c("d_moy") == moy) & (c("d_year") == year)).select("d_date_sk", "d_year")
    return (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
            .join(t.item.where(c("i_manager_id") == manager), c("ss_item_sk") == c("i_item_sk"))
            .groupBy(*group).agg(dsum("ss_ext_sales_price").alias("total")))


@model
def q42(t, manager=1, moy=12, year=1998, limit=100):
    """Category revenue of one manager in one month."""
    g = brand_or_category_revenue(t, ["d_year", "i_category_id", "i_category"], manager, moy, year)
    out = g.select("d_year", "i_category_id", "i_category", c("total").alias("total_sales"))
    return top(out, limit, "-total_sales", "d_year", "i_category_id", "i_category")


@model
def q43(t, gmt=-5, year=1998, limit=100):
    """Store sales by weekday for one year and time zone."""
    days = t.date_dim.where(c("d_year") == year).select("d_date_sk", "d_day_name")
    out = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
           .join(t.store.where(c("s_gmt_offset") == gmt), c("ss_store_sk") == c("s_store_sk"))
           .groupBy("s_store_name", "s_store_id")
           .agg(*[dsum(F.when(c("d_day_name") == n, c("ss_sales_price"))).alias(f"{d}_sales")
                  for d, n in zip(WEEKDAYS, WEEKDAY_NAMES)]))
    return top(out, limit, "s_store_name", "s_store_id", *[f"{d}_sales" for d in WEEKDAYS])


@model
def q44(t, store=2, share_tenths=9, n=10, limit=100):
    """Best and worst items of one store by average profit, side by side by rank."""
    no_demo = F.when(c("ss_hdemo_sk").isNull(), c("ss_net_profit"))
    per_item = shared(t.store_sales.where(c("ss_store_sk") == store).groupBy(c("ss_item_sk").alias("item_sk"))
                      .agg(F.sum("ss_net_profit").alias("s"), F.count("ss_net_profit").alias("cnt"),
                           davg("ss_net_profit").alias("rank_col"), F.sum(no_demo).alias("bs"), F.count(no_demo).alias("bn")))
    base = per_item.agg(F.sum("bs").alias("bs"), F.sum("bn").alias("bn"))
    per_item = per_item.drop("bs", "bn")
    # avg > 0.9 * store average, as exact decimal arithmetic against one row
    kept = per_item.crossJoin(base).where(c("s") * c("bn") * 10 > c("bs") * share_tenths * c("cnt"))
    asc = top_ranks(kept.select("item_sk", "rank_col"), "rank_col", "rnk", n).select("item_sk", "rnk")
    desc = top_ranks(kept.select(c("item_sk").alias("item_sk2"), "rank_col"), "rank_col", "rnk2", n, descending=True) \
        .select("item_sk2", "rnk2")
    i1 = t.item.select(c("i_item_sk").alias("i1_sk"), c("i_product_name").alias("best_performing"))
    i2 = t.item.select(c("i_item_sk").alias("i2_sk"), c("i_product_name").alias("worst_performing"))
    out = (asc.join(desc, c("rnk") == c("rnk2"))
           .join(i1, c("item_sk") == c("i1_sk")).join(i2, c("item_sk2") == c("i2_sk"))
           .select(c("rnk").cast("long").alias("rnk"), "best_performing", "worst_performing"))
    return top(out, limit, "rnk")


@model
def q45(t, zips=("85669", "86197", "88274", "83405", "86475", "85392", "85460", "80348", "81792"),
        item_sks=(2, 3, 5, 7, 11, 13, 17, 19, 23, 29), qoy=2, year=2000, limit=100):
    """Web sales by zip and county where the zip is listed or the item is one of a few."""
    ids = t.item.where(c("i_item_sk").isin(list(item_sks))).select(c("i_item_id").alias("pick_id")).distinct()
    days = t.date_dim.where((c("d_qoy") == qoy) & (c("d_year") == year)).select("d_date_sk")
    j = (t.web_sales.join(days, c("ws_sold_date_sk") == c("d_date_sk"))
         .join(t.customer, c("ws_bill_customer_sk") == c("c_customer_sk"))
         .join(t.customer_address, c("c_current_addr_sk") == c("ca_address_sk"))
         .join(t.item, c("ws_item_sk") == c("i_item_sk"))
         # IN (subquery) under OR: a left join against the distinct ids gives the flag
         .join(ids, c("i_item_id") == c("pick_id"), "left"))
    out = (j.where(F.substring("ca_zip", 1, 5).isin(list(zips)) | c("pick_id").isNotNull())
           .groupBy("ca_zip", "ca_county").agg(dsum("ws_sales_price").alias("total_sales")))
    return top(out, limit, "ca_zip", "ca_county")


def ticket_city(t, dow, years, cities, hd_cond, aggs):
    """Per ticket sums where the purchase address city differs from the home city (q46, q68)."""
    days = t.date_dim.where(dow & c("d_year").isin(list(years))).select("d_date_sk")
    dn = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
          .join(t.store.where(c("s_city").isin(list(cities))).select("s_store_sk"), c("ss_store_sk") == c("s_store_sk"))
          .join(t.household_demographics.where(hd_cond).select("hd_demo_sk"), c("ss_hdemo_sk") == c("hd_demo_sk"))
          .join(t.customer_address.select("ca_address_sk", c("ca_city").alias("bought_city")),
                c("ss_addr_sk") == c("ca_address_sk"))
          .groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "bought_city").agg(*aggs))
    home = t.customer_address.select(c("ca_address_sk").alias("home_sk"), "ca_city")
    return (dn.join(t.customer, c("ss_customer_sk") == c("c_customer_sk"))
            .join(home, c("c_current_addr_sk") == c("home_sk"))
            .where(c("ca_city") != c("bought_city")))


@model
def q46(t, dep=5, vehicles=3, years=(1999, 2000, 2001), cities=("Midway", "Fairview"), limit=100):
    """Weekend tickets bought away from home: coupon amount and profit."""
    j = ticket_city(t, c("d_dow").isin(6, 0), years, cities,
                    (c("hd_dep_count") == dep) | (c("hd_vehicle_count") == vehicles),
                    [dsum("ss_coupon_amt").alias("amt"), dsum("ss_net_profit").alias("profit")])
    out = j.select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "amt", "profit")
    return top(out, limit, "c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number")


def monthly_deviation(t, fact, p, outlet_join, outlet_cols, year, item_filter=None):
    """Monthly sales with the yearly mean and neighbouring months (q47, q57)."""
    days = t.date_dim.where((c("d_year") == year) | ((c("d_year") == year - 1) & (c("d_moy") == 12))
                            | ((c("d_year") == year + 1) & (c("d_moy") == 1))).select("d_date_sk", "d_year", "d_moy")
    keys = ["i_category", "i_brand", *outlet_cols]
    items = t.item if item_filter is None else t.item.where(item_filter)
    g = (fact.join(days, c(f"{p}_sold_date_sk") == c("d_date_sk"))
         .join(items, c(f"{p}_item_sk") == c("i_item_sk"))
         .join(*outlet_join)
         .groupBy(*keys, "d_year", "d_moy").agg(F.sum(f"{p}_sales_price").alias("sum_sales")))
    # the neighbour self-join on rank +/- 1 matches only non-NULL keys; with
    # those rows removed, lag/lead over the same order give the same pairs
    g = g.where(F.greatest(*[c(k).isNull() for k in keys]) == F.lit(False))
    series = W.partitionBy(*keys).orderBy("d_year", "d_moy")
    year_w = W.partitionBy(*keys, "d_year")
    v = g.select(*keys, "d_year", "d_moy", "sum_sales",
                 (F.sum("sum_sales").over(year_w).cast("double") / F.count("sum_sales").over(year_w))
                 .alias("avg_monthly_sales"),
                 F.lag("sum_sales").over(series).alias("psum"), F.lead("sum_sales").over(series).alias("nsum"),
                 F.lag("d_moy").over(series).alias("has_prev"), F.lead("d_moy").over(series).alias("has_next"))
    v = v.where(c("has_prev").isNotNull() & c("has_next").isNotNull() & (c("d_year") == year)
                & (c("avg_monthly_sales") > 0)
                & (F.when(c("avg_monthly_sales") > 0,
                          F.abs(dbl("sum_sales") - c("avg_monthly_sales")) / c("avg_monthly_sales")) > 0.1))
    return v.select(*keys, "d_year", "d_moy", "avg_monthly_sales", dbl("sum_sales").alias("sum_sales"),
                    dbl("psum").alias("psum"), dbl("nsum").alias("nsum"))


@model
def q47(t, year=2000, limit=100):
    """Store brand months deviating more than 10% from the yearly mean, with neighbours."""
    v = monthly_deviation(t, t.store_sales, "ss", (t.store, c("ss_store_sk") == c("s_store_sk")),
                          ["s_store_name", "s_company_name"], year)
    out = v.select("i_category", "i_brand", "d_year", "d_moy", "avg_monthly_sales", "sum_sales", "psum", "nsum",
                   "s_store_name", "s_company_name")
    out = top(out, limit, (c("sum_sales") - c("avg_monthly_sales")).asc_nulls_last(), "nsum")
    return out.select("i_category", "i_brand", "d_year", "d_moy", "avg_monthly_sales", "sum_sales", "psum", "nsum")


@model
def q48(t, year=1998):
    """Quantity under OR-ed demographic, price, address and profit bands."""
    sold = pinned(t.store_sales
                  .join(t.store.select("s_store_sk"), c("ss_store_sk") == c("s_store_sk"))
                  .join(t.date_dim.where(c("d_year") == year).select("d_date_sk"), c("ss_sold_date_sk") == c("d_date_sk")),
                  "ss_sales_price", "ss_net_profit")
    ss = (sold
          .join(t.customer_demographics, c("ss_cdemo_sk") == c("cd_demo_sk"))
          .join(t.customer_address.where(c("ca_country") == "United States"), c("ss_addr_sk") == c("ca_address_sk")))
    price, profit = c("ss_sales_price"), c("ss_net_profit")
    demo = (((c("cd_marital_status") == "M") & (c("cd_education_status") == "4 yr Degree") & price.between(100, 150))
            | ((c("cd_marital_status") == "D") & (c("cd_education_status") == "Primary") & price.between(50, 100))
            | ((c("cd_marital_status") == "U") & (c("cd_education_status") == "Advanced Degree")
               & price.between(150, 200)))
    geo = ((c("ca_state").isin("KY", "GA", "NM") & profit.between(0, 2000))
           | (c("ca_state").isin("MT", "OR", "IN") & profit.between(150, 3000))
           | (c("ca_state").isin("WI", "MO", "WV") & profit.between(50, 25000)))
    return ss.where(demo & geo).agg(lsum("ss_quantity").alias("total_quantity"))


def _return_ranks(t, sales, p, returns, rp, ticket, r_ticket, ret_amt, sold_date, year, moy, channel):
    days = t.date_dim.where((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk")
    # the outer join is undone by the filter on the returned amount: inner join
    sold = pinned(sales.join(days, c(sold_date) == c("d_date_sk"))
                  .select(ticket, f"{p}_item_sk", f"{p}_net_profit", f"{p}_net_paid", f"{p}_quantity"),
                  f"{p}_net_profit", f"{p}_net_paid", f"{p}_quantity")
    j = (sold.where((c(f"{p}_net_profit") > 1) & (c(f"{p}_net_paid") > 0) & (c(f"{p}_quantity") > 0))
         .join(returns.where(c(ret_amt) > 10000),
               (c(ticket) == c(r_ticket)) & (c(f"{p}_item_sk") == c(f"{rp}_item_sk"))))
    g = j.groupBy(c(f"{p}_item_sk").alias("item")).agg(
        (dbl(F.sum(F.coalesce(c(f"{rp}_return_quantity"), F.lit(0))))
         / dbl(F.sum(F.coalesce(c(f"{p}_quantity"), F.lit(0))))).alias("return_ratio"),
        (dbl(F.sum(F.coalesce(c(ret_amt), F.lit(0))))
         / dbl(F.sum(F.coalesce(c(f"{p}_net_paid"), F.lit(0))))).alias("currency_ratio"))
    g = shared(g)
    # ranks over all items of the month, computed without a single-task window
    r = global_rank(global_rank(g, "return_ratio", "return_rank"), "currency_ratio", "currency_rank")
    return r.where((c("return_rank") <= 10) | (c("currency_rank") <= 10)) \
        .select(F.lit(channel).alias("channel"), "item", "return_ratio", "return_rank", "currency_rank")


@model
def q49(t, year=2000, moy=12, limit=100):
    """Items with the worst return ratios per channel by two ranks."""
    web = _return_ranks(t, t.web_sales, "ws", t.web_returns, "wr", "ws_order_number", "wr_order_number",
                        "wr_return_amt", "ws_sold_date_sk", year, moy, "web")
    cat = _return_ranks(t, t.catalog_sales, "cs", t.catalog_returns, "cr", "cs_order_number", "cr_order_number",
                        "cr_return_amount", "cs_sold_date_sk", year, moy, "catalog")
    sto = _return_ranks(t, t.store_sales, "ss", t.store_returns, "sr", "ss_ticket_number", "sr_ticket_number",
                        "sr_return_amt", "ss_sold_date_sk", year, moy, "store")
    out = web.union(cat).union(sto).distinct()
    return top(out, limit, "channel", "return_rank", "currency_rank", "item")
