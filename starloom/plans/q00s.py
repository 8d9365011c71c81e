"""Query models q01-q09."""

from pyspark.sql import functions as F

from ..functions import c, davg, dbl, dsum, nz_div, top
from ..operators.relational import cascaded_rollup
from .q08_zips import Q08_ZIPS
from .registry import model

WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


@model
def q01(t, year=2000, state="TN", factor_tenths=12, limit=100):
    """Customers whose yearly store-return fees exceed 1.2x their store's average."""
    days = t.date_dim.where(c("d_year") == year).select("d_date_sk")
    ctr = (t.store_returns.join(days, c("sr_returned_date_sk") == c("d_date_sk"))
           .groupBy(c("sr_customer_sk").alias("cust"), c("sr_store_sk").alias("store"))
           .agg(F.sum("sr_fee").alias("total")))
    # the correlated average per store, decorrelated: one row per store,
    # joined back (a broadcast at run time, bounded by the store count)
    per_store = ctr.groupBy("store").agg(F.sum("total").alias("st"), F.count("total").alias("sc"))
    stores = t.store.where(c("s_state") == state).select("s_store_sk")
    out = (ctr.join(per_store, "store")
           .where(c("total") * c("sc") * 10 > c("st") * factor_tenths)
           .join(stores, c("store") == c("s_store_sk"))
           .join(t.customer, c("cust") == c("c_customer_sk"))
           .select("c_customer_id"))
    return top(out, limit, "c_customer_id")


def _weekday_sums(df, day_col, amount):
    return [F.sum(F.when(c(day_col) == name, c(amount))).alias(f"{short}_sales")
            for short, name in zip(WEEKDAYS, WEEKDAY_NAMES)]


@model
def q02(t, year=2001, week_gap=53):
    """Web+catalog weekly sales by weekday, week w of a year vs week w+53."""
    # only weeks that touch the two years are summed; the days meet each fact below the union, so they prune it
    wanted = t.date_dim.where(c("d_year").isin(year, year + 1)).select("d_week_seq").distinct()
    days = t.date_dim.join(wanted, "d_week_seq", "left_semi").select("d_date_sk", "d_week_seq", "d_day_name")
    sales = None
    for fact, p in ((t.web_sales, "ws"), (t.catalog_sales, "cs")):
        part = (fact.join(days, c(f"{p}_sold_date_sk") == c("d_date_sk"))
                .select("d_week_seq", "d_day_name", c(f"{p}_ext_sales_price").alias("price")))
        sales = part if sales is None else sales.unionByName(part)
    weekly = (sales.groupBy("d_week_seq").agg(*_weekday_sums(None, "d_day_name", "price")))

    def side(y, suffix):
        # joining the weeks back to date_dim repeats each week once per day of
        # that week inside the year; the query keeps those repeats
        weeks = t.date_dim.where(c("d_year") == y).select(c("d_week_seq").alias("wk"))
        s = weekly.join(weeks, c("d_week_seq") == c("wk"))
        return s.select(c("d_week_seq").alias(f"d_week_seq{suffix}"),
                        *[c(f"{d}_sales").alias(f"{d}_sales{suffix}") for d in WEEKDAYS])

    y, z = side(year, "1"), side(year + 1, "2")
    out = (y.join(z, c("d_week_seq1") == c("d_week_seq2") - week_gap)
           .select("d_week_seq1",
                   *[F.round(nz_div(dbl(f"{d}_sales1"), dbl(f"{d}_sales2")), 2).alias(f"{d}_sales_ratio")
                     for d in WEEKDAYS]))
    return top(out, None, "d_week_seq1")


def customer_years(t, fact, cust_col, date_col, measure, y1, y2, tag, total=dsum):
    """Per customer key: the channel's measure in year y1 and y2 (conditional pivot).

    Customers are met after this, so a sale is shuffled by its key alone and
    the attributes travel once for each customer that is left."""
    days = t.date_dim.where(c("d_year").isin(y1, y2)).select("d_date_sk", "d_year")
    return (fact.where(c(cust_col).isNotNull()).join(days, c(date_col) == c("d_date_sk"))
            .groupBy(c(cust_col).alias("customer_sk"))
            .agg(total(F.when(c("d_year") == y1, measure)).alias(f"{tag}1"),
                 total(F.when(c("d_year") == y2, measure)).alias(f"{tag}2")))


@model
def q03(t, manufact=436, moy=12, limit=100):
    """Brand revenue per year in one month for one manufacturer (star join, top 100)."""
    days = t.date_dim.where(c("d_moy") == moy).select("d_date_sk", "d_year")
    items = t.item.where(c("i_manufact_id") == manufact).select("i_item_sk", "i_brand_id", "i_brand")
    out = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
           .join(items, c("ss_item_sk") == c("i_item_sk"))
           .groupBy("d_year", "i_brand", "i_brand_id")
           .agg(dsum("ss_ext_sales_price").alias("sum_agg"))
           .select("d_year", c("i_brand_id").alias("brand_id"), c("i_brand").alias("brand"), "sum_agg"))
    return top(out, limit, "d_year", "-sum_agg", "brand_id")


@model
def q04(t, year=2001, limit=100):
    """Customers whose catalog growth beats both store and web growth."""
    y1, y2 = year, year + 1

    def m(p):
        return (c(f"{p}_ext_list_price") - c(f"{p}_ext_wholesale_cost") - c(f"{p}_ext_discount_amt")) \
            + c(f"{p}_ext_sales_price")

    s = customer_years(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk", m("ss"), y1, y2, "s")
    cs = customer_years(t, t.catalog_sales, "cs_bill_customer_sk", "cs_sold_date_sk", m("cs"), y1, y2, "c")
    w = customer_years(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk", m("ws"), y1, y2, "w")
    # the measure is sum(x / 2); halves are taken after the exact sum
    j = s.join(cs, "customer_sk").join(w, "customer_sk")
    half = {k: c(k) / 2 for k in ("s1", "s2", "c1", "c2", "w1", "w2")}
    out = (j.where((half["s1"] > 0) & (half["c1"] > 0) & (half["w1"] > 0)
                   & (half["c2"] / half["c1"] > half["s2"] / half["s1"])
                   & (half["c2"] / half["c1"] > half["w2"] / half["w1"]))
           .join(t.customer, c("customer_sk") == c("c_customer_sk"))
           .select(c("c_customer_id").alias("customer_id"), c("c_first_name").alias("customer_first_name"),
                   c("c_last_name").alias("customer_last_name"),
                   c("c_email_address").alias("customer_email_address")))
    return top(out, limit, "customer_id", "customer_first_name", "customer_last_name",
               "customer_email_address")


def _sales_returns(sales, returns, dates, outlet_dim, outlet_key, outlet_id):
    """Sales and returns of one channel in a date window, summed per outlet id."""
    z = F.lit(0).cast("decimal(7,2)")
    # the days meet each fact below the union, so they prune it
    in_window = lambda fact: fact.join(dates, c("date_sk") == c("d_date_sk"))
    sales = in_window(sales).select("outlet", c("sales"), c("profit"), z.alias("returns"), z.alias("loss"))
    returns = in_window(returns).select("outlet", z.alias("sales"), z.alias("profit"), c("returns"), c("loss"))
    both = sales.unionByName(returns)
    return (both.join(outlet_dim, c("outlet") == c(outlet_key))
            .groupBy(outlet_id)
            .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
                 F.sum("returns").alias("returns"), F.sum("loss").alias("loss")))


@model
def q05(t, start="1998-08-04", days=14, limit=100):
    """Sales, returns and profit per outlet and channel over 14 days, with subtotals."""
    lo = F.lit(start).cast("date")
    dates = t.date_dim.where(c("d_date").between(lo, F.date_add(lo, days))).select("d_date_sk")
    ss = t.store_sales.select(c("ss_store_sk").alias("outlet"), c("ss_sold_date_sk").alias("date_sk"),
                              c("ss_ext_sales_price").alias("sales"), c("ss_net_profit").alias("profit"))
    sr = t.store_returns.select(c("sr_store_sk").alias("outlet"), c("sr_returned_date_sk").alias("date_sk"),
                                c("sr_return_amt").alias("returns"), c("sr_net_loss").alias("loss"))
    cs = t.catalog_sales.select(c("cs_catalog_page_sk").alias("outlet"), c("cs_sold_date_sk").alias("date_sk"),
                                c("cs_ext_sales_price").alias("sales"), c("cs_net_profit").alias("profit"))
    cr = t.catalog_returns.select(c("cr_catalog_page_sk").alias("outlet"),
                                  c("cr_returned_date_sk").alias("date_sk"),
                                  c("cr_return_amount").alias("returns"), c("cr_net_loss").alias("loss"))
    ws = t.web_sales.select(c("ws_web_site_sk").alias("outlet"), c("ws_sold_date_sk").alias("date_sk"),
                            c("ws_ext_sales_price").alias("sales"), c("ws_net_profit").alias("profit"))
    # web returns carry no site: take it from the matching sale (left outer), after the date filter
    recent = t.web_returns.join(dates.select(c("d_date_sk").alias("_day")), c("wr_returned_date_sk") == c("_day"), "left_semi")
    wr = (recent.join(t.web_sales.select("ws_item_sk", "ws_order_number", "ws_web_site_sk"),
                             (c("wr_item_sk") == c("ws_item_sk")) & (c("wr_order_number") == c("ws_order_number")),
                             "left")
          .select(c("ws_web_site_sk").alias("outlet"), c("wr_returned_date_sk").alias("date_sk"),
                  c("wr_return_amt").alias("returns"), c("wr_net_loss").alias("loss")))
    parts = [
        ("store channel", "store", _sales_returns(ss, sr, dates, t.store, "s_store_sk", "s_store_id")),
        ("catalog channel", "catalog_page",
         _sales_returns(cs, cr, dates, t.catalog_page, "cp_catalog_page_sk", "cp_catalog_page_id")),
        ("web channel", "web_site", _sales_returns(ws, wr, dates, t.web_site, "web_site_sk", "web_site_id")),
    ]
    rows = None
    for channel, prefix, agg in parts:
        idcol = agg.columns[0]
        part = agg.select(F.lit(channel).alias("channel"), F.concat(F.lit(prefix), c(idcol)).alias("id"),
                          "sales", "returns", (c("profit") - c("loss")).alias("profit"))
        rows = part if rows is None else rows.unionByName(part)
    money = ("sales", "returns", "profit")
    rolled = cascaded_rollup(rows, ["channel", "id"], *[F.sum(x).alias(x) for x in money])
    out = rolled.select("channel", "id", *[dbl(x).alias(x) for x in money])
    return top(out, limit, "channel", "id")


@model
def q06(t, year=2000, moy=2, min_count=10, limit=100):
    """States with >= 10 buyers of items priced over 1.2x their category average."""
    month = (t.date_dim.where((c("d_year") == year) & (c("d_moy") == moy))
             .select(c("d_month_seq").alias("m")).distinct())
    days = t.date_dim.join(month, c("d_month_seq") == c("m")).select("d_date_sk")
    cat = t.item.groupBy(c("i_category").alias("cat")).agg(
        F.sum("i_current_price").alias("ps"), F.count("i_current_price").alias("pc"))
    items = (t.item.join(cat, c("i_category") == c("cat"))
             .where(c("i_current_price") * c("pc") * 10 > c("ps") * 12).select("i_item_sk"))
    out = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
           .join(items, c("ss_item_sk") == c("i_item_sk"))
           .join(t.customer, c("ss_customer_sk") == c("c_customer_sk"))
           .join(t.customer_address, c("c_current_addr_sk") == c("ca_address_sk"))
           .groupBy(c("ca_state").alias("state")).agg(F.count(F.lit(1)).alias("cnt"))
           .where(c("cnt") >= min_count))
    return top(out, limit, "cnt", "state")


@model
def q07(t, gender="F", marital="W", education="Primary", year=1998, limit=100):
    """Average quantity and prices per item for one demographic, non-email/event promotions."""
    cd = t.customer_demographics.where((c("cd_gender") == gender) & (c("cd_marital_status") == marital)
                                       & (c("cd_education_status") == education)).select("cd_demo_sk")
    promo = t.promotion.where((c("p_channel_email") == "N") | (c("p_channel_event") == "N")).select("p_promo_sk")
    days = t.date_dim.where(c("d_year") == year).select("d_date_sk")
    out = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
           .join(cd, c("ss_cdemo_sk") == c("cd_demo_sk"))
           .join(promo, c("ss_promo_sk") == c("p_promo_sk"))
           .join(t.item, c("ss_item_sk") == c("i_item_sk"))
           .groupBy("i_item_id")
           .agg(davg("ss_quantity").alias("agg1"), davg("ss_list_price").alias("agg2"),
                davg("ss_coupon_amt").alias("agg3"), davg("ss_sales_price").alias("agg4")))
    return top(out, limit, "i_item_id")


@model
def q08(t, zips=Q08_ZIPS, qoy=1, year=2002, min_preferred=10, limit=100):
    """Store net profit where the store's 2-digit zip matches busy preferred-customer zips."""
    listed = t.customer_address.select(F.substring("ca_zip", 1, 5).alias("zip")) \
        .where(c("zip").isin(list(zips)))
    preferred = (t.customer_address.join(t.customer.where(c("c_preferred_cust_flag") == "Y"),
                                         c("ca_address_sk") == c("c_current_addr_sk"))
                 .groupBy(F.substring("ca_zip", 1, 5).alias("zip")).agg(F.count(F.lit(1)).alias("cnt"))
                 .where(c("cnt") > min_preferred).select("zip"))
    v1 = listed.intersect(preferred)
    stores = t.store.join(v1, F.substring("s_zip", 1, 2) == F.substring("zip", 1, 2)) \
        .select("s_store_sk", "s_store_name")
    days = t.date_dim.where((c("d_qoy") == qoy) & (c("d_year") == year)).select("d_date_sk")
    out = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
           .join(stores, c("ss_store_sk") == c("s_store_sk"))
           .groupBy("s_store_name").agg(dsum("ss_net_profit").alias("total_net_profit")))
    return top(out, limit, "s_store_name")


@model
def q09(t, thresholds=(25437, 22746, 9387, 10098, 18213), reason_sk=1):
    """Five quantity buckets: average discount or average profit depending on a count."""
    q = c("ss_quantity")
    aggs = []
    for i, lo in enumerate(range(1, 101, 20)):
        inb = q.between(lo, lo + 19)
        aggs += [F.count(F.when(inb, 1)).alias(f"n{i}"),
                 F.sum(F.when(inb, c("ss_ext_discount_amt"))).alias(f"d{i}"),
                 F.count(F.when(inb, c("ss_ext_discount_amt"))).alias(f"dn{i}"),
                 F.sum(F.when(inb, c("ss_net_profit"))).alias(f"p{i}"),
                 F.count(F.when(inb, c("ss_net_profit"))).alias(f"pn{i}")]
    # one scan computes all fifteen scalar subqueries
    stats = t.store_sales.agg(*aggs)
    buckets = [F.when(c(f"n{i}") > th, nz_div(c(f"d{i}"), c(f"dn{i}")))
               .otherwise(nz_div(c(f"p{i}"), c(f"pn{i}"))).alias(f"bucket{i + 1}")
               for i, th in enumerate(thresholds)]
    return t.reason.where(c("r_reason_sk") == reason_sk).select("r_reason_sk").crossJoin(stats) \
        .select(*buckets)
