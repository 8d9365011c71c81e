"""Query models q50-q59."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import c, dbl, lsum, nz_div, top
from .q00s import WEEKDAYS, _weekday_sums
from .q30s import channel_item_revenue
from .q40s import brand_or_category_revenue, monthly_deviation
from .registry import model

LAG_BUCKETS = (("30 days", None, 30), ("31-60 days", 30, 60), ("61-90 days", 60, 90),
               ("91-120 days", 90, 120), (">120 days", 120, None))


def lag_buckets(lag):
    """Counts of rows per day-lag bucket; the lag is a difference of date keys."""
    out = []
    for name, lo, hi in LAG_BUCKETS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (lag > lo)
        if hi is not None:
            cond = cond & (lag <= hi)
        out.append(lsum(F.when(cond, 1).otherwise(0)).alias(name))
    return out


_STORE_ADDR = ("s_store_name", "s_company_id", "s_street_number", "s_street_name", "s_street_type",
               "s_suite_number", "s_city", "s_county", "s_state", "s_zip")


@model
def q50(t, year=2000, moy=9, limit=100):
    """Store returns of one month bucketed by days since the sale."""
    d2 = t.date_dim.where((c("d_year") == year) & (c("d_moy") == moy)).select(c("d_date_sk").alias("d2"))
    j = (t.store_returns.join(d2, c("sr_returned_date_sk") == c("d2"))
         .join(t.store_sales, (c("ss_ticket_number") == c("sr_ticket_number")) & (c("ss_item_sk") == c("sr_item_sk"))
               & (c("ss_customer_sk") == c("sr_customer_sk")))
         .join(t.date_dim.select(c("d_date_sk").alias("d1")), c("ss_sold_date_sk") == c("d1"))
         .join(t.store, c("ss_store_sk") == c("s_store_sk")))
    out = j.groupBy(*_STORE_ADDR).agg(*lag_buckets(c("sr_returned_date_sk") - c("ss_sold_date_sk")))
    return top(out, limit, *_STORE_ADDR)


@model
def q51(t, month_seq=1212, limit=100):
    """Item-days where cumulative web sales exceed cumulative store sales."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk", "d_date")
    running = W.partitionBy("item_sk").orderBy("d_date").rowsBetween(W.unboundedPreceding, W.currentRow)

    def cume(fact, item_col, date_col, price):
        daily = (fact.where(c(item_col).isNotNull()).join(days, c(date_col) == c("d_date_sk"))
                 .groupBy(c(item_col).alias("item_sk"), "d_date").agg(F.sum(price).alias("s")))
        # each item's partition holds at most one row per day of the year
        return daily.select("item_sk", "d_date", F.sum("s").over(running).alias("cume_sales"))

    web = cume(t.web_sales, "ws_item_sk", "ws_sold_date_sk", "ws_sales_price") \
        .select(c("item_sk").alias("w_item"), c("d_date").alias("w_date"), c("cume_sales").alias("web_sales"))
    store = cume(t.store_sales, "ss_item_sk", "ss_sold_date_sk", "ss_sales_price") \
        .select(c("item_sk").alias("s_item"), c("d_date").alias("s_date"), c("cume_sales").alias("store_sales"))
    x = (web.join(store, (c("w_item") == c("s_item")) & (c("w_date") == c("s_date")), "full")
         .select(F.when(c("w_item").isNotNull(), c("w_item")).otherwise(c("s_item")).alias("item_sk"),
                 F.when(c("w_date").isNotNull(), c("w_date")).otherwise(c("s_date")).alias("d_date"),
                 "web_sales", "store_sales"))
    y = x.select("item_sk", "d_date", "web_sales", "store_sales",
                 F.max("web_sales").over(running).alias("web_cumulative"),
                 F.max("store_sales").over(running).alias("store_cumulative"))
    out = y.where(c("web_cumulative") > c("store_cumulative")).select(
        "item_sk", "d_date", dbl("web_sales").alias("web_sales"), dbl("store_sales").alias("store_sales"),
        dbl("web_cumulative").alias("web_cumulative"), dbl("store_cumulative").alias("store_cumulative"))
    return top(out, limit, "item_sk", "d_date")


@model
def q52(t, manager=1, moy=12, year=1998, limit=100):
    """Brand revenue of one manager in one month."""
    g = brand_or_category_revenue(t, ["d_year", "i_brand", "i_brand_id"], manager, moy, year)
    out = g.select("d_year", c("i_brand_id").alias("brand_id"), c("i_brand").alias("brand"),
                   c("total").alias("ext_price"))
    return top(out, limit, "d_year", "-ext_price", "brand_id")


def _q53_items():
    return ((c("i_category").isin("Books", "Children", "Electronics")
             & c("i_class").isin("personal", "portable", "reference", "self-help")
             & c("i_brand").isin("scholaramalgamalg #14", "scholaramalgamalg #7", "exportiunivamalg #9",
                                 "scholaramalgamalg #9"))
            | (c("i_category").isin("Women", "Music", "Men")
               & c("i_class").isin("accessories", "classical", "fragrances", "pants")
               & c("i_brand").isin("amalgimporto #1", "edu packscholar #1", "exportiimporto #1", "importoamalg #1")))


def period_deviation(t, key, period, month_seq, item_filter, avg_name):
    """Sales per key and period vs the key's mean over periods (q53, q63)."""
    days = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk", period)
    g = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
         .join(t.item.where(item_filter), c("ss_item_sk") == c("i_item_sk"))
         .join(t.store.select("s_store_sk"), c("ss_store_sk") == c("s_store_sk"))
         .groupBy(key, period).agg(F.sum("ss_sales_price").alias("s")))
    w = W.partitionBy(key)
    v = g.select(key, dbl("s").alias("sum_sales"),
                 (F.sum("s").over(w).cast("double") / F.count("s").over(w)).alias(avg_name))
    return v.where(F.when(c(avg_name) > 0, F.abs(c("sum_sales") - c(avg_name)) / c(avg_name)) > 0.1)


@model
def q53(t, month_seq=1212, limit=100):
    """Manufacturer quarterly sales deviating more than 10% from their mean."""
    v = period_deviation(t, "i_manufact_id", "d_qoy", month_seq, _q53_items(), "avg_quarterly_sales")
    return top(v.select("i_manufact_id", "sum_sales", "avg_quarterly_sales"), limit,
               "avg_quarterly_sales", "sum_sales", "i_manufact_id")


@model
def q54(t, category="Jewelry", klass="consignment", year=1999, moy=3, width=50, limit=100):
    """Revenue segments of store customers who bought a kind of item by catalog or web."""
    items = t.item.where((c("i_category") == category) & (c("i_class") == klass)).select("i_item_sk")
    month = t.date_dim.where((c("d_year") == year) & (c("d_moy") == moy))
    days = month.select("d_date_sk")
    buys = (t.catalog_sales.select(c("cs_sold_date_sk").alias("sold"), c("cs_bill_customer_sk").alias("cust"),
                                   c("cs_item_sk").alias("item"))
            .unionByName(t.web_sales.select(c("ws_sold_date_sk").alias("sold"), c("ws_bill_customer_sk").alias("cust"),
                                            c("ws_item_sk").alias("item"))))
    my_customers = (buys.join(days, c("sold") == c("d_date_sk"))
                    .join(items, c("item") == c("i_item_sk"))
                    .join(t.customer, c("cust") == c("c_customer_sk"))
                    .select("c_customer_sk", "c_current_addr_sk").distinct())
    bounds = month.select((c("d_month_seq") + 1).alias("lo"), (c("d_month_seq") + 3).alias("hi")).distinct()
    rev_days = t.date_dim.join(bounds, c("d_month_seq").between(c("lo"), c("hi"))).select("d_date_sk")
    # every store of the customer's county and state joins each sale: the
    # revenue is the customer's sales times that store count
    stores = t.store.groupBy("s_county", "s_state").agg(F.count(F.lit(1)).alias("n_stores"))
    cust = (my_customers.join(t.customer_address, c("c_current_addr_sk") == c("ca_address_sk"))
            .join(stores, (c("ca_county") == c("s_county")) & (c("ca_state") == c("s_state")))
            .select("c_customer_sk", "n_stores"))
    revenue = (t.store_sales.join(rev_days, c("ss_sold_date_sk") == c("d_date_sk"))
               .join(cust, c("ss_customer_sk") == c("c_customer_sk"))
               .groupBy("c_customer_sk", "n_stores").agg(F.sum("ss_ext_sales_price").alias("s"))
               .select((c("s") * c("n_stores")).alias("revenue")))
    # cast to int rounds half to even in the reference engine
    seg = revenue.select(F.rint(dbl("revenue") / width).cast("int").alias("segment"))
    out = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("num_customers")) \
        .select("segment", "num_customers", (c("segment") * width).alias("segment_base"))
    return top(out, limit, "segment", "num_customers")


@model
def q55(t, manager=36, moy=12, year=2001, limit=100):
    """Brand revenue of one manager in one month."""
    g = brand_or_category_revenue(t, ["i_brand", "i_brand_id"], manager, moy, year)
    out = g.select(c("i_brand_id").alias("brand_id"), c("i_brand").alias("brand"), c("total").alias("ext_price"))
    return top(out, limit, "-ext_price", "brand_id")


@model
def q56(t, colors=("orchid", "chiffon", "lace"), year=2000, moy=1, gmt=-8, limit=100):
    """Item revenue across channels for items of some colours."""
    return channel_item_revenue(t, "i_item_id", c("i_color").isin(*colors), year, moy, gmt,
                                ("total_sales", "i_item_id"), limit)


@model
def q57(t, year=2000, limit=100):
    """Call-center brand months deviating more than 10% from the yearly mean, with neighbours."""
    v = monthly_deviation(t, t.catalog_sales, "cs", (t.call_center, c("cs_call_center_sk") == c("cc_call_center_sk")),
                          ["cc_name"], year)
    out = v.select("cc_name", "d_year", "d_moy", "avg_monthly_sales", "sum_sales", "psum", "nsum",
                   "i_category", "i_brand")
    out = top(out, limit, (c("sum_sales") - c("avg_monthly_sales")).asc_nulls_last(), "nsum")
    return out.select("cc_name", "d_year", "d_moy", "avg_monthly_sales", "sum_sales", "psum", "nsum")


@model
def q58(t, day="1998-02-19", limit=100):
    """Items whose revenue is within 10% across the three channels in one week."""
    wk = t.date_dim.where(c("d_date") == F.lit(day).cast("date")).select(c("d_week_seq").alias("wk"))
    days = t.date_dim.join(wk, c("d_week_seq") == c("wk")).select("d_date_sk")

    def rev(fact, p, name):
        return (fact.join(days, c(f"{p}_sold_date_sk") == c("d_date_sk"))
                .join(t.item, c(f"{p}_item_sk") == c("i_item_sk"))
                .groupBy(c("i_item_id").alias(f"{p}_id")).agg(F.sum(f"{p}_ext_sales_price").alias(name)))

    ss, cs, ws = rev(t.store_sales, "ss", "ss_rev"), rev(t.catalog_sales, "cs", "cs_rev"), \
        rev(t.web_sales, "ws", "ws_rev")
    j = ss.join(cs, c("ss_id") == c("cs_id")).join(ws, c("ss_id") == c("ws_id"))

    def near(a, b):
        return c(a).between(c(b) * 0.9, c(b) * 1.1)

    j = j.where(near("ss_rev", "cs_rev") & near("ss_rev", "ws_rev") & near("cs_rev", "ss_rev")
                & near("cs_rev", "ws_rev") & near("ws_rev", "ss_rev") & near("ws_rev", "cs_rev"))
    avg = (dbl("ss_rev") + dbl("cs_rev") + dbl("ws_rev")) / 3
    out = j.select(c("ss_id").alias("item_id"), dbl("ss_rev").alias("ss_item_rev"),
                   (dbl("ss_rev") / avg * 100).alias("ss_dev"), dbl("cs_rev").alias("cs_item_rev"),
                   (dbl("cs_rev") / avg * 100).alias("cs_dev"), dbl("ws_rev").alias("ws_item_rev"),
                   (dbl("ws_rev") / avg * 100).alias("ws_dev"), avg.alias("average"))
    return top(out, limit, "item_id", "ss_item_rev")


@model
def q59(t, month_seq=1185, week_gap=52, limit=100):
    """Store weekday sales of a year vs the same weeks one year later."""
    # only weeks that touch the two years are summed
    wanted = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 23)).select("d_week_seq").distinct()
    wss = (t.store_sales.join(t.date_dim.join(wanted, "d_week_seq", "left_semi").select("d_date_sk", "d_week_seq", "d_day_name"),
                              c("ss_sold_date_sk") == c("d_date_sk"))
           .groupBy("d_week_seq", "ss_store_sk").agg(*_weekday_sums(None, "d_day_name", "ss_sales_price")))

    def side(lo, suffix):
        # the join back to date_dim repeats each week once per day in range
        weeks = t.date_dim.where(c("d_month_seq").between(lo, lo + 11)).select(c("d_week_seq").alias("wk"))
        s = (wss.join(weeks, c("d_week_seq") == c("wk"))
             .join(t.store.select("s_store_sk", "s_store_name", "s_store_id"), c("ss_store_sk") == c("s_store_sk")))
        return s.select(c("s_store_name").alias(f"s_store_name{suffix}"), c("s_store_id").alias(f"s_store_id{suffix}"),
                        c("d_week_seq").alias(f"d_week_seq{suffix}"),
                        *[c(f"{d}_sales").alias(f"{d}_sales{suffix}") for d in WEEKDAYS])

    y, x = side(month_seq, "1"), side(month_seq + 12, "2")
    j = y.join(x, (c("s_store_id1") == c("s_store_id2")) & (c("d_week_seq1") == c("d_week_seq2") - week_gap))
    out = j.select("s_store_name1", "s_store_id1", "d_week_seq1",
                   *[nz_div(c(f"{d}_sales1"), c(f"{d}_sales2")).alias(f"{d}_sales_ratio") for d in WEEKDAYS])
    return top(out, limit, "s_store_name1", "s_store_id1", "d_week_seq1")

