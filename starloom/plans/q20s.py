"""Query models q20-q29."""

from pyspark.sql import functions as F

from ..functions import c, davg, dbl, dsum, lsum, top
from ..operators.relational import cascaded_rollup, pinned, shared
from .q10s import class_share, sale_return_rebuy
from .registry import model


@model
def q20(t, categories=("Jewelry", "Sports", "Books"), start="2001-01-12", days=30, limit=100):
    """Catalog item revenue and share of its class over 30 days."""
    return class_share(t, t.catalog_sales, "cs_item_sk", "cs_sold_date_sk", "cs_ext_sales_price",
                       categories, start, days, limit)


@model
def q21(t, pivot="1998-04-08", days=30, price_lo=0.99, price_hi=1.49, limit=100):
    """Inventory 30 days before/after a date per warehouse and item, ratio in [2/3, 3/2]."""
    p = F.lit(pivot).cast("date")
    dates = t.date_dim.where(c("d_date").between(F.date_sub(p, days), F.date_add(p, days))) \
        .select("d_date_sk", "d_date")
    g = (t.inventory.join(dates, c("inv_date_sk") == c("d_date_sk"))
         .join(t.item.where(c("i_current_price").between(price_lo, price_hi)), c("inv_item_sk") == c("i_item_sk"))
         .join(t.warehouse, c("inv_warehouse_sk") == c("w_warehouse_sk"))
         .groupBy("w_warehouse_name", "i_item_id")
         .agg(lsum(F.when(c("d_date") < p, c("inv_quantity_on_hand")).otherwise(0)).alias("inv_before"),
              lsum(F.when(c("d_date") >= p, c("inv_quantity_on_hand")).otherwise(0)).alias("inv_after")))
    ratio = F.when(c("inv_before") > 0, dbl("inv_after") / dbl("inv_before"))
    out = g.where(ratio.between(F.lit(2.0 / 3.0), F.lit(3.0 / 2.0)))
    return top(out, limit, "w_warehouse_name", "i_item_id")


@model
def q22(t, month_seq=1212, limit=100):
    """Average quantity on hand with product/brand/class/category subtotals."""
    dates = t.date_dim.where(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    keys = ["i_product_name", "i_brand", "i_class", "i_category"]
    # sums and counts of each level come from the next finer one
    stock = (t.inventory.join(dates, c("inv_date_sk") == c("d_date_sk"))
             .join(t.item, c("inv_item_sk") == c("i_item_sk")))
    rolled = cascaded_rollup(stock, keys, F.sum("inv_quantity_on_hand").alias("s"), F.count("inv_quantity_on_hand").alias("n"))
    return top(rolled.select(*keys, (dbl("s") / c("n")).alias("qoh")), limit, "qoh", *keys)


def _store_history(t, years):
    """Of one pass over store_sales: rows of (item, day) in ``years`` with their number of sales (gid 1), and
    rows of customers with their spend of all time and in ``years`` (gid 6)."""
    days = t.date_dim.where(c("d_year").isin(list(years))).select("d_date_sk", "d_date")
    spend = c("ss_quantity") * c("ss_sales_price")
    none = F.lit(None)
    facts = F.explode(F.array(
        F.struct(F.lit(1).alias("gid"), c("ss_item_sk").alias("it"), c("d_date"), none.cast("long").alias("cust")),
        F.struct(F.lit(6).alias("gid"), none.cast("long").alias("it"), none.cast("date").alias("d_date"), c("ss_customer_sk").alias("cust")))).alias("x")
    sold = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"), "left")
            .select(spend.alias("spend"), c("d_date").isNotNull().alias("in_years"), facts)
            .where("x.d_date IS NOT NULL OR x.cust IS NOT NULL"))
    return sold.groupBy("x.gid", "x.it", "x.d_date", "x.cust").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("spend").alias("spend"), F.sum(F.when(c("in_years"), c("spend"))).alias("recent"))


def _q23_channels(t, year, moy, years, min_count, share, with_names):
    history = shared(_store_history(t, years).where((c("gid") == 6) | (c("cnt") > min_count)))
    items = (history.where(c("gid") == 1).join(t.item, c("it") == c("i_item_sk"), "left_semi").select(c("it").alias("fi_sk")).distinct())
    buyers = history.where(c("gid") == 6).join(t.customer, c("cust") == c("c_customer_sk"), "left_semi")
    most = buyers.agg(F.max("recent").alias("most"))
    # one-row threshold joined to every customer total (broadcast of one row)
    best = buyers.crossJoin(most).where(dbl("spend") > F.lit(share) * dbl("most")).select(c("cust").alias("bc_sk"))
    days = t.date_dim.where((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk")
    f = None
    for table, p in (("catalog_sales", "cs"), ("web_sales", "ws")):
        part = (getattr(t, table).join(days, c(f"{p}_sold_date_sk") == c("d_date_sk"))
                .select(F.lit(p).alias("channel"), c(f"{p}_item_sk").alias("it"), c(f"{p}_bill_customer_sk").alias("cust"),
                        (c(f"{p}_quantity") * c(f"{p}_list_price")).alias("sales")))
        f = part if f is None else f.unionByName(part)
    # both key sets are distinct; a semi join would be planned below the union, once for each channel
    f = f.join(items, c("it") == c("fi_sk")).join(best, c("cust") == c("bc_sk"))
    if with_names:
        return (f.join(t.customer, c("cust") == c("c_customer_sk"))
                .groupBy("channel", "c_last_name", "c_first_name").agg(dsum("sales").alias("sales")).drop("channel"))
    return f.select("sales")


@model
def q23a(t, year=1999, moy=1, years=(1999, 2000, 2001, 2002), min_count=4, share=0.95):
    """January catalog+web sales of frequently sold items to the best store customers."""
    u = _q23_channels(t, year, moy, years, min_count, share, False)
    return u.agg(dsum("sales").alias("total_sales"))


@model
def q23b(t, year=1999, moy=1, years=(1999, 2000, 2001, 2002), min_count=4, share=0.95, limit=100):
    """The same, per customer name."""
    u = _q23_channels(t, year, moy, years, min_count, share, True)
    return top(u, limit, "c_last_name", "c_first_name", "sales")


def _q24(t, color, market):
    ss = (t.store_sales
          .join(t.store_returns, (c("ss_ticket_number") == c("sr_ticket_number")) & (c("ss_item_sk") == c("sr_item_sk")))
          .join(t.store.where(c("s_market_id") == market), c("ss_store_sk") == c("s_store_sk"))
          .join(t.item, c("ss_item_sk") == c("i_item_sk"))
          .join(t.customer, c("ss_customer_sk") == c("c_customer_sk"))
          .join(t.customer_address, c("c_current_addr_sk") == c("ca_address_sk"))
          .where((c("c_birth_country") != F.upper("ca_country")) & (c("s_zip") == c("ca_zip")))
          .groupBy("c_last_name", "c_first_name", "s_store_name", "ca_state", "s_state", "i_color",
                   "i_current_price", "i_manager_id", "i_units", "i_size")
          .agg(F.sum("ss_sales_price").alias("netpaid")))
    # 'paid > 0.05 * avg(netpaid)' as exact decimal arithmetic against one row
    stats = ss.agg(F.sum("netpaid").alias("tot"), F.count("netpaid").alias("cnt"))
    g = (ss.where(c("i_color") == color).groupBy("c_last_name", "c_first_name", "s_store_name")
         .agg(F.sum("netpaid").alias("paid")))
    return (g.crossJoin(stats).where(c("paid") * c("cnt") * 100 > c("tot") * 5)
            .select("c_last_name", "c_first_name", "s_store_name", dbl("paid").alias("paid")))


@model
def q24a(t, color="orchid", market=7):
    """Store purchases returned by foreign-born customers living at the store's zip, one colour."""
    return top(_q24(t, color, market), None, "c_last_name", "c_first_name", "s_store_name")


@model
def q24b(t, color="chiffon", market=7):
    """As q24a for a second colour."""
    return top(_q24(t, color, market), None, "c_last_name", "c_first_name", "s_store_name")


@model
def q25(t, year=2000, moy=4, moy_hi=10, limit=100):
    """Profit and loss along store sale -> return -> catalog re-purchase."""
    d1 = (c("d_moy") == moy) & (c("d_year") == year)
    d2 = c("d_moy").between(moy, moy_hi) & (c("d_year") == year)
    j = sale_return_rebuy(t, None, None, False, d1, d2, d2)
    out = (j.groupBy("i_item_id", "i_item_desc", "s_store_id", "s_store_name")
           .agg(dsum("ss_net_profit").alias("store_sales_profit"), dsum("sr_net_loss").alias("store_returns_loss"),
                dsum("cs_net_profit").alias("catalog_sales_profit")))
    return top(out, limit, "i_item_id", "i_item_desc", "s_store_id", "s_store_name")


@model
def q26(t, gender="F", marital="W", education="Primary", year=1998, limit=100):
    """Catalog averages per item for one demographic, non-email/event promotions."""
    cd = t.customer_demographics.where((c("cd_gender") == gender) & (c("cd_marital_status") == marital)
                                       & (c("cd_education_status") == education)).select("cd_demo_sk")
    promo = t.promotion.where((c("p_channel_email") == "N") | (c("p_channel_event") == "N")).select("p_promo_sk")
    out = (t.catalog_sales
           .join(t.date_dim.where(c("d_year") == year).select("d_date_sk"), c("cs_sold_date_sk") == c("d_date_sk"))
           .join(cd, c("cs_bill_cdemo_sk") == c("cd_demo_sk"))
           .join(promo, c("cs_promo_sk") == c("p_promo_sk"))
           .join(t.item, c("cs_item_sk") == c("i_item_sk"))
           .groupBy("i_item_id")
           .agg(davg("cs_quantity").alias("agg1"), davg("cs_list_price").alias("agg2"),
                davg("cs_coupon_amt").alias("agg3"), davg("cs_sales_price").alias("agg4")))
    return top(out, limit, "i_item_id")


@model
def q27(t, gender="F", marital="W", education="Primary", year=1998, states=("TN",), limit=100):
    """Store averages by item and state with subtotals and a grouping flag."""
    cd = t.customer_demographics.where((c("cd_gender") == gender) & (c("cd_marital_status") == marital)
                                       & (c("cd_education_status") == education)).select("cd_demo_sk")
    j = (t.store_sales
         .join(t.date_dim.where(c("d_year") == year).select("d_date_sk"), c("ss_sold_date_sk") == c("d_date_sk"))
         .join(cd, c("ss_cdemo_sk") == c("cd_demo_sk"))
         .join(t.store.where(c("s_state").isin(list(states))), c("ss_store_sk") == c("s_store_sk"))
         .join(t.item, c("ss_item_sk") == c("i_item_sk")))
    measures = ("ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_sales_price")
    rolled = cascaded_rollup(j, ["i_item_id", "s_state"], *[F.sum(x).alias(f"s{i + 1}") for i, x in enumerate(measures)],
                             *[F.count(x).alias(f"n{i + 1}") for i, x in enumerate(measures)])
    out = rolled.select("i_item_id", "s_state", (c("_level") > 0).cast("long").alias("g_state"),
                        *[(dbl(f"s{i + 1}") / c(f"n{i + 1}")).alias(f"agg{i + 1}") for i in range(len(measures))])
    return top(out, limit, "i_item_id", "s_state")


Q28_BANDS = (  # quantity range, list price from, coupon from, wholesale from
    ((0, 5), 11, 460, 14), ((6, 10), 91, 1430, 32), ((11, 15), 66, 920, 4),
    ((16, 20), 142, 3054, 80), ((21, 25), 135, 14180, 38), ((26, 30), 28, 2513, 42),
)


@model
def q28(t, bands=Q28_BANDS):
    """Six price bands: average, count and distinct count of list price."""
    # the quantity ranges are disjoint, so each row falls in at most one band:
    # tag it, count per (band, price), then fold to one row per band
    band = None
    for i, ((qlo, qhi), lp, cp, wc) in enumerate(bands):
        cond = c("ss_quantity").between(qlo, qhi) & (
            c("ss_list_price").between(lp, lp + 10) | c("ss_coupon_amt").between(cp, cp + 1000)
            | c("ss_wholesale_cost").between(wc, wc + 20))
        band = F.when(cond, i + 1) if band is None else band.when(cond, i + 1)
    sold = pinned(t.store_sales.select("ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_wholesale_cost"),
                  "ss_list_price", "ss_coupon_amt", "ss_wholesale_cost")
    per_price = (sold.where(c("ss_list_price").isNotNull())
                 .select(band.alias("band"), "ss_list_price").where(c("band").isNotNull())
                 .groupBy("band", "ss_list_price").agg(F.count(F.lit(1)).alias("n")))
    per_band = per_price.groupBy("band").agg(
        F.sum(c("ss_list_price") * c("n")).alias("s"), F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("cntd"))
    cols = []
    for i in range(1, len(bands) + 1):
        cols += [(dbl(F.max(F.when(c("band") == i, c("s")))) / F.max(F.when(c("band") == i, c("cnt"))))
                 .alias(f"B{i}_LP"),
                 F.coalesce(F.max(F.when(c("band") == i, c("cnt"))), F.lit(0)).cast("long").alias(f"B{i}_CNT"),
                 F.coalesce(F.max(F.when(c("band") == i, c("cntd"))), F.lit(0)).cast("long").alias(f"B{i}_CNTD")]
    return per_band.agg(*cols)


@model
def q29(t, year=1999, moy=4, months=4, years=(1999, 2000, 2001), limit=100):
    """Quantities along store sale -> return -> catalog re-purchase over three years."""
    d1 = (c("d_moy") == moy) & (c("d_year") == year)
    d2 = c("d_moy").between(moy, moy + months - 1) & (c("d_year") == year)
    d3 = c("d_year").isin(list(years))
    j = sale_return_rebuy(t, None, None, False, d1, d2, d3)
    out = (j.groupBy("i_item_id", "i_item_desc", "s_store_id", "s_store_name")
           .agg(lsum("ss_quantity").alias("store_sales_quantity"),
                lsum("sr_return_quantity").alias("store_returns_quantity"),
                lsum("cs_quantity").alias("catalog_sales_quantity")))
    return top(out, limit, "i_item_id", "i_item_desc", "s_store_id", "s_store_name")
