"""Query models q10-q19."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import c, davg, dbl, dsum, r6, top
from ..operators.relational import cascaded_rollup, pinned
from .q00s import customer_years
from .registry import model


def _buyers(t, fact, cust_col, date_col, year, moy_lo, moy_hi):
    days = t.date_dim.where((c("d_year") == year) & c("d_moy").between(moy_lo, moy_hi)).select("d_date_sk")
    return fact.join(days, c(date_col) == c("d_date_sk")).select(c(cust_col).alias("buyer"))


_CD_ATTRS = ("cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate",
             "cd_credit_rating", "cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count")


@model
def q10(t, counties=("Walker County", "Richland County", "Gaines County", "Douglas County", "Dona Ana County"),
        year=2002, moy=4, months=4, limit=100):
    """Demographic counts of customers buying in store and (web or catalog) in 4 months."""
    hi = moy + months - 1
    store = _buyers(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk", year, moy, hi)
    # EXISTS(web) OR EXISTS(catalog) is one semi join on the union of both buyer sets
    other = (_buyers(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk", year, moy, hi)
             .unionByName(_buyers(t, t.catalog_sales, "cs_ship_customer_sk", "cs_sold_date_sk", year, moy, hi)))
    cust = (t.customer.join(store, c("c_customer_sk") == c("buyer"), "left_semi")
            .join(other, c("c_customer_sk") == c("buyer"), "left_semi"))
    out = (cust.join(t.customer_address.where(c("ca_county").isin(list(counties))),
                     c("c_current_addr_sk") == c("ca_address_sk"))
           .join(t.customer_demographics, c("c_current_cdemo_sk") == c("cd_demo_sk"))
           .groupBy(*_CD_ATTRS).agg(F.count(F.lit(1)).alias("n")))
    out = out.select("cd_gender", "cd_marital_status", "cd_education_status", c("n").alias("cnt1"),
                     "cd_purchase_estimate", c("n").alias("cnt2"), "cd_credit_rating", c("n").alias("cnt3"),
                     "cd_dep_count", c("n").alias("cnt4"), "cd_dep_employed_count", c("n").alias("cnt5"),
                     "cd_dep_college_count", c("n").alias("cnt6"))
    return top(out, limit, *_CD_ATTRS)


@model
def q11(t, year=2001, limit=100):
    """Customers whose web growth on list-minus-discount beats store growth."""
    y1, y2 = year, year + 1
    s = customer_years(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk",
                       c("ss_ext_list_price") - c("ss_ext_discount_amt"), y1, y2, "s")
    w = customer_years(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk",
                       c("ws_ext_list_price") - c("ws_ext_discount_amt"), y1, y2, "w")
    out = (s.join(w, "customer_sk")
           .where((c("s1") > 0) & (c("w1") > 0) & c("s2").isNotNull() & c("w2").isNotNull()
                  & (c("w2") / c("w1") > c("s2") / c("s1")))
           .join(t.customer, c("customer_sk") == c("c_customer_sk"))
           .select(c("c_customer_id").alias("customer_id"), c("c_first_name").alias("customer_first_name"),
                   c("c_last_name").alias("customer_last_name"),
                   c("c_email_address").alias("customer_email_address")))
    return top(out, limit, "customer_id", "customer_first_name", "customer_last_name", "customer_email_address")


def class_share(t, fact, item_col, date_col, amount, categories, start, days, limit):
    """Item revenue in a date window and its share of the item's class (q12, q20, q98)."""
    lo = F.lit(start).cast("date")
    dates = t.date_dim.where(c("d_date").between(lo, F.date_add(lo, days))).select("d_date_sk")
    items = t.item.where(c("i_category").isin(list(categories)))
    g = (fact.join(dates, c(date_col) == c("d_date_sk"))
         .join(items, c(item_col) == c("i_item_sk"))
         .groupBy("i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price")
         .agg(F.sum(amount).alias("rev")))
    # the class total as an aggregate joined back, not a window: a class holds
    # one row per item (unbounded); Spark picks the join by the totals' size
    totals = g.groupBy(c("i_class").alias("cls")).agg(F.sum("rev").alias("class_rev"))
    share = dbl("rev") * 100 / dbl("class_rev")
    out = g.join(totals, c("i_class").eqNullSafe(c("cls"))).select(
        "i_item_id", "i_item_desc", "i_category", "i_class", dbl("i_current_price").alias("i_current_price"),
        dbl("rev").alias("itemrevenue"), share.alias("revenueratio"))
    return top(out, limit, "i_category", "i_class", "i_item_id", "i_item_desc", "revenueratio")


@model
def q12(t, categories=("Jewelry", "Sports", "Books"), start="2001-01-12", days=30, limit=100):
    """Web item revenue and share of its class over 30 days."""
    return class_share(t, t.web_sales, "ws_item_sk", "ws_sold_date_sk", "ws_ext_sales_price",
                       categories, start, days, limit)


@model
def q13(t, year=2001):
    """Store sale averages under OR-ed demographic, price, address and profit bands."""
    sold = pinned(t.store_sales
                  .join(t.store.select("s_store_sk"), c("ss_store_sk") == c("s_store_sk"))
                  .join(t.date_dim.where(c("d_year") == year).select("d_date_sk"), c("ss_sold_date_sk") == c("d_date_sk")),
                  "ss_sales_price", "ss_net_profit")
    ss = (sold
          .join(t.household_demographics, c("ss_hdemo_sk") == c("hd_demo_sk"))
          .join(t.customer_demographics, c("ss_cdemo_sk") == c("cd_demo_sk"))
          .join(t.customer_address.where(c("ca_country") == "United States"),
                c("ss_addr_sk") == c("ca_address_sk")))
    price, profit = c("ss_sales_price"), c("ss_net_profit")
    demo = (((c("cd_marital_status") == "D") & (c("cd_education_status") == "2 yr Degree")
             & price.between(100, 150) & (c("hd_dep_count") == 3))
            | ((c("cd_marital_status") == "S") & (c("cd_education_status") == "Secondary")
               & price.between(50, 100) & (c("hd_dep_count") == 1))
            | ((c("cd_marital_status") == "W") & (c("cd_education_status") == "Advanced Degree")
               & price.between(150, 200) & (c("hd_dep_count") == 1)))
    geo = ((c("ca_state").isin("CO", "IL", "MN") & profit.between(100, 200))
           | (c("ca_state").isin("OH", "MT", "NM") & profit.between(150, 300))
           | (c("ca_state").isin("TX", "MO", "MI") & profit.between(50, 250)))
    return ss.where(demo & geo).agg(
        davg("ss_quantity").alias("avg_quantity"), davg("ss_ext_sales_price").alias("avg_ext_sales_price"),
        davg("ss_ext_wholesale_cost").alias("avg_ext_wholesale_cost"),
        dsum("ss_ext_wholesale_cost").alias("sum_ext_wholesale_cost"))


_CHANNELS = (("store", "store_sales", "ss"), ("catalog", "catalog_sales", "cs"), ("web", "web_sales", "ws"))


_TRIPLE = ("i_brand_id", "i_class_id", "i_category_id")


def _brand_sales(t, windows, y_lo, y_hi, calendar=None):
    """One row per brand, class and category of all channels, each fact read once.

    ``windows`` maps a name to (condition on the calendar, by default date_dim, and channels).  Columns: in how many
    channels the triple sold in [y_lo, y_hi]; for every window and channel the
    sum (``name_channel``) and number (``name_channel_n``) of sales; and
    ``average_sales``, the mean of quantity * list price in [y_lo, y_hi] over all
    channels and rows.  The mean is a window over the triples, whose number
    the product hierarchy bounds, not the sales.
    """
    years = c("d_year").between(y_lo, y_hi)
    flags = [years.alias("in_years"), *[cond.alias(w) for w, (cond, _) in windows.items()]]
    days = (t.date_dim if calendar is None else calendar).select("d_date_sk", *flags).where(" OR ".join(["in_years", *windows]))
    u = None
    for ch, table, p in _CHANNELS:
        part = (getattr(t, table).join(days, c(f"{p}_sold_date_sk") == c("d_date_sk"))
                .select(F.lit(ch).alias("ch"), c(f"{p}_item_sk").alias("it"),
                        (c(f"{p}_quantity") * c(f"{p}_list_price")).alias("v"), "in_years", *windows))
        u = part if u is None else u.unionByName(part)
    own = [(f"{w}_{ch}", c(w) & (c("ch") == ch)) for w, (_, chs) in windows.items() for ch in chs]
    per_item = u.groupBy("it").agg(
        F.sum(F.when(c("in_years"), c("v"))).alias("s"), F.count(F.when(c("in_years"), c("v"))).alias("n"),
        *[F.max(c("in_years") & (c("ch") == ch)).alias(f"in_{ch}") for ch, _, _ in _CHANNELS],
        *[F.sum(F.when(cond, c("v"))).alias(name) for name, cond in own],
        *[F.count(F.when(cond, 1)).alias(f"{name}_n") for name, cond in own])
    triples = (per_item.join(t.item.select("i_item_sk", *_TRIPLE), c("it") == c("i_item_sk"), "left").groupBy(*_TRIPLE).agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"),
        sum((F.coalesce(F.max(f"in_{ch}"), F.lit(False)).cast("int") for ch, _, _ in _CHANNELS), F.lit(0)).alias("channels"),
        *[F.sum(name).alias(name) for name, _ in own], *[F.sum(f"{name}_n").alias(f"{name}_n") for name, _ in own]))
    everything = W.partitionBy()
    return triples.withColumn("average_sales", dbl(F.sum("s").over(everything)) / F.sum("n").over(everything))


def _cross_channel(triples):
    """Triples that sold in all three channels; a triple without brand, class or category matches no item."""
    return triples.where(c("channels") == len(_CHANNELS)).dropna(subset=list(_TRIPLE))


@model
def q14a(t, year_lo=1998, year=2000, moy=11, limit=100):
    """Cross-channel items: per channel brand sales above the overall average, with subtotals."""
    channels = [ch for ch, _, _ in _CHANNELS]
    triples = _cross_channel(_brand_sales(t, {"now": ((c("d_year") == year) & (c("d_moy") == moy), channels)}, year_lo, year_lo + 2))
    sales = F.explode(F.array(*[F.struct(F.lit(ch).alias("channel"), c(f"now_{ch}").alias("sales"), c(f"now_{ch}_n").alias("number_sales"))
                                for ch in channels])).alias("x")
    u = (triples.select(*_TRIPLE, "average_sales", sales).select("x.channel", *_TRIPLE, "x.sales", "x.number_sales", "average_sales")
         .where(dbl("sales") > c("average_sales")))
    out = (cascaded_rollup(u, ["channel", *_TRIPLE], F.sum("sales").alias("s"), F.sum("number_sales").alias("n"))
           .select("channel", *_TRIPLE, dbl("s").alias("total_sales"), c("n").cast("long").alias("total_number_sales")))
    return top(out, limit, "channel", *_TRIPLE)


@model
def q14b(t, year_lo=1998, year=1999, moy=12, dom=16, limit=100):
    """Cross-channel items: store sales of one week this year vs the same week last year."""
    weeks = (t.date_dim.where(c("d_year").isin(year, year - 1) & (c("d_moy") == moy) & (c("d_dom") == dom))
             .select(c("d_year").alias("wk_year"), c("d_week_seq").alias("wk")))
    calendar = (t.date_dim.join(weeks, c("d_week_seq") == c("wk"), "left"))
    week = {tag: (F.coalesce(c("wk_year") == y, F.lit(False)), ["store"]) for tag, y in (("ty", year), ("ly", year - 1))}
    triples = _cross_channel(_brand_sales(t, week, year_lo, year_lo + 2, calendar))
    out = triples.where((dbl("ty_store") > c("average_sales")) & (dbl("ly_store") > c("average_sales")))
    out = out.select(*[x for tag in week for x in (
        F.lit("store").alias(f"{tag}_channel"), c("i_brand_id").alias(f"{tag}_brand"), c("i_class_id").alias(f"{tag}_class"),
        c("i_category_id").alias(f"{tag}_category"), dbl(f"{tag}_store").alias(f"{tag}_sales"),
        c(f"{tag}_store_n").alias(f"{tag}_number_sales"))])
    return top(out, limit, "ty_channel", "ty_brand", "ty_class", "ty_category")


@model
def q15(t, zips=("85669", "86197", "88274", "83405", "86475", "85392", "85460", "80348", "81792"),
        states=("CA", "WA", "GA"), min_price=500, qoy=2, year=2000, limit=100):
    """Catalog sales per zip where zip listed, state listed or price high, one quarter."""
    days = t.date_dim.where((c("d_qoy") == qoy) & (c("d_year") == year)).select("d_date_sk")
    out = (t.catalog_sales.join(days, c("cs_sold_date_sk") == c("d_date_sk"))
           .join(t.customer, c("cs_bill_customer_sk") == c("c_customer_sk"))
           .join(t.customer_address, c("c_current_addr_sk") == c("ca_address_sk"))
           .where(F.substring("ca_zip", 1, 5).isin(list(zips)) | c("ca_state").isin(list(states))
                  | (c("cs_sales_price") > min_price))
           .groupBy("ca_zip").agg(dsum("cs_sales_price").alias("total_sales_price")))
    return top(out, limit, "ca_zip")


def multi_warehouse_unreturned(t, sales, p, returns, rp, ship_date_col, addr_col, outlet_filter,
                               start, days, state, returned):
    """Orders shipped from more than one warehouse, returned or not (q16, q94, q95 helpers)."""
    lo = F.lit(start).cast("date")
    dates = t.date_dim.where(c("d_date").between(lo, F.date_add(lo, days))).select("d_date_sk")
    # EXISTS(other line of the order from another warehouse) holds exactly when
    # the line has a warehouse and the order's warehouses are not all equal:
    # one partial aggregation per order instead of a join of line pairs
    base = (sales.where(c(f"{p}_warehouse_sk").isNotNull())
            .join(dates, c(ship_date_col) == c("d_date_sk"))
            .join(t.customer_address.where(c("ca_state") == state).select("ca_address_sk"),
                  c(addr_col) == c("ca_address_sk"))
            .join(outlet_filter[0], outlet_filter[1]))
    # over the orders that the other filters leave, not over all history
    orders = base.select(c(f"{p}_order_number").alias("co")).distinct()
    multi = (sales.select(c(f"{p}_order_number").alias("mo"), c(f"{p}_warehouse_sk").alias("w"))
             .join(orders, c("mo") == c("co"), "left_semi")
             .groupBy("mo").agg(F.min("w").alias("wmin"), F.max("w").alias("wmax"))
             .where(c("wmin") < c("wmax")).select("mo"))
    base = base.join(multi, c(f"{p}_order_number") == c("mo"), "left_semi")
    how = "left_semi" if returned else "left_anti"
    base = base.join(returns.select(c(f"{rp}_order_number").alias("ro")), c(f"{p}_order_number") == c("ro"), how)
    return base.agg(F.countDistinct(f"{p}_order_number").alias("order count"),
                    dsum(f"{p}_ext_ship_cost").alias("total shipping cost"),
                    dsum(f"{p}_net_profit").alias("total net profit"))


@model
def q16(t, start="1999-02-01", days=60, state="IL", county="Williamson County"):
    """Catalog orders from several warehouses, never returned: count, ship cost, profit."""
    cc = t.call_center.where(c("cc_county") == county).select("cc_call_center_sk")
    return multi_warehouse_unreturned(t, t.catalog_sales, "cs", t.catalog_returns, "cr", "cs_ship_date_sk",
                                      "cs_ship_addr_sk", (cc, c("cs_call_center_sk") == c("cc_call_center_sk")),
                                      start, days, state, returned=False)


def sale_return_rebuy(t, q1, q_list, by_quarter=True, d1_cond=None, d2_cond=None, d3_cond=None):
    """store sale -> store return -> catalog purchase of the same item by the same customer."""
    d = t.date_dim
    if by_quarter:
        d1 = d.where(c("d_quarter_name") == q1)
        d2 = d.where(c("d_quarter_name").isin(list(q_list)))
        d3 = d2
    else:
        d1, d2, d3 = d.where(d1_cond), d.where(d2_cond), d.where(d3_cond)
    ss = t.store_sales.join(d1.select(c("d_date_sk").alias("d1")), c("ss_sold_date_sk") == c("d1"))
    sr = t.store_returns.join(d2.select(c("d_date_sk").alias("d2")), c("sr_returned_date_sk") == c("d2"))
    cs = t.catalog_sales.join(d3.select(c("d_date_sk").alias("d3")), c("cs_sold_date_sk") == c("d3"))
    return (ss.join(sr, (c("ss_customer_sk") == c("sr_customer_sk")) & (c("ss_item_sk") == c("sr_item_sk"))
                    & (c("ss_ticket_number") == c("sr_ticket_number")))
            .join(cs, (c("sr_customer_sk") == c("cs_bill_customer_sk")) & (c("sr_item_sk") == c("cs_item_sk")))
            .join(t.store, c("ss_store_sk") == c("s_store_sk"))
            .join(t.item, c("ss_item_sk") == c("i_item_sk")))


@model
def q17(t, q1="1998Q1", quarters=("1998Q1", "1998Q2", "1998Q3"), limit=100):
    """Quantity statistics along store sale -> return -> catalog re-purchase."""
    j = sale_return_rebuy(t, q1, quarters)
    aggs = []
    for name, col in (("store_sales", "ss_quantity"), ("store_returns", "sr_return_quantity"),
                      ("catalog_sales", "cs_quantity")):
        aggs += [F.count(col).alias(f"{name}_quantitycount"), davg(col).alias(f"{name}_quantityave"),
                 r6(F.stddev_samp(col)).alias(f"{name}_quantitystdev"),
                 r6(F.stddev_samp(col) / F.avg(col)).alias(f"{name}_quantitycov")]
    out = j.groupBy("i_item_id", "i_item_desc", "s_state").agg(*aggs)
    return top(out, limit, "i_item_id", "i_item_desc", "s_state")


@model
def q18(t, gender="M", education="College", months=(9, 5, 12, 4, 1, 10), year=2001,
        states=("ND", "WI", "AL", "NC", "OK", "MS", "TN"), limit=100):
    """Catalog averages by item/country/state/county subtotals for one demographic."""
    cd1 = t.customer_demographics.where((c("cd_gender") == gender) & (c("cd_education_status") == education)) \
        .select(c("cd_demo_sk").alias("cd1_sk"), c("cd_dep_count").alias("cd1_dep"))
    cd2 = t.customer_demographics.select(c("cd_demo_sk").alias("cd2_sk"))
    cust = t.customer.where(c("c_birth_month").isin(list(months)))
    j = (t.catalog_sales
         .join(t.date_dim.where(c("d_year") == year).select("d_date_sk"), c("cs_sold_date_sk") == c("d_date_sk"))
         .join(cd1, c("cs_bill_cdemo_sk") == c("cd1_sk"))
         .join(cust, c("cs_bill_customer_sk") == c("c_customer_sk"))
         .join(cd2, c("c_current_cdemo_sk") == c("cd2_sk"))
         .join(t.customer_address.where(c("ca_state").isin(list(states))), c("c_current_addr_sk") == c("ca_address_sk"))
         .join(t.item, c("cs_item_sk") == c("i_item_sk")))
    dec = "decimal(12,2)"
    measures = ("cs_quantity", "cs_list_price", "cs_coupon_amt", "cs_sales_price", "cs_net_profit", "c_birth_year", "cd1_dep")
    keys = ["i_item_id", "ca_country", "ca_state", "ca_county"]
    rolled = cascaded_rollup(j, keys, *[F.sum(c(x).cast(dec)).alias(f"s{i + 1}") for i, x in enumerate(measures)],
                             *[F.count(c(x).cast(dec)).alias(f"n{i + 1}") for i, x in enumerate(measures)])
    out = rolled.select(*keys, *[(dbl(f"s{i + 1}") / c(f"n{i + 1}")).alias(f"agg{i + 1}") for i in range(len(measures))])
    return top(out, limit, "ca_country", "ca_state", "ca_county", "i_item_id")


@model
def q19(t, manager=7, moy=11, year=1999, limit=100):
    """Brand revenue where the customer's zip differs from the store's zip."""
    days = t.date_dim.where((c("d_moy") == moy) & (c("d_year") == year)).select("d_date_sk")
    out = (t.store_sales.join(days, c("ss_sold_date_sk") == c("d_date_sk"))
           .join(t.item.where(c("i_manager_id") == manager), c("ss_item_sk") == c("i_item_sk"))
           .join(t.customer, c("ss_customer_sk") == c("c_customer_sk"))
           .join(t.customer_address, c("c_current_addr_sk") == c("ca_address_sk"))
           .join(t.store, c("ss_store_sk") == c("s_store_sk"))
           .where(F.substring("ca_zip", 1, 5) != F.substring("s_zip", 1, 5))
           .groupBy("i_brand", "i_brand_id", "i_manufact_id", "i_manufact")
           .agg(dsum("ss_ext_sales_price").alias("ext_price"))
           .select(c("i_brand_id").alias("brand_id"), c("i_brand").alias("brand"), "i_manufact_id",
                   "i_manufact", "ext_price"))
    return top(out, limit, "-ext_price", "brand", "brand_id", "i_manufact_id", "i_manufact")
