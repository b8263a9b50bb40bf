"""Finance reports (R1-R16): monthly KPIs, seller ledger, margin, state sales.

Each report is ``report(t: Tables, as_of=..., ...) -> DataFrame``. Window
filters are date literals on the line / receipt date, so they are applied
in the scan before any join; the receipt enrichment (J1) is joined only to
lines that survive the filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import calendar as cal
from marketlens.functions import expressions as X
from marketlens.operators import aggregates as A
from marketlens.operators import filters as Fl
from marketlens.operators import joins as J
from marketlens.operators import setops as O
from marketlens.params import AS_OF, HOUSE_SELLERS, ROLLING_END, TAX, lead_gen_months
from marketlens.sources.literal import literal_table
from marketlens.sources.tables import Tables


def _own_sales(t: Tables, window, positive: bool = True, cols=("channel",)) -> DataFrame:
    """Completed lines in a window, enriched with the receipt channel, own site only."""
    lines = Fl.completed_sales(t.lines.filter(window), positive=positive)
    return Fl.own_channel(J.with_receipt(lines, t.bridge, t.receipts, cols))


# ---- R1-R6, R9-R14: one-row KPIs --------------------------------------------------
def seller_transactions(t: Tables, as_of: dt.date = AS_OF, seller: int = HOUSE_SELLERS[0]) -> DataFrame:
    """Distinct receipts of one seller's completed own-site lines last month."""
    lines = t.lines.filter(cal.in_months("accepted_date", as_of, 1, 0) & (F.col("company_id") == seller))
    df = Fl.own_channel(J.with_receipt(Fl.completed_sales(lines), t.bridge, t.receipts))
    return A.kpi_distinct(df, "receipt_id", "transactions")


def active_customers(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """R2: distinct customers with a completed own-site purchase in the trailing 12 months."""
    df = _own_sales(t, cal.in_months("accepted_date", as_of, 12, 0))
    return A.kpi_distinct(df, "customer_id", "active_customers")


def active_this_vs_last(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Active customers for the trailing year ('This Month') and the one a month earlier.

    One scan over the union window (13, 0), one partially aggregated pass
    per customer flagging the two windows (no Expand of the rows for two
    DISTINCT counts), two counts, unpivoted to two labelled rows.
    """
    df = _own_sales(t, cal.in_months("accepted_date", as_of, 13, 0))
    per = (df.filter(F.col("customer_id").isNotNull()).groupBy("customer_id")
             .agg(F.max(cal.in_months("accepted_date", as_of, 12, 0).cast("int")).alias("cur"),
                  F.max(cal.in_months("accepted_date", as_of, 13, 1).cast("int")).alias("prev")))
    wide = per.agg(F.count(F.when(F.col("cur") == 1, 1)).alias("this_month"),
                   F.count(F.when(F.col("prev") == 1, 1)).alias("last_month"))
    return O.stack_periods(wide, {"This Month": "this_month", "Last Month": "last_month"},
                           label="Period", value="active_users")


def churned_customers(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Customers active in (13, 1) but not in (12, 0); no channel filter.

    One aggregation per customer over the union window replaces the
    anti-join: partial aggregation keeps a hot customer cheap.
    """
    prev_w = cal.in_months("accepted_date", as_of, 13, 1)
    cur_w = cal.in_months("accepted_date", as_of, 12, 0)
    lines = Fl.completed_sales(t.lines.filter(cal.in_months("accepted_date", as_of, 13, 0)))
    per = (lines.filter(F.col("customer_id").isNotNull())
           .groupBy("customer_id")
           .agg(F.max(prev_w.cast("int")).alias("prev"), F.max(cur_w.cast("int")).alias("cur")))
    return per.agg(F.count(F.when((F.col("prev") == 1) & (F.col("cur") == 0), 1)).alias("churned_customers"))


def first_time_customers(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Customers whose first approved own-site receipt (amount > 0) was last month."""
    r = Fl.own_channel(Fl.approved_receipts(t.receipts, positive=True))
    lo, hi = cal.month_window(as_of, 1, 0)
    win = (F.col("first_date") >= F.lit(lo)) & (F.col("first_date") < F.lit(hi))
    return A.first_event_in(r, "customer_id", "transaction_date", "receipt_id", win,
                            "new_customers_transcations")


def new_customers(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """As R5 without the amount test."""
    r = Fl.own_channel(Fl.approved_receipts(t.receipts, positive=False))
    lo, hi = cal.month_window(as_of, 1, 0)
    win = (F.col("first_date") >= F.lit(lo)) & (F.col("first_date") < F.lit(hi))
    return A.first_event_in(r, "customer_id", "transaction_date", "receipt_id", win, "new_customers")


def units_shipped(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Units of completed own-site product lines, trailing 12 months."""
    df = Fl.product_lines(_own_sales(t, cal.in_months("accepted_date", as_of, 12, 0)))
    return A.kpi_sum(df, "qty", "units_shipped")


def total_customers(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Distinct customers last month, coupon lines (type 6) excluded."""
    df = _own_sales(t, cal.in_months("accepted_date", as_of, 1, 0) & (F.col("order_type") != 6))
    return A.kpi_distinct(df, "customer_id", "total_customers")


def total_transactions(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Approved own-site receipts last month."""
    r = Fl.own_channel(Fl.approved_receipts(
        t.receipts.filter(cal.in_months("transaction_date", as_of, 1, 0))))
    return A.kpi_distinct(r, "receipt_id", "total_transactions")


def unique_companies(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Distinct sellers with completed own-site lines last month."""
    df = _own_sales(t, cal.in_months("accepted_date", as_of, 1, 0))
    return A.kpi_distinct(df, "company_id", "unique_companies")


def unique_products(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Distinct CONCAT(product, sku) sold last month (protection lines excluded)."""
    df = Fl.product_lines(_own_sales(t, cal.in_months("accepted_date", as_of, 1, 0)), freight=False)
    return A.kpi_distinct_composite(df, ["product_id", "sku"], "unique_products")


def web_app_aov(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Per platform: transactions, gross sales, AOV, sorted by transactions."""
    r = Fl.own_channel(Fl.approved_receipts(
        t.receipts.filter(cal.in_months("transaction_date", as_of, 1, 0))))
    return A.order_value_by(r, X.bucket_enum("client_type"), "platform").orderBy(F.desc("total_transactions"))


# ---- R7: category x month -----------------------------------------------------------
def category_month(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Revenue and margin per category and 'Mon yyyy', by revenue desc."""
    p = t.performance.filter(cal.in_months("sale_date", as_of, 1, 0))
    return (p.groupBy(F.col("level1").alias("Level1"), cal.month_label("sale_date", "short").alias("SalesMonth"))
             .agg(X.money_sum("revenue").alias("revenue"), X.money_sum("margin").alias("margin"))
             .orderBy(F.desc("revenue")))


# ---- R8: seller ledger -------------------------------------------------------------
def seller_ledger(t: Tables, as_of: dt.date = AS_OF, tax: float = TAX) -> DataFrame:
    """Per month and seller: GTV/NTV, net payable, fee commissions (ex tax)."""
    lines = Fl.completed_sales(t.lines.filter(cal.in_months("accepted_date", as_of, 1, 0)), positive=False)
    # the seller id comes from the seller table (NULL when the seller is unknown)
    c = t.company.select(F.col("company_id").alias("c_id"), F.col("description").alias("company_name"),
                         "gst_registered")
    j = lines.join(c, lines.company_id == c.c_id, "left")
    e = X.line_economics(j, tax).withColumn("type_text", X.classify_order_type())
    s, n, ot = F.col("total_ex_tax"), F.col("net_ex_tax"), F.col("order_type")
    non_product = ot.isin(*X.NON_PRODUCT_TYPES) | (F.col("type_text") == "FreightProtection")
    fee = ot.isin(*X.FEE_TYPES)

    def zsum(x):
        return X.money_sum(x)

    z = F.lit(0.0)
    comm = F.col("commission_fee") / F.lit(tax)
    return (e.groupBy(F.date_format(F.trunc("accepted_date", "month"), "MMM yyyy").alias("SalesMonth"),
                      F.col("c_id").alias("CompanyId"), F.col("company_name").alias("CompanyName"))
             # IF(cond, a, b) semantics: a NULL condition takes the ELSE branch
             .agg(zsum(F.when(s > 0, s).otherwise(z)).alias("GTV"),
                  zsum(F.when(s > 0, F.when(non_product, z).otherwise(s)).otherwise(z)).alias("ProductGTV"),
                  zsum(F.when(s != 0, s).otherwise(z)).alias("NTV"),
                  zsum(F.when(s != 0, F.when(non_product, z).otherwise(s)).otherwise(z)).alias("ProductNTV"),
                  zsum(F.when((s < 0) | fee, z).otherwise(n)).alias("NetAmountExGSTGTV"),
                  zsum(F.when(non_product | (s < 0) | fee, z).otherwise(n)).alias("ProductNetAmountExGSTGTV"),
                  zsum(F.when(fee, z).otherwise(n)).alias("NetAmountExGSTNTV"),
                  zsum(F.when(non_product, z).otherwise(n)).alias("ProductNetAmountExGSTNTV"),
                  zsum(F.when(ot == 9, comm).otherwise(z)).alias("TransactionFeeBasedCommissionExGST"),
                  zsum(F.when(ot == 10, comm).otherwise(z)).alias("SubscriptionFeeBasedCommissionExGST"),
                  zsum(F.when(ot == 11, comm).otherwise(z)).alias("RefundFeeBasedCommissionExGST"))
             .orderBy("CompanyId"))


# ---- R15: rolling margin -----------------------------------------------------------
def profit_margin(t: Tables, end: dt.date = ROLLING_END, tax: float = TAX,
                  lead_gen: list[tuple[str, float]] | None = None) -> DataFrame:
    """Rolling-52-week gross profit and margin per month.

    Sums are rounded before the profit arithmetic (as in the original).
    A month missing from the lead-generation table leaves other_incomes,
    gross_profit and profit_margin NULL.
    """
    spark = t.spark
    lines = Fl.completed_sales(t.lines.filter(cal.in_weeks("accepted_date", end, 52)), positive=False)
    enriched = Fl.own_channel(J.with_receipt(lines, t.bridge, t.receipts, ("channel", "receipt_type")))
    c = t.company.select("company_id", "gst_registered")
    e = X.line_economics(enriched.join(c, "company_id", "left"), tax)
    e = e.withColumn("type_text", X.classify_order_type())
    s, n, ot, tt = F.col("total_ex_tax"), F.col("net_ex_tax"), F.col("order_type"), F.col("type_text")
    comm = F.col("commission_fee") / F.lit(tax)

    def zs(cond, x, neg=False):
        # exact SUM(IF(cond, x, 0)), or SUM(IF(cond, 0, x)) with neg=True, as decimal(38,6)
        z = F.lit(0.0)
        return X.money_total(F.when(cond, z).otherwise(x) if neg else F.when(cond, x).otherwise(z))

    def r2(total):
        return F.round(total, 2).cast("double")

    base = (e.groupBy(cal.month_label("accepted_date", "long").alias("sale_month"),
                      F.month("accepted_date").cast("long").alias("sale_month_counter"))
             .agg(r2(zs(s > 0, s) - zs((s < 0) | ot.isin(*X.FEE_TYPES), n, neg=True)).alias("ttv_commission"),
                  r2(zs(ot == 9, comm)).alias("transaction_fee_based_commission_exgst"),
                  r2(zs(ot == 10, comm)).alias("subscription_fee_based_commission_exgst"),
                  r2(zs(ot == 11, comm)).alias("refund_fee_based_commission_exgst"),
                  r2(zs(tt == "RefundMoney", comm)).alias("refund_exgst"),
                  r2(zs(tt == "FreightProtection", comm)).alias("freightprotection_exgst"),
                  r2(zs(tt == "CouponApplied", s)).alias("coupon_sales_exgst"),
                  r2(zs((s > 0) & (tt != "FreightProtection"), s)).alias("gmv_exgst"),
                  r2(zs(s > 0, s)).alias("gtv_exgst")))
    lg = literal_table(spark, lead_gen if lead_gen is not None else lead_gen_months(),
                       "month_year string, revenue double")
    j = J.broadcast_lookup(base, lg, base.sale_month == lg.month_year)
    return O.order_months(X.profit_metrics(j), "sale_month", "sale_month_counter")


# ---- R16: sales by state -----------------------------------------------------------
def sales_by_state(t: Tables, end: dt.date = ROLLING_END, tax: float = TAX) -> DataFrame:
    """Month x 8 states x (gmv, gtv, units), 52 weeks to ``end``.

    The (month, state) sums and the PIVOT are one aggregation: each pivot
    cell is ROUND(SUM(..)/tax, 2) over that state's rows. 'Unknown' rows
    keep their month row but have no column.
    """
    lines = Fl.completed_sales(t.lines.filter(cal.in_weeks("accepted_date", end, 52)))
    enriched = Fl.own_channel(J.with_receipt(lines, t.bridge, t.receipts, ("channel", "receipt_type")))
    enriched = enriched.filter(F.col("receipt_type").isin(*Fl.RECEIPT_TYPES))
    df = enriched.select(cal.month_label("accepted_date", "long").alias("month_year"),
                         X.bucket_regex("postal_state").alias("state"),
                         "total_amount", "qty", "is_protection", "is_freight")
    not_prot = F.col("is_protection") == F.lit(False)
    not_freight = F.col("is_freight") == F.lit(False)
    amt = F.col("total_amount")
    wide = A.pivot_sums(df, ["month_year"], "state", X.STATE_PIVOT, {
        "gmv_exgst": F.when(not_prot, amt), "gtv_exgst": amt,
        "units_sold": F.when(not_prot & not_freight, F.col("qty"))},
        name=lambda m, v: f"__{m}_{v.replace(' ', '_')}")
    out = ["month_year"]
    for st in X.STATE_PIVOT:
        sfx = st.replace(" ", "_")
        out += [F.round(F.col(f"__gmv_exgst_{sfx}") / F.lit(tax), 2).alias(f"gmv_exgst_{sfx}"),
                F.round(F.col(f"__gtv_exgst_{sfx}") / F.lit(tax), 2).alias(f"gtv_exgst_{sfx}"),
                F.col(f"__units_sold_{sfx}").alias(f"units_sold_{sfx}")]
    return wide.select(*out)
