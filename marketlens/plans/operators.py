"""Stand-alone queries for the non-trivial operators, each over whole tables.

These exercise one operator at a time (the reports exercise them in
combination); every one has an oracle in ``checks/sql_operators.py``.
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
from marketlens.operators import windows as W
from marketlens.params import AS_OF, CHANNEL_A
from marketlens.plans import merch as M
from marketlens.session import scratch_path
from marketlens.sources.literal import latest_snapshot
from marketlens.sources.publish import publish_version, read_published
from marketlens.sources.tables import Tables


def k2_publish_roundtrip(t: Tables) -> DataFrame:
    """K2: publish the channel-B master as a version partitioned by run date, clustered by
    product id, into the shared checkpoint folder; return what reads back."""
    path = scratch_path(t.spark, "catalogue_master_b")
    publish_version(M.catalogue_master_b(t), path, "report_run_date", "product_id")
    return read_published(t.spark, path, "report_run_date")


def published_compliance(t: Tables) -> DataFrame:
    """R17 -> K2 -> R19: the channel-A master is published as a version; the compliance report reads that version."""
    path = scratch_path(t.spark, "catalogue_master_a")
    publish_version(M.catalogue_master_a(t), path, "report_run_date", "product_id")
    return M.published_compliance(read_published(t.spark, path, "report_run_date"), M.daily_listed_price(t))


def k4_latest_snapshot(t: Tables) -> DataFrame:
    """K4: snapshot rows at the table's latest date."""
    return latest_snapshot(t.snapshot, "last_updated_date")


def j03_null_safe_join(t: Tables) -> DataFrame:
    """Promotions with the latest snapshot price, NULL variant matching NULL."""
    snap = latest_snapshot(t.snapshot, "last_updated_date").select("product_id", "variant_id", "price")
    return J.null_safe_join(t.promo.select("product_id", "variant_id", "promo_price"), snap,
                            ["product_id"], ["variant_id"])


def j08_semi_any(t: Tables, today: dt.date = AS_OF) -> DataFrame:
    """Completed lines of the 5-week window whose (product, variant) is a
    catalogue key or a parent key of the channel-A catalogue."""
    cat = M.with_parents(M.catalogue(t, M.subscription_status(t, CHANNEL_A)), t.secondary)
    win = cal.local_windows(today)
    lines = Fl.completed_sales(t.lines.filter(cal.between("accepted_date", win["prefilter"])))
    keep = J.semi_any(lines, [cat.select("product_id", "variant_id"),
                              cat.select("parent_product_id", "parent_variant_id")], "product_id", "variant_id")
    return keep.select("line_id", "product_id", "variant_id", "company_id", "total_amount", "accepted_date")


def j10_lookback(t: Tables) -> DataFrame:
    """Price as of 14, 7 and 3 days before each promotion start."""
    base = t.promo_check.select("event_id", "product_id", "variant_id", "start_date")
    prices = M.daily_sell_price(t).withColumn("price", F.col("sell.price"))
    return J.lookback(base, prices, "start_date", M.LOOKBACKS, "product_id", "variant_id",
                      "run_date", "product_id", "variant_key", "price",
                      out="sell_price_lb{d}", lookback_col="lookback_{d}days", key_cast="string")


def w01_dedupe_latest(t: Tables) -> DataFrame:
    """Channel-2 order lines, latest row per (order, line) with tiebreaks."""
    return W.dedupe_latest(t.channel2, ["order_id", "order_line_id"],
                           [F.desc("order_date"), F.desc("l_shipdate"), F.asc("product_id"),
                            F.asc("l_suppkey"), F.asc("gmv")])


def w04_previous_price(t: Tables) -> DataFrame:
    """Each price observation with the previous price and date of its key."""
    h = t.price_history.withColumn("date", F.to_date("ts"))
    prev = W.with_previous(h, ["product_id", "variant_id"], "ts", ["event_id"],
                           {"price": "pre_sell_price", "date": "pre_sell_price_date"})
    return prev.select("event_id", "product_id", "variant_id", "date", "price", "pre_sell_price",
                       "pre_sell_price_date", Fl.changed("price", "pre_sell_price").alias("is_change"))


def w05_first_by(t: Tables) -> DataFrame:
    """Every price row with the first price of its (day, product, variant)."""
    h = t.price_history.withColumn("run_date", F.to_date("ts"))
    out = W.first_by(h, ["run_date", "product_id", "variant_id"], "price", ["ts", "event_id"], "first_price")
    return out.select("event_id", "run_date", "product_id", "variant_id", "price", "first_price")


def p04_order_type_mix(t: Tables) -> DataFrame:
    """P4 over all lines: line count and ex-tax amount per type label."""
    e = X.line_economics(t.lines.join(t.company.select("company_id", "gst_registered"), "company_id", "left"))
    return (e.groupBy(X.classify_order_type().alias("type_text"))
             .agg(F.count(F.lit(1)).alias("lines"), X.money_sum("total_ex_tax").alias("total_ex_tax"),
                  X.money_sum("net_ex_tax").alias("net_ex_tax")))


def p05_state_buckets(t: Tables) -> DataFrame:
    """P5 over all lines: raw state text -> canonical state, with line counts."""
    return (t.lines.groupBy("postal_state", X.bucket_regex("postal_state").alias("state"))
                   .agg(F.count(F.lit(1)).alias("lines")))


def a14_windowed_sales(t: Tables, today: dt.date = AS_OF) -> DataFrame:
    """A14 + J9: channel-A windowed sales with the parent roll-in (pre-join)."""
    s = M.windowed_sales_a(t, today)
    return s.select("product_id", "variant_id", "company_id", *[F.round(c, 3).cast("double").alias(c) if "gmv" in c else F.col(c) for c in M.SALES_A])


def o04_live_promotions(t: Tables, today: dt.date = AS_OF) -> DataFrame:
    """O4 (+F8, J6, J7): live promotions including those inherited by secondary products."""
    return M.live_promotions(t, today, with_secondary=True)


def f03_local_windows(t: Tables, today: dt.date = AS_OF) -> DataFrame:
    """daily completed-sales totals tagged with each local window they fall in."""
    win = cal.local_windows(today)
    lines = Fl.completed_sales(t.lines.filter(cal.between("accepted_date", (win["last_12m"][0], today))))
    d = F.col("accepted_date")
    return (lines.groupBy("accepted_date")
                 .agg(X.money_sum("total_amount").alias("amount"))
                 .select("accepted_date", "amount",
                         *[cal.between(d, win[k]).alias(f"in_{k}") for k in
                           ("this_week", "last_4w", "ytd", "last_12m", "prefilter")]))


def j01_with_receipt(t: Tables) -> DataFrame:
    """Every order line with its receipt and the receipt's channel(s)."""
    return J.with_receipt(t.lines.select("line_id", "product_id", "total_amount"), t.bridge, t.receipts)


def j06_churned_ids(t: Tables, as_of: dt.date = AS_OF) -> DataFrame:
    """Customers active in the year to last month but not in the trailing year (anti-join)."""
    done = Fl.completed_sales(t.lines)
    prev = done.filter(cal.in_months("accepted_date", as_of, 13, 1)).select("customer_id")
    cur = done.filter(cal.in_months("accepted_date", as_of, 12, 0)).select("customer_id")
    return J.anti(prev.filter(F.col("customer_id").isNotNull()).distinct(), cur, "customer_id")


def a07_first_receipts(t: Tables) -> DataFrame:
    """A7 (before the window filter): first approved own-site receipt and date per customer."""
    r = Fl.own_channel(Fl.approved_receipts(t.receipts, positive=True))
    return r.groupBy("customer_id").agg(F.min("receipt_id").alias("first_receipt"),
                                        F.min("transaction_date").alias("first_date"))


def a08_customer_span(t: Tables) -> DataFrame:
    """First and latest completed own-site product purchase per customer."""
    lines = Fl.product_lines(Fl.completed_sales(t.lines))
    df = Fl.own_channel(J.with_receipt(lines, t.bridge, t.receipts))
    return A.customer_span(df, "customer_id", "accepted_date")


def a13_order_products(t: Tables) -> DataFrame:
    """Channel-1 revenue per (customer, receipt, date, product, seller)."""
    from marketlens.plans.cohort import channel1_order_products
    op = channel1_order_products(t)
    return op.select(*[c for c in op.columns if c != "product_revenue"],
                     F.round("product_revenue", 2).cast("double").alias("product_revenue"))


def p03_catalogue(t: Tables) -> DataFrame:
    """P3 + J2 + J5 + F12 + P9: channel-A subscribed catalogue with variant-else-parent fields."""
    return M.catalogue(t, M.subscription_status(t, CHANNEL_A))


def p08_line_economics(t: Tables) -> DataFrame:
    """Ex-tax amount, net payable and commission of every line, with its type label."""
    e = X.line_economics(t.lines.join(t.company.select("company_id", "gst_registered"), "company_id", "left"))
    return e.select("line_id", "product_id", "order_type", X.classify_order_type().alias("type_text"),
                    *[X.money_round(c, 4).alias(c) for c in ("total_ex_tax", "net_ex_tax", "commission_fee")])
