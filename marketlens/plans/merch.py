"""Catalogue masters (R17, R18) and promotion price compliance.

The masters join a product-variant catalogue with subscription status,
latest marketplace snapshot, windowed sales (with parent roll-in), live
promotions (including those inherited by secondary products), last price
change and last stock-out. Optional variant ids match NULL to NULL through
``eqNullSafe`` (still a hash/sort-merge equi-join), replacing the sentinel
constants of the original.

Sizes: the line table is the only input that grows with sales; it is
filtered to the 5-week pre-window in the scan, semi-joined to the catalogue
keys, and aggregated before it meets the catalogue. Everything else is
catalogue-sized and joined by shuffle joins that adaptive execution turns
into broadcasts only when the measured size is under the threshold.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import calendar as cal
from marketlens.functions import compliance as C
from marketlens.functions import expressions as X
from marketlens.operators import aggregates as A
from marketlens.operators import filters as Fl
from marketlens.operators import joins as J
from marketlens.operators import setops as O
from marketlens.operators import windows as W
from marketlens.operators.keyfilter import key_filter
from marketlens.params import AS_OF, CHANNEL_A, CHANNEL_B, CHANNEL_OWN, URL_PREFIX
from marketlens.sources.literal import latest_snapshot
from marketlens.sources.publish import materialize
from marketlens.sources.tables import Tables


def subscription_status(t: Tables, channel: str) -> DataFrame:
    """Middleware subscription rows of one marketplace."""
    s = t.subscription.filter(Fl.ieq("channel", channel))
    return s.select("product_id", F.col("channel").alias("marketplace_name"),
                    F.col("subscribed").alias("middleware_subscribed_status"),
                    F.col("unsubscribed_reason").alias("product_unsubscribed_reason"), "banner_note",
                    F.col("last_updated").alias("last_middleware_updated"))


#: Fields that a variant has before its product (P3), and their names in the catalogue.
CATALOGUE_FIELDS = {"sku": "product_sku", "sell_price": "product_sell_price", "rrp": "product_retail_price",
                    "stock": "product_stock_level", "created": "product_created_date"}


def catalogue(t: Tables, subscribed: DataFrame) -> DataFrame:
    """Subscribed products x variants with seller, brand, category.

    Products reach their variants through the item bridge. A product without
    an item, variants, brand or category keeps its row with nulls; one whose
    seller is unknown or deleted is left out. Relations of about a row per
    product are never broadcast: packed files make them look small, and the
    driver would hold several at once.
    """
    p = J.semi(t.product, subscribed.hint("merge"), "product_id").drop("level1")
    own = {f: f"v_{f}" for f in ("sku", "sell_price", "rrp", "stock", "created")}
    v = t.variant.select("item_id", "variant_id", *[F.col(f).alias(n) for f, n in own.items()])
    sellers = Fl.active_sellers(t.company).select("company_id", F.col("description").alias("seller_name"))
    j = (p.join(sellers, "company_id", "inner")
          .join(t.item.select("product_id", "item_id").hint("merge"), "product_id", "left")
          .join(v.hint("merge"), "item_id", "left")
          .join(t.category.withColumnRenamed("tag_id", "category_id").hint("merge"), "product_id", "left")
          .join(t.brand, "brand_id", "left"))
    j = X.fallback(j, {name: (own[f], f) for f, name in CATALOGUE_FIELDS.items()})
    return j.select(
        F.col("company_id").alias("seller_id"), "seller_name", "product_id", "product_name",
        F.concat(F.lit(URL_PREFIX), F.col("sku")).alias("product_url"),
        "variant_id", "brand_id", "brand_name", "category_id", "level1", "level2", "level3", "level4",
        *CATALOGUE_FIELDS.values())


def with_parents(df: DataFrame, secondary: DataFrame, key: str = "product_id") -> DataFrame:
    """Secondary product -> its primary (parent) product and variant, plus *_mod ids."""
    m = secondary.select(F.col("secondary_id").alias("__sec"), F.col("product_id").alias("parent_product_id"),
                         F.col("variant_id").alias("parent_variant_id"))
    j = df.join(m, df[key] == m["__sec"], "left").drop("__sec")
    return j


def asked_for(history: DataFrame, products: DataFrame | None) -> DataFrame:
    """A history without most rows of products that are not in ``products`` (a run-time key filter, where that pays)."""
    asked = key_filter(products.select("product_id"), ["product_id"], history) if products is not None else None
    return asked.keep(history, ["product_id"]) if asked else history


def last_price_change(t: Tables, products: DataFrame | None = None) -> DataFrame:
    """W4 + F13 + W2: latest date whose price differs from the previous observation.

    Observations are ordered by (date, ts, event_id): the date is the
    original order key, the rest make ties deterministic. With ``products``,
    rows of other products may be missing.
    """
    h = asked_for(t.price_history, products)
    h = h.withColumn("date", F.to_date("ts"))  # (ts, event_id) orders as (date, ts, event_id) does
    ch = W.with_previous(h, ["product_id", "variant_id"], "ts", ["event_id"], {"price": "pre_sell_price"})
    ch = ch.filter(Fl.changed("price", "pre_sell_price"))
    return ch.groupBy("product_id", "variant_id").agg(F.max("date").alias("last_price_change_date"))


def last_stock_out(t: Tables, products: DataFrame | None = None) -> DataFrame:
    """Latest stock-out date per (product, variant); NULL variant is its own group. ``products`` as above."""
    return asked_for(t.stock_out, products).groupBy("product_id", "variant_id").agg(F.max("oos_date").alias("last_stock_oos_date"))


def live_promotions(t: Tables, today: dt.date, with_secondary: bool = True) -> DataFrame:
    """F8 + O4: live promotions; with_secondary adds the ones inherited by
    secondary products (variant NULL) and drops primary rows of mapped keys (J6, J7)."""
    live = Fl.live_promos(t.promo, today)
    cols = [F.col("company_id").alias("seller_id"), F.col("promo_price").alias("promotional_price"),
            F.col("commission").alias("commission_percentage"), F.col("start_date").alias("promotion_start_date"),
            F.col("end_date").alias("promotion_end_date")]
    if not with_secondary:
        return live.select("product_id", "variant_id", *cols)
    sec = t.secondary
    primary = J.null_safe_join(live, sec.select("product_id", "variant_id"), ["product_id"], ["variant_id"],
                               how="left_anti")
    primary = primary.select("product_id", "variant_id", *cols).distinct()
    inherited = J.null_safe_join(live, sec, ["product_id"], ["variant_id"], how="inner")
    inherited = inherited.select(F.col("secondary_id").alias("product_id"),
                                 F.lit(None).cast("long").alias("variant_id"), *cols).distinct()
    return O.union_typed([primary, inherited])


STATUS_FIELDS = ("middleware_subscribed_status", "product_unsubscribed_reason", "banner_note", "last_middleware_updated")
SALES_A = ("chan_gmv_tw", "chan_gmv_l4w", "chan_gmv_ytd", "all_gmv_l12m",
           "chan_units_tw", "chan_units_l4w", "chan_units_ytd", "all_units_l12m")


#: Fields of the marketplace's own listing of a product, and their names in the master.
LISTING_FIELDS = {"listing_id": "listing_id", "created_date": "listing_created_date", "name": "listing_name",
                  "link": "listing_url", "sku": "listing_sku", "price": "marketplace_price", "stock": "listing_stock",
                  "level1": "listing_level1", "level2": "listing_level2", "level3": "listing_level3",
                  "level4": "listing_level4", "active_status": "listing_active_status", "rrp": "listing_rrp",
                  "seller_name": "listing_seller_name", "seller_type": "listing_seller_type"}


def catalogue_a(t: Tables, channel: str = CHANNEL_A) -> DataFrame:
    """Channel-A catalogue with parent ids (*_mod) and the latest marketplace listing."""
    mps = subscription_status(t, channel)
    cat = with_parents(catalogue(t, mps), t.secondary)
    cat = (cat.withColumn("product_id_mod", F.coalesce("parent_product_id", "product_id"))
              .withColumn("variant_id_mod", F.coalesce("parent_variant_id", "variant_id")))
    snap = latest_snapshot(t.snapshot, "last_updated_date").select(
        "product_id", "variant_id", *[F.col(f).alias(n) for f, n in LISTING_FIELDS.items()])
    return J.null_safe_join(cat, snap, ["product_id"], ["variant_id"])


def windowed_sales_a(t: Tables, today: dt.date = AS_OF, channel: str = CHANNEL_A,
                     prefilter_weeks: int | None = 5, cat: DataFrame | None = None) -> DataFrame:
    """A14 + J8 + J9: 4 windows x {value, units} per (product, variant, seller),
    for catalogue products and their parents, with the parent's sales rolled in."""
    win = cal.local_windows(today)
    cat = cat if cat is not None else catalogue_a(t, channel)
    lines = t.lines
    if prefilter_weeks is not None:
        lo = today - dt.timedelta(weeks=prefilter_weeks)
        lines = lines.filter(F.col("accepted_date").between(F.lit(lo), F.lit(win["prefilter"][1])))
    lines = Fl.completed_sales(lines)
    lines = J.semi_any(lines, [cat.select("product_id", "variant_id"),
                               cat.select("parent_product_id", "parent_variant_id")], "product_id", "variant_id")
    sales = with_parents(J.with_receipt(lines, t.bridge, t.receipts), t.secondary)
    d = F.col("accepted_date")
    in_chan = Fl.ieq("channel", channel)
    not_prot = F.col("is_protection") == F.lit(False)
    unit_ok = not_prot & (F.col("is_freight") == F.lit(False))
    amt, qty = F.col("total_amount"), F.col("qty")
    measures = {
        "chan_gmv_tw": (in_chan & cal.between(d, win["this_week"]) & not_prot, amt),
        "chan_gmv_l4w": (in_chan & cal.between(d, win["last_4w"]) & not_prot, amt),
        "chan_gmv_ytd": (in_chan & cal.between(d, win["ytd"]) & not_prot, amt),
        "all_gmv_l12m": (cal.between(d, win["last_12m"]) & not_prot, amt),
        "chan_units_tw": (in_chan & cal.between(d, win["this_week"]) & unit_ok, qty),
        "chan_units_l4w": (in_chan & cal.between(d, win["last_4w"]) & unit_ok, qty),
        "chan_units_ytd": (in_chan & cal.between(d, win["ytd"]) & unit_ok, qty),
        "all_units_l12m": (cal.between(d, win["last_12m"]) & unit_ok, qty),
    }
    base_sales = A.windowed_metrics(
        sales, ["product_id", "parent_product_id", "variant_id", "parent_variant_id", "company_id"], measures,
        money=[n for n in measures if "gmv" in n])
    return J.add_parent_metrics(base_sales, "product_id", "variant_id", "parent_product_id",
                                "parent_variant_id", list(measures),
                                keep=["product_id", "variant_id", "company_id"])


def catalogue_master_a(t: Tables, today: dt.date = AS_OF, channel: str = CHANNEL_A,
                       prefilter_weeks: int | None = 5) -> DataFrame:
    """Marketplace catalogue master of channel A.

    ``prefilter_weeks=5`` reproduces the original, whose outer WHERE keeps
    only 5 weeks of sales, so the year-to-date and 12-month columns see 5
    weeks and this-week is cut at yesterday; ``None`` gives the true windows.
    """
    win = cal.local_windows(today)
    mps = subscription_status(t, channel)
    cat = materialize(catalogue_a(t, channel))  # read by the sales filter and the final assembly
    consolidated = windowed_sales_a(t, today, channel, prefilter_weeks, cat)
    measures = SALES_A
    out = J.assemble(cat, [
        (live_promotions(t, today, with_secondary=True), ["product_id", "seller_id"], ["variant_id"]),
        (consolidated.withColumnRenamed("company_id", "seller_id"), ["product_id", "seller_id"], ["variant_id"]),
        (last_price_change(t, cat), ["product_id"], ["variant_id"]),
        (last_stock_out(t, cat), ["product_id"], ["variant_id"]),
        (mps, ["product_id"], []),
    ])
    g = [F.round(n, 3).cast("double").alias(n) for n in measures if "gmv" in n]
    u = [F.col(n) for n in measures if "units" in n]
    return out.select(
        *X.stamp(today, win["last_4w"]),
        "seller_id", "seller_name", "product_id", "product_name", "product_url", "variant_id", "brand_id", "brand_name",
        "category_id", "level1", "level2", "level3", "level4", *CATALOGUE_FIELDS.values(),
        "parent_product_id", "parent_variant_id", "product_id_mod", "variant_id_mod", *LISTING_FIELDS.values(),
        "promotional_price", "commission_percentage", "promotion_start_date",
        "promotion_end_date", *g, *u, "last_price_change_date", "last_stock_oos_date",
        F.col("promotion_start_date").isNotNull().alias("is_promo_product"), *STATUS_FIELDS)


def catalogue_master_b(t: Tables, today: dt.date = AS_OF, channel: str = CHANNEL_B) -> DataFrame:
    """Marketplace catalogue master of channel B (4-week sales, marketplace lookup)."""
    win = cal.local_windows(today)
    mps = subscription_status(t, channel)
    cat = catalogue(t, mps)
    lines = t.lines.filter(cal.between("accepted_date", win["prefilter"]))
    lines = J.semi(Fl.completed_sales(lines), mps, "product_id")
    sales = J.with_receipt(lines, t.bridge, t.receipts)
    d = F.col("accepted_date")
    in_chan = Fl.ieq("channel", channel)
    l4w = cal.between(d, win["last_4w"])
    not_prot = F.col("is_protection") == F.lit(False)
    unit_ok = not_prot & (F.col("is_freight") == F.lit(False))
    m = (sales.groupBy("product_id", "variant_id", F.col("company_id").alias("seller_id"))
         .agg(X.money_total(F.when(in_chan & l4w & not_prot, F.col("total_amount"))).alias("chan_gmv_l4w"),
              F.sum(F.when(in_chan & l4w & unit_ok, F.col("qty"))).alias("chan_units_l4w"),
              X.money_total(F.when(l4w & not_prot, F.col("total_amount"))).alias("all_gmv_l4w"),
              F.sum(F.when(l4w & unit_ok, F.col("qty"))).alias("all_units_l4w")))
    lk = t.lookup.filter(Fl.ieq("marketplace", channel)).select(
        F.col("product_id").alias("lk_product"), F.col("variant_id").alias("lk_variant"),
        F.col("seller_id").alias("lk_seller"), "internal_product_id",
        F.col("published_date").alias("listing_created_date"),
        F.coalesce(Fl.ieq("active_status", "active"), F.lit(False)).alias("listing_published"),
        F.col("seller_name").alias("listing_seller_name"))
    out = cat.join(mps, "product_id", "left")
    out = out.join(lk, (out.product_id.cast("string") == lk.lk_product)
                   & (out.seller_id.cast("string") == lk.lk_seller)
                   & out.variant_id.cast("string").eqNullSafe(lk.lk_variant), "left")
    out = J.null_safe_join(out, live_promotions(t, today, with_secondary=False),
                           ["product_id", "seller_id"], ["variant_id"])
    out = J.null_safe_join(out, m, ["product_id", "seller_id"], ["variant_id"])
    return out.select(
        "product_created_date", "product_sku", "product_id", "product_name", "variant_id", "product_url",
        "seller_id", "seller_name", "category_id", "level1", "level2", "level3", "level4", "brand_id", "brand_name",
        "product_sell_price", "product_retail_price", "product_stock_level", *STATUS_FIELDS,
        "internal_product_id", "listing_created_date",
        "listing_published", "listing_seller_name", "promotional_price", "commission_percentage",
        "promotion_start_date", "promotion_end_date",
        *[F.round(c, 3).cast("double").alias(c) for c in ("chan_gmv_l4w", "chan_units_l4w", "all_gmv_l4w", "all_units_l4w")],
        *X.stamp(today, win["last_4w"]))


# ---- R19: promotion price compliance -------------------------------------------
LOOKBACKS = (14, 7, 3)


def daily_first(history: DataFrame, order: Sequence[str]) -> DataFrame:
    """The daily price relation: first price of each (day, product, variant), and how many history rows the key has."""
    first = history.groupBy("run_date", "product_id", "variant_id").agg(
        F.struct(F.min_by(F.col("price").cast("double"), F.struct(*order)).alias("price"),
                 F.count(F.lit(1)).alias("copies")).alias("sell"))
    return first.withColumn("variant_key", F.expr("try_cast(variant_id as bigint)"))


def daily_sell_price(t: Tables) -> DataFrame:
    """Daily prices from the price history's observations."""
    h = t.price_history.select(F.to_date("ts").alias("run_date"),
                               F.col("product_id").cast("string").alias("product_id"),
                               F.col("variant_id").cast("string").alias("variant_id"),
                               "price", "ts", "event_id")
    return daily_first(h, ["ts", "event_id"])


def daily_listed_price(t: Tables, marketplace: str = CHANNEL_OWN) -> DataFrame:
    """Daily prices from the marketplaces' daily price table (F10: one marketplace's rows).

    A day has one or a few rows of a product, so adding them up before the shuffle would only sort
    all that a scan's task gives out; they are dealt out first.
    """
    rows = t.daily_price.filter(Fl.ieq("marketplace", marketplace))
    return daily_first(rows.repartition("run_date", "product_id", "variant_id"), ["row_no"])


def promo_compliance(t: Tables, strict: bool = False, dedupe: bool = False) -> DataFrame:
    """R19 over promotion events: lookback prices, five checks per lookback, flags (``compliance``)."""
    base = t.promo_check
    base = base.join(t.created, "product_id", "left")
    base = J.null_safe_join(base, last_price_change(t), ["product_id"], ["variant_id"])
    base = J.null_safe_join(base, last_stock_out(t), ["product_id"], ["variant_id"])
    base = base.select("event_id", F.col("created").alias("product_created_date"), "product_id", "variant_id",
                       F.col("promo_price").alias("promotional_price"),
                       F.col("start_date").alias("promotion_start_date"),
                       "last_price_change_date", "last_stock_oos_date")
    return compliance(base, daily_sell_price(t), strict, dedupe)


#: Columns of the catalogue master that the compliance report keeps, in its order.
CHECKED_FIELDS = ("product_created_date", "product_id", "product_name", "product_url", "listing_url", "variant_id",
                  "product_sku", "product_sell_price", "product_retail_price", "product_stock_level",
                  "promotional_price", "promotion_start_date", "promotion_end_date", "last_price_change_date",
                  "last_stock_oos_date")


def published_compliance(master: DataFrame, daily: DataFrame, strict: bool = False, dedupe: bool = False) -> DataFrame:
    """R19 over a catalogue master (R17) as it was published (K2): its promoted rows, all 28 columns."""
    return compliance(master.filter("is_promo_product").select(*CHECKED_FIELDS), daily, strict, dedupe)


def compliance(base: DataFrame, daily: DataFrame, strict: bool = False, dedupe: bool = False) -> DataFrame:
    """Per promoted product row: lookback prices, five checks per lookback, flags; all columns of ``base`` first.

    The daily price relation of the original keeps every history row of a day
    with that day's first price, so each lookback repeats a promoted row as
    often; ``dedupe`` gives one row for each promoted row instead. The joins
    move one row per (day, product, variant) either way; copies are made after
    them.
    """
    j = J.lookback(base, daily, "promotion_start_date", LOOKBACKS, "product_id", "variant_id",
                   "run_date", "product_id", "variant_key", "sell",
                   out="__sell{d}", lookback_col="lookback_{d}days", key_cast="string")
    if not dedupe:
        copies = F.lit(1).cast("bigint")
        for d in LOOKBACKS:
            copies = copies * F.coalesce(F.col(f"__sell{d}.copies"), F.lit(1))
        j = j.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    j = j.withColumns({f"sell_price_lb{d}": F.col(f"__sell{d}.price") for d in LOOKBACKS})
    flags = []
    for d in LOOKBACKS:
        chk = C.compliance_check("promotion_start_date", f"lookback_{d}days", f"sell_price_lb{d}",
                                 "promotional_price", "last_price_change_date", "last_stock_oos_date",
                                 "product_created_date")
        flags.append(C.compliance_flag(chk).alias(f"__f{d}"))
    j = j.select("*", *flags)
    out_cols = []
    for d in LOOKBACKS:
        out_cols += [F.col(f"__f{d}.complaint_flag").alias(f"complaint_flag_lb{d}"),
                     F.col(f"__f{d}.complaince_text").alias(f"complaint_text_lb{d}")]
    return j.select(
        *base.columns,
        *[f"lookback_{d}days" for d in LOOKBACKS], *[f"sell_price_lb{d}" for d in LOOKBACKS], *out_cols,
        C.overall_flag(F.col("__f7.complaint_flag"), F.col("__f3.complaint_flag"), strict).alias("complaint_flag"))
