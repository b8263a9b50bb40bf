"""K1: table scans and the canonical views the reports read.

The reports are written against a canonical marketplace model (order lines,
line->receipt bridge, receipt headers, sellers, products, variants, promos,
price and stock histories, channel feeds). ``Tables`` binds that model to the
driver's Parquet tables exactly as FIXTURES.md part 3 specifies, using only
DataFrame expressions, so Catalyst prunes columns and pushes filters into
the Parquet scans. Every view is built lazily and is a plain DataFrame plan.

In production the same class would be pointed at the real tables; only
this module knows how canonical columns map to physical ones.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.operators.hotkeys import Hot, hot_keys, tasks_for

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """K1: read one named table; optional explicit column pruning.

    The schema is inferred from the Parquet footers once per path and then
    passed explicitly, so repeated reads skip footer inference on the driver.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
    else:
        df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df


def _opt_variant(key) -> F.Column:
    """Optional variant id: NULL when key % 4 = 0, else key % 4."""
    return F.when(key % 4 == 0, F.lit(None).cast("long")).otherwise(key % 4)


def _brand_id(brand: F.Column) -> F.Column:
    """The number in a brand's name."""
    return F.regexp_extract(brand, "([0-9]+)$", 1).cast("long")


def _day(d: dt.date) -> F.Column:
    return F.lit(d)


class Tables:
    """Canonical views over the driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The driver table ``name`` (one DataFrame per table and instance)."""
        if name not in self._raw:
            self._raw[name] = load(self.spark, self.sf_dir, name)
        return self._raw[name]

    # ---- sellers and catalogue -------------------------------------------------
    @cached_property
    def company(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(
            s.s_suppkey.alias("company_id"),
            s.s_name.alias("description"),
            (s.s_suppkey % 2 == 0).alias("gst_registered"),
            (s.s_suppkey % 10 == 9).alias("soft_deleted"),
        )

    @cached_property
    def product(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            p.p_partkey.alias("product_id"),
            p.p_name.alias("product_name"),
            p.p_brand.alias("brand"),
            F.when(p.p_partkey % 13 != 0, _brand_id(p.p_brand)).alias("brand_id"),
            p.p_type.alias("level1"),
            (p.p_partkey % 10).alias("company_id"),
            F.concat(F.lit("P-"), p.p_partkey.cast("string")).alias("sku"),
            p.p_retailprice.alias("sell_price"),
            (p.p_retailprice * 1.2).alias("rrp"),
            p.p_size.alias("stock"),
            F.date_add(_day(dt.date(1995, 1, 1)), (p.p_partkey % 365).cast("int")).alias("created"),
        )

    @cached_property
    def variant(self) -> DataFrame:
        p = self.raw("part")
        return p.filter(p.p_partkey % 4 != 0).select(
            (p.p_partkey + 500000).alias("item_id"),
            (p.p_partkey % 4).alias("variant_id"),
            F.when(p.p_size % 3 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("V-"), p.p_partkey.cast("string"))).alias("sku"),
            F.when(p.p_size % 5 == 0, F.lit(None).cast("double"))
             .otherwise(p.p_retailprice * 0.95).alias("sell_price"),
            F.when(p.p_size % 4 != 0, p.p_retailprice * 1.1).alias("rrp"),
            F.when(p.p_size % 6 != 0, p.p_size + 7).alias("stock"),
            F.when(p.p_size % 2 != 0, F.date_add(_day(dt.date(1995, 10, 1)), (p.p_partkey % 400).cast("int"))).alias("created"),
        )

    @cached_property
    def item(self) -> DataFrame:
        """Bridge of a product to the item that its variants belong to."""
        p = self.raw("part")
        return p.select(p.p_partkey.alias("product_id"), (p.p_partkey + 500000).alias("item_id"))

    @cached_property
    def brand(self) -> DataFrame:
        b = self.raw("part").select("p_brand").distinct()
        return b.select(_brand_id(b.p_brand).alias("brand_id"), b.p_brand.alias("brand_name"))

    @cached_property
    def category(self) -> DataFrame:
        """A product's tag and its four category levels; some products have none."""
        p = self.raw("part")
        return p.filter(p.p_partkey % 9 != 0).select(
            p.p_partkey.alias("product_id"),
            (p.p_partkey % 50 + 1).alias("tag_id"),
            p.p_type.alias("level1"),
            F.concat(p.p_type, F.lit("/"), (p.p_size % 4).cast("string")).alias("level2"),
            F.when(p.p_size % 2 == 0, p.p_brand).alias("level3"),
            F.when(p.p_size % 5 == 0, F.concat(F.lit("S"), p.p_size.cast("string"))).alias("level4"),
        )

    # ---- order lines, bridge, receipts ------------------------------------------
    @cached_property
    def lines(self) -> DataFrame:
        l, o = self.raw("lineitem"), self.raw("orders")
        j = l.join(o, l.l_orderkey == o.o_orderkey, "inner")
        ln, rf = F.col("l_linenumber"), F.col("l_returnflag")
        return j.select(
            F.col("l_orderkey").alias("line_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            _opt_variant(F.col("l_partkey")).alias("variant_id"),
            (F.col("l_partkey") % 10).alias("company_id"),
            F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 4)
             .otherwise(1).alias("status"),
            F.when(ln <= 3, 0).when(ln == 4, 9).when(ln == 5, 10).when(ln == 6, 11)
             .otherwise(6).alias("order_type"),
            F.when((ln <= 3) & (rf == "R"), 4).otherwise(0).alias("refund_type"),
            F.when(rf == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
             .alias("total_amount"),
            F.col("l_quantity").alias("qty"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("customer_price"),
            (F.col("l_extendedprice") / F.col("l_quantity") * (1 - F.col("l_discount")))
             .alias("company_pay_price"),
            F.col("o_orderdate").cast("date").alias("accepted_date"),
            ((ln == 2) & (F.col("l_linestatus") == "O")).alias("is_freight"),
            ((ln == 3) & (F.col("l_linestatus") == "O")).alias("is_protection"),
            F.when(F.col("l_partkey") % 5 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("P-"), F.col("l_partkey").cast("string"))).alias("sku"),
            F.when(F.col("o_custkey") % 10 == 0, "QLD")
             .when(F.col("o_custkey") % 10 == 1, "New South Wales")
             .when(F.col("o_custkey") % 10 == 2, "vic")
             .when(F.col("o_custkey") % 10 == 3, "Western Australia")
             .when(F.col("o_custkey") % 10 == 4, "Tasmania")
             .when(F.col("o_custkey") % 10 == 5, "south australia")
             .when(F.col("o_custkey") % 10 == 6, "ACT")
             .when(F.col("o_custkey") % 10 == 7, "Northern Territory")
             .when(F.col("o_custkey") % 10 == 8, "Other").alias("postal_state"),
        )

    @cached_property
    def bridge(self) -> DataFrame:
        o = self.raw("orders")
        return o.filter(o.o_orderkey % 97 != 0).select(
            o.o_orderkey.alias("line_id"), o.o_orderkey.alias("receipt_id"))

    @cached_property
    def receipts(self) -> DataFrame:
        o = self.raw("orders")
        pr = F.col("o_orderpriority")
        return o.select(
            o.o_orderkey.alias("receipt_id"),
            o.o_custkey.alias("customer_id"),
            o.o_orderdate.cast("date").alias("transaction_date"),
            F.when(o.o_orderkey % 50 == 0, F.lit(0.0)).otherwise(o.o_totalprice).alias("amount"),
            (o.o_orderstatus != "P").alias("approved"),
            F.when(o.o_orderkey % 10 < 9, o.o_orderkey % 3).otherwise(F.lit(3)).alias("receipt_type"),
            (F.substring(pr, 1, 1).cast("int") - 1).alias("client_type"),
            F.when(pr == "4-NOT SPECIFIED", "partner_a").when(pr == "5-LOW", "partner_b")
             .alias("channel"),
        )

    # ---- catalogue side tables ------------------------------------------------
    @cached_property
    def subscription(self) -> DataFrame:
        p = self.raw("part")
        return p.filter(p.p_size % 3 != 0).select(
            p.p_partkey.alias("product_id"),
            F.when(p.p_size % 3 == 1, "partner_a").otherwise("partner_b").alias("channel"),
            (p.p_size < 25).alias("subscribed"),
            F.when(p.p_size >= 25, F.concat(F.lit("reason "), (p.p_size % 3).cast("string"))).alias("unsubscribed_reason"),
            F.when(p.p_size % 4 == 0, F.concat(F.lit("note "), (p.p_size % 5).cast("string"))).alias("banner_note"),
            F.date_add(_day(dt.date(1996, 1, 1)), (p.p_partkey % 190).cast("int")).alias("last_updated"),
        )

    @cached_property
    def secondary(self) -> DataFrame:
        p = self.raw("part")
        nxt = p.p_partkey + 1
        return p.filter(p.p_partkey % 10 == 3).select(
            nxt.alias("product_id"), _opt_variant(nxt).alias("variant_id"),
            p.p_partkey.alias("secondary_id"))

    @cached_property
    def snapshot(self) -> DataFrame:
        p = self.raw("part").filter(F.col("p_partkey") % 7 != 0)
        days = F.inline(F.array(
            F.struct(_day(dt.date(1996, 7, 13)).alias("d"), F.lit(0).alias("k")),
            F.struct(_day(dt.date(1996, 7, 14)).alias("d"), F.lit(1).alias("k"))))
        e = p.select("p_partkey", "p_retailprice", "p_name", "p_type", "p_brand", "p_size", days)
        key, size = F.col("p_partkey"), F.col("p_size")
        return e.select(
            F.col("d").alias("last_updated_date"),
            key.alias("product_id"),
            _opt_variant(key).alias("variant_id"),
            (F.col("p_retailprice") + F.col("k")).alias("price"),
            (key + 900000).alias("listing_id"),
            F.date_add(_day(dt.date(1995, 3, 1)), (key % 300).cast("int")).alias("created_date"),
            F.concat(F.lit("Listing "), F.col("p_name")).alias("name"),
            F.concat(F.lit("https://listing.example/"), key.cast("string")).alias("link"),
            F.concat(F.lit("L-"), key.cast("string")).alias("sku"),
            (size * 2).alias("stock"),
            F.col("p_type").alias("level1"),
            F.col("p_brand").alias("level2"),
            F.concat(F.lit("S"), (size % 5).cast("string")).alias("level3"),
            F.when(size % 2 == 1, F.concat(F.lit("T"), (size % 3).cast("string"))).alias("level4"),
            F.when(size % 2 == 0, "Active").otherwise("Inactive").alias("active_status"),
            (F.col("p_retailprice") * 1.3).alias("rrp"),
            F.concat(F.lit("Seller "), (key % 10).cast("string")).alias("seller_name"),
            F.when(key % 10 <= 2, "1P").otherwise("3P").alias("seller_type"))

    @cached_property
    def promo(self) -> DataFrame:
        p = self.raw("part")
        return p.filter(p.p_size <= 20).select(
            p.p_partkey.alias("product_id"),
            _opt_variant(p.p_partkey).alias("variant_id"),
            (p.p_partkey % 10).alias("company_id"),
            (p.p_retailprice * 0.9).alias("promo_price"),
            p.p_size.alias("commission"),
            F.date_add(_day(dt.date(1996, 7, 1)), p.p_size).alias("start_date"),
            F.date_add(_day(dt.date(1996, 7, 15)), p.p_size - 5).alias("end_date"),
            (p.p_size % 7 == 0).alias("is_deleted"),
            (p.p_size % 11 == 0).alias("is_archived"),
        )

    @cached_property
    def lookup(self) -> DataFrame:
        """Marketplace product lookup (ids as strings), one row per listed part."""
        p = self.raw("part")
        return p.filter(p.p_partkey % 5 != 0).select(
            p.p_partkey.cast("string").alias("product_id"),
            F.when(p.p_partkey % 4 == 0, F.lit(None).cast("string"))
             .otherwise((p.p_partkey % 4).cast("string")).alias("variant_id"),
            (p.p_partkey + 100000).alias("internal_product_id"),
            (p.p_partkey % 10).cast("string").alias("seller_id"),
            F.date_add(_day(dt.date(1995, 6, 1)), (p.p_partkey % 200).cast("int")).alias("published_date"),
            F.when(p.p_size % 2 == 0, "Active").otherwise("Inactive").alias("active_status"),
            F.concat(F.lit("Seller "), (p.p_partkey % 10).cast("string")).alias("seller_name"),
            F.when(p.p_size % 3 == 1, "partner_a").otherwise("partner_b").alias("marketplace"),
        )

    @cached_property
    def daily_price(self) -> DataFrame:
        """Daily price history of the marketplaces (ids as strings): some days are missing, some have two rows."""
        p, first = self.raw("part"), _day(dt.date(1996, 6, 18))
        days = p.select("*", F.explode(F.sequence(F.lit(0), F.lit(30))).alias("k"))
        days = days.filter(F.col("k") % (F.col("p_size") % 3 + 1) == 0)
        again = F.when(F.col("p_size") % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        key, k = F.col("p_partkey"), F.col("k")
        return days.select("*", F.explode(again).alias("n")).select(
            F.date_add(first, k).alias("run_date"), F.col("n").cast("long").alias("row_no"),
            key.cast("string").alias("product_id"), _opt_variant(key).cast("string").alias("variant_id"),
            (F.col("p_retailprice") - k % 5 * 30 + F.col("n")).alias("price"),
            F.when(key % 8 == 0, "partner_b").otherwise("Own").alias("marketplace"))

    def _events(self, kind: str) -> DataFrame:
        e = self.raw("events")
        return e.filter(e.event_type == kind)

    @cached_property
    def price_history(self) -> DataFrame:
        e = self._events("view")
        return e.select("ts", "event_id", e.user_id.alias("product_id"),
                        _opt_variant(e.user_id).alias("variant_id"), e.value.alias("price"))

    @cached_property
    def stock_out(self) -> DataFrame:
        e = self._events("error")
        return e.select(e.ts.cast("date").alias("oos_date"), "event_id",
                        e.user_id.alias("product_id"), _opt_variant(e.user_id).alias("variant_id"))

    @cached_property
    def promo_check(self) -> DataFrame:
        e = self._events("purchase")
        return e.select("event_id", e.user_id.alias("product_id"),
                        _opt_variant(e.user_id).alias("variant_id"),
                        e.ts.cast("date").alias("start_date"), e.value.alias("promo_price"))

    @cached_property
    def created(self) -> DataFrame:
        e = self._events("signup")
        return e.groupBy(e.user_id.alias("product_id")).agg(F.max(e.ts.cast("date")).alias("created"))

    # ---- other channels ---------------------------------------------------------
    @cached_property
    def _line_tasks(self) -> int:
        return tasks_for(self.spark, self.raw("lineitem").count())

    def line_tasks(self, view: str) -> int:
        """How many tasks the lines of ``lines``, ``channel2`` or ``channel3`` are dealt to, from their number in the files' footers."""
        return self._line_tasks

    def hot_products(self, view: str) -> Hot:
        """The products of too many lines for one task, by the ids in ``lines``, ``channel2`` or ``channel3``, from one pass over these."""
        return hot_keys(self.raw("lineitem").select("l_partkey"), ["l_partkey"])

    def dealt(self, view: str) -> DataFrame:
        """``channel2`` or ``channel3`` with its lines dealt to ``line_tasks`` tasks by order."""
        return {"channel2": self._channel2, "channel3": self._channel3}[view](by_order=True)

    def _order_lines(self, by_order: bool) -> DataFrame:
        """Lines with their order; ``by_order``: dealt by order, so what is grouped by order next needs no other shuffle."""
        l, o = self.raw("lineitem"), self.raw("orders")
        dealt = l.repartition(self._line_tasks, l.l_orderkey) if by_order else l
        return dealt.join(o, l.l_orderkey == o.o_orderkey, "inner")

    @cached_property
    def channel2(self) -> DataFrame:
        return self._channel2(by_order=False)

    def _channel2(self, by_order: bool) -> DataFrame:
        return self._order_lines(by_order).select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_line_id"),
            F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_partkey").cast("string").alias("external_product_id"),
            F.col("l_extendedprice").alias("gmv"), "l_shipdate", "l_suppkey")

    @cached_property
    def channel3(self) -> DataFrame:
        return self._channel3(by_order=False)

    def _channel3(self, by_order: bool) -> DataFrame:
        return self._order_lines(by_order).select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("article_id"),
            F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(F.col("l_partkey") % 10 == 7, F.lit(None).cast("string"))
             .otherwise((F.col("l_partkey") % 10).cast("string")).alias("seller_id"),
            F.col("l_extendedprice").alias("line_total"), "l_shipdate", "l_linenumber", "l_suppkey")

    @cached_property
    def performance(self) -> DataFrame:
        l, o, p = self.raw("lineitem"), self.raw("orders"), self.raw("part")
        j = l.join(o, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)
        rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
        return j.select(F.col("p_type").alias("level1"),
                        F.col("o_orderdate").cast("date").alias("sale_date"),
                        rev.alias("revenue"), (rev * F.col("l_tax")).alias("margin"))
