"""The catalogue masters' columns, their fallbacks and joins, and the compliance report over a published master."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.plans import merch
from marketlens.plans import operators as ops
from marketlens.session import scratch_path
from marketlens.sources.publish import publish_version, read_published

D = dt.date


class Shop:
    """The views that ``catalogue`` reads, by hand."""

    def __init__(self, spark):
        made = spark.createDataFrame
        self.product = made(
            [(1, "one", 5, "x", 100, "P1", 10.0, 12.0, 3, D(2024, 1, 1), "b"),
             (2, "two", None, "x", 100, "P2", 20.0, None, 4, D(2024, 1, 2), None),
             (3, "three", 6, "x", 101, "P3", 30.0, 33.0, 5, D(2024, 1, 3), None),
             (4, "four", 77, "x", 100, "P4", 40.0, 44.0, 6, None, None),
             (5, "five", 5, "x", 100, "P5", 50.0, 55.0, 7, None, None)],
            "product_id long, product_name string, brand_id long, level1 string, company_id long, sku string, "
            "sell_price double, rrp double, stock int, created date, brand string")
        self.item = made([(1, 11), (2, 22), (3, 33)], "product_id long, item_id long")
        self.variant = made(
            [(11, 1, "V1", None, 13.0, None, D(2024, 5, 5)), (11, 2, None, 9.0, None, 0, None), (33, 1, "V3", 1.0, 1.0, 1, None)],
            "item_id long, variant_id long, sku string, sell_price double, rrp double, stock int, created date")
        self.brand = made([(5, "five"), (6, "six")], "brand_id long, brand_name string")
        self.category = made([(1, 9, "a", "b", None, "d")],
                             "product_id long, tag_id long, level1 string, level2 string, level3 string, level4 string")
        self.company = made([(100, "seller", True, False), (101, "gone", True, True)],
                            "company_id long, description string, gst_registered boolean, soft_deleted boolean")
        self.subscribed = made([(1,), (1,), (2,), (3,), (4,)], "product_id long")


def test_catalogue_fields_fall_back_one_by_one(spark):
    shop = Shop(spark)
    got = {(r.product_id, r.variant_id): r for r in merch.catalogue(shop, shop.subscribed).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, None), (4, None)}  # 3's seller is deleted, 5 is not subscribed

    def fields(*key):
        r = got[key]
        return r.product_sku, r.product_sell_price, r.product_retail_price, r.product_stock_level, r.product_created_date
    assert fields(1, 1) == ("V1", 10.0, 13.0, 3, D(2024, 5, 5))
    assert fields(1, 2) == ("P1", 9.0, 12.0, 0, D(2024, 1, 1))
    assert fields(2, None) == ("P2", 20.0, None, 4, D(2024, 1, 2))
    assert (got[1, 1].brand_name, got[2, None].brand_name, got[4, None].brand_id, got[4, None].brand_name) == ("five", None, 77, None)
    assert [got[1, 2][c] for c in ("category_id", "level1", "level2", "level3", "level4")] == [9, "a", "b", None, "d"]
    assert got[2, None].category_id is None and got[2, None].level1 is None


def test_an_empty_catalogue_is_empty(spark):
    shop = Shop(spark)
    assert merch.catalogue(shop, shop.subscribed.limit(0)).count() == 0


def test_masters_have_all_columns(tables_small):
    a, b = merch.catalogue_master_a(tables_small), merch.catalogue_master_b(tables_small)
    assert (len(a.columns), len(set(a.columns))) == (59, 59)
    assert (len(b.columns), len(set(b.columns))) == (37, 37)
    for df in (a, b):
        filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
        hollow = {c for c, n in filled.items() if n == 0}
        # the small fixture's price and stock histories have other products, and its channel sells little in five weeks
        assert hollow <= {"last_price_change_date", "last_stock_oos_date", *(c for c in df.columns if c.startswith("chan_"))}


@pytest.fixture(scope="module")
def published(spark, tables_small):
    path = scratch_path(spark, "master-for-compliance")
    publish_version(merch.catalogue_master_a(tables_small), path, "report_run_date", "product_id")
    return read_published(spark, path, "report_run_date")


def test_compliance_reads_the_published_master(tables_small, published):
    out = merch.published_compliance(published, merch.daily_listed_price(tables_small))
    assert len(out.columns) == 28
    assert out.columns == ops.published_compliance(tables_small).columns
    promoted = published.where("is_promo_product").count()
    once = merch.published_compliance(published, merch.daily_listed_price(tables_small), dedupe=True)
    assert 0 < promoted == once.count() < out.count()
    seen = once.agg(*[F.count(f"sell_price_lb{d}").alias(f"p{d}") for d in merch.LOOKBACKS],
                    F.collect_set("complaint_flag_lb7").alias("flags")).first()
    assert min(seen.p14, seen.p7, seen.p3) > 0 and set(seen.flags) == {"Complaint", "Non Compliant"}


def test_strict_flag_fails_rows_that_the_lenient_one_passes(tables_small, published):
    daily = merch.daily_listed_price(tables_small)
    lenient = merch.published_compliance(published, daily)
    strict = merch.published_compliance(published, daily, strict=True)
    assert lenient.where("complaint_flag <> 'Complaint'").count() == 0
    bad = strict.where("complaint_flag = 'Non Complaint'")
    want = lenient.where("complaint_flag_lb7 = 'Non Compliant' or complaint_flag_lb3 = 'Non Compliant'")
    assert bad.count() == want.count() > 0


def test_daily_price_is_the_first_row_of_one_marketplace(spark):
    class Feed:
        daily_price = spark.createDataFrame(
            [(D(2024, 1, 1), 1, "1", "2", 8.0, "OWN"), (D(2024, 1, 1), 0, "1", "2", 7.0, "own"), (D(2024, 1, 1), 0, "1", None, 5.0, "own"),
             (D(2024, 1, 1), 0, "1", "2", 1.0, "other"), (D(2024, 1, 1), 0, "1", "x", 4.0, "own"), (D(2024, 1, 2), 0, "1", "2", 9.0, None)],
            "run_date date, row_no long, product_id string, variant_id string, price double, marketplace string")
    got = {(r.variant_id, r.variant_key): (r.sell.price, r.sell.copies) for r in merch.daily_listed_price(Feed()).collect()}
    assert got == {("2", 2): (7.0, 2), (None, None): (5.0, 1), ("x", None): (4.0, 1)}


def test_published_master_without_promotions_gives_no_rows(tables_small, published):
    assert merch.published_compliance(published.where("not is_promo_product"), merch.daily_listed_price(tables_small)).count() == 0
