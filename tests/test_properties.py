"""Properties that must hold on the fixture data (sf0.001 / sf0.01)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions import calendar as cal
from marketlens.operators import filters as Fl
from marketlens.plans import cohort, finance, merch
from marketlens.plans import operators as ops
from marketlens.sources.tables import Tables
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF_MID)


def test_churned_is_active_before_and_not_now(t):
    as_of = dt.date(1996, 7, 15)
    done = Fl.completed_sales(t.lines)
    prev = done.filter(cal.in_months("accepted_date", as_of, 13, 1)).select("customer_id").distinct()
    cur = done.filter(cal.in_months("accepted_date", as_of, 12, 0)).select("customer_id").distinct()
    churned = prev.join(cur, "customer_id", "left_anti").count()
    assert finance.churned_customers(t, as_of).collect()[0][0] == churned > 0


def test_dedupe_is_unique_on_key(t):
    d = ops.w01_dedupe_latest(t)
    assert d.count() == d.select("order_id", "order_line_id").distinct().count()


def test_category_columns_cover_revenue(t):
    r = cohort.category_study_channel1(t).collect()
    cats = [f"cl_product_revenue_{c.lower()}" for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]
    for row in r:
        assert abs(sum(row[c] or 0.0 for c in cats) - row.cl_product_revenue) < 0.05


def test_party_split_adds_up_without_null_sellers(t):
    for row in cohort.study_channel1(t).collect():
        assert abs((row.cl_1p_product_revenue or 0) + (row.cl_3p_product_revenue or 0) - row.cl_product_revenue) < 0.02


def test_reports_are_not_empty(t):
    assert finance.active_this_vs_last(t).count() == 2
    m = merch.catalogue_master_a(t)
    assert m.filter(F.col("is_promo_product")).count() > 0
    assert m.filter(F.col("all_gmv_l12m").isNotNull()).count() > 0
    c = merch.promo_compliance(t)
    assert c.filter(F.col("sell_price_lb7").isNotNull()).count() > 0
    assert c.filter(F.col("complaint_flag_lb7") == "Non Compliant").count() > 0


def test_true_windows_see_more_than_prefiltered(t):
    pre = merch.windowed_sales_a(t).agg(F.sum("all_gmv_l12m")).collect()[0][0] or 0
    full = merch.windowed_sales_a(t, prefilter_weeks=None).agg(F.sum("all_gmv_l12m")).collect()[0][0]
    assert full > pre  # Q2: the 5-week pre-filter truncates the 12-month column


def test_basket_flag_shortcut_equals_running_mix(t):
    from marketlens.operators import aggregates as A
    from marketlens.params import FIRST_SINCE
    literal = cohort.running_basket_totals(t).select(
        *cohort.GRAIN, "first_transaction_contains_1p", "first_transaction_1p_only")
    op = cohort.channel1_order_products(t)
    span = A.customer_span(op, "customer_id", "transaction_date").filter(
        F.col("first_transaction_date") >= F.lit(FIRST_SINCE))
    shortcut = cohort.basket_flags(op, span).select(
        *cohort.GRAIN, "first_transaction_contains_1p", "first_transaction_1p_only")
    assert literal.count() == shortcut.count()
    assert literal.exceptAll(shortcut).count() == 0
