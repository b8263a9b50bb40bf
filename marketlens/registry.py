"""Query registry: one entry per report and per non-trivial operator.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built over the
whole driver tables of that scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.plans import cohort as coh
from marketlens.plans import finance as fin
from marketlens.plans import merch as mer
from marketlens.plans import operators as ops
from marketlens.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]


def _report(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


REPORTS: dict[str, QueryFn] = {
    "r01_seller_transactions": _report(fin.seller_transactions),
    "r02_active_customers": _report(fin.active_customers),
    "r03_active_this_vs_last": _report(fin.active_this_vs_last),
    "r04_churned_customers": _report(fin.churned_customers),
    "r05_first_time_customers": _report(fin.first_time_customers),
    "r06_new_customers": _report(fin.new_customers),
    "r07_category_month": _report(fin.category_month),
    "r08_seller_ledger": _report(fin.seller_ledger),
    "r09_units_shipped": _report(fin.units_shipped),
    "r10_total_customers": _report(fin.total_customers),
    "r11_total_transactions": _report(fin.total_transactions),
    "r12_unique_companies": _report(fin.unique_companies),
    "r13_unique_products": _report(fin.unique_products),
    "r14_web_app_aov": _report(fin.web_app_aov),
    "r15_profit_margin": _report(fin.profit_margin),
    "r16_sales_by_state": _report(fin.sales_by_state),
    "r17_catalogue_master_a": _report(mer.catalogue_master_a),
    "r18_catalogue_master_b": _report(mer.catalogue_master_b),
    "r19_promo_compliance": _report(mer.promo_compliance),
    "r19_published_compliance": _report(ops.published_compliance),
    "r20_study_channel1": _report(coh.study_channel1),
    "r21_study_channel2": _report(coh.study_channel2),
    "r22_study_channel3": _report(coh.study_channel3),
    "r23_category_study_channel1": _report(coh.category_study_channel1),
    "r24_category_study_channel3": _report(coh.category_study_channel3),
    "r25_category_study_channel2": _report(coh.category_study_channel2),
    "r26_product_study_channel1": _report(coh.product_study_channel1),
}

OPERATORS: dict[str, QueryFn] = {
    "k02_publish_roundtrip": _report(ops.k2_publish_roundtrip),
    "k04_latest_snapshot": _report(ops.k4_latest_snapshot),
    "j03_null_safe_join": _report(ops.j03_null_safe_join),
    "j08_semi_any": _report(ops.j08_semi_any),
    "j10_lookback": _report(ops.j10_lookback),
    "w01_dedupe_latest": _report(ops.w01_dedupe_latest),
    "w04_previous_price": _report(ops.w04_previous_price),
    "w05_first_by": _report(ops.w05_first_by),
    "p04_order_type_mix": _report(ops.p04_order_type_mix),
    "p05_state_buckets": _report(ops.p05_state_buckets),
    "a14_windowed_sales": _report(ops.a14_windowed_sales),
    "o04_live_promotions": _report(ops.o04_live_promotions),
    "f03_local_windows": _report(ops.f03_local_windows),
    "j01_with_receipt": _report(ops.j01_with_receipt),
    "j06_churned_ids": _report(ops.j06_churned_ids),
    "a07_first_receipts": _report(ops.a07_first_receipts),
    "a08_customer_span": _report(ops.a08_customer_span),
    "a13_order_products": _report(ops.a13_order_products),
    "p03_catalogue": _report(ops.p03_catalogue),
    "p08_line_economics": _report(ops.p08_line_economics),
    "w06_running_totals": _report(coh.running_basket_totals),
    "w09_top_product_per_brand": _report(coh.top_products_by_brand),
}


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    out.update(REPORTS)
    out.update(OPERATORS)
    return out


def oracle_sql() -> dict[str, str]:
    from marketlens.checks import sql_cohort, sql_finance, sql_merch, sql_operators
    out: dict[str, str] = {}
    out.update(sql_finance.SQL)
    out.update(sql_cohort.SQL)
    out.update(sql_merch.SQL)
    out.update(sql_operators.SQL)
    return out
