"""Aggregations.

All aggregates are hash aggregates with map-side partial aggregation, so a
hot key is reduced inside each map task before the shuffle. Distinct counts
are planned by Catalyst as a two-level aggregation (first on (key, value),
then on key), which also spreads a hot key over many shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import expressions as X


def kpi_distinct(df: DataFrame, c: str, name: str) -> DataFrame:
    """A1: one-row distinct count."""
    return df.agg(F.count_distinct(F.col(c)).alias(name))


def kpi_distinct_composite(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """A2: distinct count of CONCAT(cols); a NULL part drops the row (as CONCAT does)."""
    return df.agg(F.count_distinct(F.concat(*[F.col(c).cast("string") for c in cols])).alias(name))


def kpi_sum(df: DataFrame, c: str, name: str) -> DataFrame:
    """A3: one-row sum."""
    return df.agg(F.sum(F.col(c)).alias(name))


def order_value_by(df: DataFrame, key: Column, key_name: str, receipt: str = "receipt_id",
                   amount: str = "amount") -> DataFrame:
    """A4: per key: distinct transactions, gross sales, average order value."""
    return (df.groupBy(key.alias(key_name))
              .agg(F.count_distinct(F.col(receipt)).alias("total_transactions"),
                   X.money_total(amount).alias("__gross"))
              .select(key_name, "total_transactions",
                      F.round("__gross", 2).cast("double").alias("gross_sales"),
                      X.safe_ratio("__gross", "total_transactions").alias("aov")))


def first_event_in(df: DataFrame, key: str, date_col: str, receipt: str, window: Column,
                   name: str) -> DataFrame:
    """MIN(date) / MIN(receipt) per key; count keys whose first date is in the window.

    ``window`` is a predicate on the column ``first_date``.
    """
    firsts = df.groupBy(key).agg(F.min(receipt).alias("first_receipt"),
                                 F.min(date_col).alias("first_date"))
    return firsts.filter(window).agg(F.count_distinct(F.col(key)).alias(name))


def customer_span(df: DataFrame, key: str, date_col: str) -> DataFrame:
    """First and latest transaction date per customer."""
    return df.groupBy(key).agg(F.min(date_col).alias("first_transaction_date"),
                               F.max(date_col).alias("latest_transaction_date"))


def pivot_sums(df: DataFrame, index: Sequence[str], pivot_col: str, values: Sequence[str],
               metrics: Mapping[str, Column], name=lambda metric, value: f"{metric}_{value}") -> DataFrame:
    """PIVOT of several sums over a fixed value list, in one aggregation.

    Written as conditional sums in a single ``groupBy`` (one shuffle with
    partial aggregation) instead of ``groupBy().pivot()``, which aggregates
    twice. Semantics match PIVOT: a cell is NULL when no row (or only NULL
    values) has that pivot value; values outside the list are dropped while
    their index row stays.
    """
    aggs = []
    for v in values:
        for m, expr in metrics.items():
            aggs.append(F.sum(F.when(F.col(pivot_col) == F.lit(v), expr)).alias(name(m, v)))
    return df.groupBy(*index).agg(*aggs)


def order_product_grain(df: DataFrame, keys: Sequence[str], amount: str = "total_amount",
                        out: str = "product_revenue") -> DataFrame:
    """SUM(amount) per (customer, receipt, date, product, seller, ...), exact (decimal)."""
    return df.groupBy(*keys).agg(X.money_total(amount).alias(out))


def windowed_metrics(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[Column, Column]],
                     money: Sequence[str] = ()) -> DataFrame:
    """Many (predicate, value) conditional sums in one pass per key; those named in ``money`` are exact decimals."""
    return df.groupBy(*keys).agg(*[
        X.cond_sum(p, v.cast("decimal(38,6)") if n in money else v).alias(n) for n, (p, v) in measures.items()])
