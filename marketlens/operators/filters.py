"""Row filters.

All are Catalyst predicates; the ones on scan columns reach the Parquet
reader as pushed filters, the rest are evaluated inside the scan's codegen
stage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: completed order-line statuses and countable receipt types.
COMPLETED_STATUSES = (3, 4)
RECEIPT_TYPES = (0, 1, 2)


def completed_sales(df: DataFrame, positive: bool = True, status: str = "status",
                    amount: str = "total_amount") -> DataFrame:
    """status in (3, 4) and (optionally) amount > 0."""
    cond = F.col(status).isin(*COMPLETED_STATUSES)
    if positive:
        cond = cond & (F.col(amount) > 0)
    return df.filter(cond)


def own_channel(df: DataFrame, channel: str = "channel") -> DataFrame:
    """own-site rows: channel IS NULL (after the receipt left join, so
    lines without a receipt are kept)."""
    return df.filter(F.col(channel).isNull())


def product_lines(df: DataFrame, freight: bool = True, protection: bool = True,
                  exclude_types: tuple[int, ...] = ()) -> DataFrame:
    """drop freight and/or freight-protection lines, and/or some order types."""
    cond = F.lit(True)
    if freight:
        cond = cond & (F.col("is_freight") == F.lit(False))
    if protection:
        cond = cond & (F.col("is_protection") == F.lit(False))
    if exclude_types:
        cond = cond & ~F.col("order_type").isin(*exclude_types)
    return df.filter(cond)


def approved_receipts(df: DataFrame, positive: bool = True) -> DataFrame:
    """approved receipts of type 0/1/2 (and amount > 0)."""
    cond = (F.col("approved") == F.lit(True)) & F.col("receipt_type").isin(*RECEIPT_TYPES)
    if positive:
        cond = cond & (F.col("amount") > 0)
    return df.filter(cond)


def live_promos(df: DataFrame, today: dt.date) -> DataFrame:
    """F8: not deleted, not archived, end date on or after today."""
    return df.filter((F.col("is_deleted") == F.lit(False)) & (F.col("is_archived") == F.lit(False))
                     & (F.col("end_date") >= F.lit(today)))


def having(df: DataFrame, cond: Column) -> DataFrame:
    """predicate on an aggregate's output (HAVING)."""
    return df.filter(cond)


def ieq(c: Column | str, literal: str) -> Column:
    """case-insensitive equality."""
    return F.lower(F.col(c) if isinstance(c, str) else c) == F.lit(literal.lower())


def active_sellers(company: DataFrame) -> DataFrame:
    """sellers that are not soft-deleted (filter before the join, so the
    LEFT JOIN + WHERE of the original becomes an inner join on a smaller side)."""
    return company.filter(F.col("soft_deleted") == F.lit(False))


def changed(cur: Column | str, prev: Column | str) -> Column:
    """previous value present and |cur - prev| > 0."""
    c = F.col(cur) if isinstance(cur, str) else cur
    p = F.col(prev) if isinstance(prev, str) else prev
    return p.isNotNull() & (F.abs(c - p) > 0)
