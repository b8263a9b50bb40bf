"""Sorting and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_months(df: DataFrame, label: str, month_no: str) -> DataFrame:
    """O2: chronological order of 'Month-YYYY' labels: by year text, then month number."""
    return df.orderBy(F.right(F.col(label), F.lit(4)), F.col(month_no))


def stack_periods(wide: DataFrame, periods: Mapping[str, str], label: str = "Period",
                  value: str = "value") -> DataFrame:
    """O3: one labelled row per period from a one-row result (UNION ALL of constants).

    ``periods`` maps the label text to the column holding its value. Uses
    ``stack`` (a generator on the row) rather than re-running the query once
    per period.
    """
    args = ", ".join(f"'{k}', `{v}`" for k, v in periods.items())
    return wide.selectExpr(f"stack({len(periods)}, {args}) as (`{label}`, `{value}`)")


def union_typed(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name (missing columns must be added as typed NULLs)."""
    return reduce(lambda a, b: a.unionByName(b), parts)
