"""Date windows relative to a report date.

Bounds are computed once on the driver as date literals, so every window
filter is ``date_col >= DATE 'x' AND date_col < DATE 'y'``: constant-folded,
pushed below joins and into the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month arithmetic with end-of-month clamping (SQL ADD_MONTHS)."""
    m0 = d.month - 1 + n
    y, m = d.year + m0 // 12, m0 % 12 + 1
    last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28,
            31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m - 1]
    return dt.date(y, m, min(d.day, last))


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def month_window(as_of: dt.date, a: int, b: int) -> tuple[dt.date, dt.date]:
    """[month_start(as_of) - a months, month_start(as_of) - b months)."""
    ms = month_start(as_of)
    return add_months(ms, -a), add_months(ms, -b)


def in_months(date_col: Column | str, as_of: dt.date, a: int, b: int) -> Column:
    """date in the half-open month window (a, b) before ``as_of``'s month.

    (1, 0) last month, (12, 0) trailing year, (13, 1) trailing year one month earlier.
    """
    lo, hi = month_window(as_of, a, b)
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def weeks_window(end: dt.date, n: int) -> tuple[dt.date, dt.date]:
    return end - dt.timedelta(weeks=n), end


def in_weeks(date_col: Column | str, end: dt.date, n: int = 52) -> Column:
    """date BETWEEN end - n weeks AND end (both inclusive)."""
    lo, hi = weeks_window(end, n)
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return c.between(F.lit(lo), F.lit(hi))


def local_today(tz: str) -> Column:
    """today's date in a time zone (used when no ``as_of`` is given)."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), tz))


def local_windows(today: dt.date) -> dict[str, tuple[dt.date, dt.date]]:
    """inclusive (lo, hi) bounds used by the catalogue masters.

    this_week   Monday..Sunday of today's ISO week
    last_4w     today - 4 weeks .. yesterday
    ytd         1 January .. today
    last_12m    today - 12 months .. yesterday
    prefilter   today - 5 weeks .. yesterday (the outer WHERE of the sales CTE)
    """
    monday = today - dt.timedelta(days=today.weekday())
    yesterday = today - dt.timedelta(days=1)
    return {
        "this_week": (monday, monday + dt.timedelta(days=6)),
        "last_4w": (today - dt.timedelta(weeks=4), yesterday),
        "ytd": (today.replace(month=1, day=1), today),
        "last_12m": (add_months(today, -12), yesterday),
        "prefilter": (today - dt.timedelta(weeks=5), yesterday),
    }


def between(date_col: Column | str, bounds: tuple[dt.date, dt.date]) -> Column:
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return c.between(F.lit(bounds[0]), F.lit(bounds[1]))


def month_label(date_col: Column | str, style: str = "long") -> Column:
    """S8: 'July-1995' (long, '%B-%Y') or 'Jul 1995' (short, '%b %Y')."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.date_format(c, "MMMM-yyyy" if style == "long" else "MMM yyyy")
