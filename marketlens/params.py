"""Run parameters (K6) and the constants of the fixture binding.

The reports take these as keyword arguments; the values here are the ones
the fixture tables are bound with (see FIXTURES.md, part 3).
"""

from __future__ import annotations

import datetime as dt

# Report date used by the "last month" / "trailing 12 months" KPIs and as the
# local "today" of the catalogue masters. 1996-07-15 is a Monday.
AS_OF = dt.date(1996, 7, 15)
# End of the rolling 52-week window of the margin and state reports.
ROLLING_END = dt.date(1996, 6, 30)
# First-purchase cut of the channel-1 cohort study.
FIRST_SINCE = dt.date(1995, 6, 1)
# Sellers that count as first party ("1P").
HOUSE_SELLERS = (1, 2)
# Sales-tax divisor applied to amounts.
TAX = 1.1
# Sales channels of the receipt header; NULL means the own site.
CHANNEL_A = "partner_a"
CHANNEL_B = "partner_b"
# Name of the own site in the marketplaces' daily price table.
CHANNEL_OWN = "own"
# Local time zone of the catalogue masters.
LOCAL_TZ = "Australia/Melbourne"
# URL prefix of product pages.
URL_PREFIX = "https://shop.example/p/"
# Product ids tracked as their own columns by the top-product study.
TRACKED_PRODUCTS = (1, 2, 11, 12, 21, 22, 31, 32, 41, 42)
# Category (level1) values tracked as their own columns by the category study.
TRACKED_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def lead_gen_months(start: dt.date = dt.date(1995, 7, 1), n: int = 12) -> list[tuple[str, float]]:
    """The inline (month label, lead-generation revenue) table of the margin report.

    Generated from a rule: 12 consecutive months from ``start``, revenue
    5000 + 750 * i.
    """
    out = []
    y, m = start.year, start.month
    for i in range(n):
        label = dt.date(y, m, 1).strftime("%B-%Y")
        out.append((label, round(5000.0 + 750.0 * i, 2)))
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out
