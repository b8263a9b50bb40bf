"""Promotion compliance checks (U1-U3) as native Column expressions.

The original defines them as SQL functions; here each is a Python function
that builds a Catalyst expression, so the checks run inside codegen and
never call back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.functions.expressions import col, money_round

# FIXED VALUES: check names, in order, with the reason text each adds when it fires.
CHECKS = [
    ("price_change_check", "[Price change check failed]"),
    ("published_date_check", "[Product created after promo start date]"),
    ("product_oos_check", "[Product oos check failed]"),
    ("sellprice_check", "[Promo price greater than sell price]"),
    ("savings_check", "[Savings is less than 5%]"),
]
# FIXED VALUES: flag labels produced by the per-lookback flag (spelled as in the source).
FLAG_NON_COMPLIANT = "Non Compliant"
FLAG_COMPLIANT = "Complaint"
# FIXED VALUES: labels of the overall flag, and the text its original tests for.
OVERALL_NON = "Non Complaint"
OVERALL_OK = "Complaint"
ORIGINAL_NON_TEST = "non complaint"
MIN_SAVING_PCT = 5.0


def compliance_check(start, lookback, price, promo, last_change, last_oos, created) -> Column:
    """Struct of five checks, each TRUE when it fires and NULL otherwise (never FALSE)."""
    start, lookback, price, promo = col(start), col(lookback), col(price), col(promo)
    last_change, last_oos, created = col(last_change), col(last_oos), col(created)
    before = lookback < start
    saving = money_round(F.try_divide(price - promo, price), 2) * 100
    t = F.lit(True)
    return F.struct(
        F.when(before & last_change.between(lookback, start), t).alias("price_change_check"),
        F.when(created > start, t).alias("published_date_check"),
        F.when(before & last_oos.between(lookback, start), t).alias("product_oos_check"),
        F.when(before & (price < promo), t).alias("sellprice_check"),
        F.when(before & (saving < F.lit(MIN_SAVING_PCT)), t).alias("savings_check"),
    )


def compliance_flag(checks: Column) -> Column:
    """struct(complaint_flag, complaince_text) from the five checks.

    The text is the bracketed reasons of the fired checks joined by newlines
    ('' when none fired).
    """
    fired = [checks.getField(name).isNotNull() for name, _ in CHECKS]
    any_fired = fired[0]
    for f in fired[1:]:
        any_fired = any_fired | f
    text = F.concat_ws("\n", *[F.when(f, F.lit(reason)) for f, (_, reason) in zip(fired, CHECKS)])
    return F.struct(F.when(any_fired, FLAG_NON_COMPLIANT).otherwise(FLAG_COMPLIANT).alias("complaint_flag"),
                    text.alias("complaince_text"))


def overall_flag(lb7: Column | str, lb3: Column | str, strict: bool = False) -> Column:
    """Combine the 7-day and 3-day flags.

    strict=False reproduces the original, which compares against the text
    'non complaint' that the flags never hold, so the result is always
    'Complaint'. strict=True compares against the real non-compliant label.
    """
    non = FLAG_NON_COMPLIANT.lower() if strict else ORIGINAL_NON_TEST
    a, b = F.lower(col(lb7)), F.lower(col(lb3))
    return (F.when(a == non, OVERALL_NON)
             .when(a.isNull() & (b == non), OVERALL_NON)
             .when((a == FLAG_COMPLIANT.lower()) & (b == non), OVERALL_NON)
             .when(a.isNull() & (b == FLAG_COMPLIANT.lower()), OVERALL_OK)
             .otherwise(OVERALL_OK))
