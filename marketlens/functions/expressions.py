"""Column-valued building blocks.

Every helper returns a native Catalyst expression (no Python UDF), so it
stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.params import HOUSE_SELLERS, TAX


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- fixed values -------------------------------------------------------------
# FIXED VALUES: order-line type labels (P4). Each rule is
# (order_type, refund_type or None for any, amount sign '<', '>' or None,
#  requires the freight-protection flag, label), tested in this order;
# anything unmatched is 'Missing'.
ORDER_TYPE_RULES = [
    (6, 0, "<", False, "CouponApplied"),
    (6, 0, ">", False, "CoupoonReversed"),
    (3, 0, "<", False, "CreditApplied"),
    (3, 0, ">", False, "CreditIssued"),
    (0, 0, None, True, "FreightProtection"),
    (0, 4, None, False, "RefundMoney"),
    (0, 3, None, False, "RefundCredit"),
    (1, 0, None, False, "AddOn"),
    (2, 0, None, False, "Special / FreightQuote"),
    (12, 0, "<", False, "MyMoneyApplied"),
    (12, 0, ">", False, "MyMoneyReinstated"),
    (5, 0, None, False, "SupplierDeduction"),
    (4, 0, None, False, "SupplierPayment"),
    (9, 0, None, False, "TransactionFee"),
    (10, 0, None, False, "SubscriptionFee"),
    (11, 0, None, False, "RefundFee"),
    (0, 0, None, False, "Normal"),
    (0, 1, None, False, "Normal"),
    (0, 2, None, False, "Normal"),
]
ORDER_TYPE_DEFAULT = "Missing"

# FIXED VALUES: free-text state -> canonical state (P5). Unanchored regexes on
# the lower-cased text, first match wins, otherwise 'Unknown'.
STATE_RULES = [
    ("qld|queensland", "Queensland"),
    ("nsw|newsouthwales|new.south.wales", "New South Wales"),
    ("vic|victoria", "Victoria"),
    ("wa|westernaustralia|western.australia", "Western Australia"),
    ("tas|tasmania", "Tasmania"),
    ("sa|southaustralia|south.australia", "South Australia"),
    ("act|australiancapitalterritory|australian.capital.territory", "Australian Capital Territory"),
    ("nt|northernterritory|northern.territory", "Northern Territory"),
]
STATE_DEFAULT = "Unknown"
# FIXED VALUES: pivot column order of the state report.
STATE_PIVOT = ["Victoria", "Western Australia", "Australian Capital Territory", "Queensland",
               "South Australia", "New South Wales", "Tasmania", "Northern Territory"]

# FIXED VALUES: client type -> platform (P6); other codes give NULL.
PLATFORM_RULES = [([0], "web"), ([1, 2, 3], "app")]

# FIXED VALUES: order types whose amounts are fees rather than goods.
FEE_TYPES = (9, 10, 11)
# FIXED VALUES: order types excluded from "product" GTV/NTV besides freight protection.
NON_PRODUCT_TYPES = (9, 10, 11, 5, 4)


# ---- P3 -----------------------------------------------------------------------
def fallback(df: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """Output column = variant field, else the parent product's field."""
    return df.select("*", *[F.coalesce(col(v), col(p)).alias(out) for out, (v, p) in mapping.items()])


# ---- P4 -----------------------------------------------------------------------
def classify_order_type(order_type: Column | str = "order_type", refund_type: Column | str = "refund_type",
                        amount: Column | str = "total_amount",
                        protection: Column | str = "is_protection") -> Column:
    """17 labels from (order type, refund type, amount sign, protection flag)."""
    ot, rt, amt, prot = col(order_type), col(refund_type), col(amount), col(protection)
    expr = None
    for o, r, sign, needs_prot, label in ORDER_TYPE_RULES:
        cond = (ot == o) & (rt == r)
        if sign == "<":
            cond = cond & (amt < 0)
        elif sign == ">":
            cond = cond & (amt > 0)
        if needs_prot:
            cond = cond & (prot == F.lit(True))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(ORDER_TYPE_DEFAULT)


# ---- P5 / P6 / P7 ---------------------------------------------------------------
def bucket_regex(c: Column | str, rules: Sequence[tuple[str, str]] = tuple(STATE_RULES),
                 default: str = STATE_DEFAULT) -> Column:
    """P5: first matching (unanchored) regex on lower(c); NULL text -> default."""
    low = F.lower(col(c))
    expr = None
    for pattern, label in rules:
        cond = low.rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def bucket_enum(c: Column | str, mapping: Sequence[tuple[Iterable, str]] = tuple(PLATFORM_RULES)) -> Column:
    """Code -> label by membership lists; unmatched codes give NULL."""
    expr = None
    for codes, label in mapping:
        cond = col(c).isin(list(codes))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def is_house(c: Column | str, house: Sequence[int] = HOUSE_SELLERS) -> Column:
    """Three-valued: TRUE for a house seller, FALSE for another, NULL for NULL."""
    return col(c).isin(list(house))


def party(c: Column | str, house: Sequence[int] = HOUSE_SELLERS) -> Column:
    """P7: '1P' for house sellers, otherwise (including NULL) '3P'."""
    return F.when(is_house(c, house), "1P").otherwise("3P")


# ---- P8 -----------------------------------------------------------------------
def line_economics(df: DataFrame, tax: float = TAX, gst_col: str = "gst_registered") -> DataFrame:
    """Ex-tax amount, seller net payable ex-tax and commission of each line."""
    net = F.col("company_pay_price") * F.col("qty")
    return df.select(
        "*",
        (F.col("total_amount") / F.lit(tax)).alias("total_ex_tax"),
        F.when((F.col(gst_col) == F.lit(True)) | F.col("order_type").isin(*FEE_TYPES), net / F.lit(tax))
         .otherwise(net).alias("net_ex_tax"),
        ((F.col("customer_price") - F.col("company_pay_price")) * F.col("qty")).alias("commission_fee"),
    )


# ---- P10 ------------------------------------------------------------------------
def stamp(today, window: tuple) -> list[Column]:
    """P10: report run date and sales window bounds, the same on every row."""
    return [F.lit(today).alias("report_run_date"), F.lit(window[0]).alias("sales_start_date"),
            F.lit(window[1]).alias("sales_end_date")]


# ---- P13 ------------------------------------------------------------------------
def profit_metrics(df: DataFrame) -> DataFrame:
    """Margin, other incomes and deductions, gross profit and profit margin
    from the rounded monthly sums (rounding first, as the original does).

    A NULL lead-generation revenue leaves other_incomes, gross_profit and
    profit_margin NULL.
    """
    other_inc = F.round(F.col("revenue") + F.col("freightprotection_exgst")
                        + F.col("transaction_fee_based_commission_exgst")
                        + F.col("subscription_fee_based_commission_exgst")
                        + F.col("refund_fee_based_commission_exgst"), 2)
    m = df.select(
        "sale_month", "sale_month_counter", "ttv_commission", "gtv_exgst",
        (F.round(F.try_divide(F.col("ttv_commission"), F.col("gtv_exgst")), 3) * 100).alias("margin"),
        other_inc.alias("other_incomes"),
        F.round(F.try_add(F.abs("refund_exgst"), F.abs("coupon_sales_exgst")), 2).alias("other_deductions"),
        "transaction_fee_based_commission_exgst", "subscription_fee_based_commission_exgst",
        "refund_fee_based_commission_exgst", "refund_exgst", "freightprotection_exgst",
        "coupon_sales_exgst", "gmv_exgst", F.col("revenue").alias("lead_gen_revenue"))
    gp = F.try_subtract(F.try_add(F.col("ttv_commission"), F.col("other_incomes")), F.col("other_deductions"))
    return m.select("*", gp.alias("gross_profit"),
                    F.try_divide(gp, F.try_add(F.col("gtv_exgst"), F.col("other_incomes"))).alias("profit_margin"))


# ---- P12 / P14 ------------------------------------------------------------------
def customer_type(first: Column | str, last: Column | str) -> Column:
    """P12: 'New Customer' when last <= first, else (also with NULLs) 'Returning Customer'."""
    return F.when(col(last) <= col(first), "New Customer").otherwise("Returning Customer")


def money_round(x: Column | str, digits: int = 2) -> Column:
    """S3: half-up rounding of a money value as written in decimal.

    The double is first fixed to 6 decimals, so 138905.205 (stored as
    138905.20499999...) rounds to 138905.21 on every engine.
    """
    return F.round(col(x).cast("decimal(38,6)"), digits).cast("double")


def money_total(x: Column | str) -> Column:
    """A5/S3: exact, order-independent sum of a money expression.

    Each value is fixed to 6 decimals and summed as DECIMAL, so the total
    does not depend on the order in which partitions are combined (a double
    sum can land on either side of a half cent). Result: decimal(38,6).
    """
    return F.sum(col(x).cast("decimal(38,6)"))


def money_sum(x: Column | str, digits: int = 2) -> Column:
    """ROUND(SUM(x), digits) computed exactly (see ``money_total``), as a double."""
    return F.round(money_total(x), digits).cast("double")


def safe_ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round(num / den, digits); NULL when den is 0 or NULL."""
    return money_round(F.try_divide(col(num), col(den)), digits)


def cond_sum(pred: Column, x: Column | str, empty: str = "null") -> Column:
    """A5: SUM(CASE WHEN p THEN x END) (empty='null') or SUM(IF(p, x, 0)) (empty='zero')."""
    if empty == "zero":
        return F.sum(F.when(pred, col(x)).otherwise(F.lit(0)))
    return F.sum(F.when(pred, col(x)))
