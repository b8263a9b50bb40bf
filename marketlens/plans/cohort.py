"""First-party (1P) new-customer studies (R20-R26) and their building blocks.

All seven scripts are one pipeline, ``first_party_study``; only the
order-product source (A13) and the optional wide columns differ.

Plan, per customer c, receipt r, date d (order-product grain rows):
  1. stage the rows once, bucketed by (c, r) (K5): one shuffle for all that follows
     on (c, r) or (c, r, d).
  2. one row per (c, r, d): party presence and revenue sums (A13 -> daily grain),
     and the customer span (A8), optionally HAVING first >= first_since (F9).
  3. first-basket flags (W3 + W7 + W8): a row has rank 1 iff d = first date,
     and its running party list over (c, r) with a RANGE frame then holds
     exactly the parties of (c, r) on the first date -- the (c, r, first date)
     row's party presence. So both flags are constant per (c, r, d) row and
     come from a join with the span: no window partitioned by customer, so a
     hot customer never lands in one task.
  4. receipt counts and all revenue statistics (A15, A5, A6, A12): per (c, r)
     then per customer, from the daily rows, after the join with the span by
     customer without a shuffle of their own unless customers are hot; product
     counts (A17): the product rows joined to their receipt's flag inside the
     buckets, per (c, product) then per customer. Customers without a
     contains_1p row are dropped (J5).
  5. join the customer span back and derive type (P12) and averages (P14).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import expressions as X
from marketlens.operators import aggregates as A
from marketlens.operators import filters as Fl
from marketlens.operators import joins as J
from marketlens.operators import windows as W
from marketlens.operators.hotkeys import Hot, hot_join, hot_keys, tasks_for
from marketlens.params import FIRST_SINCE, HOUSE_SELLERS, TRACKED_CATEGORIES, TRACKED_PRODUCTS
from marketlens.sources.publish import materialize, stage_bucketed
from marketlens.sources.tables import Tables

GRAIN = ["customer_id", "receipt_id", "transaction_date", "product_id", "seller_key"]


# ---- order-product sources (A13) per channel -------------------------------------
def channel1_order_products(t: Tables, extra: Sequence[str] = ()) -> DataFrame:
    """Own-site completed product lines at order-product grain."""
    lines = Fl.product_lines(Fl.completed_sales(t.lines))
    df = Fl.own_channel(J.with_receipt(lines, t.bridge, t.receipts))
    df = df.select("customer_id", "receipt_id", F.col("accepted_date").alias("transaction_date"),
                   "product_id", F.col("company_id").alias("seller_key"), "total_amount")
    op = A.order_product_grain(df, GRAIN, "total_amount")
    return _with_product_attrs(t, op, extra, "lines", "product_id")


def channel2_order_products(t: Tables, extra: Sequence[str] = ()) -> DataFrame:
    """Channel-2 order lines: de-duplicated (W1), seller from the catalogue via a string id."""
    c2 = W.dedupe_latest(t.dealt("channel2"), ["order_id", "order_line_id"],
                         [F.desc("order_date"), F.desc("l_shipdate"), F.asc("product_id"),
                          F.asc("l_suppkey"), F.asc("gmv")])
    op = (c2.groupBy(F.col("customer_id"), F.col("order_id").alias("receipt_id"),
                     F.col("order_date").alias("transaction_date"), "product_id", "external_product_id",
                     F.col("l_suppkey").alias("seller_id"))
            .agg(X.money_total("gmv").alias("product_revenue")))
    return _with_product_attrs(t, op, [F.col("company_id").alias("seller_key"), *extra], "channel2", "external_product_id", "string")


def channel3_order_products(t: Tables, extra: Sequence[str] = ()) -> DataFrame:
    """Channel-3 order lines: de-duplicated (W1), seller id cast from text."""
    c3 = W.dedupe_latest(t.dealt("channel3"), ["order_id", "article_id"],
                         [F.desc("order_date"), F.desc("l_shipdate"), F.asc("l_linenumber"),
                          F.asc("l_suppkey"), F.asc("line_total")])
    op = (c3.groupBy(F.col("customer_id"), F.col("order_id").alias("receipt_id"),
                     F.col("order_date").alias("transaction_date"), F.col("article_id").alias("product_id"),
                     F.expr("try_cast(seller_id as int)").alias("seller_key"))
            .agg(X.money_total("line_total").alias("product_revenue")))
    return _with_product_attrs(t, op, extra, "channel3", "product_id", "string")


def _with_product_attrs(t: Tables, op: DataFrame, extra: Sequence[str | Column], view: str, key: str,
                        as_type: str | None = None) -> DataFrame:
    """Attach product attributes after aggregation (they depend on the product only); ``as_type`` casts both ids.

    Rows of more lines than the session's shuffle partitions take are dealt to
    ``line_tasks`` tasks by product, a hot product's to several of them, and
    the products, of which there are more then, are not broadcast.
    """
    if not extra:
        return op
    pid, of = F.col("product_id"), F.col(key)
    prod = t.product.select((pid.cast(as_type) if as_type else pid).alias("__pid"), *extra)
    rows = op.withColumn("__pid", of.cast(as_type) if as_type else of)
    tasks = t.line_tasks(view)
    if tasks > tasks_for(t.spark, 0):
        rows = hot_join(rows, prod, "__pid", "left", ["customer_id", "receipt_id"], t.hot_products(view),
                        null_safe=False, tasks=tasks, hint="merge")
    else:
        rows = rows.join(prod, "__pid", "left")
    return rows.drop("__pid")


def days_of_customers(rows: DataFrame, span: DataFrame, skew_salts: int = 1, hot: Hot | None = None,
                      tasks: int | None = None) -> DataFrame:
    """The daily rows of the customers in ``span``, a hot customer's spread over tasks.

    Hot customers are found with a sketch (unless given) and only they are
    salted, whatever the session's adaptive settings; ``skew_salts`` > 1 salts
    all customers. ``tasks``: how many the rows are dealt to.
    """
    salt_from = [c for c in rows.columns if c.endswith("receipt") or c in ("receipt_id", "transaction_date")]
    if skew_salts > 1:
        return J.salted_join(rows, span, "customer_id", skew_salts, "inner", salt_from)
    return hot_join(rows, span, "customer_id", "inner", salt_from, hot, null_safe=False, tasks=tasks)


# ---- the study --------------------------------------------------------------------
def basket_flags(op: DataFrame, span: DataFrame, house: Sequence[int] = HOUSE_SELLERS) -> DataFrame:
    """W3 + W7 + W8: rows joined to their customer's first date, with the two
    first-basket flags (contains_1p, first_1p_only) as 0/1 integers."""
    rows = op.join(span, "customer_id", "inner")
    first = F.col("transaction_date") == F.col("first_transaction_date")
    h = X.is_house("seller_key", house)
    mix = (rows.filter(first)
               .groupBy("customer_id", "receipt_id")
               .agg(F.max(F.when(h, 1).otherwise(0)).alias("__has1p"),
                    F.max(F.when(h, 0).otherwise(1)).alias("__has3p")))
    m = mix.select(F.col("customer_id").alias("__c"), F.col("receipt_id").alias("__r"), "__has1p", "__has3p")
    j = rows.join(m, (rows.customer_id == m["__c"]) & rows.receipt_id.eqNullSafe(m["__r"]), "left")
    return j.select(*[F.col(c) for c in rows.columns],
                    F.when(first & (F.col("__has1p") == 1), 1).otherwise(0).alias("first_transaction_contains_1p"),
                    F.when(first & (F.col("__has3p") == 0), 1).otherwise(0).alias("first_transaction_1p_only"))


def first_party_study(op: DataFrame, house: Sequence[int] = HOUSE_SELLERS, first_since: dt.date | None = None,
                      wide: Mapping[str, Column] | None = None, fix_rp_3p_aov: bool = False,
                      skew_salts: int = 1, tasks: int | None = None) -> DataFrame:
    """R20-R26 core. ``op`` has GRAIN columns + product_revenue (+ wide inputs).

    ``wide`` maps a column suffix to a predicate; each adds
    cl_product_revenue_<suffix> and rp_product_revenue_<suffix>.
    ``fix_rp_3p_aov`` divides repeat 3P revenue (instead of all repeat
    revenue, as the original does) by repeat transactions. ``skew_salts``: see
    ``days_of_customers``. ``tasks``: how many the rows are dealt to (default: the
    session's shuffle partitions), so that a task's memory doesn't grow with the input.
    """
    # K5, read by daily rows and product rows. A missing receipt is a receipt of its own per customer: two columns
    # stand for the id, so that it can be a bucket's and a join's plain key.
    receipt = ["customer_id", "__no_receipt", "__receipt"]
    tasks = tasks or tasks_for(op.sparkSession, 0)
    op = stage_bucketed(op.withColumns({
        "__no_receipt": F.col("receipt_id").isNull(),
        "__receipt": F.coalesce("receipt_id", F.lit(0).cast(op.schema["receipt_id"].dataType))}), "order_products", receipt, tasks)
    h = X.is_house("seller_key", house)
    rev, pid = F.col("product_revenue").cast("decimal(38,6)"), F.col("product_id")
    wide = dict(wide or {})
    house_row, other_row = F.when(h, 1).otherwise(0), F.when(h, 0).otherwise(1)

    # 1. One row per (customer, receipt, date): party presence and revenue
    #    sums. The first-basket flags are constant within such a group, so
    #    span, flags and every revenue statistic come from these rows. Buckets
    #    by (customer, receipt) hold whole groups: no shuffle.
    parts = {"__rev": F.lit(True), "__rev1p": h, "__rev3p": ~h}
    for suffix, pred in wide.items():
        parts[f"__w_{suffix}"] = pred
    daily = op.groupBy(*receipt, "transaction_date").agg(
        F.max(house_row).alias("__has1p"), F.max(other_row).alias("__has3p"),
        *[F.sum(F.when(pred, rev)).alias(name) for name, pred in parts.items()])
    span = op.groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_transaction_date"), F.max("transaction_date").alias("latest_transaction_date"),
        F.max(F.col("transaction_date").isNull()).alias("__undated"))
    if first_since is not None:
        span = Fl.having(span, F.col("first_transaction_date") >= F.lit(first_since))
    span = materialize(span)  # one row per customer, read by the join and for the result
    # rows without a date sort first, so where there are some they are the first basket
    first = F.when(F.col("__undated"), F.col("transaction_date").isNull()).otherwise(
        F.col("transaction_date") == F.col("first_transaction_date"))
    contains = F.when(first & (F.col("__has1p") == 1), 1).otherwise(0)
    days = days_of_customers(daily, span, skew_salts, tasks=tasks).select(
        "*", contains.alias("first_transaction_contains_1p"),
        F.when(first & (F.col("__has3p") == 0), 1).otherwise(0).alias("first_transaction_1p_only"))
    rp = F.col("first_transaction_contains_1p") != 1
    only = F.col("first_transaction_1p_only") == 1

    # 2. Receipt counts and revenue: per (customer, receipt), then per customer.
    #    Decimal sums on both levels, rounded once, so no order of rows matters.
    sums = {"cl_product_revenue": F.col("__rev"), "cl_1p_product_revenue": F.col("__rev1p"),
            "cl_3p_product_revenue": F.col("__rev3p"),
            "cl_1p_product_revenue_1p_only": F.when(only, F.col("__rev1p")),
            "rp_product_revenue": F.when(rp, F.col("__rev")), "rp_1p_product_revenue": F.when(rp, F.col("__rev1p")),
            "rp_3p_product_revenue": F.when(rp, F.col("__rev3p"))}
    for suffix in wide:
        sums[f"cl_product_revenue_{suffix}"] = F.col(f"__w_{suffix}")
        sums[f"rp_product_revenue_{suffix}"] = F.when(rp, F.col(f"__w_{suffix}"))
    per_receipt = days.groupBy(*receipt).agg(
        F.max(F.col("first_transaction_contains_1p")).alias("__c1p"),
        F.max(F.when(rp, 1).otherwise(0)).alias("__rp"),
        F.max(F.when(only, 1).otherwise(0)).alias("__only"),
        *[F.sum(expr).alias(name) for name, expr in sums.items()])
    has_receipt = ~F.col("__no_receipt")
    by_receipt = per_receipt.groupBy("customer_id").agg(
        F.max("__c1p").alias("__new1p"), F.max("__rp").alias("__has_rp"),
        F.count(F.when(has_receipt, 1)).alias("cl_transactions"),
        F.count(F.when(has_receipt & (F.col("__only") == 1), 1)).alias("cl_transactions_1p_only"),
        F.count(F.when(has_receipt & (F.col("__rp") == 1), 1)).alias("rp_transactions"),
        *[F.round(F.sum(name), 2).cast("double").alias(name) for name in sums])

    # 3. Product counts need each product row's flag: its receipt's flag, if the
    #    row is of the first day. The join by receipt reads the buckets as they
    #    are; then per (customer, product), then per customer. A row without a
    #    product counts nowhere, so it goes no further.
    flags = days.groupBy(*receipt).agg(
        F.max("first_transaction_contains_1p").alias("__contains"), F.first("__undated").alias("__undated"),
        F.first("first_transaction_date").alias("first_transaction_date"))
    rows = op.join(flags, receipt, "inner").withColumn(
        "first_transaction_contains_1p", F.when(first & (F.col("__contains") == 1), 1).otherwise(0))
    marked = rows.where(pid.isNotNull()).select(
        "customer_id", "product_id", F.when(h, 1).otherwise(0).alias("__p1"), F.when(~h, 1).otherwise(0).alias("__p3"),
        F.when(rp & h, 1).otherwise(0).alias("__rp1"), F.when(rp & ~h, 1).otherwise(0).alias("__rp3"))
    flag_names = ("__p1", "__p3", "__rp1", "__rp3")
    per_product = marked.repartition(tasks, "customer_id", "product_id").groupBy("customer_id", "product_id").agg(
        *[F.max(name).alias(name) for name in flag_names])
    by_product = per_product.groupBy("customer_id").agg(
        F.count(pid).alias("cl_unique_products"),
        *[F.count(F.when(F.col(name) == 1, 1)).alias(n) for name, n in zip(flag_names, (
            "cl_1p_unique_products", "cl_3p_unique_products", "rp_1p_unique_products", "rp_3p_unique_products"), strict=True)])
    stats = by_receipt.filter(F.col("__new1p") == 1).join(by_product, "customer_id", "left").fillna(
        0, [c for c in by_product.columns if c != "customer_id"])

    has_rp = F.col("__has_rp") == 1

    def rpc(name):  # repeat-order columns are NULL for customers without repeat rows (LEFT JOIN)
        return F.when(has_rp, F.col(name))

    out = stats.join(span, "customer_id", "left")
    rp_3p_num = "rp_3p_product_revenue" if fix_rp_3p_aov else "rp_product_revenue"
    cols = [
        X.customer_type("first_transaction_date", "latest_transaction_date").alias("customer_type"),
        "customer_id", "first_transaction_date", "latest_transaction_date",
        "cl_transactions", "cl_product_revenue",
        X.safe_ratio("cl_product_revenue", "cl_transactions").alias("cl_aov"),
        "cl_1p_product_revenue", X.safe_ratio("cl_1p_product_revenue", "cl_transactions").alias("cl_1p_aov"),
        "cl_3p_product_revenue", X.safe_ratio("cl_3p_product_revenue", "cl_transactions").alias("cl_3p_aov"),
        "cl_transactions_1p_only", "cl_1p_product_revenue_1p_only",
        "cl_1p_unique_products", "cl_3p_unique_products",
        rpc("rp_transactions").alias("rp_transactions"),
        rpc("rp_product_revenue").alias("rp_product_revenue"),
        X.safe_ratio(rpc("rp_product_revenue"), rpc("rp_transactions")).alias("rp_aov"),
        rpc("rp_1p_product_revenue").alias("rp_1p_product_revenue"),
        X.safe_ratio(rpc("rp_1p_product_revenue"), rpc("rp_transactions")).alias("rp_1p_aov"),
        rpc("rp_3p_product_revenue").alias("rp_3p_product_revenue"),
        X.safe_ratio(rpc(rp_3p_num), rpc("rp_transactions")).alias("rp_3p_aov"),
        rpc("rp_1p_unique_products").alias("rp_1p_unique_products"),
        rpc("rp_3p_unique_products").alias("rp_3p_unique_products"),
    ]
    cols += [f"cl_product_revenue_{s}" for s in wide]
    cols += [rpc(f"rp_product_revenue_{s}").alias(f"rp_product_revenue_{s}") for s in wide]
    return out.select(*cols)


def category_columns(level_col: str = "level1", categories: Sequence[str] = TRACKED_CATEGORIES) -> dict[str, Column]:
    """A12 predicates: lower(level1) = category."""
    return {c.lower(): Fl.ieq(level_col, c) for c in categories}


def product_columns(products: Sequence[int] = TRACKED_PRODUCTS) -> dict[str, Column]:
    """A12 predicates: product_id = p."""
    return {f"p{p}": F.col("product_id") == F.lit(p) for p in products}


# ---- reports -----------------------------------------------------------------------
def study_channel1(t: Tables, first_since: dt.date | None = FIRST_SINCE) -> DataFrame:
    """1P study, own site, customers first buying on/after ``first_since``."""
    return first_party_study(channel1_order_products(t), first_since=first_since, tasks=t.line_tasks("lines"))


def study_channel2(t: Tables) -> DataFrame:
    """1P study, channel 2 (no first-purchase cut)."""
    return first_party_study(channel2_order_products(t), tasks=t.line_tasks("channel2"))


def study_channel3(t: Tables) -> DataFrame:
    """1P study, channel 3 (no first-purchase cut)."""
    return first_party_study(channel3_order_products(t), tasks=t.line_tasks("channel3"))


def category_study_channel1(t: Tables, first_since: dt.date | None = FIRST_SINCE) -> DataFrame:
    """R20 + revenue per tracked category for all and repeat orders."""
    return first_party_study(channel1_order_products(t, ["level1"]), first_since=first_since,
                             wide=category_columns(), tasks=t.line_tasks("lines"))


def category_study_channel3(t: Tables) -> DataFrame:
    """R22 + category columns (category via a string product id)."""
    return first_party_study(channel3_order_products(t, ["level1"]), wide=category_columns(), tasks=t.line_tasks("channel3"))


def category_study_channel2(t: Tables) -> DataFrame:
    """R21 + category columns."""
    return first_party_study(channel2_order_products(t, ["level1"]), wide=category_columns(), tasks=t.line_tasks("channel2"))


def product_study_channel1(t: Tables, first_since: dt.date | None = FIRST_SINCE) -> DataFrame:
    """R20 + revenue per tracked product for all and repeat orders."""
    return first_party_study(channel1_order_products(t), first_since=first_since, wide=product_columns(), tasks=t.line_tasks("lines"))


def top_products_by_brand(t: Tables, first_since: dt.date | None = FIRST_SINCE, k: int = 10) -> DataFrame:
    """Best-selling product of each brand among first-basket-1P rows, top ``k`` by revenue."""
    op = materialize(channel1_order_products(t, ["brand", "product_name"]))
    span = A.customer_span(op, "customer_id", "transaction_date")
    if first_since is not None:
        span = Fl.having(span, F.col("first_transaction_date") >= F.lit(first_since))
    rows = basket_flags(op, span).filter(F.col("first_transaction_contains_1p") == 1)
    per = rows.groupBy("brand", "product_id", "product_name").agg(X.money_sum("product_revenue").alias("pr"))
    return W.top_per_group(per, "brand", "pr", ["product_id"], k)


def running_basket_totals(t: Tables, first_since: dt.date | None = FIRST_SINCE) -> DataFrame:
    """W3 + W6 + W7 + W8: the per-row customer base of the channel-1 study.

    Running totals per receipt and per customer (RANGE frame), dense rank of
    the date, the running party mix of the receipt (as 1P / 3P containment)
    and the first-basket flags derived from rank and mix, as the original
    defines them. The studies compute the same flags with aggregates
    (``basket_flags``); this query checks that shortcut.
    """
    op = materialize(channel1_order_products(t))
    span = A.customer_span(op, "customer_id", "transaction_date")
    if first_since is not None:
        span = Fl.having(span, F.col("first_transaction_date") >= F.lit(first_since))
    op = J.semi(op, span, "customer_id")
    h = X.is_house("seller_key")
    rev = F.col("product_revenue")
    op = materialize(op)
    by_receipt, by_customer = ["customer_id", "receipt_id"], ["customer_id"]
    per_receipt = W.running(op, by_receipt, "transaction_date", {
        "transaction_revenue": ("sum", rev),
        "transaction_products": ("count", F.col("product_id")),
        "transaction_1p_products": ("count", F.when(h, F.col("product_id"))),
        "transaction_3p_products": ("count", F.when(~h, F.col("product_id"))),
        "transaction_revenue_1p_products": ("sum", F.when(h, rev)),
        "transaction_revenue_3p_products": ("sum", F.when(~h, rev)),
        **W.mix_flags(h),
    }, hot_keys(op, by_receipt))
    ranked = W.running(per_receipt, by_customer, "transaction_date", {
        "customer_lifetime_revenue": ("sum", rev),
        "customer_lifetime_transactions": ("count", F.col("receipt_id")),
    }, hot_keys(op, by_customer), rank="transaction_rank")
    first = F.col("transaction_rank") == 1
    return ranked.select(*GRAIN, "transaction_rank",
                         F.round("transaction_revenue", 2).cast("double").alias("transaction_revenue"),
                         "transaction_products", "transaction_1p_products", "transaction_3p_products",
                         F.round("transaction_revenue_1p_products", 2).cast("double").alias("transaction_revenue_1p_products"),
                         F.round("transaction_revenue_3p_products", 2).cast("double").alias("transaction_revenue_3p_products"),
                         F.round("customer_lifetime_revenue", 2).cast("double").alias("customer_lifetime_revenue"),
                         "customer_lifetime_transactions", "mix_has_1p", "mix_has_3p",
                         F.when(first & (F.col("mix_has_1p") == 1), 1).otherwise(0)
                          .alias("first_transaction_contains_1p"),
                         F.when(first & (F.col("mix_has_3p") == 0), 1).otherwise(0)
                          .alias("first_transaction_1p_only"))
