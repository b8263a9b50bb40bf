"""What one task holds doesn't grow with the input: tasks are as many as the rows need, and large relations aren't broadcast."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marketlens.operators import hotkeys
from marketlens.plans import cohort
from marketlens.sources.tables import Tables

LINES = 3000


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Lines of 1,000 orders of 90 customers; one line in ten is there twice."""
    d = str(tmp_path_factory.mktemp("shop"))
    i = F.col("id")
    day = F.date_add(F.lit(dt.date(1996, 1, 1)), (i % 170).cast("int")).cast("timestamp")
    lines = spark.range(LINES).select(
        (i % 1000 * 7).alias("l_orderkey"), (i % 83 + 1).alias("l_partkey"), (i % 10).alias("l_suppkey"),
        F.floor(i / 1000).cast("int").alias("l_linenumber"), F.lit(2.0).alias("l_quantity"),
        (i % 97 + 1).cast("double").alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), day.alias("l_shipdate"))
    lines.unionByName(lines.where("l_partkey % 10 = 1")).write.parquet(f"{d}/lineitem.parquet")
    spark.range(1000).select(
        (i * 7).alias("o_orderkey"), (i % 90).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{d}/orders.parquet")
    spark.range(1, 84).select(
        i.alias("p_partkey"), F.concat(F.lit("part "), i).alias("p_name"), F.concat(F.lit("Brand#"), i % 5).alias("p_brand"),
        F.when(i % 2 == 0, "ECONOMY").otherwise("PROMO").alias("p_type"), (i % 50).cast("int").alias("p_size"),
        i.cast("double").alias("p_retailprice")).write.parquet(f"{d}/part.parquet")
    spark.range(10).select(
        i.alias("s_suppkey"), F.concat(F.lit("seller "), i).alias("s_name"), F.lit(1).alias("s_nationkey"),
        F.lit(1.0).alias("s_acctbal")).write.parquet(f"{d}/supplier.parquet")
    return d


def staged_tasks(spark, monkeypatch, shop, source, study, rows_each):
    """The order-product rows' partitions, the staged table's buckets and the study's rows, if a task takes ``rows_each`` lines."""
    monkeypatch.setattr(hotkeys, "TASK_ROWS", rows_each)
    op = source(Tables(spark, shop), ["level1"])
    dealt = op.groupBy(F.spark_partition_id().alias("p")).count().count()
    out = sorted(map(tuple, study(Tables(spark, shop)).collect()))
    return dealt, len(spark.table("order_products").inputFiles()), out


@pytest.mark.parametrize("source, study", [(cohort.channel2_order_products, cohort.category_study_channel2),
                                           (cohort.channel3_order_products, cohort.category_study_channel3)])
def test_study_tasks_grow_with_the_lines(spark, monkeypatch, shop, source, study):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    _, few_buckets, whole = staged_tasks(spark, monkeypatch, shop, source, study, 1 << 30)
    dealt, buckets, out = staged_tasks(spark, monkeypatch, shop, source, study, 100)
    assert few_buckets <= 4 and dealt >= 30 and buckets >= 30
    assert out == whole and len(out) > 0


def test_customer_without_products_keeps_a_row(spark):
    rows = spark.createDataFrame([
        (1, 10, dt.date(1996, 1, 1), None, 1, 5.0), (1, 11, dt.date(1996, 1, 2), None, 7, 6.0),
        (2, 12, dt.date(1996, 1, 1), 3, 1, 7.0), (2, 13, dt.date(1996, 1, 3), 3, 7, 8.0), (2, 13, dt.date(1996, 1, 3), None, 7, 8.0)],
        "customer_id long, receipt_id long, transaction_date date, product_id long, seller_key int, product_revenue double")
    out = {r.customer_id: r for r in cohort.first_party_study(rows).collect()}
    assert (out[1].cl_1p_unique_products, out[1].cl_3p_unique_products, out[1].rp_3p_unique_products) == (0, 0, 0)
    assert (out[2].cl_1p_unique_products, out[2].cl_3p_unique_products, out[2].rp_3p_unique_products) == (1, 1, 1)


def test_named_tables_are_dealt_too(spark, monkeypatch, shop, tmp_path):
    from marketlens.sources.warehouse import Binding, WarehouseTables
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 100)
    plain = Tables(spark, shop)
    bindings = {}
    for view in ("channel2", "channel3", "product"):
        getattr(plain, view).write.parquet(f"{tmp_path}/{view}")
        bindings[view] = Binding(f"{tmp_path}/{view}")
    named = WarehouseTables(spark, bindings)
    for study in (cohort.study_channel2, cohort.study_channel3):
        assert sorted(map(tuple, study(named).collect())) == sorted(map(tuple, study(plain).collect()))
        assert len(spark.table("order_products").inputFiles()) >= 30


def test_snapshot_of_exploded_rows_is_not_broadcast(spark):
    """Made by exploding a few rows, so its estimate is far below its size."""
    from marketlens.operators.joins import lookback
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 1 << 20
    day = dt.date(1996, 1, 1)
    snap = spark.range(20).select("id", (F.col("id") % 3).alias("v"), F.explode(F.sequence(F.lit(0), F.lit(40))).alias("k")).select(
        "id", "v", F.date_add(F.lit(day), F.col("k")).alias("d"), F.col("k").alias("price"))
    base = spark.range(30).select(F.col("id").alias("p"), (F.col("id") % 3).alias("pv"), F.lit(dt.date(1996, 1, 20)).alias("at"))
    out = lookback(base, snap, "at", (14, 3), "p", "pv", "d", "id", "v", "price")
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert sorted((r.p, r.value_lb14, r.value_lb3) for r in rows) == [(p, 5, 16) if p < 20 else (p, None, None) for p in range(30)]


def test_catalogue_broadcasts_nothing_of_a_row_per_product(spark, shop):
    from marketlens.plans.merch import catalogue, subscription_status
    t = Tables(spark, shop)
    out = catalogue(t, subscription_status(t, "partner_a"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [product_id" not in plan and "BroadcastHashJoin [item_id" not in plan


def test_daily_prices_are_dealt_out_before_they_are_added_up(spark, shop):
    from marketlens.plans.merch import daily_listed_price
    plan = daily_listed_price(Tables(spark, shop))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    added = [i for i, line in enumerate(lines) if "Aggregate" in line]
    dealt = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and dealt[0] > max(added)  # printed top-down


@pytest.mark.parametrize("source, view, key", [
    (cohort.channel1_order_products, "lines", "product_id"), (cohort.channel2_order_products, "channel2", "external_product_id"),
    (cohort.channel3_order_products, "channel3", "product_id")])
def test_product_join_is_dealt_by_the_lines(spark, monkeypatch, shop, source, view, key):
    """Not to the session's shuffle partitions, and a hot product's rows not to one task."""
    t = Tables(spark, shop)
    whole = sorted(map(repr, source(t, ["level1"]).collect()))
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 100)
    assert not t.hot_products(view).rows
    spark.conf.set("spark.marketlens.hotRows", "60")
    try:
        t = Tables(spark, shop)
        assert len(t.hot_products(view).rows) > 0
        salted = source(t, ["level1"])
    finally:
        spark.conf.unset("spark.marketlens.hotRows")
    for op in (source(Tables(spark, shop), ["level1"]), salted):
        assert sorted(map(repr, op.collect())) == whole and len(whole) > 0
        plan = op._jdf.queryExecution().executedPlan().toString()
        dealt = [int(n) for n in re.findall(r"hashpartitioning\(__pid#\d+L?(?:, __salt#\d+L?)?, (\d+)\)", plan)]
        assert dealt and min(dealt) >= 30 and "LeftOuter" in plan
        assert not re.search(r"BroadcastHashJoin \[__pid", plan)
    assert "__salt" in plan
