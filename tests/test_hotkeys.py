"""Hot keys: the window operators equal the plain windows, and no task gets a hot key's rows alone."""

import contextlib
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators import windows as W
from marketlens.operators.hotkeys import hot_join, hot_keys
from marketlens.plans import cohort
from marketlens.registry import oracle_sql, queries
from tests.conftest import SF_MID
from tests.oracle_compare import compare, duck

TASKS = 16


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {f"spark.{k.replace('_', '.')}": str(v) for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_tasks(spark, rows=1000):
    return conf(spark, marketlens_hotRows=rows, sql_shuffle_partitions=TASKS, sql_adaptive_enabled="false",
                sql_autoBroadcastJoinThreshold=-1)


def task_rows(df):
    """Rows per task, with all columns computed."""
    whole = df.select(F.spark_partition_id().alias("p"), F.hash(*df.columns).alias("h"))
    return sorted((r["n"] for r in whole.groupBy("p").agg(F.count("h").alias("n"), F.max("h")).collect()), reverse=True)


def history(spark, n=20_000):
    """One product and variant with 70 % of the rows, all within one hour and half of those at one instant; nulls in keys and values."""
    i = F.col("id")
    ts = F.when(i % 5 < 2, F.lit("1996-03-01 10:30:00").cast("timestamp")).otherwise(
        F.expr("timestamp_micros(825676200000000 + (id * 7919 % 3600) * 1000000)"))
    return spark.range(n).select(
        i.alias("event_id"), F.when(i % 5 < 4, F.lit(1)).otherwise(i % 97).alias("product_id"),
        F.when(i % 10 < 8, F.lit(None).cast("long")).otherwise(i % 3).alias("variant_id"), ts.alias("ts"),
        F.when(i % 11 == 0, F.lit(None).cast("double")).otherwise((i % 7).cast("double")).alias("price")).repartition(8)


def test_sketch_finds_hot_keys(spark):
    df = history(spark)
    with small_tasks(spark):
        hot = hot_keys(df, ["product_id", "variant_id"])
        real = df.where("product_id = 1 and variant_id is null").count()
    assert list(hot.rows.values()) == [real] and list(hot.pieces().values()) == [-(-real // 1000)] and real > 14_000
    with small_tasks(spark, 100_000):
        assert not hot_keys(df, ["product_id"]).rows
    empty = df.where("event_id < 0")
    assert not hot_keys(empty, ["product_id"]).rows


def test_previous_of_a_hot_product_hour(spark):
    df = history(spark)
    w = Window.partitionBy("product_id", "variant_id").orderBy("ts", "event_id")
    want = {r[0]: r[1:] for r in df.select("event_id", F.lag("price").over(w), F.lag("ts").over(w)).collect()}
    with small_tasks(spark):
        out = W.with_previous(df, ["product_id", "variant_id"], "ts", ["event_id"], {"price": "p", "ts": "t"})
        got = {r[0]: r[1:] for r in out.select("event_id", "p", "t").collect()}
        sizes = task_rows(out)
    assert got == want
    assert sizes[0] < 4_000 and len(sizes) == TASKS  # plain: 14,000 in one task


def test_without_hot_keys_there_is_one_shuffle_and_no_join(spark):
    df = history(spark, 2_000)
    for out in (W.with_previous(df, ["product_id", "variant_id"], "ts", ["event_id"], {"price": "p"}),
                W.first_by(df, ["product_id", "variant_id"], "price", ["ts", "event_id"], "f"),
                W.running_totals(df, ["product_id"], "ts", {"s": ("sum", F.col("price"))}),
                W.with_transaction_rank(df, ["product_id"], "ts")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def baskets(spark, n=20_000):
    """A customer with 80 % of the rows, half of them on one day, some on none."""
    i = F.col("id")
    day = F.when(i % 5 < 2, F.lit("1996-02-02").cast("date")).when(i % 50 == 4, F.lit(None).cast("date")).otherwise(
        F.expr("date_add(date'1996-01-01', int(id * 31 % 90))"))
    return spark.range(n).select(
        i.alias("row"), F.when(i % 5 < 4, F.lit(1)).otherwise(i % 200).alias("c"), day.alias("d"),
        (i % 13 * 0.01).alias("x"), F.when(i % 3 == 0, i).alias("y"), (i * 7919 % 1001).alias("z")).repartition(8)


@pytest.mark.parametrize("rank", [None, "r"])
def test_running_totals_of_a_hot_customer(spark, rank):
    df = baskets(spark)
    w = Window.partitionBy("c").orderBy("d")
    frame = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = {r[0]: r[1:] for r in df.select(
        "row", F.sum(F.col("x").cast("decimal(20,2)")).over(frame).cast("double"), F.count("y").over(frame), F.max("z").over(frame),
        *([F.dense_rank().over(w).cast("long")] if rank else [])).collect()}
    with small_tasks(spark):
        out = W.running(df, ["c"], "d", {"s": ("sum", F.col("x")), "n": ("count", F.col("y")), "m": ("max", F.col("z"))}, rank=rank)
        got = {r[0]: r[1:] for r in out.select("row", "s", "n", "m", *([rank] if rank else [])).collect()}
        sizes = task_rows(out)
    assert set(out.columns) == {*df.columns, "s", "n", "m", *([rank] if rank else [])}
    assert got == want
    assert sizes[0] < 5_000 and sum(sizes) == 20_000  # plain: 16,000 in one task


def test_sums_do_not_depend_on_partitions(spark):
    df = baskets(spark, 3_000).withColumn("x", F.col("x") * 1.005)
    got = [sorted(map(tuple, W.running_totals(df.repartition(n), ["c"], "d", {"s": ("sum", F.col("x"))}).select("row", "s").collect()))
           for n in (1, 16)]
    assert got[0] == got[1]


def test_first_value_of_a_hot_key(spark):
    df = history(spark)
    w = Window.partitionBy("product_id", "variant_id").orderBy("ts", "event_id")
    want = {r[0]: r[1] for r in df.select("event_id", F.first("price").over(w)).collect()}
    with small_tasks(spark):
        out = W.first_by(df, ["product_id", "variant_id"], "price", ["ts", "event_id"], "f")
        got = {r[0]: r[1] for r in out.select("event_id", "f").collect()}
        sizes = task_rows(out)
    assert got == want and out.columns == [*df.columns, "f"]
    assert sizes[0] < 5_000 and len(sizes) == TASKS


def test_hot_join_equals_plain_join(spark):
    rnd = random.Random(4)
    big = spark.createDataFrame([(1 if rnd.random() < 0.8 else rnd.randrange(50), None if i % 7 else i % 3, i) for i in range(5000)], "k long, v long, i long")
    small = spark.createDataFrame([(k, v, k * 10 + (v or 0)) for k in range(0, 50, 2) for v in (None, 0, 1)] + [(1, None, 5)], "k long, v long, w long")
    cond = (big.k == small.k) & big.v.eqNullSafe(small.v)
    for how in ("inner", "left"):
        want = sorted(map(tuple, big.join(small, cond, how).select("i", "w").collect()), key=repr)
        with small_tasks(spark, 200):
            got = hot_join(big, small, ["k", "v"], how)
            assert sorted(map(tuple, got.select("i", "w").collect()), key=repr) == want
            assert task_rows(got)[0] < 1500


def test_hot_customer_study_is_split_without_adaptive_execution(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 5 < 4, F.lit(1)).otherwise(F.col("id")).cast("bigint").alias("customer_id"),
        F.col("id").alias("receipt_id"), F.expr("date_add(date'1996-01-01', int(id % 90))").alias("transaction_date"))
    span = rows.groupBy("customer_id").agg(F.min("transaction_date").alias("first_transaction_date"))
    with small_tasks(spark, 2000):
        sizes = task_rows(cohort.days_of_customers(rows, span))
    assert sum(sizes) == 60_000 and sizes[0] < 3 * 60_000 / TASKS  # plain: 48,000 in one task


@pytest.mark.parametrize("name", ["w04_previous_price", "w05_first_by", "w06_running_totals", "r20_study_channel1"])
def test_queries_with_hot_keys_equal_their_oracles(spark, name):
    with conf(spark, marketlens_hotRows=12):
        ok, info = compare(queries()[name](spark, SF_MID), duck(SF_MID), oracle_sql()[name])
    assert ok, info
