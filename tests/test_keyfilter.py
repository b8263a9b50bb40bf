"""Run-time key filters in front of J1 and J10."""

import pytest
from pyspark.sql import functions as F

from marketlens.operators import joins as J
from marketlens.operators import keyfilter as K
from marketlens.registry import oracle_sql, queries
from tests.conftest import SF_MID
from tests.oracle_compare import compare, duck


@pytest.fixture
def filters_on(spark):
    spark.conf.set("spark.marketlens.keyFilter", "on")
    yield
    spark.conf.unset("spark.marketlens.keyFilter")


def test_a_filter_keeps_its_keys_and_few_others(spark):
    keys = spark.range(0, 300_000, 7).selectExpr("id k", "if(id % 2 = 0, null, id) v")
    big = spark.range(300_000).selectExpr("id k", "if(id % 2 = 0, null, id) v")
    kept = K.build(keys, ["k", "v"], 43_000).keep(big, ["k", "v"])
    assert kept.join(keys, "k").count() == 42_858
    assert kept.count() < 42_858 + 0.03 * 300_000
    assert K.build(keys.where("k < 0"), ["k", "v"], 1).keep(big, ["k", "v"]).count() == 0


def test_too_many_keys_and_few_files_go_without(spark):
    df = spark.range(10)
    assert K.build(df, ["id"], K.MOST_BITS) is None
    assert not K.wanted(df)
    spark.conf.set("spark.marketlens.keyFilter", "perhaps")
    try:
        with pytest.raises(ValueError):
            K.wanted(df)
    finally:
        spark.conf.unset("spark.marketlens.keyFilter")


def test_receipts_outside_the_window_are_not_shuffled(spark, filters_on):
    lines = spark.range(200).select(F.col("id").alias("line_id"), (F.col("id") * 2).alias("amount"))
    bridge = spark.range(50_000).select(F.col("id").alias("line_id"), (F.col("id") + 7).alias("receipt_id"))
    read = []
    receipts = spark.range(60_000).select(F.col("id").alias("receipt_id"), F.when(F.col("id") % 2 == 0, "web").alias("channel"))
    real = K.KeyFilter.keep

    def spy(self, df, cols):
        out = real(self, df, cols)
        read.append((df.count(), out.count()))
        return out

    K.KeyFilter.keep = spy
    try:
        out = J.with_receipt(lines, bridge, receipts)
    finally:
        K.KeyFilter.keep = real
    assert [b for b, _ in read] == [50_000, 60_000] and read[0][1] < 2_500 and read[1][1] < 2_500
    want = lines.join(bridge, "line_id", "left").join(receipts, "receipt_id", "left")
    assert sorted(map(tuple, out.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_lookback_is_one_join(spark):
    base = spark.createDataFrame([(1, "2024-01-20", 5, None), (2, "2024-01-20", 5, 1), (2, "2024-01-20", 5, 1), (3, None, 5, 1)],
                                 "e long, d string, p long, v long").withColumn("d", F.col("d").cast("date"))
    snap = spark.createDataFrame([("2024-01-13", "5", None, 1.0), ("2024-01-17", "5", 1, 2.0), ("2024-01-06", "5", 1, 3.0)],
                                 "day string, k string, v long, price double").withColumn("day", F.col("day").cast("date"))
    for setting in ("off", "on"):
        spark.conf.set("spark.marketlens.keyFilter", setting)
        try:
            out = J.lookback(base, snap, "d", (14, 7, 3), "p", "v", "day", "k", "v", "price", key_cast="string")
        finally:
            spark.conf.unset("spark.marketlens.keyFilter")
        got = sorted(((r.e, r.value_lb14, r.value_lb7, r.value_lb3) for r in out.collect()), key=repr)
        assert got == [(1, None, 1.0, None), (2, 3.0, None, 2.0), (2, 3.0, None, 2.0), (3, None, None, None)]
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftOuter") == 1


@pytest.mark.parametrize("name", ["j10_lookback", "r19_promo_compliance", "r02_active_customers", "r03_active_this_vs_last",
                                  "r12_unique_companies"])
def test_filtered_queries_equal_their_oracles(spark, filters_on, name):
    ok, info = compare(queries()[name](spark, SF_MID), duck(SF_MID), oracle_sql()[name])
    assert ok, info
