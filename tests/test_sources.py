"""K1 on named tables, K2 versions, K4 and K5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.plans import finance, merch
from marketlens.session import scratch_path
from marketlens.sources.literal import latest_snapshot, newest_plan, newest_value
from marketlens.sources.publish import publish_version, read_published, stage_bucketed
from marketlens.sources.warehouse import CANONICAL, Binding, WarehouseTables, flag
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def warehouse(spark, tables_small):
    """Every view written as a table of its own: flags as INT, BOOL or text, some columns under other names."""
    bindings = {}
    for i, view in enumerate(CANONICAL):
        df = getattr(tables_small, view)
        names = {}
        for f in df.schema.fields:
            if isinstance(f.dataType, T.BooleanType):
                as_int, as_text = F.col(f.name).cast("int"), F.when(F.col(f.name), "Yes").otherwise("no")
                df = df.withColumn(f.name, (as_int, F.col(f.name), as_text)[i % 3])
            if f.name in ("customer_id", "accepted_date", "channel"):
                names[f.name] = f"x_{f.name}"
                df = df.withColumnRenamed(f.name, names[f.name])
        path = scratch_path(spark, f"wh-{view}")
        df.withColumn("unused", F.lit("x")).write.parquet(path)
        bindings[view] = Binding(path, names)
    return bindings


def test_views_are_those_of_the_fixture(spark, tables_small, warehouse):
    t = WarehouseTables(spark, warehouse)
    for view, schema in CANONICAL.items():
        want = getattr(tables_small, view)
        assert getattr(t, view).dtypes == [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(schema).fields]
        assert set(getattr(t, view).columns) == set(want.columns)
        assert getattr(t, view).count() == want.count()


@pytest.mark.parametrize("kpi", [finance.active_customers, finance.units_shipped, finance.unique_products, finance.seller_ledger,
                                 finance.web_app_aov])
def test_reports_on_named_tables_equal_the_fixture(spark, tables_small, warehouse, kpi):
    assert rows(kpi(WarehouseTables(spark, warehouse))) == rows(kpi(tables_small))


def test_masters_on_named_tables(spark, tables_small, warehouse):
    assert rows(merch.catalogue_master_b(WarehouseTables(spark, warehouse))) == rows(merch.catalogue_master_b(tables_small))


def test_window_reaches_the_scan_of_a_named_table(spark, warehouse):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = finance.units_shipped(WarehouseTables(spark, warehouse))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(x_accepted_date" in plan and "unused" not in plan


def test_flags_of_every_type(spark):
    df = spark.createDataFrame([(True, 1, "Yes", 1.0), (False, 0, "0", 0.0), (None, None, "maybe", None)], "b boolean, i int, s string, d double")
    got = df.select(*[flag(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]).collect()
    assert [tuple(r) for r in got] == [(True,) * 4, (False,) * 4, (None,) * 4]
    with pytest.raises(TypeError):
        flag(F.col("x"), T.DateType())


def test_a_wrong_binding_says_what_is_missing(spark, warehouse):
    with pytest.raises(KeyError, match="bridge"):
        finance.active_customers(WarehouseTables(spark, {"lines": warehouse["lines"]}))
    with pytest.raises(KeyError, match="receipt_id"):
        WarehouseTables(spark, {"bridge": Binding(warehouse["lines"].source)}).bridge
    with pytest.raises(KeyError, match="nonsense"):
        WarehouseTables(spark, {"nonsense": Binding("x")})
    derived = Binding(warehouse["lines"].source, derived={"receipt_id": "line_id + 1"})
    assert WarehouseTables(spark, {"bridge": derived}).bridge.where("receipt_id = line_id + 1").count() > 0


# ---- K2 -----------------------------------------------------------------------------
def days(spark, first, n, value):
    return spark.range(n).select(F.lit(dt.date(1996, 7, first)).alias("run"), F.col("id").alias("product_id"), F.lit(value).alias("v"))


def test_versions_replace_the_table_or_their_dates(spark):
    path = scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path, "run")
    assert publish_version(days(spark, 1, 5, "a").union(days(spark, 2, 5, "a")), path, "run", "product_id") == 1
    assert publish_version(days(spark, 2, 3, "b"), path, "run", "product_id", replace="dates") == 2
    assert publish_version(days(spark, 3, 2, "c"), path, "run", "product_id", replace="dates") == 3
    got = read_published(spark, path, "run").groupBy("run", "v").count()
    assert rows(got) == [(dt.date(1996, 7, 1), "a", 5), (dt.date(1996, 7, 2), "b", 3), (dt.date(1996, 7, 3), "c", 2)]
    before = read_published(spark, path, "run")
    assert publish_version(days(spark, 4, 1, "d"), path, "run", "product_id") == 4
    assert rows(read_published(spark, path, "run").select("v")) == [("d",)]
    assert before.count() == 10  # a reader that has begun keeps its version
    publish_version(days(spark, 4, 0, "e"), path, "run", "product_id")
    assert read_published(spark, path, "run").count() == 0


def test_a_failed_write_is_never_seen(spark):
    path = scratch_path(spark, "failing")
    publish_version(days(spark, 1, 100, "old"), path, "run", "product_id")
    bad = days(spark, 1, 100, "new").withColumn("v", F.when(F.col("product_id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        publish_version(bad, path, "run", "product_id")
    assert rows(read_published(spark, path, "run").groupBy("v").count()) == [("old", 100)]
    publish_version(days(spark, 1, 7, "new"), path, "run", "product_id")
    assert rows(read_published(spark, path, "run").groupBy("v").count()) == [("new", 7)]


def test_reads_during_a_write_see_one_version(spark):
    """While a version is being written, and until its manifest is there, readers get the version before."""
    import threading
    path = scratch_path(spark, "busy")
    publish_version(days(spark, 1, 50, "old"), path, "run", "product_id")
    seen, done = [], threading.Event()

    def reader():
        while not done.is_set():
            seen.append(rows(read_published(spark, path, "run").groupBy("v").count()))

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        publish_version(days(spark, 1, 80, "new"), path, "run", "product_id")
    finally:
        done.set()
        thread.join()
    assert seen and all(s in ([("old", 50)], [("new", 80)]) for s in seen)


# ---- K4, K5 -------------------------------------------------------------------------
def test_newest_value_comes_from_footers(spark):
    path = scratch_path(spark, "footers")
    spark.range(1000).select(F.expr("date_add(date'1996-01-01', int(id % 50))").alias("d"), "id").repartition(4).write.parquet(path)
    assert newest_value(spark, path, "d") == dt.date(1996, 2, 19)
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    assert "PushedAggregation: [MAX(d)]" in newest_plan(other, path, "d")._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_latest_snapshot_is_one_pruned_scan(spark):
    path = scratch_path(spark, "snapshots")
    spark.range(300).select(F.expr("date_add(date'1996-01-01', int(id % 30))").alias("d"), "id").write.partitionBy("d").parquet(path)
    df = spark.read.parquet(path)
    for newest in (None, newest_value(spark, path, "d")):
        out = latest_snapshot(df, "d", newest)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(d" in plan and "Join" not in plan
        assert out.count() == 10 and len(out.inputFiles()) <= len(df.inputFiles())
    assert latest_snapshot(df.where("id < 0"), "d").count() == 0


def test_bucketed_stage_is_grouped_without_a_shuffle(spark):
    df = spark.range(2000).select((F.col("id") % 40).alias("c"), (F.col("id") % 7).alias("r"), "id")
    staged = stage_bucketed(df, "rows_by_c_r", ["c", "r"], 6)
    plan = staged.groupBy("c", "r", "id").count().groupBy("c", "r").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows(spark.table("rows_by_c_r")) == rows(df)


def test_studies_shuffle_three_times(spark):
    """R20-R26 read one staged relation; 11 shuffles before."""
    from marketlens.registry import queries
    for name in ("r20_study_channel1", "r24_category_study_channel3"):
        plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 5, plan
