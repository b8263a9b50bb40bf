"""K2 publish: partitioned, clustered write and read-back."""

import os

from marketlens.plans import merch
from marketlens.session import scratch_path
from marketlens.sources.publish import publish


def test_publish_roundtrip(spark, tables_small):
    df = merch.catalogue_master_b(tables_small)
    path = scratch_path(spark, "sink-test")
    publish(df, path, "report_run_date", "product_id")
    local = path.removeprefix("file:")
    assert os.path.isdir(os.path.join(local, "report_run_date=1996-07-15"))
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    cols = df.columns
    assert sorted(map(tuple, back.select(*cols).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    # publishing again replaces the whole table; one date's rows only where that is asked for
    from pyspark.sql import functions as F
    setting = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    days = [df.withColumn("report_run_date", F.lit(d).cast("date")) for d in ("1996-07-16", "1996-07-17")]
    publish(days[0], path, "report_run_date", "product_id")
    assert [str(r[0]) for r in spark.read.parquet(path).select("report_run_date").distinct().collect()] == ["1996-07-16"]
    publish(days[1], path, "report_run_date", "product_id", replace="dates")
    publish(days[1], path, "report_run_date", "product_id", replace="dates")
    assert spark.read.parquet(path).count() == 2 * df.count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == setting


def test_no_private_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from marketlens.session import ensure_checkpoint_dir, is_local
    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[3,2,1024]") and not is_local("yarn")
    context = SimpleNamespace(master="yarn", applicationId="x", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_bucketed_publish_joins_without_shuffle(spark, tables_small):
    from pyspark.sql import functions as F

    from marketlens.sources.publish import publish_table
    df = merch.catalogue_master_b(tables_small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = publish_table(df, "cat_b_bucketed_a", scratch_path(spark, "bucketed-a"), "report_run_date",
                          "product_id", 8)
        b = publish_table(df.select("report_run_date", "product_id", F.col("chan_gmv_l4w").alias("g")),
                          "cat_b_bucketed_b", scratch_path(spark, "bucketed-b"), "report_run_date", "product_id", 8)
        assert a.count() == df.count()
        j = a.join(b.select("product_id", "g"), "product_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        assert j.count() == df.join(df.select("product_id"), "product_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists cat_b_bucketed_a")
        spark.sql("drop table if exists cat_b_bucketed_b")
