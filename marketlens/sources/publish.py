"""K2 partitioned publishing and K5 staged relations.

``publish`` overwrites a folder, as the warehouse's full refresh does. A reader
at that moment may see the folder half replaced; ``publish_version`` and
``read_published`` avoid it. A version's files go into a folder of their own,
which no reader knows, until its manifest rows, one for each run date, are
added to the table's log: a single small file that appears at once or not at
all. A reader takes the newest manifest, so it sees the old version or the new
one, also while a write fails;
the old version's files stay, so a reader that has begun can end.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.session import ensure_checkpoint_dir, scratch_path


def publish(df: DataFrame, path: str, partition_col: str, cluster_col: str, replace: str = "table") -> None:
    """K2: full-refresh table partitioned by ``partition_col``, clustered by ``cluster_col``.

    Rows are range-partitioned on (partition, cluster) keys so each output
    file covers one run date and a contiguous range of ``cluster_col``
    (min/max statistics then prune reads by product id), and sorted within
    each file. Range partitioning samples its input, so an expensive ``df``
    is best materialized first. ``replace="table"`` puts the new rows in the
    place of all old ones; ``replace="dates"`` only in the place of the run
    dates that the new rows have. The mode is an option of this write; the
    session's settings stay as they are.
    """
    mode = {"table": "static", "dates": "dynamic"}[replace]
    (df.repartitionByRange(partition_col, cluster_col)
       .sortWithinPartitions(partition_col, cluster_col)
       .write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(partition_col).parquet(path))


def publish_version(df: DataFrame, path: str, partition_col: str, cluster_col: str, replace: str = "table") -> int:
    """K2 as a versioned table; returns the committed version. Layout and ``replace`` as in ``publish``.

    The commit adds ``(version, writer, full, run date, folder)`` rows to the
    log in one file. Of two writers of one version the one of the larger
    writer name counts as later, for every reader alike.
    """
    spark = df.sparkSession
    known = _log(spark, path)
    version = 1 + (known.agg(F.max("version")).first()[0] or 0 if known is not None else 0)
    writer = os.urandom(8).hex()
    folder = f"data/v{version}-{writer}"
    if replace not in ("table", "dates"):
        raise ValueError(replace)
    publish(df, f"{path}/{folder}", partition_col, cluster_col)
    dates = spark.read.schema(df.schema).parquet(f"{path}/{folder}").select(F.col(partition_col).cast("string").alias("run_date")).distinct()
    # a version without rows has one manifest row without a date, so that a full refresh can empty the table
    rows = dates.unionByName(spark.createDataFrame([(None,)], "run_date string")).select(
        F.lit(version).cast("bigint").alias("version"), F.lit(writer).alias("writer"), F.lit(replace == "table").alias("full"),
        "run_date", F.lit(folder).alias("folder"), F.lit(df.schema.json()).alias("columns"))
    rows.coalesce(1).write.mode("append").parquet(f"{path}/log")
    return version


LOG = "version bigint, writer string, full boolean, run_date string, folder string, columns string"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's manifest rows, or None before the first version."""
    try:
        return spark.read.schema(LOG).parquet(f"{path}/log")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _current(log: DataFrame) -> DataFrame:
    """The manifest rows that count: the newest full refresh and, for each run date, the newest write since."""
    order = F.struct("version", "writer")
    last = log.where("full").agg(F.max(order).alias("last"))  # one row
    since = log.join(F.broadcast(last), F.col("last").isNull() | (order >= F.col("last")))
    return since.where("run_date is not null").groupBy("run_date").agg(
        F.max_by(F.struct("folder", "columns"), order).alias("at")).select("run_date", "at.*")


def read_published(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """The newest committed version of a table written by ``publish_version``; its run dates are listed, not its rows."""
    log = _log(spark, path)
    if log is None:
        raise FileNotFoundError(f"nothing has been published at {path}")
    found = _current(log).collect()  # one row for each run date
    if not found:
        columns = log.select(F.max_by("columns", F.struct("version", "writer"))).first()[0]
        return spark.createDataFrame([], StructType.fromJson(json.loads(columns)))
    folders: dict[tuple[str, str], list[str]] = {}
    for r in found:
        at = f"{path}/{r['folder']}"
        folders.setdefault((at, r["columns"]), []).append(f"{at}/{partition_col}={r['run_date']}")
    frames = [spark.read.option("basePath", at).schema(StructType.fromJson(json.loads(columns))).parquet(*sorted(parts))
              for (at, columns), parts in sorted(folders.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def publish_table(df: DataFrame, table: str, path: str, partition_col: str, cluster_col: str,
                  buckets: int, mode: str = "overwrite") -> DataFrame:
    """K2 as a catalog table: partitioned by ``partition_col`` and bucketed +
    sorted by ``cluster_col`` (Spark's form of CLUSTER BY).

    Readers that join or aggregate on ``cluster_col`` with the same bucket
    count skip the shuffle of this side. Data files live under ``path``
    (a shared folder); the table is registered in the session catalog.
    """
    (df.write.mode(mode).option("path", path)
       .partitionBy(partition_col)
       .bucketBy(buckets, cluster_col).sortBy(cluster_col)
       .saveAsTable(table))
    return df.sparkSession.table(table)


def stage(df: DataFrame, name: str, how: str | None = None) -> DataFrame:
    """K5: a named intermediate read several times (a script's temp table).

    Materialized once (see ``materialize``) and registered as a temp view
    for SQL use.
    """
    staged = materialize(df, how)
    staged.createOrReplaceTempView(name)
    return staged


def stage_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """K5: a staged relation bucketed and sorted by ``keys``, for several consumers that group or join on them.

    One shuffle deals the rows to their buckets, and each task writes one file.
    Aggregations and windows on ``keys``, or on ``keys`` and more columns,
    then read it without a shuffle. ``buckets`` is by default the number of
    shuffle partitions. The files lie in the shared checkpoint folder, so a
    lost executor's tasks read them again; ``name`` becomes a temporary view.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"marketlens_{name}_{os.urandom(6).hex()}"
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", scratch_path(spark, table))
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    staged = spark.table(table)
    staged.createOrReplaceTempView(name)
    return staged


def materialize(df: DataFrame, how: str | None = None) -> DataFrame:
    """Compute a relation that several branches of one plan read, once.

    Column pruning gives each consumer a slightly different projection, so
    Spark cannot reuse the shared exchanges by itself and would recompute
    the whole subtree per consumer.

    how="checkpoint": eager reliable checkpoint into the shared
    ``spark.checkpoint.dir`` (lineage cut; survives executor loss without
    recomputation). how="persist": memory-and-disk cache (lost blocks are
    recomputed from lineage). Default: ``spark.marketlens.materialize``
    session setting, else "checkpoint".
    """
    how = how or df.sparkSession.conf.get("spark.marketlens.materialize", "checkpoint")
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist()
    if how == "none":
        return df
    raise ValueError(how)
