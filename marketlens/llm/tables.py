"""Intermediate tables in the cluster's shared folder, and row helpers for every operator."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_path

#: Rows of two or three numbers that may be broadcast: some 16 MB.
FEW = 1_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows once as Parquet under ``spark.checkpoint.dir`` and reads them again.

    Cuts the lineage like a reliable checkpoint, compressed and by column; a
    lost executor reads the files again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like ``written``, each task's rows in files by bucket of ``key``: what groups or joins by it reads them without a shuffle."""
    spark = df.sparkSession
    table = f"marketlens_{name}_{os.urandom(6).hex()}"
    df.write.option("path", scratch_path(spark, name)).bucketBy(buckets, key).saveAsTable(table)
    return spark.table(table)


#: Bytes of a batch that Spark hands to a Python worker, where the session sets none.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds batches by bytes: by Spark's default, 10,000 long texts make one, several times over in memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def maybe_broadcast(df: DataFrame, most_rows: int = FEW) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have few rows, else for a shuffle join."""
    return F.broadcast(df) if df.count() <= most_rows else df


def hash_of(*texts) -> object:
    """Hex sha-256 of the joined strings."""
    return F.sha2(F.concat_ws(",", *texts), 256)
