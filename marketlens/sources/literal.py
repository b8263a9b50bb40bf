"""K3 inline literal tables and K4 latest-snapshot scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """K3: a small fixed table given inline (an ARRAY<STRUCT> script variable).

    Its size is the size of the literal, never of the data, so it is safe to
    broadcast.
    """
    return spark.createDataFrame(list(rows), schema)


def newest_value(spark: SparkSession, files: Sequence[str] | str, column: str):
    """The largest value of a Parquet table's column from its file footers alone.

    Spark's own aggregate push-down answers MAX from the row groups'
    statistics; it belongs to the second reader interface, which is switched
    on in a session of its own, so the caller's settings stay. Columns
    without statistics (text) are read instead, by the same query.
    """
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return newest_plan(other, files, column).first()[0]


def newest_plan(spark: SparkSession, files: Sequence[str] | str, column: str) -> DataFrame:
    """The query of ``newest_value``."""
    files = [files] if isinstance(files, str) else list(files)
    return spark.read.parquet(*files).agg(F.max(column).alias("newest"))


def latest_snapshot(df: DataFrame, date_col: str, newest=None) -> DataFrame:
    """K4: rows whose snapshot date equals the table's maximum.

    The newest date is a literal when the scan is planned: ``newest`` if the
    caller has it (``newest_value`` from footers), else a pass over that one
    column. So the rows are one scan, pruned to the newest partition or row
    groups. A table without rows or dates gives no rows.
    """
    if newest is None:
        newest = df.agg(F.max(date_col)).first()[0]
    return df.where(F.lit(False) if newest is None else F.col(date_col) == F.lit(newest))
