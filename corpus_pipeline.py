"""A corpus pipeline: each stage works on all that the one before it kept.

``run`` writes every stage's rows as Parquet in the cluster's shared folder and
gives the next stage the reread table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import bpe, decontaminate, near_dedup, quality_rules, secret_scan, spans
from marketlens.llm.tables import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned decision list rejects."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 or more of its 5-word shingles."""
    return near_dedup.keep_one(docs, k=5, percent=80)


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of benchmark windows."""
    return _recount(decontaminate.remove(docs, read(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return _recount(spans.redact(secret_scan.scan(docs)))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' token ids, and whether decoding them gives the text again."""
    coded = bpe.round_trip(docs)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        same.alias("round_trip"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("byte-pair encoding", encoding),
]

#: Byte-pair encoding can't be written in SQL; tests compare the stages with plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
