"""Small tables with awkward rows, and a DuckDB view of the given tables."""

import duckdb
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # names that operators use inside
    T.StructField("n", T.StringType()), T.StructField("node", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("ids", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("bands", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("h", T.StringType())])

LONG = " ".join(f"word{i} é😀 x{i * i}" for i in range(30_000))
COPY = "The quick brown fox jumps over the lazy dog and runs to the far green hills beyond the river"


def row(doc_id, text):
    return (doc_id, text, "x", "y", "s", "i", "w", "b", "h", "k")


#: null id, null text, empty, blanks only, short, very long, equal rows, equal texts, one id with two texts
ROWS = [row(None, "a text without an id but with words"), row(1, None), row(2, ""), row(3, " \t\n\x0b\x0c\r "), row(4, "one"),
        row(5, "two words"), row(6, LONG), row(7, COPY), row(7, COPY), row(8, COPY), row(9, "Other " + COPY[4:]),
        row(10, "\xa0　non breaking\xa0blanks"), row(11, "one id"), row(11, "two texts of the one id here"),
        row(-4, "ONE"), row(12, COPY + " far"), row(None, None), row(13, "'s don't\n\n  x\t\ty  \U0001f9d1‍\U0001f680 ﬁ \x00 end ")]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def duck(sql, folder=SMALL):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con.sql(sql).df()


def texts(folder=SMALL):
    return duck("SELECT doc_id, text FROM documents ORDER BY doc_id", folder)


def plain(text):
    """A-Z lower-cased, the rest as it is."""
    return (text or "").translate({c: c + 32 for c in range(65, 91)})
