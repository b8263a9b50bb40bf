import hashlib

import duckdb
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from marketlens.llm import warc_audit
from marketlens.llm.queries import OP4_SQL, op4_merkle_fixity
from marketlens.llm.tables import read
from tests.llm.common import SMALL

ROWS = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 7)) for i in range(3000)] + [(None, None, None), (5, "http://h/5", "<p>5</p>")]


def captured(spark, rows=ROWS, **copies):
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return warc_audit.capture(table, **copies)


def test_records_are_real_bytes(spark):
    row = captured(spark, [(7, "http://é/", "<b>é</b>")]).select("record.*").first()
    data = ("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:7>\r\nWARC-Target-URI: http://é/\r\n"
            "Content-Type: text/html\r\nContent-Length: 9\r\n\r\n<b>é</b>\r\n\r\n").encode()
    assert (row.n_bytes, row.sha256) == (len(data), hashlib.sha256(data).hexdigest())


def test_faults_are_located(spark):
    rotten = F.when(F.col("page_id").isin(10, 2999), F.concat(F.col("html"), F.lit("!"))).otherwise(F.col("html"))
    both = captured(spark, copy=rotten)
    original = both.select("page_id", "place", "record.*")
    replica = both.where("page_id is null or page_id not in (20, 21)").select("place", "copy.*")
    extra = spark.createDataFrame([(1 << 40, 10, "ab")], replica.schema)
    got = warc_audit.audit(original, replica.union(extra))
    assert got.count() == len(ROWS)
    bad = {(r.page_id, r.status) for r in got.where("status <> 'intact'").collect()}
    assert bad == {(10, "changed"), (2999, "changed"), (20, "missing"), (21, "missing")}
    # ordered, gapless offsets in each segment
    gaps = got.groupBy("segment").agg((F.max(F.col("offset") + F.col("n_bytes")) - F.sum("n_bytes")).alias("gap"), F.min("offset").alias("low"))
    assert {(r.gap, r.low) for r in gaps.collect()} == {(0, 0)}


def test_equal_and_empty(spark):
    both = captured(spark, copy=F.col("html"))
    original = both.select("page_id", "place", "record.*")
    located = warc_audit.with_offsets(original)
    copies = located.withColumn("copy", F.lit(0)).union(located.withColumn("copy", F.lit(1)))
    assert warc_audit.mismatches(warc_audit.tree(copies)).isEmpty()
    none = captured(spark, [], copy=F.col("html"))
    got = warc_audit.audit(none.select("page_id", "place", "record.*"), none.select("place", "copy.*"))
    assert got.count() == 0


def test_places_do_not_depend_on_splits(spark, tmp_path):
    """The query on a table of several row groups and files, read in many partitions, against its SQL."""
    pages = pq.read_table(f"{SMALL}/pages.parquet")
    folder = tmp_path / "pages.parquet"
    folder.mkdir()
    cut = pages.num_rows // 3
    pq.write_table(pages.slice(0, cut), folder / "part-0.parquet", row_group_size=50)
    pq.write_table(pages.slice(cut), folder / "part-1.parquet", row_group_size=50)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet(['{folder}/part-0.parquet', '{folder}/part-1.parquet'])")
    want = con.sql(OP4_SQL).df().sort_values("page_id").reset_index(drop=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert read(spark, str(tmp_path), "pages").rdd.getNumPartitions() > 4
        got = op4_merkle_fixity(spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = got.sort_values("page_id").reset_index(drop=True)[list(want)]
    assert len(got) == pages.num_rows and got.equals(want.astype(got.dtypes))


def test_places_are_dense(spark):
    both = captured(spark)
    assert sorted(r.place for r in both.select("place").collect()) == list(range(len(ROWS)))


def test_moved_and_extra_records_are_found(spark):
    """A record elsewhere in the replica with the same bytes, and records that only the replica has."""
    both = captured(spark, copy=F.col("html"))
    original = both.select("page_id", "place", "record.*")
    replica = warc_audit.with_offsets(both.select("place", "copy.*"))
    moved = replica.withColumn("offset", F.when(F.col("place") == 7, F.col("offset") + 5).otherwise(F.col("offset")))
    extra = spark.createDataFrame([(len(ROWS), 10, "ab", 2, 99)], "place long, n_bytes long, sha256 string, segment long, offset long")
    got = warc_audit.audit(original, moved.unionByName(extra), extras=True)
    assert got.count() == len(ROWS) + 1
    bad = [(r.place, r.status, r.page_id, r.segment, r.offset) for r in got.where("place = 3002 or status = 'extra'").collect()]
    assert bad == [(len(ROWS), "extra", None, 2, 99)]
    assert {(r.place, r.status) for r in got.where("status <> 'intact'").collect()} == {(7, "changed"), (len(ROWS), "extra")}


def located(spark, longer=(), n=3000):
    """An archive, and a replica with its own offsets in which the records ``longer`` have a byte more."""
    copy = F.when(F.col("page_id").isin(*longer), F.concat("html", F.lit("!"))).otherwise(F.col("html"))
    both = captured(spark, [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 7)) for i in range(n)], copy=copy)
    return both.select("page_id", "place", "record.*"), warc_audit.with_offsets(both.select("page_id", "place", "copy.*"))


def bad(got):
    return sorted((r.place, r.status) for r in got.where("status <> 'intact'").collect())


def test_a_longer_record_is_one_fault(spark):
    original, replica = located(spark, [3, 1500])
    places = sorted(r.place for r in original.where("page_id in (3, 1500)").collect())
    assert bad(warc_audit.audit(original, replica, moved=True)) == [(p, "changed") for p in places]


def test_lost_records_with_and_without_their_room(spark):
    original, replica = located(spark, [3])
    changed = original.where("page_id = 3").first().place
    lost = [p for p in (0, 1, 700, 1023, 1024, 2999) if p != changed]
    want = sorted([(p, "missing") for p in lost] + [(changed, "changed")])
    kept = replica.where(~F.col("place").isin(lost))
    assert bad(warc_audit.audit(original, kept, moved=True)) == want
    closed = warc_audit.with_offsets(kept.drop("segment", "offset"))
    assert bad(warc_audit.audit(original, closed, moved=True)) == want


def test_a_run_that_moved(spark):
    original, replica = located(spark)
    by = F.when(F.col("place").between(100, 140), 9).otherwise(0)
    got = warc_audit.audit(original, replica.withColumn("offset", F.col("offset") + by), moved=True)
    assert bad(got) == [(p, "moved") for p in range(100, 141)]
    away = replica.withColumn("segment", F.when(F.col("place") == 2000, 9).otherwise(F.col("segment")))
    assert (2000, "moved") in bad(warc_audit.audit(original, away, moved=True))


def test_query_on_awkward_contents(spark, tmp_path):
    """Null, empty, multi-byte and ``#`` contents at changed pages, and columns with the names used inside."""
    html = {0: None, 97: "", 194: "éa", 291: "#b", 388: "\U0001f600"}
    table = spark.createDataFrame(
        [(i, f"http://h/{i}", html.get(i, "x" * (i % 50)), "p", 7, "s", "r") for i in range(1300)],
        "page_id long, url string, html string, place string, segment int, part string, record string")
    table.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = con.sql(OP4_SQL).df().sort_values("page_id").reset_index(drop=True)
    got = op4_merkle_fixity(spark, str(tmp_path)).toPandas().sort_values("page_id").reset_index(drop=True)[list(want)]
    assert got.equals(want.astype(got.dtypes))
