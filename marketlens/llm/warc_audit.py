"""Merkle fixity audit of WARC replicas.

A replica is a table of records at places of an archive: ``place`` numbers the
records 0 to n - 1 in capture order; each run of ``SEGMENT`` places is one WARC segment, in which records follow
each other by byte offset. A leaf hashes a record's size and bytes and the gap
between it and the record before it (0 in a sound segment), so one of another
length leaves the leaves after it as they are; every further level hashes
``FAN`` neighbouring nodes, in order, with the bytes they span, so a node stands for its ordered
offset ranges relative to its begin. Roots are compared first and only the children of
mismatching nodes are read further, down to the records.

Places come from each row's number in its file or partition and the counts of
those before (a number for each comes to the driver), so no row is numbered in
one task, and a segment is bounded whatever the keys are. All steps are grouped
DataFrame operations with groups of at most ``FAN`` (nodes) or ``SEGMENT``
(offsets) rows.

A record with the same bytes counts as moved if its offset isn't what the sizes of
the replica's records before it in the segment give, with the room of all lost
ones either kept or closed.

Defined cases: null ids, URLs and contents are empty in the record; repeated
rows are records of their own; equal replicas and empty tables give no
mismatch; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketlens.llm.tables import written

FAN_BITS = 6  # 64 children
SEGMENT_BITS = 10  # 1024 records


def record(key: Column, url: Column, body: Column) -> Column:
    """The bytes of one WARC record, header and content."""
    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    content = F.encode(text(body), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"), text(key),
        F.lit(">\r\nWARC-Target-URI: "), text(url),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(content).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), content, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def fingerprint(key: str, url: str, body: Column) -> Column:
    """Size and hash of a record's bytes."""
    data = record(F.col(key), F.col(url), body)
    return F.struct(F.octet_length(data).cast("bigint").alias("n_bytes"), F.sha2(data, 256).alias("sha256"))


#: File and row number in it, for rows that are read from files: an order that doesn't depend on how files are split.
IN_FILES = ("_metadata.file_path", "_metadata.row_index")


def capture(rows: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
            order: tuple[str, str] | None = None, **copies: Column) -> DataFrame:
    """page_id, place and the fingerprint of each row's record (and of further ``copies`` of its body), written once.

    ``order`` names the part that a row is in and its number there, from 0 without gaps; parts follow by name.
    Without it, the rows' order when they are written becomes the capture order.
    """
    part, number = map(F.col, order) if order else (F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    listed = written(rows.select(
        F.col(key).alias("page_id"), part.alias("part"), number.alias("number"),
        fingerprint(key, url, F.col(body)).alias("record"),
        *(fingerprint(key, url, c).alias(name) for name, c in copies.items())), "captured")
    first, total = [], 0
    for name, n in sorted(tuple(r) for r in listed.groupBy("part").agg(F.count(F.lit(1))).collect()):
        first.append((name, total))
        total += n
    before = listed.sparkSession.createDataFrame(first, T.StructType([
        T.StructField("part", listed.schema["part"].dataType), T.StructField("first", T.LongType())]))
    return listed.join(F.broadcast(before), "part").select(
        "page_id", (F.col("first") + F.col("number")).alias("place"), "record", *copies)


def with_offsets(records: DataFrame) -> DataFrame:
    """The records with their segment and byte offset in it."""
    segment = F.shiftright("place", SEGMENT_BITS)
    before = Window.partitionBy("segment").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("segment", segment).withColumn(
        "offset", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)))


def _next_level(nodes: DataFrame) -> DataFrame:
    """Parents of (copy, place, span, hash)."""
    child = F.concat_ws(":", F.col("place").cast("string"), F.col("span").cast("string"), "hash")
    children = F.transform(F.array_sort(F.collect_list(F.struct("place", child.alias("child")))), lambda c: c["child"])
    return nodes.groupBy("copy", F.shiftright("place", FAN_BITS).alias("place")).agg(
        F.sum("span").alias("span"), F.sha2(F.concat_ws("|", children), 256).alias("hash"))


def tree(copies: DataFrame) -> list[DataFrame]:
    """All levels, leaves first, of located records (copy, place, segment, offset, n_bytes, sha256); the last has the roots."""
    before = Window.partitionBy("copy", "segment").orderBy("place", "offset")
    gap = F.col("offset") - F.coalesce(F.lag(F.col("offset") + F.col("n_bytes")).over(before), F.lit(0))
    leaf = copies.withColumn("gap", gap).select(
        "copy", "place", "segment", "gap", "n_bytes", "sha256", (F.col("gap") + F.col("n_bytes")).alias("span"),
        F.sha2(F.concat_ws("|", F.col("gap").cast("string"), F.col("n_bytes").cast("string"), "sha256"), 256).alias("hash"))
    levels = [written(leaf, "leaves")]
    last = levels[0].agg(F.max("place")).first()[0]
    while last:
        levels.append(written(_next_level(levels[-1].select("copy", "place", "span", "hash")), "nodes"))
        last >>= FAN_BITS
    return levels


def _differ(nodes: DataFrame) -> DataFrame:
    """Places whose node isn't the same in both copies."""
    return (nodes.groupBy("place").agg(F.min("hash").alias("x"), F.max("hash").alias("y"),
                                       F.count_if(F.col("copy") == 0).alias("left"), F.count_if(F.col("copy") == 1).alias("right"))
            .where("x <> y or left <> right").select("place"))


def _faults(leaves: DataFrame) -> DataFrame:
    """place and fault of records with differing leaves, and of those that moved along with one."""
    def of(copy: int, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("copy") == copy, F.col(name))), F.lit(0))

    sides = leaves.groupBy("place").agg(
        F.count_if(F.col("copy") == 0).alias("left"), F.count_if(F.col("copy") == 1).alias("right"),
        (F.min("sha256") == F.max("sha256")).alias("same"), (F.min("segment") == F.max("segment")).alias("stays"),
        (of(1, "gap") - of(0, "gap")).alias("shift"), of(0, "n_bytes").alias("room"))
    # leaves that are equal in both copies have equal gaps, so the differing ones alone add up to every shift
    segment = Window.partitionBy(F.shiftright("place", SEGMENT_BITS)).orderBy("place")
    shift = F.sum("shift").over(segment)
    lost = F.coalesce(F.sum(F.when(F.col("right") == 0, F.col("room"))).over(segment), F.lit(0))
    end = F.shiftleft(F.shiftright("place", SEGMENT_BITS) + 1, SEGMENT_BITS)
    sides = sides.select("*", ((shift != 0) & (shift != lost)).alias("shifted"),
                         F.coalesce(F.lead("place").over(segment), end).alias("until"))
    fault = (F.when(F.col("right") == 0, "missing").when(F.col("left") == 0, "extra")
             .when(~F.col("same") | (F.col("left") != F.col("right")), "changed")
             .when(F.col("shifted") | ~F.col("stays"), "moved"))
    along = sides.where(F.col("shifted") & (F.col("until") > F.col("place") + 1)).select(
        F.explode(F.sequence(F.col("place") + 1, F.col("until") - 1)).alias("place"), F.lit("moved").alias("fault"))
    return sides.select("place", fault.alias("fault")).where("fault is not null").union(along)


def mismatches(levels: list[DataFrame]) -> DataFrame:
    """place and fault (changed, moved, missing, extra) of the records where copy 1 differs from copy 0.

    Goes down from the roots; each level reads only the children of nodes that differ.
    """
    found = _differ(levels[-1])
    for nodes in reversed(levels[:-1]):
        parent = found.select(F.col("place").alias("parent"))
        found = _differ(nodes.join(parent, F.shiftright("place", FAN_BITS) == F.col("parent"), "left_semi"))
    return _faults(levels[0].join(found, "place", "left_semi"))


def audit(original: DataFrame, other: DataFrame, extras: bool = False, moved: bool = False) -> DataFrame:
    """page_id, place, segment, offset, n_bytes, sha256 and status of every record of the original.

    ``other`` has place, n_bytes and sha256 of the replica's records, and the
    segment and offset where the replica has them; a record that is elsewhere
    is changed, or, with ``moved``, has that status if its bytes are the same. A replica's record keeps its
    place, so a lost one leaves a gap. Without offsets of its own, a replica is compared by place and bytes only.
    With ``extras`` the records that only the replica has are returned too, as
    ``extra``, without a page_id and where the replica has them.
    """
    first = written(with_offsets(original), "records")
    located = ["place", "segment", "offset", "n_bytes", "sha256"]
    if not {"segment", "offset"} <= set(other.columns):
        other = with_offsets(other.select("place", "n_bytes", "sha256"))
    second = written(other.select(located), "replica")
    both = first.select(F.lit(0).alias("copy"), *located).union(second.select(F.lit(1).alias("copy"), *located))
    faults = written(mismatches(tree(both)), "faults").withColumnRenamed("place", "__place")
    # of a run that moved along, only places that the original has
    status = F.when((F.col("fault") == "moved") & F.lit(not moved), "changed").otherwise(F.coalesce("fault", F.lit("intact")))
    out = first.join(faults, first["place"] == F.col("__place"), "left").select("page_id", *located, status.alias("status"))
    if not extras:
        return out
    extra = faults.where("fault = 'extra'").select(F.col("__place").alias("place"))
    return out.union(second.join(extra, "place", "left_semi").select(
        F.lit(None).cast(out.schema["page_id"].dataType).alias("page_id"), *located, F.lit("extra").alias("status")))
