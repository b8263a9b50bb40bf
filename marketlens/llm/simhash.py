"""SimHash near-duplicates: one-wildcard segment variants, joined by equality and verified.

A text's fingerprint has bit b set if over half of its shingles' XXH64 hashes
have it set. Two fingerprints that differ in at most ``bits`` = 4 of 64 bits
agree up to one bit in at least one of three segments (4 = 1 + 1 + 1 + 1 bits
can't put two into each of three segments), where the classic cut for equal
segments needs five. So every distinct fingerprint is indexed under each of
its segments with one bit left out, 64 variants in all: fingerprints whose
segments differ by at most one bit share the variant that leaves that bit out.

The index is joined with itself by variant, and a pair counts after all its
64 bits are compared. No pairs are written: a bucket (the fingerprints of one
variant) gives out a spanning forest of the links found in it, at most m - 1
rows for m members. A bucket of more than ``SLICE`` members is dealt into
slices, and each two of its slices meet in a task of their own, so every two
members are compared, whatever the bucket's size, and a task holds at most
two slices. Equal fingerprints are one class from the beginning, so copies
are never joined with each other.

Work per bucket is quadratic in its distinct fingerprints (a 64-bit exclusive
or and a bit count per pair, some 5 ns), rows are not, except that a bucket
of s slices repeats a member s times.

Defined cases: A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``; a text of
fewer than k words is one shingle, the whole sequence; a null text or one
without words has fingerprint zero and is linked like any other. Rows with
one id stand for themselves. A row without id is in its component, which is
named by the smallest id there is (null, where there is none). Ties: exactly
half of the hashes leave a bit 0. Repeated rows get equal results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.components import connected
from marketlens.llm.spanhash import Spans
from marketlens.llm.tables import maybe_broadcast, written
from marketlens.llm.textbatch import NOT_SPACE, Block, blocks

#: Where the three segments begin, and the end of the last.
CUTS = (0, 21, 42, 64)
SLICE = 2048
SEED = 42


def prints(block: Block, k: int, seed: int = SEED) -> np.ndarray:
    """The fingerprint of every row of a block of lower-cased texts."""
    inside = NOT_SPACE[block.buf]
    row, start, end = block.runs(inside)
    out = np.zeros(block.n, dtype=np.uint64)
    if not len(row):
        return out
    # one blank between the words of a row
    keep = inside.copy()
    gap = end[:-1][row[1:] == row[:-1]]
    keep[gap] = True
    joined = block.buf[keep]
    place = np.cumsum(keep) - 1
    joined[place[gap]] = 0x20
    first = np.searchsorted(row, np.arange(block.n))
    count = np.diff(np.append(first, len(row)))
    # the rows' shingles, one after another
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    begin = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    last = begin + np.repeat(np.minimum(count, k), n) - 1
    h = Spans(joined, place[start[begin]], place[end[last] - 1] + 1).xxh64(seed)
    full = np.flatnonzero(n)
    at = (np.cumsum(n) - n)[full]
    set_bits = np.zeros((len(full), 64), dtype=np.int64)
    for byte in range(8):  # eight bits at a time keep the unpacked table small
        bits = np.unpackbits((h >> np.uint64(8 * byte)).astype(np.uint8)[:, None], axis=1, bitorder="little")
        set_bits[:, 8 * byte:8 * byte + 8] = np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    over = 2 * set_bits > n[full, None]
    out[full] = (over.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, k: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and the fingerprint (64 bits as a bigint) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", lower=True):
            yield pa.RecordBatch.from_arrays([block.rows.column(0), pa.array(prints(block, k).view(np.int64))],
                                             names=["doc_id", "print"])

    ids = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {ids}, print bigint")


def variants(of: str = "print") -> Column:
    """The 64 index keys of a fingerprint: (bit left out, the rest of its segment) in one bigint."""
    keys = []
    for low, high in zip(CUTS, CUTS[1:]):
        segment = F.shiftrightunsigned(F.col(of), low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for bit in range(low, high):
            hole = segment.bitwiseAND(F.lit(((1 << (high - low)) - 1) & ~(1 << (bit - low))))
            keys.append(F.lit(bit << 22).cast("bigint").bitwiseOR(hole))
    return F.array(*keys)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the smallest member that links (a, b) lead to."""
    name = np.arange(n)
    while len(a):
        low = np.minimum(name[a], name[b])
        before = name.copy()
        np.minimum.at(name, a, low)
        np.minimum.at(name, b, low)
        name = name[name]
        if np.array_equal(before, name):
            break
    return name


def _close(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= bits


def links(task: np.ndarray, side: np.ndarray, value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (positions) within each run of equal ``task``; sides 0 and 1 meet each other only, 2 all."""
    edge = np.flatnonzero(np.diff(task, prepend=task[:1] - 1))
    size = np.diff(np.append(edge, len(task)))
    found_a, found_b = [], []
    # small buckets, all at once: every member with the one ``step`` places further on
    many = size > 64
    small = np.repeat(~many, size)
    at, step = np.flatnonzero(small), 1
    while len(at):
        at = at[at + step < len(task)]
        at = at[task[at] == task[at + step]]
        ok = _close(value[at], value[at + step], bits)
        found_a.append(at[ok])
        found_b.append(at[ok] + step)
        step += 1
    for low, n in zip(edge[many], size[many]):
        here = slice(low, low + n)
        left = np.flatnonzero(side[here] != 1) + low
        right = np.flatnonzero(side[here] != 0) + low
        for part in range(0, len(left), 256):
            i, j = np.nonzero(_close(value[left[part:part + 256], None], value[right][None, :], bits))
            i, j = left[part:part + 256][i], right[j]
            name = forest(n, i[i != j] - low, j[i != j] - low)  # at most n - 1 links are carried on
            child = np.flatnonzero(name != np.arange(n))
            found_a.append(name[child] + low)
            found_b.append(child + low)
    if not found_a:
        return edge[:0], edge[:0]
    name = forest(len(task), np.concatenate(found_a), np.concatenate(found_b))
    child = np.flatnonzero(name != np.arange(len(task)))
    return name[child], child


def _compare(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def found(rows: list[np.ndarray]) -> pa.RecordBatch:
            task, side, value = rows
            a, b = links(task, side, value.view(np.uint64), bits)
            pairs = np.unique(np.stack([value[a], value[b]]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if kept:
                rows = [np.concatenate([x, y]) for x, y in zip(kept, rows)]
            whole = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0  # the last task may go on
            kept = [x[whole:] for x in rows]
            if whole:
                yield found([x[:whole] for x in rows])
        if kept and len(kept[0]):
            yield found(kept)
    return run


def similar(prints_df: DataFrame, bits: int = 4, slice_rows: int = SLICE) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column ``print``) that span every component of at most ``bits`` differing bits.

    ``bits`` is at most 5, which three segments with one wildcard each find.
    """
    if not 0 <= bits <= 5:
        raise ValueError("three segments with one wildcard find up to 5 differing bits")
    # a print becomes 64 rows, so the prints are dealt out before
    n = int(prints_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = prints_df.select("print").repartition(n, "print").select("print", F.explode(variants()).alias("variant"))
    large = index.groupBy("variant").count().where(F.col("count") > slice_rows)
    large = written(large.select("variant", F.ceil(F.col("count") / slice_rows).alias("slices")), "large-buckets")
    dealt = index.join(maybe_broadcast(large), "variant", "left")
    slices = F.coalesce("slices", F.lit(1))
    own = F.pmod(F.xxhash64("print"), slices)
    meet = F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), slices - 1), lambda other: F.struct(
        F.least(own, other).alias("low"), F.greatest(own, other).alias("high"),
        F.when(own == other, 2).when(own < other, 0).otherwise(1).cast("int").alias("side"))))
    tasks = dealt.select("print", "variant", meet.alias("m")).select(
        F.xxhash64("variant", "m.low", "m.high").alias("task"), "m.side", "print")
    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_compare(bits), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, k: int = 4, bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, print (bigint) and component_id (the smallest id of the component) of every row."""
    signed = written(fingerprints(docs, k, text, key), "prints")
    classes = written(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "print-classes")
    groups = connected(similar(classes, bits))
    named = classes.join(groups.withColumnRenamed("node", "print"), "print", "left")
    named = written(named.withColumn("component", F.coalesce("component", "print")), "print-components")
    # one row a component; only those of several classes have to be looked up
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    least = written(least.where("classes > 1").select("component", "component_id"), "component-ids")
    known = named.join(maybe_broadcast(least), "component", "left").select(
        "print", F.coalesce("component_id", "least").alias("component_id"))
    # written, so that both sides of the last join are plain shuffles and a print of very many copies is split
    return signed.join(written(known, "print-ids"), "print", "left").select("doc_id", "print", "component_id")
