"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate edges.

One pass over the whole texts makes each document's set of k-word shingles,
a 128-bit fingerprint of the set, and a one-permutation MinHash signature
whose empty bins are filled by optimal densification (each empty bin walks a
fixed random order of bins to the first full one). Equal sets collapse into
one class; a class is carried by its smallest document.

Bands of signature bins form buckets. A bucket of m classes gives m - 1
candidate edges to its centre, not m * (m - 1) / 2. Every edge is confirmed
on full shingle sets and links are closed into components. Buckets whose
classes then still lie in several components are settled exactly: their
classes, grouped into families that share buckets, are dealt into slices of
bounded size by set size (only sizes that allow the similarity meet), and a
task compares two slices by counting common shingles, giving out a spanning
forest of the links it finds. So no candidate is dropped, there is no cap on
a bucket, and no pairs are written out.

With ``rows * bands`` = 5 * 40 a pair of similarity 0.85 misses every bucket
with probability (1 - 0.85**5)**40 = 7e-11, at 0.8 with 1e-7.

Defined cases: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of
fewer than k words is one shingle, the whole sequence; a null text or one
without words has an empty set and is linked with nothing. Rows with one
document id are one document. Rows without id stand for themselves: their
component is null. Repeated rows get equal results; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.components import connected
from marketlens.llm.decontaminate import expand
from marketlens.llm.tables import maybe_broadcast, written
from marketlens.llm.textbatch import NOT_SPACE, Block, blocks, mix, windows

ROWS, BANDS = 5, 40
SLICE_CLASSES, SLICE_SHINGLES = 512, 1 << 19  # what a slice holds, about


def shingles(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, by row and then by hash."""
    row, start, end = block.runs(NOT_SPACE[block.buf])
    word = block.hashes(start, end)
    first, h = windows(row, word, k)
    of = row[first]
    count = np.bincount(row, minlength=block.n)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        begin = np.searchsorted(row, short)
        whole = np.full(len(short), 1, dtype=np.uint64)
        for j in range(k - 1):
            has = count[short] > j
            whole[has] = mix(whole[has] * np.uint64(0x9FB21C651E98DF25) + word[begin[has] + j])
        h, of = np.concatenate([h, mix(whole + np.uint64(k))]), np.concatenate([of, short])
    order = np.argsort(h)
    order = order[np.argsort(of[order].astype(np.int32), kind="stable")]
    of, h = of[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return of[new], h[new]


_walks: dict[int, np.ndarray] = {}


def signatures(of: np.ndarray, h: np.ndarray, n: int, bins: int) -> np.ndarray:
    """One minimum per bin for each of ``n`` rows; rows without shingles stay 0."""
    sig = np.zeros((n, bins), dtype=np.uint64)
    full = np.zeros((n, bins), dtype=bool)
    at = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    at = at.astype(np.int64)
    lead = np.ones(len(h), dtype=bool)  # hashes are in order, so the first of a bin is its minimum
    lead[1:] = (at[1:] != at[:-1]) | (of[1:] != of[:-1])
    sig[of[lead], at[lead]] = h[lead]
    full[of[lead], at[lead]] = True
    if bins not in _walks:
        rng = np.random.default_rng(bins)
        _walks[bins] = np.stack([rng.permutation(bins) for _ in range(bins)])
    row, empty = np.nonzero(~full & full.any(axis=1)[:, None])
    for step in range(bins):
        if not len(row):
            break
        source = _walks[bins][empty, step]
        found = full[row, source]
        sig[row[found], empty[found]] = sig[row[found], source[found]]
        row, empty = row[~found], empty[~found]
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A hash for each band of ``rows`` neighbouring bins, different for each band."""
    n, bins = sig.shape
    parts = sig.reshape(n, bins // rows, rows)
    out = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64), (n, bins // rows)).copy()
    for j in range(rows):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + parts[:, :, j])
    return out


def _lists(values: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))


def _sets(block: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]:
    """Rows and hashes of the shingles, set sizes, where each row's begin, and the two halves of the fingerprint."""
    of, h = shingles(block, k)
    n = np.bincount(of, minlength=block.n)
    at = np.zeros(block.n + 1, dtype=np.int64)
    np.cumsum(n, out=at[1:])
    prints = []
    for salt in (0x51ED270B27B4F3CF, 0xA0761D6478BD642F):
        total = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(mix(h + np.uint64(salt)), out=total[1:])
        prints.append(pa.array(mix(total[at[1:]] - total[at[:-1]] + n.astype(np.uint64)).view(np.int64)))
    return of, h, n, at, prints


def sign(docs: DataFrame, k: int, rows: int, bands: int, text: str, key: str) -> DataFrame:
    """doc_id, n_shingles, fingerprint (f1, f2) and band keys of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, lower=True):
            of, h, n, _, prints = _sets(block, k)
            keys = band_keys(signatures(of, h, block.n, rows * bands), rows)
            keys = keys[n > 0]
            ends = np.zeros(block.n + 1, dtype=np.int64)
            np.cumsum(np.where(n > 0, bands, 0), out=ends[1:])
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(0), pa.array(n.astype(np.int64)), *prints, _lists(keys.ravel(), ends)], names=["doc_id", "n", "f1", "f2", "bands"])

    ids = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias(text)).mapInArrow(
        run, f"doc_id {ids}, n bigint, f1 bigint, f2 bigint, bands array<bigint>")


def shingle_sets(docs: DataFrame, k: int, text: str) -> DataFrame:
    """node, first half of the fingerprint, and the shingle hashes of every row of (node, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, lower=True):
            _, h, _, at, prints = _sets(block, k)
            yield pa.RecordBatch.from_arrays([block.rows.column(0), prints[0], _lists(h, at)],
                                             names=["node", "f1", "shingles"])

    return docs.mapInArrow(run, "node bigint, f1 bigint, shingles array<bigint>")


def confirm(pairs: DataFrame, docs: DataFrame, percent: int, k: int, text: str) -> DataFrame:
    """Those of (a, a1, b, b1) whose full sets reach the similarity; the texts of both sides are read again.

    The members' sets are moved once to their centre; both joins are plain
    shuffle joins, which adaptive execution splits where a centre has very
    many members.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = shingle_sets(docs.join(maybe_broadcast(wanted), "node").select("node", text), k, text)
    left = sets.select(F.col("node").alias("a"), F.col("f1").alias("a1"), F.col("shingles").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("f1").alias("b1"), F.col("shingles").alias("t"))
    both = pairs.join(right, ["b", "b1"]).join(left, ["a", "a1"])
    common = F.size(F.array_intersect("s", "t"))
    union = F.size("s") + F.size("t") - common
    return both.where(100 * common >= percent * union).select("a", "b")


def _pairs(edges: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, a1, b, b1) that the set sizes n and m allow to be similar."""
    return edges.where(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).select("a", "a1", "b", "b1").distinct()


def _unsettled(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of buckets that hold classes of several components, with their component."""
    named = members.join(maybe_broadcast(groups), "node", "left")
    named = written(named.withColumn("component", F.coalesce("component", "node")), "labelled")
    mixed = written(named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                    .where("x <> y").select("bucket"), "mixed")
    return named.join(maybe_broadcast(mixed), "bucket")


def common_counts(doc: np.ndarray, shingle: np.ndarray, m: int) -> np.ndarray:
    """How many shingles each two of ``m`` sets share; (doc, shingle): all their elements."""
    order = np.argsort(shingle)
    doc, shingle = doc[order], shingle[order]
    edge = np.flatnonzero(np.diff(shingle, prepend=shingle[:1] + np.uint64(1)))
    size = np.diff(edge, append=len(shingle))
    out = np.zeros((m, m), dtype=np.int64)
    often = np.flatnonzero(size > max(8, m // 16))
    for low in range(0, len(often), 4096):  # shingles of many sets: a matrix product
        at, column = expand(edge[often[low:low + 4096]], edge[often[low:low + 4096]] + size[often[low:low + 4096]])
        x = np.zeros((m, min(4096, len(often) - low)), dtype=np.float32)
        x[doc[at], column] = 1
        out += (x @ x.T).astype(np.int64)  # at most 4096 each, which floats hold exactly
    seldom = np.flatnonzero((size > 1) & (size <= max(8, m // 16)))
    for low in range(0, len(seldom), 1 << 11):  # others: the pairs of sets themselves
        part = seldom[low:low + (1 << 11)]
        at, of = expand(edge[part], edge[part] + size[part])
        other, source = expand(at + 1, (edge[part] + size[part])[of])
        code = doc[at[source]] * m + doc[other]
        both = np.bincount(code, minlength=m * m).reshape(m, m)
        out += both + both.T
    return out


def _forest(similar: np.ndarray) -> list[tuple[int, int]]:
    """An edge from the first member of each component of a boolean matrix to each other member."""
    out, new = [], np.ones(len(similar), dtype=bool)
    for root in range(len(similar)):
        if not new[root]:
            continue
        new[root] = False
        front = np.array([root])
        while len(front):
            reached = similar[front].any(axis=0) & new
            front = np.flatnonzero(reached)
            new[front] = False
            out += [(root, int(j)) for j in front]
    return out


def _settle(left: DataFrame, docs: DataFrame, percent: int, k: int, text: str) -> DataFrame:
    """Links (a, b) among the classes of unsettled buckets: all that there are, up to the components they form."""
    centre = left.groupBy("bucket").agg(F.min("node").alias("a"))
    families = connected(left.join(maybe_broadcast(written(centre, "centres")), "bucket").select("a", F.col("node").alias("b")))
    # sets of at least ``percent`` alike lie in the same class of sizes or in neighbouring ones
    width = 1.001 * 100 / percent
    size_class = F.floor(F.log(F.col("n").cast("double")) / float(np.log(width))).cast("int")
    member = written(left.select("node", "f1", "n").distinct().join(maybe_broadcast(families), "node")
                     .withColumn("class", size_class), "members")
    sizes = written(member.groupBy("component", "class").agg(F.count(F.lit(1)).alias("m"), F.greatest(
        F.ceil(F.count(F.lit(1)) / SLICE_CLASSES), F.ceil(F.sum("n") / SLICE_SHINGLES)).alias("slices")), "sizes")
    sizes = maybe_broadcast(sizes)
    dealt = member.join(sizes, ["component", "class"]).withColumn("slice", F.pmod(F.xxhash64("node", "f1"), F.col("slices")))

    def task(rows: DataFrame, of: str, low: object, high: object) -> DataFrame:
        return rows.select("node", "f1", F.xxhash64("component", F.lit(of), F.col("class"), low, high).alias("task"))

    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))
    same = dealt.where("m > 1").withColumn("other", partner)
    same = task(same, "same", F.least("slice", "other"), F.greatest("slice", "other"))
    below = sizes.select("component", (F.col("class") - 1).alias("class"), F.col("slices").alias("above"))
    lower = dealt.join(below, ["component", "class"]).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("above") - 1)))
    lower = task(lower, "next", F.col("slice"), F.col("other"))
    above = sizes.select("component", (F.col("class") + 1).alias("class"), F.col("slices").alias("under"))
    upper = dealt.join(above, ["component", "class"]).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("under") - 1))).withColumn("class", F.col("class") - 1)
    upper = task(upper, "next", F.col("other"), F.col("slice"))
    tasks = same.union(lower).union(upper)
    sets = shingle_sets(docs.join(maybe_broadcast(member.select("node").distinct()), "node").select("node", text), k, text)
    full = tasks.join(sets.dropDuplicates(["node", "f1"]), ["node", "f1"])

    def compare(rows: pa.Table) -> pa.Table:
        lists = rows["shingles"].combine_chunks()
        n = lists.value_lengths().to_numpy().astype(np.int64)
        node = rows["node"].to_numpy()
        doc = np.repeat(np.arange(len(n)), n)
        both = common_counts(doc, lists.flatten().to_numpy().view(np.uint64), len(n))
        similar = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        links = _forest(similar)
        return pa.table({"a": pa.array([node[i] for i, _ in links], pa.int64()), "b": pa.array([node[j] for _, j in links], pa.int64())})

    return full.select("task", "node", "shingles").groupBy("task").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, rows: int = ROWS, bands: int = BANDS,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, class_id (smallest document with an equal set), component_id and kept, for every row."""
    signed = written(sign(docs, k, rows, bands, text, key), "signed")
    print_of = ["n", "f1", "f2"]
    with_set = signed.where("n > 0 and doc_id is not null")
    classes = written(with_set.groupBy(*print_of).agg(F.min("doc_id").alias("node")), "classes")
    carrier = with_set.join(classes.withColumnRenamed("node", "doc_id"), ["doc_id", *print_of], "left_semi")
    carrier = written(carrier.select(F.col("doc_id").cast("bigint").alias("node"), "f1", "n", "bands"), "carriers")

    bucketed = carrier.select("node", "f1", "n", F.explode("bands").alias("bucket"))
    # a bucket's centre comes with its size and fingerprint, so its edges need no join with the centres
    centres = written(bucketed.groupBy("bucket").agg(F.min(F.struct("node", "f1", "n")).alias("c"), F.max("node").alias("z"))
                      .where("c.node <> z").select("bucket", F.col("c.node").alias("a"), F.col("c.f1").alias("a1"),
                                                   F.col("c.n").alias("size")), "centres")
    members = written(bucketed.join(centres, "bucket"), "members")
    star = members.where("node <> a").select("a", "a1", F.col("size").alias("n"), F.col("node").alias("b"),
                                             F.col("f1").alias("b1"), F.col("n").alias("m"))
    named = docs.select(F.col(key).cast("bigint").alias("node"), F.col(text).alias(text))
    pairs = written(_pairs(star, percent), "pairs")
    groups = connected(confirm(pairs, named, percent, k, text))

    left = written(_unsettled(members.select("bucket", "node", "f1", "n"), groups), "unsettled")
    if not left.isEmpty():
        more = written(_settle(left, named, percent, k, text), "links")
        groups = connected(more.union(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    own = signed.select("doc_id", F.col("n").alias("n_shingles"), *print_of)
    out = own.join(classes.withColumn("node", F.col("node").cast("bigint")), print_of, "left").join(groups, "node", "left")
    known = F.col("doc_id").isNotNull()
    component = F.when(known, F.coalesce("component", "node", "doc_id"))
    return out.select("doc_id", F.col("n_shingles").cast("bigint"),
                      F.when(known, F.coalesce("node", "doc_id")).alias("class_id"),
                      component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each group of near duplicates, with all its columns; rows without id stay."""
    gone = near_duplicates(docs, k, percent, text=text, key=key).where("not kept").select(
        F.col("doc_id").alias("__gone")).distinct()
    return docs.join(maybe_broadcast(gone), F.col(key) == F.col("__gone"), "left_anti")
