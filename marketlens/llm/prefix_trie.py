"""Conversation prefix trie: double-array tries per prefix shard, shared upper nodes merged globally.

A turn is the SHA-256 of its role and text; a conversation is the sequence of
its turns, and a node of the trie is a distinct prefix. Conversations of one
sequence are one class from the start (their ids are hashed in order, as a
stream), so copies never meet in a shard.

Classes are dealt to shards by a prefix that few classes share: one turn, or,
where more than ``HOT`` classes share it, two, four, eight turns and so on, so a
very common beginning is spread over many shards. The nodes from that prefix
down then lie in one shard alone. A task gives the turns of its shards dense
ids, packs each shard's classes into a double array (``double_array.py``),
walks every class through it and sums up its nodes from the leaves. Nodes above
the shards' prefixes (the root and the beginnings of common prefixes) are seen
by many shards: each gives partial sums, which are merged by the prefix's hash
in Spark, summed over the shared tree, and then name the parents of the
shards' top nodes.

``saved_tokens`` of a subtree is a sum over its nodes, so a shared node's own
share is counted once, after the merge, and the shards' parts are added to it.

Defined cases: turns are ordered by turn number, null first, then by the hash of
role and text; a null role or text is empty; rows without conversation id belong
to no conversation. Repeated rows are turns of their own. Negative ids belong to
the next smaller multiple of 20. A conversation without turns ends at the root.
An empty table gives an empty result; other columns are ignored. A conversation
is a record: its turns' hashes (not their texts) have to fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.double_array import DoubleArray, build
from marketlens.llm.tables import maybe_broadcast, written

#: A prefix that more classes share is no shard's prefix.
HOT = 256
#: Turns in a shard, about.
SHARD_TURNS = 1 << 15
#: Conversations may take over the beginning of the one whose id is the next smaller multiple of this.
FAMILY = 20


def turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """conv_id and its turns in order: an array of (turn's hash, words of its text)."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    mark = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    words = F.regexp_count(said, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")
    one = F.struct(F.col(turn).isNotNull().alias("numbered"), F.col(turn).alias("at"), mark.alias("mark"), words.alias("words"))
    slim = conversations.where(F.col(key).isNotNull()).select(F.col(key).alias("conv_id"), one.alias("one"))
    return slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all")).select(
        "conv_id", F.transform("all", lambda t: F.struct(t["mark"].alias("mark"), t["words"].alias("words"))).alias("turns"))


def rebuilt(own: DataFrame, family: int = FAMILY) -> DataFrame:
    """Every conversation c with its first crc32(c) % 4 turns taken from conversation c - c % 20."""
    c = F.col("conv_id")
    head = F.crc32(c.cast("string").cast("binary")) % 4
    parent = c - F.pmod(c, F.lit(family))
    heads = own.where(F.pmod("conv_id", F.lit(family)) == 0).select(
        F.col("conv_id").alias("__parent"), F.slice("turns", 1, 3).alias("__turns"))
    both = own.withColumn("__h", head.cast("int")).join(heads, parent == F.col("__parent"), "left")
    begin = F.when(F.col("__turns").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("__turns", 1, F.col("__h")))
    rest = F.slice("turns", F.col("__h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(begin, rest).alias("turns"))


def _path(turns_col, upto=None):
    """The hash of a sequence, or of its first ``upto`` turns."""
    marks = F.transform(turns_col if upto is None else F.slice(turns_col, 1, upto), lambda t: F.hex(t["mark"]))
    return F.unhex(F.sha2(F.concat_ws(",", marks), 256))


def ends(paths: DataFrame) -> DataFrame:
    """path and the SHA-256 of its conversations' ids, ascending and comma-joined; input: path, conv_id.

    Ids are sorted over the cluster and joined to pieces of some 64 KB where
    they lie; then a path's pieces are hashed as a stream in their order, so a
    path of very many conversations holds one piece at a time.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, first, ids, n = None, None, [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([first], pa.int64()),
                                               pa.array([",".join(ids)])], names=["path", "first", "ids"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path is not None and (p != path or n > 1 << 16):
                    held.append(out())
                    path = None
                if path is None:
                    path, first, ids, n = p, c, [], 0
                ids.append(str(c))
                n += len(ids[-1]) + 1
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if path is not None:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for p, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p == path:
                    state.update(b",")
                else:
                    if path is not None:
                        done.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256()
                state.update(ids.encode())
            yield _ends(done)
        if path is not None:
            yield _ends([(path, state.hexdigest())])

    joined = (paths.select("path", F.col("conv_id").cast("bigint").alias("conv_id"))
              .repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
              .mapInArrow(pieces, "path binary, first bigint, ids string"))
    return (joined.repartition("path").sortWithinPartitions("path", "first").select("path", "ids")
            .mapInArrow(digests, "path binary, ends string"))


def _ends(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.binary()), pa.array([e for _, e in rows], pa.string())],
                                      names=["path", "ends"])


def classes(convs: DataFrame) -> DataFrame:
    """One row a distinct sequence: path, n, least id, turns, depth and the hash of its conversations' ids."""
    slim = written(convs.select("conv_id", "turns", _path(F.col("turns")).alias("path")), "rebuilt")
    one = slim.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
                                   F.min_by("turns", "conv_id").alias("turns"))
    return one.join(ends(slim), "path").select("*", F.size("turns").alias("depth"))


def cut(found: DataFrame, hot: int = HOT) -> DataFrame:
    """``classes`` with the length (``cut``) of the prefix that deals each to its shard.

    A class's cut is the first of 1, 2, 4, ... whose prefix at most ``hot``
    classes share; one that ends before gets ``depth + 1``: all its nodes are shared.
    """
    out, left, length = None, found, 1
    while True:
        at = left.withColumn("prefix", _path(F.col("turns"), length))
        long = at.where(F.col("depth") >= length)
        many = written(long.groupBy("prefix").count().where(F.col("count") > hot).select("prefix"), "hot-prefixes")
        n_hot = many.count()
        few = F.broadcast(many) if n_hot <= 100_000 else many
        cold = long.join(few, "prefix", "left_anti") if n_hot else long
        short = at.where(F.col("depth") < length)
        done = cold.withColumn("cut", F.lit(length)).unionByName(short.withColumn("cut", F.col("depth") + 1))
        out = done if out is None else out.unionByName(done)
        if not n_hot:
            return out
        left = written(long.join(few, "prefix", "left_semi").drop("prefix"), "hot-classes")
        length *= 2


NODE = ("conv_id bigint, depth int, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends string")
#: A task's row: a finished node, or (``path`` not null) what it knows of a shared node.
PART = NODE + ", path binary, above array<binary>, under binary, words bigint, tops bigint"


def _prefix_hash(marks: list[bytes], length: int) -> bytes:
    """What ``_path`` gives for the first ``length`` turns."""
    return hashlib.sha256(",".join(m.hex().upper() for m in marks[:length]).encode()).digest()


def shard_nodes(rows: list[dict]) -> list[dict]:
    """The nodes of some whole shards (classes of one or more prefixes): finished ones, and parts of shared ones."""
    every = sorted({t["mark"] for r in rows for t in r["turns"]})
    dense = {m: i for i, m in enumerate(every)}
    sequences = [np.array([dense[t["mark"]] for t in r["turns"]], dtype=np.int64) for r in rows]
    trie = build(sequences)
    nodes: dict[int, dict] = {}
    order: list[int] = []
    for r, ids in zip(rows, sequences):
        at, marks = 0, [t["mark"] for t in r["turns"]]
        for depth in range(len(ids) + 1):
            if depth:
                at = trie.child(at, int(ids[depth - 1]))
            node = nodes.get(at)
            if node is None:
                node = nodes[at] = {"depth": depth, "conv_id": r["least"], "n": 0, "kids": 0, "leaves": 0, "saved": 0, "tops": 0,
                                    "words": r["turns"][depth - 1]["words"] if depth else 0, "ends": None,
                                    "shared": depth < r["cut"], "marks": marks}
                order.append(at)
            node["conv_id"] = min(node["conv_id"], r["least"])
            node["n"] += r["n"]
        node["ends"] = r["ends"]
    out = []
    nothing = hashlib.sha256(b"").hexdigest()
    order.sort(key=lambda at: -nodes[at]["depth"])
    for at in order:  # from the leaves up
        node, parent = nodes[at], nodes[int(trie.check[at])]
        if not node["shared"]:
            node["leaves"] += not node["kids"]
            node["saved"] += (node["n"] - 1) * node["words"]
        if at:
            parent["kids"] += not node["shared"]
            if not node["shared"]:
                parent["leaves"] += node["leaves"]
                parent["saved"] += node["saved"]
                parent["tops"] += parent["shared"]
    for at in order:
        node, parent = nodes[at], nodes[int(trie.check[at])]
        row = {"conv_id": node["conv_id"], "depth": node["depth"], "n_convs": node["n"], "n_children": node["kids"],
               "n_leaves": node["leaves"], "saved_tokens": node["saved"], "ends": node["ends"], "parent_conv_id": None,
               "path": None, "above": None, "under": None, "words": None, "tops": None}
        if node["shared"]:
            chain = [_prefix_hash(node["marks"], d) for d in range(node["depth"] + 1)]
            row |= {"path": chain[-1], "above": chain, "words": node["words"], "tops": node["tops"],
                    "under": chain[-2] if at else None}
        elif parent["shared"]:
            row["under"] = _prefix_hash(node["marks"], node["depth"] - 1)
        else:
            row["parent_conv_id"] = parent["conv_id"]
        if not node["shared"]:
            row["ends"] = node["ends"] or nothing
        out.append(row)
    return out


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
                             "array<binary>": pa.list_(pa.binary())}[t]) for n, t in (c.split() for c in PART.split(", "))])
    held, size, last = [], 0, None
    for batch in batches:
        for row in batch.to_pylist():
            if size > SHARD_TURNS and row["prefix"] != last:  # only whole prefixes
                yield pa.RecordBatch.from_pylist(shard_nodes(held), schema)
                held, size = [], 0
            held.append(row)
            size, last = size + len(row["turns"]) + 1, row["prefix"]
    if held:
        yield pa.RecordBatch.from_pylist(shard_nodes(held), schema)


def nodes(dealt: DataFrame) -> DataFrame:
    """All nodes from ``cut``'s rows."""
    parts = written(dealt.select("prefix", "cut", "n", "least", "ends", "turns").repartition("prefix")
                    .sortWithinPartitions("prefix").mapInArrow(_tries, PART), "trie-parts")
    finished = parts.where("path is null")
    pieces = parts.where("path is not null")
    shared = written(pieces.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("tops").alias("tops"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.max("ends").alias("ends"), F.first("words").alias("words"), F.first("above").alias("above"),
        F.first("under").alias("under")), "shared-nodes")
    kids = shared.where("under is not null").groupBy(F.col("under").alias("path")).agg(F.count(F.lit(1)).alias("kids"))
    n_kids = F.col("tops") + F.coalesce("kids", F.lit(0))
    own = written(shared.join(kids, "path", "left").select(
        "path", "above", n_kids.alias("n_children"),
        (F.col("leaves") + F.when(n_kids == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved")), "shared-own")
    below = own.select(F.explode("above").alias("path"), "leaves", "saved").groupBy("path").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    # shared nodes are few unless beginnings are common; counted before they are broadcast
    named = maybe_broadcast(shared.select(F.col("path").alias("under"), F.col("conv_id").alias("above_conv_id")), 100_000)
    upper = (shared.select("path", "conv_id", "depth", "n_convs", "under", "ends")
             .join(own.select("path", "n_children"), "path").join(below, "path").join(named, "under", "left"))
    lower = finished.join(named, "under", "left")
    columns = ["conv_id", F.col("depth").cast("bigint").alias("depth")]
    rest = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    return upper.select(*columns, F.col("above_conv_id").alias("parent_conv_id"), *rest,
                        F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")).unionByName(
        lower.select(*columns, F.coalesce("parent_conv_id", "above_conv_id").alias("parent_conv_id"), *rest,
                     F.col("ends").alias("ends_sha256")))


def prefix_trie(conversations: DataFrame, family: int = FAMILY, hot: int = HOT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    own = written(turns(conversations), "own-turns")
    return nodes(cut(written(classes(rebuilt(own, family)), "classes"), hot))


__all__ = ["DoubleArray", "build", "classes", "cut", "ends", "nodes", "prefix_trie", "rebuilt", "shard_nodes", "turns"]
