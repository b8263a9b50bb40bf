"""Training-order materialisation of token sequences as fixed-stride shards.

Each text's tokens and an end mark are cut into sequences of ``stride``
tokens. Sequences are counted by run of rows (a split of a file, or a partition), which numbers them 0 to N - 1
without a sort, in the order of files and of rows in them, whatever the splits; a keyed Feistel permutation of the next power of four, walked
until it falls below N, gives each its global slot. A task packs its sequences
by shard (a range of slots) and each pack goes straight to its shard's
partition, where slot s is put at ``(s - first) * stride`` tokens of the file;
a reader can begin or resume at any slot. A task holds one shard at a time.

The payload is shuffled once, compressed, and never collected. A shard's file is written
under a temporary name and renamed, so readers never see a part of one and a
repeated task puts the same bytes in its place. Should the input's partitions
change between the count and the write, the task that sees it fails, and both
are done again on a written copy of the input.

``order`` names the file and the split's begin in it (``IN_FILES``). Rows that aren't read from
files have none: their runs are Spark's partitions.

Tokens are the UTF-8 bytes of a text (one byte each; the end mark and padding
are 255, which UTF-8 never has) or the ids of an array column (as little-endian
numbers of ``width`` bytes; the end mark and padding are the largest number).

Defined cases: a null or empty text (or list) has no sequence; repeated rows
have sequences of their own; null ids of documents pass through; other columns
are ignored; an empty table writes no shard.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.tables import written

STRIDE = 512
SHARD_SEQUENCES = 1 << 15
ROUNDS = 4
#: The file of a row and the begin of the split it is read in; a split is read by one task, in the file's order.
IN_FILES = ("_metadata.file_path", "_metadata.file_block_start")
_LOW32 = np.uint64(0xFFFFFFFF)


def round_keys(key: int) -> list[int]:
    """A 32-bit key for each round."""
    return [(key * 0x9E3779B1 + (i + 1) * 0x85EBCA77) & 0xFFFFFFFF for i in range(ROUNDS)]


def half_bits(n: int) -> int:
    """Bits of each half of the smallest balanced domain that holds ``n`` numbers."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of sequence numbers below ``n``: a permutation chosen by ``key``."""
    half = np.uint64(half_bits(n))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for k in round_keys(key):
            h = (right * np.uint64(0x9E3779B1) + np.uint64(k)) & _LOW32
            h ^= h >> np.uint64(15)
            h = h * np.uint64(0x85EBCA77) & _LOW32
            h ^= h >> np.uint64(13)
            left, right = right, left ^ (h & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(n)]  # cycle-walking: again until it falls inside
    return out.astype(np.int64)


def _tokens(batch: pa.RecordBatch, column: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a batch as raw bytes, and each row's number of tokens."""
    cells = batch.column(column)
    if pa.types.is_list(cells.type):
        counts = np.asarray(pc.fill_null(pc.list_value_length(cells), 0)).astype(np.int64)
        ids = np.asarray(cells.flatten()).astype(f"<u{width}")
        return ids.view(np.uint8), counts
    cells = pc.fill_null(cells, "").cast(pa.large_binary())
    _, at, data = cells.buffers()
    at = np.frombuffer(at, dtype=np.int64)[cells.offset:cells.offset + len(cells) + 1]
    every = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return every[at[0]:at[-1]], np.diff(at)


def _slices(batches: Iterable[pa.RecordBatch], column: int, width: int, limit: int = 4 << 20,
            ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in slices of bounded tokens."""
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            rows = batch.slice(low, 512)
            yield rows, *_tokens(rows, column, width)


def _numbered(named: DataFrame, column: str, stride: int, width: int) -> tuple[DataFrame, dict[int, int], dict[int, int], int]:
    """The rows with a number for their run; each run's first sequence and number of sequences; and all sequences' number.

    A run's number is a hash of its file and begin; another seed is taken should two runs share one.
    """
    listed = isinstance(named.schema["tokens"].dataType, T.ArrayType)
    if not listed and width != 1:
        raise ValueError("texts have tokens of one byte")
    n = F.size("tokens") if listed else F.octet_length("tokens")
    parts = F.when(n > 0, F.ceil((n + 1) / F.lit(stride))).otherwise(0)
    for seed in range(8):
        run = F.xxhash64(F.lit(seed), "file", "begin")
        # a number for each split of a file, not for each row, comes to the driver
        runs = named.groupBy("file", "begin", run.alias("run")).agg(F.sum(parts).alias("n")).collect()
        if len({r["run"] for r in runs}) == len(runs):
            break
    offsets, total = {}, 0
    for r in sorted(runs, key=lambda r: (r["file"], r["begin"])):
        offsets[r["run"]] = total
        total += r["n"]
    return named.select("doc_id", "tokens", run.alias("run")), offsets, {r["run"]: r["n"] for r in runs}, total


def sequences(docs: DataFrame, column: str = "text", key: str = "doc_id", stride: int = STRIDE, width: int = 1,
              seed: int = 1, per_shard: int = SHARD_SEQUENCES, order: tuple[str, str] | None = None) -> tuple[DataFrame, int]:
    """Packs of sequences of one shard (slots, ids, parts, token counts, compressed payload), and the sequences' number."""
    named = docs.select(F.col(key).alias("doc_id"), F.col(column).alias("tokens"),
                        *(F.col(c).alias(n) for c, n in zip(order or (), ("file", "begin"), strict=False)))
    named = named if order else named.select("*", F.lit("").alias("file"), F.spark_partition_id().alias("begin"))
    source, offsets, counted, total = _numbered(named, column, stride, width)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[int, int] = {}  # sequences of each run so far
        for rows, raw, counts in _slices(batches, 1, width):
            number = np.where(counts > 0, -(-(counts + 1) // stride), 0)
            row = np.repeat(np.arange(rows.num_rows), number)
            part = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            payload = np.full(len(row) * stride * width, 255, dtype=np.uint8)
            first = (np.cumsum(number) - number) * stride
            move = np.repeat((first - (np.cumsum(counts) - counts)) * width, counts * width)
            payload[np.arange(len(raw)) + move] = raw
            if not len(row):
                continue
            index = np.empty(len(row), dtype=np.int64)
            runs = rows.column(2).to_numpy()[row]
            at = np.flatnonzero(np.append(True, runs[1:] != runs[:-1])[:len(runs)])
            for low, high in zip(at, [*at[1:], len(runs)], strict=True):
                mine = int(runs[low])
                have = done.get(mine, 0)
                done[mine] = have + int(high - low)
                if done[mine] > counted.get(mine, 0):
                    raise RuntimeError(CHANGED)
                index[low:high] = np.arange(high - low) + offsets[mine] + have
            slot = feistel(index, total, seed)
            shard = slot // per_shard
            order = np.argsort(shard, kind="stable")
            edges = np.flatnonzero(np.diff(shard[order], prepend=-1))
            at = pa.array(np.append(edges, len(order)).astype(np.int32))
            packs = payload.reshape(len(row), stride * width)[order]
            packed = [pa.compress(packs[low:high].tobytes(), codec="zstd", asbytes=True)
                      for low, high in zip(edges, [*edges[1:], len(order)], strict=True)]
            row, part = row[order], part[order]
            lists = (pa.array(slot[order]), rows.column(0).take(pa.array(row)), pa.array(part),
                     pa.array(np.minimum(stride, counts[row] + 1 - part * stride)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[order][edges].astype(np.int32)), *(pa.ListArray.from_arrays(at, x) for x in lists),
                 pa.array(packed, pa.binary())], names=schema.names)
        if any(n != counted[mine] for mine, n in done.items()):
            raise RuntimeError(CHANGED)

    id_type = source.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("slot", T.ArrayType(T.LongType())),
        T.StructField("doc_id", T.ArrayType(id_type)), T.StructField("part", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())])
    return source.mapInArrow(run, schema), total


CHANGED = "the input's partitions changed after the count"


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def _write(packs: DataFrame, folder: str, total: int, per_shard: int, size: int) -> DataFrame:
    """Writes each shard's file; a manifest row for each sequence, by slot."""
    id_type = packs.schema["doc_id"].dataType.elementType
    schema = T.StructType([
        T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("doc_id", id_type),
        T.StructField("part", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[int, np.ndarray] = {}  # one, as a partition is a shard
        entries: dict[int, list[pa.Table]] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                shard = batch.column(0)[r].as_py()
                first = shard * per_shard
                if shard not in files:
                    files[shard] = np.empty((min(per_shard, total - first), size), dtype=np.uint8)
                    entries[shard] = []
                slot, doc_id, part, n_tokens = (batch.column(c)[r].values for c in range(1, 5))
                data = pa.decompress(batch.column(5)[r].as_buffer(), decompressed_size=len(slot) * size, codec="zstd")
                files[shard][slot.to_numpy() - first] = np.frombuffer(data, dtype=np.uint8).reshape(len(slot), size)
                entries[shard].append(pa.table([slot, doc_id, part, n_tokens], names=["slot", "doc_id", "part", "n_tokens"]))
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for shard, rows in files.items():
            mark = f"{root}/part-{uuid.uuid4().hex}"
            with system.open_output_stream(mark) as stream:
                stream.write(rows)
            system.move(mark, f"{root}/{shard_name(shard)}")
            listed = pa.concat_tables(entries[shard]).sort_by("slot")
            offset = (listed["slot"].to_numpy() - shard * per_shard) * size
            whole = pa.table([listed["slot"], pa.array(np.full(len(offset), shard, dtype=np.int32)), listed["doc_id"],
                              listed["part"], listed["n_tokens"], pa.array(offset)], names=schema.names)
            yield from whole.combine_chunks().to_batches()

    n_shards = max(1, -(-total // per_shard))
    return packs.repartitionById(n_shards, F.col("shard")).mapInArrow(run, schema)


def materialise(docs: DataFrame, folder: str, column: str = "text", key: str = "doc_id", stride: int = STRIDE,
                width: int = 1, seed: int = 1, per_shard: int = SHARD_SEQUENCES, order: tuple[str, str] | None = None) -> DataFrame:
    """Writes all shards under ``folder`` (a URI that every executor reaches); returns the written manifest.

    The manifest has slot, shard, doc_id, part, n_tokens and the byte offset in the shard's file.
    """
    spark = docs.sparkSession
    for attempt in range(2):
        rows, total = sequences(docs, column, key, stride, width, seed, per_shard, order)
        manifest = _write(rows, folder, total, per_shard, stride * width)
        path = f"{folder.rstrip('/')}/manifest-{attempt}"
        try:
            manifest.write.mode("overwrite").parquet(path)
            if spark.read.schema(manifest.schema).parquet(path).count() != total:  # a counted run that no task saw
                raise RuntimeError(CHANGED)
            break
        except Exception as failed:
            if CHANGED not in str(failed) or attempt:
                raise
            # rows of a shuffle, say, whose partitions are made anew each time: a written table's stay
            docs, order = written(docs.select(key, column), "sequences"), IN_FILES
    return spark.read.schema(manifest.schema).parquet(path)


def read(folder: str, first: int, n: int, stride: int = STRIDE, width: int = 1, per_shard: int = SHARD_SEQUENCES) -> np.ndarray:
    """Up to ``n`` sequences from slot ``first`` on, a row each; sequential, so a reader resumes at any slot."""
    system, root = fs.FileSystem.from_uri(folder)
    out = []
    while n > 0:
        shard, inside = divmod(first, per_shard)
        info = system.get_file_info(f"{root}/{shard_name(shard)}")
        have = 0 if info.type == fs.FileType.NotFound else info.size // (stride * width) - inside
        take = min(n, have)
        if take <= 0:
            break
        with system.open_input_file(f"{root}/{shard_name(shard)}") as f:
            data = f.read_at(take * stride * width, inside * stride * width)
        out.append(np.frombuffer(data, dtype=f"<u{width}").reshape(take, stride))
        first, n = first + take, n - take
    return np.concatenate(out) if out else np.zeros((0, stride), dtype=f"<u{width}")
