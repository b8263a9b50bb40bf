"""Benchmark decontamination with an FM-index for each training shard.

A shard is a run of whole texts in one Spark task. Its words become symbols
(the test phrases' vocabulary; every stretch of other words is one break), a
wavelet-matrix FM-index is built over them, all test windows are searched
backwards, occurrences are located by sampled suffix positions, and the hit
words are merged into removal spans. Nothing is shuffled: rows keep their
partition, so a lost task is simply run again.

Test phrases are taken in blocks of at most ``block_bytes`` of text; each
block is broadcast on its own, with the rows written to the shared folder in
between, so the broadcast is bounded for any size of the benchmark.

Defined cases: words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.
An item of fewer than ``size`` words is one window, an item without words (or
a null text or id) has none. A null or empty document has no words and no
hits; repeated rows get equal results; other columns pass through; an empty
benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.fm_index import FMIndex
from marketlens.llm.tables import written
from marketlens.llm.textbatch import ALNUM, Block, blocks, one_of_each, windows

#: A shard ends at so many words or bytes of text, whichever comes first, with whole texts.
SHARD_WORDS = 1 << 18
SHARD_BYTES = 4 << 20
LEAK = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("first", T.ArrayType(T.LongType())),
    T.StructField("stop", T.ArrayType(T.LongType())),
])


@dataclass
class Phrases:
    """Windows of a block of test items, as rows of symbols by length."""

    vocabulary: np.ndarray  # sorted word hashes; symbol i + 1 is vocabulary[i]
    by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # phrases, where their items begin, items
    ids: list[str]

    @classmethod
    def of(cls, items: list[tuple[str, str]], size: int) -> Phrases:
        batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in items], pa.large_string())], names=["text"])
        rows, words = [], []
        done = 0
        for block in blocks([batch], lower=True):
            row, start, end = block.runs(ALNUM[block.buf])
            rows.append(row + done)
            words.append(block.hashes(start, end))
            done += block.n
        row = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        word = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
        vocabulary, symbol = np.unique(word, return_inverse=True)
        symbol = symbol.astype(np.int64) + 1
        count = np.bincount(row, minlength=len(items)) if len(row) else np.zeros(len(items), dtype=np.int64)
        begin = np.zeros(len(items) + 1, dtype=np.int64)
        np.cumsum(count, out=begin[1:])
        out = []
        for length in [*(m for m in np.unique(count) if 0 < m < size), size]:
            if length == size:
                first, h = windows(row, word, size)
            else:
                first = begin[:-1][count == length]
                _, h = windows(np.zeros(len(first) * length, dtype=np.int64),
                               word[(first[:, None] + np.arange(length)).ravel()], int(length))
                h = h[::length]
            if not len(first):
                continue
            kinds, kind = np.unique(h, return_inverse=True)
            lead = np.zeros(len(kinds), dtype=np.int64)
            lead[kind] = first
            pair = np.unique(kind.astype(np.int64) * len(items) + row[first])
            at = np.searchsorted(pair // len(items), np.arange(len(kinds) + 1))
            out.append((symbol[lead[:, None] + np.arange(length)], at, pair % len(items)))
        return cls(vocabulary, out, [i for i, _ in items])

    def symbols(self, words: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [low, high), and the range each comes from."""
    size = high - low
    of = np.repeat(np.arange(len(low)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + low[of], of


def _search(row: np.ndarray, word: np.ndarray, phrases: Phrases, at_once: int = 1 << 18,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Change in the number of covering occurrences at each word, and distinct (row, item)."""
    cover = np.zeros(len(word) + 1, dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    symbol = phrases.symbols(word)
    edge = np.ones(len(word), dtype=bool)  # the row's first word
    edge[1:] = row[1:] != row[:-1]
    # one break before each row and for each stretch of other words
    other = symbol == 0
    dull = np.zeros(len(word), dtype=bool)
    dull[1:] = other[1:] & other[:-1] & ~edge[1:]
    kept = np.flatnonzero(~dull)
    extra = np.cumsum(edge[kept] & (symbol[kept] != 0))
    place = np.arange(len(kept)) + extra
    text = np.zeros(len(kept) + (int(extra[-1]) if len(kept) else 0) + 1, dtype=np.int64)
    text[place] = symbol[kept]
    if not text.any():
        return cover, none, none
    word_at = np.zeros(len(text), dtype=np.int64)
    word_at[place] = kept
    index = FMIndex.build(text, len(phrases.vocabulary))
    pairs = []
    for phrase, begin, items in phrases.by_length:
        which, low, high = index.search(phrase)
        done = np.concatenate([[0], np.cumsum(high - low)])
        start = 0
        while start < len(which):  # a bounded number of occurrences at a time, at least one phrase's
            stop = max(start + 1, int(np.searchsorted(done, done[start] + at_once, side="right")) - 1)
            slots, of = expand(low[start:stop], high[start:stop])
            first = word_at[index.locate(slots)]
            np.add.at(cover, first, 1)
            np.add.at(cover, first + phrase.shape[1], -1)
            # each phrase once for a row, then its items
            hit = one_of_each(row[first] * len(phrase) + which[start:stop][of])
            at_row, kind = row[first[hit]], which[start:stop][of[hit]]
            listed, source = expand(begin[kind], begin[kind + 1])
            pair = at_row[source] * len(phrases.ids) + items[listed]
            pairs.append(pair[one_of_each(pair)])
            start = stop
    if not pairs:
        return cover, none, none
    pair = np.unique(np.concatenate(pairs))
    return cover, pair // len(phrases.ids), pair % len(phrases.ids)


def _shard(parts: list[tuple[Block, np.ndarray, np.ndarray]], phrases: Phrases, names: list[str], merge: bool,
           ) -> Iterator[pa.RecordBatch]:
    rows = np.cumsum([0, *(b.n for b, _, _ in parts)])
    row = np.concatenate([r + at for (_, r, _), at in zip(parts, rows, strict=False)])
    word = np.concatenate([w for _, _, w in parts])
    cover, hit_row, hit_item = _search(row, word, phrases)
    n_words = np.bincount(row, minlength=rows[-1])
    first_word = np.zeros(rows[-1] + 1, dtype=np.int64)
    np.cumsum(n_words, out=first_word[1:])
    found = [[] for _ in range(rows[-1])]
    for r, i in zip(hit_row.tolist(), hit_item.tolist(), strict=True):
        found[r].append(phrases.ids[i])
    if merge:  # what earlier blocks of test items have found
        earlier = [x for b, _, _ in parts for x in b.rows.column(b.rows.schema.get_field_index("__leak")).to_pylist()]
        for r, x in enumerate(earlier):
            found[r] = sorted({*found[r], *x["items"]})
            np.add.at(cover, first_word[r] + np.array(x["first"], dtype=np.int64), 1)
            np.add.at(cover, first_word[r] + np.array(x["stop"], dtype=np.int64), -1)
    hit = np.cumsum(cover)[:len(row)] > 0
    edge = np.ones(len(row), dtype=bool)
    edge[1:] = row[1:] != row[:-1]
    before, after = np.zeros(len(row), dtype=bool), np.zeros(len(row), dtype=bool)
    before[1:], after[:-1] = hit[:-1], hit[1:]
    first = np.flatnonzero(hit & (~before | edge))
    stop = np.flatnonzero(hit & (~after | np.append(edge[1:], True))) + 1
    spans = np.searchsorted(first, first_word)
    n_hit = np.bincount(row[hit], minlength=rows[-1])
    for (block, _, _), a in zip(parts, rows, strict=False):
        b = a + block.n
        at = pa.array((spans[a:b + 1] - spans[a]).astype(np.int32))
        inner = slice(spans[a], spans[b])
        base = first_word[row[first[inner]]] if len(row) else first[inner]
        leak = pa.StructArray.from_arrays([
            pa.array(n_words[a:b].astype(np.int64)), pa.array(n_hit[a:b].astype(np.int64)),
            pa.array([sorted(set(x)) for x in found[a:b]], pa.list_(pa.string())),
            pa.ListArray.from_arrays(at, pa.array(first[inner] - base)),
            pa.ListArray.from_arrays(at, pa.array(stop[inner] - base)),
        ], names=LEAK.names)
        yield pa.RecordBatch.from_arrays([*block.rows.select(names).columns, leak], names=[*names, "__leak"])


def _phrase_blocks(items: DataFrame, size: int, text: str, key: str, block_bytes: int) -> Iterator[Phrases]:
    """Phrases of items in blocks of bounded text; the driver never holds more than one."""
    held, n = [], 0
    rows = items.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("string"), text)
    for item, words in rows.toLocalIterator():
        held.append((item, words))
        n += len(words)
        if n >= block_bytes:
            yield Phrases.of(held, size)
            held, n = [], 0
    if held:
        yield Phrases.of(held, size)


def find(docs: DataFrame, items: DataFrame, size: int = 10, text: str = "text", item_text: str = "text",
         item_key: str = "item_id", block_bytes: int = 8 << 20, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows with ``__leak``: n_words, n_hit, items hit, and merged spans of word numbers [first, stop)."""
    names = docs.columns
    found: DataFrame | None = None
    for phrases in _phrase_blocks(items, size, item_text, item_key, block_bytes):
        source = docs if found is None else written(found, "leaks")
        found = _find_block(source, phrases, names, found is not None, text, shard_words)
    return _find_block(docs, Phrases.of([], size), names, False, text, shard_words) if found is None else found


def _finder(sent, names: list[str], merge: bool, text: str, most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n, size = [], 0, 0
        for block in blocks(batches, text, lower=True):
            row, start, end = block.runs(ALNUM[block.buf])
            parts.append((block, row, block.hashes(start, end)))
            n, size = n + len(row), size + len(block.buf)
            if n >= most or size >= SHARD_BYTES:
                yield from _shard(parts, sent.value, names, merge)
                parts, n, size = [], 0, 0
        if parts:
            yield from _shard(parts, sent.value, names, merge)
    return run


def _find_block(docs: DataFrame, phrases: Phrases, names: list[str], merge: bool, text: str, most: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(phrases)
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("__leak", LEAK)])
    return docs.mapInArrow(_finder(sent, names, merge, text, most), schema)


def _cutter(names: list[str], text: str):
    at = names.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, lower=True):
            column = block.rows.column(block.rows.schema.get_field_index(text))
            leak = block.rows.column(block.rows.schema.get_field_index("__leak"))
            texts = column.to_pylist()
            row, start, end = block.runs(ALNUM[block.buf])
            first = np.searchsorted(row, np.arange(block.n + 1))
            for r, x in enumerate(leak.to_pylist()):
                if x["first"]:
                    raw, out, last = texts[r].encode(), [], 0
                    stop_at = np.append(start[first[r]:first[r + 1]] - block.at[r], len(raw))
                    for a, b in zip(x["first"], x["stop"], strict=True):
                        out.append(raw[last:stop_at[a]])
                        last = int(stop_at[b])
                    texts[r] = b"".join([*out, raw[last:]]).decode()
            arrays = list(block.rows.select(names).columns)
            arrays[at] = pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def cut(found: DataFrame, text: str = "text") -> DataFrame:
    """``find``'s rows with the hit words taken out of the text, up to the next word; others as they were."""
    names = [c for c in found.columns if c != "__leak"]
    return found.mapInArrow(_cutter(names, text), T.StructType([found.schema[c] for c in names]))


def remove(docs: DataFrame, items: DataFrame, size: int = 10, text: str = "text", item_text: str = "text",
           item_key: str = "item_id", block_bytes: int = 8 << 20, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``cut(find(...))``, with the last block of test items searched and cut in one pass of one worker."""
    names = docs.columns
    source, waiting, merge = docs, None, False
    for phrases in _phrase_blocks(items, size, item_text, item_key, block_bytes):
        if waiting is not None:
            source, merge = written(_find_block(source, waiting, names, merge, text, shard_words), "leaks"), True
        waiting = phrases
    sent = docs.sparkSession.sparkContext.broadcast(Phrases.of([], size) if waiting is None else waiting)
    search, trim = _finder(sent, names, merge, text, shard_words), _cutter(names, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from trim(search(batches))

    return source.mapInArrow(run, T.StructType([docs.schema[c] for c in names]))
