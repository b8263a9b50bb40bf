"""Vectorised words, lines and hashes over blocks of whole texts.

The operators read texts in Arrow batches inside Spark tasks. A batch is cut
into blocks of at most ``BLOCK_BYTES`` of text (always whole rows), so memory
follows the block and the longest single text, never the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marketlens.llm.spanhash import Spans

BLOCK_BYTES = 1 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Block:
    """Texts of a few rows as one byte buffer; row r is ``buf[at[r]:at[r + 1]]``."""

    rows: pa.RecordBatch
    buf: np.ndarray
    at: np.ndarray

    @property
    def n(self) -> int:
        return self.rows.num_rows

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte range, equal for equal bytes; every eight bytes are mixed in, so no kind of text collides by its form."""
        return Spans(self.buf, start, end).keys()

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are flagged."""
        return np.diff(np.searchsorted(np.flatnonzero(flags), self.at))

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, start and end of every longest run of flagged bytes that stays in its row."""
        if not len(inside):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        new = np.zeros(len(inside), dtype=bool)
        new[self.at[:-1][self.at[:-1] < len(inside)]] = True
        before = np.zeros(len(inside), dtype=bool)
        before[1:] = inside[:-1]
        start = np.flatnonzero(inside & (~before | new))
        after = np.zeros(len(inside), dtype=bool)
        after[:-1] = inside[1:] & ~new[1:]
        end = np.flatnonzero(inside & ~after) + 1
        return np.searchsorted(self.at, start, side="right") - 1, start, end


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", lower: bool = False,
           limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Whole rows in blocks of about ``limit`` bytes of text; a null text counts as empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        every = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        row = 0
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
            stop = min(stop, len(texts))
            buf = every[at[row]:at[stop]]
            yield Block(batch.slice(row, stop - row), LOWER[buf] if lower else buf, at[row:stop + 1] - at[row])
            row = stop
    give_back()


def give_back() -> None:
    """Returns freed memory to the machine: a worker that waits for its next task keeps little."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def one_of_each(key: np.ndarray) -> np.ndarray:
    """The index of one element of every distinct key."""
    order = np.argsort(key)
    first = np.ones(len(key), dtype=bool)
    ordered = key[order]
    first[1:] = ordered[1:] != ordered[:-1]
    return order[first]


def windows(row: np.ndarray, word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word's index and hash of every ``k`` consecutive words of one row."""
    if len(word) < k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    first = np.flatnonzero(row[:len(row) - k + 1] == row[k - 1:])
    h = np.full(len(first), k, dtype=np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + word[first + j])
    return first, h


def with_columns(rows: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The rows with columns added, or put in the place of columns of that name."""
    names, arrays = list(rows.schema.names), list(rows.columns)
    for name, values in columns.items():
        values = values if isinstance(values, pa.Array) else pa.array(values)
        if name in names:
            arrays[names.index(name)] = values
        else:
            names.append(name)
            arrays.append(values)
    return pa.RecordBatch.from_arrays(arrays, names=names)
