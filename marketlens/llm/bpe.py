"""Byte-level BPE of whole texts by corpus-level merge replay.

Each Spark task holds a shard of the corpus. The shard's words not seen before
are gathered, each once, into one chain of symbols with an inverted index from
a pair's merged rank to its positions. The merges are then replayed in rank
order over all those words together: a merge visits just its listed positions
and only the touched neighbours get new entries. The texts are then looked up
word by word. Decoding is the inverse, from ids alone. Nothing is shuffled.

The result equals the tiktoken library's ``encode_ordinary``: a word that is a
vocabulary entry is one token; elsewhere the lowest rank goes first and, among
equal ranks, the leftmost; a new pair of a lower rank is merged before the
rest of the current rank.

Defined cases: a null or empty text has no tokens; repeated rows and ties get
equal results; other columns pass through (columns called ``ids`` or
``decoded`` are replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.decontaminate import expand
from marketlens.llm.textbatch import blocks, give_back

RANKS = "byte_bpe_multi_50k.tiktoken"
REPLAY_BYTES = 1 << 20  # of new words, and
SHARD_BYTES = 4 << 20  # of text: what a replay gathers at most
CACHE_WORDS = 500_000
CACHE_PAIRS = 500_000  # merged pairs that are remembered between replays
MANY = 48  # positions of a rank that are merged as arrays


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: a line for each token, base64 and rank."""
    rows = map(bytes.split, Path(path).read_bytes().splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in rows}


class Splitter:
    """The tokenizer's pattern for the ``re`` module, with its Unicode classes written as ranges.

    ``\\s`` is the Unicode property, as in the tokenizer's own library. Texts
    of the basic plane get a pattern without the ranges beyond it.
    """

    def __init__(self, pattern: str):
        self.basic = re.compile(self._translate(pattern, 0xFFFF)).findall
        self.every = re.compile(self._translate(pattern, 0x10FFFF)).findall

    @staticmethod
    def _translate(pattern: str, last: int) -> str:
        points = [c for c in range(last + 1) if not 0xD800 <= c <= 0xDFFF]
        text = "".join(map(chr, points))

        def ranges(name: str) -> str:
            runs = (m.span() for m in regex.finditer(f"{name}++", text))
            parts = []
            for low, high in runs:  # a run of neighbours in ``text`` may step over the surrogates
                ends = [(points[low], points[high - 1])]
                if ends[0][0] < 0xD800 and ends[0][1] > 0xDFFF:
                    ends = [(ends[0][0], 0xD7FF), (0xE000, ends[0][1])]
                parts += [f"\\U{a:08x}-\\U{b:08x}" for a, b in ends]
            return "".join(parts)

        out, inside = [], False
        for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.DOTALL):
            if part[:2] in ("\\p", "\\P", "\\s", "\\S"):
                named = {"\\s": r"\p{White_Space}", "\\S": r"\P{White_Space}"}.get(part, part)
                listed = ranges(named)
                out.append(listed if inside else f"[{listed}]")
            else:
                inside = part == "[" or inside and part != "]"
                out.append(part)
        return "".join(out)

    def __call__(self, text: str) -> list[str]:
        return (self.basic if len(text.encode("utf-16-le")) == 2 * len(text) else self.every)(text)


class Replay:
    """Ids of words, made for many words at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.merged: dict[int, int] = {}  # a pair's rank, -1 if none; key: left << 32 | right
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for byte {missing[0]}")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.byte_pair = np.full(1 << 16, -1, dtype=np.int64)
        for a in range(256):
            for b in range(256):
                self.byte_pair[a << 8 | b] = ranks.get(bytes([a, b]), -1)

    def rank_of(self, left: int, right: int) -> int:
        key = left << 32 | right
        rank = self.merged.get(key)
        if rank is None:
            rank = self.merged[key] = self.ranks.get(self.token[left] + self.token[right], -1)
        return rank

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids in order, and where each word's begin."""
        whole = [self.ranks.get(w, -1) for w in words]
        rest = [w for w, known in zip(words, whole, strict=True) if known < 0]
        ids, begin = self._replay(rest)
        count = np.ones(len(words), dtype=np.int64)
        missing = np.array(whole, dtype=np.int64) < 0
        count[missing] = np.diff(begin)
        at = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(count, out=at[1:])
        out = np.zeros(at[-1], dtype=np.int32)
        out[at[:-1][~missing]] = np.array(whole, dtype=np.int64)[~missing]
        out[expand(at[:-1][missing], at[1:][missing])[0]] = ids
        return out, at

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        begin = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(sizes, out=begin[1:])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        n = len(flat)
        if not n:
            return np.zeros(0, dtype=np.int32), begin
        following = np.arange(1, n + 1)
        following[begin[1:] - 1] = -1
        preceding = np.arange(-1, n - 1)
        preceding[begin[:-1]] = -1
        symbol = array("i", self.byte_id[flat].astype(np.int32).tobytes())
        after = array("i", following.astype(np.int32).tobytes())
        before = array("i", preceding.astype(np.int32).tobytes())

        # the inverted index: rank of a pair -> positions of its left symbol
        rank = np.full(n, -1, dtype=np.int64)
        rank[:-1] = self.byte_pair[flat[:-1] << 8 | flat[1:]]
        rank[following < 0] = -1
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        kinds, first = np.unique(rank[at], return_index=True)
        index = {int(k): array("i", part.astype(np.int32).tobytes())
                 for k, part in zip(kinds, np.split(at, first[1:]), strict=True)} if len(at) else {}
        turn = list(index)  # in rank order, hence a heap
        merged, rank_of = self.merged, self.rank_of

        def note(position: int, of: int) -> None:
            if of in index:
                index[of].append(position)
            else:
                index[of] = array("i", (position,))
                heapq.heappush(turn, of)

        symbols, afters, befores = (np.frombuffer(x, dtype=np.int32) for x in (symbol, after, before))

        def note_all(positions: np.ndarray, kinds: np.ndarray, of: np.ndarray) -> None:
            """Adds positions whose pair has the rank ``of[kind]``, where there is one."""
            some = of[kinds] >= 0
            positions, ranks = positions[some], of[kinds[some]]
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            edges = np.flatnonzero(np.diff(ranks, prepend=-1))
            if not len(edges):
                return
            for new, part in zip(ranks[edges].tolist(), np.split(positions, edges[1:]), strict=True):
                if new not in index:
                    index[new] = array("i")
                    heapq.heappush(turn, new)
                index[new].frombytes(part.astype(np.int32).tobytes())

        def merge_all(current: int, places: np.ndarray) -> bool:
            """All of a rank's merges at once; False, with nothing done, where their order matters."""
            p = places[(afters[places] >= 0) & (symbols[places] >= 0)]
            q = afters[p]
            pairs, kind = np.unique(symbols[p].astype(np.int64) << 32 | symbols[q], return_inverse=True)
            same = np.array([rank_of(x >> 32, x & 0xFFFFFFFF) == current for x in pairs.tolist()], dtype=bool)[kind]
            p, q = p[same], q[same]
            if len(np.intersect1d(p, q, assume_unique=True)):
                return False
            nxt, prv = afters[q], befores[p]
            p_right, p_left = p[nxt >= 0], p[prv >= 0]
            nxt, prv = nxt[nxt >= 0], prv[prv >= 0]
            # neighbours' symbols now; those that merge too become ``current``
            seen_right, seen_left = np.unique(symbols[nxt]).tolist(), np.unique(symbols[prv]).tolist()
            near = [rank_of(current, current), *(rank_of(current, x) for x in seen_right), *(rank_of(x, current) for x in seen_left)]
            if any(0 <= x <= current for x in near):
                return False
            full_nxt = afters[q]
            symbols[p], symbols[q] = current, -1
            afters[p], afters[q] = full_nxt, -1
            befores[nxt] = p_right
            right, kind = np.unique(symbols[nxt], return_inverse=True)
            note_all(p_right, kind, np.array([rank_of(current, x) for x in right.tolist()], dtype=np.int64))
            prv = befores[p_left]  # where the left neighbour merged, its symbol now begins there
            left, kind = np.unique(symbols[prv], return_inverse=True)
            note_all(prv, kind, np.array([rank_of(x, current) for x in left.tolist()], dtype=np.int64))
            return True

        while turn:
            current = heapq.heappop(turn)
            listed = index.pop(current)
            if len(listed) >= MANY:
                places = np.unique(np.frombuffer(listed, dtype=np.int32))
                if merge_all(current, places):
                    continue
                places = places.tolist()
            else:
                places = sorted(listed)
            for i, p in enumerate(places):
                q = after[p]
                left = symbol[p]
                if q < 0 or left < 0:
                    continue  # a neighbour's merge took it
                right = symbol[q]
                pair = merged.get(left << 32 | right)
                if (rank_of(left, right) if pair is None else pair) != current:
                    continue
                symbol[p] = current
                symbol[q] = -1
                nxt = after[p] = after[q]
                after[q] = -1
                soon = False
                if nxt >= 0:
                    before[nxt] = p
                    right = symbol[nxt]
                    new = merged.get(current << 32 | right)
                    if new is None:
                        new = rank_of(current, right)
                    if new >= 0:
                        note(p, new)
                        soon = new <= current
                prv = before[p]
                if prv >= 0:
                    left = symbol[prv]
                    new = merged.get(left << 32 | current)
                    if new is None:
                        new = rank_of(left, current)
                    if new >= 0:
                        note(prv, new)
                        soon = soon or new <= current
                if soon:  # a lower rank has come up: it goes before the rest of this one
                    for rest in places[i + 1:]:
                        note(rest, current)
                    break
        alive = symbols >= 0
        counts = np.add.reduceat(alive, begin[:-1]) if len(words) else begin[:0]
        out = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(counts, out=out[1:])
        return symbols[alive], out


class Encoder:
    """Encodes texts; keeps the ids of words already replayed, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_words: int = CACHE_WORDS):
        self.replay = Replay(ranks)
        self.find = Splitter(pattern)
        self.cache_words = cache_words
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.waiting: list[str] = []  # the last words with a number, not replayed yet
        self.ids, self.at = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Each word's number; new words get the next ones and wait for the replay."""
        for word in set(words).difference(self.number):
            self.number[word] = len(self.number)
            self.waiting.append(word)
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int32, count=len(words))

    def learn(self) -> None:
        """Replays the words that wait."""
        ids, at = self.replay.encode([w.encode() for w in self.waiting])
        self.waiting.clear()
        self.at = np.concatenate([self.at, at[1:] + self.at[-1]])
        self.ids = np.concatenate([self.ids, ids])
        if len(self.replay.merged) > CACHE_PAIRS:
            self.replay.merged.clear()

    def encode(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as words, and where each text's begin."""
        numbered = [self.numbers(words) for words in texts]
        self.learn()
        return self.look_up(numbered)

    def look_up(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as numbers of replayed words, and where each text's begin."""
        word = np.concatenate([np.zeros(0, dtype=np.int32), *texts])
        sizes = np.array([len(words) for words in texts], dtype=np.int64)
        low, high = self.at[word], self.at[word + 1]
        total = np.zeros(len(word) + 1, dtype=np.int64)
        np.cumsum(high - low, out=total[1:])
        ends = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(sizes, out=ends[1:])
        return self.ids[expand(low, high)[0]], total[ends]


def _vocabulary(path: str | None) -> dict[bytes, int]:
    return read_ranks(path or public_tokenizers.path(RANKS))


Pass = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoding(sent: Broadcast, names: list[str], text: str, column: str) -> Pass:
    """Batches with ``names`` and the ids of their texts; ``sent`` has the ranks and the pattern."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*sent.value)
        held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if encoder.waiting:
                encoder.learn()
            for rows, texts in held:
                ids, at = encoder.look_up(texts)
                listed = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*rows.select(names).columns, listed], names=[*names, column])
            held.clear()
            if len(encoder.number) > encoder.cache_words:
                encoder.clear()
            give_back()

        for block in blocks(batches, text):
            cells = block.rows.column(block.rows.schema.get_field_index(text))
            held.append((block.rows, [encoder.numbers(encoder.find(t.as_py() or "")) for t in cells]))
            size += len(block.buf)
            if sum(map(len, encoder.waiting)) >= REPLAY_BYTES or size >= SHARD_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    return run


def _decoding(sent: Broadcast, names: list[str], ids: str, column: str) -> Pass:
    """Batches with ``names`` and the bytes of their ids; ``sent`` has the ranks first."""
    limit = 1 << 19

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sorted((rank, token) for token, rank in sent.value[0].items())
        size = np.zeros(tokens[-1][0] + 1, dtype=np.int64)
        for rank, token in tokens:
            size[rank] = len(token)
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(token for _, token in tokens), dtype=np.uint8)
        for batch in batches:
            row = 0
            lists = batch.column(batch.schema.get_field_index(ids))
            counts = np.asarray(lists.value_lengths().fill_null(0))
            ends = np.cumsum(counts)
            while row < batch.num_rows:
                stop = max(row + 1, int(np.searchsorted(ends, ends[row] - counts[row] + limit, side="right")))
                part = np.asarray(lists.slice(row, stop - row).flatten()).astype(np.int64)
                if len(part) and (part.min() < 0 or part.max() >= len(size) or not size[part].all()):
                    raise ValueError("an id that isn't in the vocabulary")
                text = flat[expand(start[part], start[part] + size[part])[0]]
                total = np.zeros(len(part) + 1, dtype=np.int64)
                np.cumsum(size[part], out=total[1:])
                at = np.concatenate([[0], total[np.cumsum(counts[row:stop])]])
                decoded = pa.BinaryArray.from_buffers(
                    pa.binary(), stop - row, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(text.tobytes())])
                rows = batch.slice(row, stop - row).select(names)
                yield pa.RecordBatch.from_arrays([*rows.columns, decoded], names=[*names, column])
                row = stop

    return run


def _sent(docs: DataFrame, path: str | None, pattern: str | None) -> Broadcast:
    """The vocabulary, a file of fixed size, and the pattern."""
    return docs.sparkSession.sparkContext.broadcast((_vocabulary(path), pattern or public_tokenizers.PATTERN))


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None,
           column: str = "ids") -> DataFrame:
    """The rows with their whole text's token ids, an array of int."""
    names = [c for c in docs.columns if c != column]
    return docs.mapInArrow(_encoding(_sent(docs, path, pattern), names, text, column), T.StructType([
        *(docs.schema[c] for c in names), T.StructField(column, T.ArrayType(T.IntegerType()))]))


def decode(coded: DataFrame, ids: str = "ids", path: str | None = None, column: str = "decoded") -> DataFrame:
    """The rows with the bytes that their ids stand for; a null list counts as empty, an unknown id is an error."""
    names = [c for c in coded.columns if c != column]
    return coded.mapInArrow(_decoding(_sent(coded, path, None), names, ids, column), T.StructType([
        *(coded.schema[c] for c in names), T.StructField(column, T.BinaryType())]))


def round_trip(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None,
               ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows as ``decode(encode(docs))`` gives them, in one pass of one worker a task."""
    sent = _sent(docs, path, pattern)
    names = [c for c in docs.columns if c not in (ids, decoded)]
    first, then = _encoding(sent, names, text, ids), _decoding(sent, [*names, ids], ids, decoded)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(first(batches))

    return docs.mapInArrow(run, T.StructType([
        *(docs.schema[c] for c in names), T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.BinaryType())]))


def ids_digest(ids: str = "ids"):
    """Hex sha-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256)
