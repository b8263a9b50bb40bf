"""Language-model scores by online logistic context mixing, beside a word-count baseline.

Shards: texts are dealt to shards of bounded text, tokens and contexts, and written once, compressed, in buckets of
shards. A shard gives out, for each of several contexts (the last three and four bytes; the word so far) and for words,
how often its training texts have each (context, next byte), and the contexts that only its other texts have.
These are sorted numbers by ranges of hashed contexts, packed as differences; they are shuffled once and not written.

Training: a range's task adds up the counts of all shards, so the model grows with what was read and no context shares
a row with another. Bytes are coded by the bits of a Huffman code of the
training bytes, which needs about half of the eight plain bits; a context's
counts become one bit predictor for each inner node of that code's tree, kept
as a stretched probability (log-odds) if it isn't 0. The same task answers every shard with what is
known of the shard's contexts and tokens, in their order: a shard has them in its texts, so they aren't sent back, and
the answers come to the texts' buckets. A hot context or token has one number a shard; a range is 32 MB of
the text's contexts, so ranges grow in number, not in size, and a task holds one range or what one shard needs.

Scoring: a text is coded bit by bit, after the bits before. A shard's distinct (contexts, next byte) are
looked up once, and their bits are put in a row for each text. The predictors'
log-odds are combined with the weights of a gate (whether a word is under
way); after each ``STEP`` bits of a gate its weights are refined by the gradient of
the coding cost in that text. All texts of a block move in step, so the work
is array operations; a shard's texts are scored by falling length, so the long
ones are in blocks of their own. A text's score depends on nothing but the
text and the model. The score counts an end mark (byte 0).

Baseline: the words of a text and its end, by the corpus counts of the shard's
tokens. Every range answers every shard with its number of tokens and of distinct ones; a shard adds these up.

Defined cases: A-Z are lower-cased; a null text counts as empty and has one
token, the end; a null id is training data; repeated rows are scored alike and
each counts; with no training rows the model is uniform (8 bits a byte) until
it adapts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketlens.llm.decontaminate import expand
from marketlens.llm.tables import bucketed, written
from marketlens.llm.textbatch import NOT_SPACE, Block, blocks, mix

CONTEXTS = ("last3", "last4", "word")
TOKEN = len(CONTEXTS)  # the kind of a shard's tokens, beside those of contexts
HASHED = {2: 56, TOKEN: 64}  # kinds whose keys are hashes, and their bits
SLOT_BITS = (15, 17, 18)  # slots of each kind in a plain table of hashed contexts, which scoring takes also
SYMBOLS = 256  # every byte; their code's tree has 255 nodes
RANGE_BYTES = 32 << 20  # training text for each range of contexts
DENSE = 1 << 18  # contexts whose predictors are spread out at a time
SPREAD = 1 << 16  # contexts whose counts become log-odds at a time
STEP = 128
PLACES, FEW_PLACES = 1 << 17, 1 << 14  # distinct places whose bits are coded at a time, and places whose bits are put in a row
POWERS = 1 << 21  # kept for blocks below this size
RATE, START, SCALE = 0.006, 0.4, 16
SHARD_KEYS = 12 << 20  # keys, as estimated from samples of a shard's blocks
SHARD_BYTES = 32 << 20
MIXED_BYTES = 15 << 17  # text of a block that is scored; with its zeros it is below POWERS
STREAMS = 1 << 9  # mixed in step
SAMPLE = 32, 1 << 10  # slices of a block, and bytes of each, that its keys are estimated from
BUCKET_BYTES = 4 << 20  # training text for each bucket of shards
MOST_BUCKETS = 50_000  # a bucket then has more shards, one after the other
END = np.uint64(0x5851F42D4C957F2D)  # the end token's hash


def _order(x: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers from 0; sorting numbers with their places takes a third of np.argsort's time."""
    n = max(1, len(x) - 1).bit_length()
    if int(x.max(initial=0)) >> (63 - n):
        return np.argsort(x, kind="stable")
    return np.sort(x << n | np.arange(len(x))) & ((1 << n) - 1)


class Code:
    """A Huffman code of bytes: for each byte, the tree nodes on its way and the bits taken there.

    Contexts predict every node. Symbols are the bytes by falling frequency.
    """

    def __init__(self, counts: np.ndarray):
        weight = counts.astype(np.int64) + 1  # bytes never seen have a code too
        order = np.argsort(-weight, kind="stable")
        self.symbol = np.empty(256, dtype=np.int64)
        self.symbol[order] = np.arange(SYMBOLS)
        self.byte = order  # of each symbol
        of, self.children = self._tree(weight[order].tolist())
        ways = [of[symbol] for symbol in self.symbol]
        self.at = np.cumsum([0, *map(len, ways)])
        self.node = np.array([n for way in ways for n, _ in way], dtype=np.int64)
        self.sign = np.array([1 - 2 * b for way in ways for _, b in way], dtype=np.int8)  # 1 for a bit 0

    @staticmethod
    def _tree(weights: list[int]) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int]]]:
        """Each symbol's way, as (node, bit), and each node's children: symbols, then n + node."""
        n = len(weights)
        heap = [(w, s) for s, w in enumerate(weights)]
        heapq.heapify(heap)
        children = []
        while len(heap) > 1:
            (w, low), (v, high) = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (w + v, n + len(children)))
            children.append((low, high))
        ways: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        todo: list[tuple[int, list[tuple[int, int]]]] = [(len(children) - 1, [])]
        while todo:
            node, way = todo.pop()
            for bit, child in enumerate(children[node]):
                if child < n:
                    ways[child] = [*way, (node, bit)]
                else:
                    todo.append((child - n, [*way, (node, bit)]))
        return ways, children

    def odds(self, row: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, node and scaled log-odds of bit 1, where not 0, from counts ``n`` of a row's symbols; by row and node."""
        byte = self.byte[symbol]
        step, of = expand(self.at[byte], self.at[byte + 1])
        at = row[of] * SYMBOLS + self.node[step]
        order = _order(at)
        at, n = at[order], n[of][order]
        zero = np.where(self.sign[step][order] > 0, n, 0)
        edge = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)])
        if not len(edge):
            return at, at, np.zeros(0, dtype=np.int8)
        every, zero = np.add.reduceat(n, edge), np.add.reduceat(zero, edge)
        odds = np.clip(np.rint(np.log((every - zero + 0.4) / (zero + 0.4)) * SCALE), -127, 127).astype(np.int8)
        keep = np.flatnonzero(odds)
        at = at[edge[keep]]
        return at >> 8, at & 255, odds[keep]

    def stretch(self, counts: np.ndarray) -> np.ndarray:
        """Scaled log-odds of bit 1 at each node (columns) from the symbol counts of each context (rows)."""
        row, symbol = np.nonzero(counts)
        out = np.zeros((len(counts), SYMBOLS), dtype=np.int8)
        row, node, odds = self.odds(row, symbol, counts[row, symbol])
        out[row, node] = odds
        return out


def held_out(key: str) -> Column:
    """Texts that aren't learned from: crc32 of the id as text, modulo 5, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 1, F.lit(False))


def layout(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's texts with four zeros before and one, the end mark, after; first places and lengths with the end."""
    size = np.diff(block.at)
    begin = np.cumsum(size + 5) - size - 1
    flat = np.zeros(int((size + 5).sum()), dtype=np.uint8)
    flat[np.arange(len(block.buf)) + np.repeat(begin - block.at[:-1], size)] = block.buf
    return flat, begin, size + 1


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    odd = 0x9E3779B97F4A7C15
    return tuple(np.cumprod(np.full(n, x, dtype=np.uint64)) for x in (odd, pow(odd, -1, 1 << 64)))


class Before:
    """What is before each place of a block: the last four bytes, and the word so far (since the last space or text start)."""

    def __init__(self, flat: np.ndarray):
        n = len(flat)
        self.last4 = np.zeros(n, dtype=np.uint64)
        self.last4[4:] = np.ndarray(max(0, n - 4), ">u4", flat, strides=(1,))
        self.inside = NOT_SPACE[flat] & (flat != 0)
        power, self.back = _powers(POWERS) if n < POWERS else _powers.__wrapped__(n + 1)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.total[1:])

    def word(self, first: np.ndarray, place: np.ndarray) -> np.ndarray:
        """56 bits of the hash of the word so far, from its first place."""
        word = (self.total[place] - self.total[first]) * self.back[first] + (place - first).astype(np.uint64)
        return mix(word) >> np.uint64(8)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """First place and end of every whole word of four bytes or more; a zero is before and after the texts."""
        edge = np.flatnonzero(self.inside[1:] != self.inside[:-1]) + 1
        long = np.flatnonzero(edge[1::2] - edge[::2] >= 4)
        return edge[::2][long], edge[1::2][long]


def contexts(flat: np.ndarray) -> list[np.ndarray]:
    """For each kind, the context before each place: the bytes themselves, or 56 bits of the word's hash."""
    before, place = Before(flat), np.arange(len(flat))
    first = np.zeros(len(flat), dtype=np.int64)  # start of the word that the place before belongs to
    first[1:] = np.maximum.accumulate(np.where(before.inside, -1, place))[:-1] + 1
    return _of_kinds(before.last4, before.word(first, place))


def _of_kinds(last4: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    return [last4 & np.uint64((1 << 24) - 1), last4, word]


def _coded(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places that are coded: the texts' bytes and end marks."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys as they come, and the number of each key's."""
    coded = pa.array(key).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


class Places:
    """The distinct (contexts, next byte) of a shard's places, and the number of each place's.

    A word so far of four bytes or more tells the last four bytes, and these tell a shorter word; so all that depends
    on a place's contexts is found once for all places alike. Places after four bytes of a word are numbered by whole words,
    each with the byte after it; the others by the last four bytes.
    """

    def __init__(self, texts: Iterable[Block]):
        #: Each block's texts' numbers of places, and these places' numbers in the block.
        self.size: list[np.ndarray] = []
        self.number: list[np.ndarray] = []
        none = np.zeros(0, dtype=np.uint64)
        parts = [(none, none, none, none.astype(np.int64), none.astype(np.uint8)), *map(self._block, texts)]
        short, word, tail, size, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        short, of_short = _numbered(short)
        self.word = np.zeros(len(short), dtype=np.uint64)
        self.word[of_short] = word
        # the distinct words in one text; a word's number here is that of its fifth place
        tail, of_tail = _numbered(tail)
        one = np.empty(len(tail), dtype=np.int64)
        one[of_tail] = np.arange(len(of_tail))
        flat = np.append(np.zeros(4, dtype=np.uint8), flat[expand((np.cumsum(size) - size)[one], np.cumsum(size)[one])[0]])
        before, stop = Before(flat), np.cumsum(size[one]) + 4
        place, of = expand(stop - size[one] + 4, stop)
        begin = np.cumsum(size[one] - 4) - (size[one] - 4)
        long, of_long = _numbered(before.word((stop - size[one])[of], place) << np.uint64(8) | flat[place])
        at = np.empty(len(long), dtype=np.int64)
        at[of_long] = place  # any of those alike
        key = np.concatenate([short, long])
        self.n = len(key)
        self.byte = (key & np.uint64(255)).astype(np.uint8)
        self.last4 = np.concatenate([short >> np.uint64(8), before.last4[at]])
        self.word = np.concatenate([self.word, long >> np.uint64(8)])
        last = (self.last4 & np.uint64(255)).astype(np.uint8)
        self.under_way = NOT_SPACE[last] & (last != 0)
        #: Each block's distinct places among the shard's.
        self.of: list[np.ndarray] = []
        i = j = 0
        for low, _, high, n, _ in parts[1:]:
            first = begin[of_tail[j:j + len(high)]]
            self.of.append(np.concatenate([of_short[i:i + len(low)], of_long[expand(first, first + n - 4)[0]] + np.int32(len(short))]))
            i, j = i + len(low), j + len(high)

    def _block(self, block: Block) -> tuple[np.ndarray, ...]:
        """A block's distinct last four bytes with the next one, the words so far; its distinct words as numbers, their lengths and bytes, with the next."""
        flat, begin, size = layout(block)
        before = Before(flat)
        first, stop = before.words()
        tail, of_tail = _numbered(before.word(first, stop) << np.uint64(8) | flat[stop])
        one = np.empty(len(tail), dtype=np.int64)
        one[of_tail] = np.arange(len(of_tail))
        length = stop[one] - first[one] + 1
        coded = np.ones(len(flat), dtype=bool)
        for i in range(1, 5):
            coded[begin - i] = False
        n = stop - first - 3
        long = np.repeat(first + 4 - np.cumsum(n) + n, n)
        long += np.arange(len(long))
        is_short = coded.copy()
        is_short[long] = False
        short = np.flatnonzero(is_short)
        low, of_low = _numbered(before.last4[short] << np.uint64(8) | flat[short])
        number = np.empty(len(flat), dtype=np.int32)
        number[short] = of_low
        at = len(low) + np.cumsum(length - 4) - (length - 4)
        number[long] = long + np.repeat(at[of_tail] - first - 4, n)
        number = number[coded]
        place = np.empty(len(low), dtype=np.int64)
        place[of_low] = short  # any of those alike
        so_far, under_way = np.zeros(len(low), dtype=np.int64), np.ones(len(low), dtype=bool)
        for i in range(1, 4):
            under_way &= before.inside[place - i]
            so_far += under_way
        self.size.append(size)
        self.number.append(number)
        return low, before.word(place - so_far, place), tail, length, flat[expand(first[one], stop[one] + 1)[0]]

    def contexts(self) -> list[np.ndarray]:
        return _of_kinds(self.last4, self.word)


def count_bytes(docs: DataFrame, text: str) -> np.ndarray:
    """How often each byte is coded; 256 numbers, whatever the corpus."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for block in blocks(batches, text, lower=True):
            total += np.bincount(block.buf, minlength=256)
            total[0] += block.n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    out = np.zeros(256, dtype=np.int64)
    for row in docs.select(text).mapInArrow(run, "byte bigint, n bigint").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[row["byte"]] = row["n"]
    return out


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of a sorted array, and how often each occurs."""
    edge = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)])
    return at[edge], np.diff(edge, append=len(at))


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct numbers in order; np.unique hashes them first, which takes longer than sorting."""
    return _runs(np.sort(x))[0]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    at, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(at, kind="stable")  # the parts are in order, so they are merged
    at = at[order]
    edge = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)])
    return at[edge], np.add.reduceat(n[order], edge) if len(edge) else n


def _counted(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and the sum of each one's counts."""
    at, of = _numbered(at)
    order = np.argsort(at)
    return at[order], np.bincount(of, weights=n, minlength=len(at)).astype(np.int64)[order]  # exact below 2^53


def _pack(x: np.ndarray, ordered: bool = False) -> bytes:
    """Whole numbers (as differences if in order) by planes of equal bytes, as many as the largest needs, compressed."""
    x = x.astype(np.uint64)
    x = np.diff(x, prepend=np.uint64(0)) if ordered else x
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    planes = x.view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, ordered: bool = False) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(pa.decompress(memoryview(data)[1:], decompressed_size=width * n, codec="zstd"), dtype=np.uint8)
    x = np.zeros((n, 8), dtype=np.uint8)
    x[:, :width] = planes.reshape(width, n).T
    x = x.view(np.uint64).reshape(-1)
    return np.cumsum(x, dtype=np.uint64) if ordered else x


def _by_range(key: np.ndarray, kind: int, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each range that has keys, and their indexes in order; keys that are hashes are cut by their first bits."""
    bits = HASHED.get(kind)
    head = mix(key) >> np.uint64(33) if bits is None else key >> np.uint64(bits - 31)
    of = head * np.uint64(ranges) >> np.uint64(31)
    order = np.argsort(of, kind="stable")
    first, n = _runs(of[order])
    for r, high, size in zip(first.tolist(), np.cumsum(n).tolist(), n.tolist(), strict=True):
        yield r, order[high - size:high]


def _within(key: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each ``x`` is one of the sorted ``key``, and where."""
    have = np.searchsorted(key, x)
    hit = have < len(key)
    hit[hit] = key[have[hit]] == x[hit]
    return hit, have


def _one_shard(held: dict[int, list], more: dict[int, list], ranges: int) -> Iterator[tuple]:
    """A shard's (kind, range, number and pack of its counted keys, their counts, number and pack of its other keys); every range of tokens."""
    for kind, parts in held.items():
        shift = np.uint64(0 if kind == TOKEN else 8)
        at, n = _merged(parts)
        others = _distinct(np.concatenate(more[kind]))
        others = others[~_within(at >> shift, others)[0]]
        of_range = {r: [slice(0), others[:0]] for r in range(ranges)} if kind == TOKEN else {}
        of_range |= {r: [i, others[:0]] for r, i in _by_range(at >> shift, kind, ranges)}
        for r, i in _by_range(others, kind, ranges):
            of_range.setdefault(r, [slice(0), others[:0]])[1] = others[i]
        for r, (i, rest) in of_range.items():
            yield (kind, r, len(at[i]), _pack(at[i], True), _pack(n[i]), len(rest), _pack(rest, True))


def _closed(rows: list[pa.RecordBatch]) -> bytes:
    """The rows, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        for batch in rows:
            stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _n_keys(block: Block) -> float:
    """About how many distinct keys a block has, by slices of it."""
    slices, size = SAMPLE
    step = max(size, len(block.buf) // slices)
    part = np.concatenate([np.zeros(5, dtype=np.uint8), *(block.buf[i:i + size] for i in range(0, len(block.buf), step))])
    keys = sum(len(_distinct(c[5:] << np.uint64(8) | part[5:])) for c in contexts(part))
    return keys * len(block.buf) / max(1, len(part) - 5)


def _shards(docs: DataFrame) -> DataFrame:
    """A row for each shard: its name and whole texts (doc_id, held_out, text), compressed."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            shard = uuid.uuid4().hex  # the rows are written once, so a repeated task's name doesn't matter
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([_closed(texts)], pa.binary())], names=["shard", "texts"])

        texts, size, n_bytes = [], 0, 0
        for block in blocks(batches, "text"):
            texts.append(block.rows)
            size += _n_keys(block)
            n_bytes += len(block.buf) + block.n
            if size >= SHARD_KEYS or n_bytes >= SHARD_BYTES:
                yield flush()
                texts, size, n_bytes = [], 0, 0
        if texts:
            yield flush()

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "shard string, texts binary")


def _packs(shards: DataFrame, symbol: np.ndarray, ranges: int) -> DataFrame:
    """A row for each shard, kind and range of keys.

    ``keys`` are the training texts' (context * 256 + next symbol), or the hashes of their tokens, with ``counts``;
    ``others`` are the contexts, or tokens, that only the shard's other texts have.
    """
    schema = T.StructType([
        T.StructField("shard", T.StringType()), T.StructField("kind", T.IntegerType()), T.StructField("range", T.IntegerType()),
        *(T.StructField(c, T.LongType() if c[0] == "n" else T.BinaryType()) for c in ("n_keys", "keys", "counts", "n_others", "others"))])
    arrow = to_arrow_schema(schema)

    def keys(texts: pa.Scalar) -> tuple[dict[int, list], dict[int, list]]:
        held, more = ({k: [] for k in range(TOKEN + 1)} for _ in range(2))
        for block in blocks(pa.ipc.open_stream(texts.as_buffer()), "text", lower=True):
            flat, begin, length = layout(block)
            place = _coded(begin, length)
            learned = ~block.rows.column(1).to_numpy(zero_copy_only=False)
            learn = np.repeat(learned, length)
            seen, other = place[learn], place[~learn]
            of = symbol[flat[seen]].astype(np.uint64)
            _, *wide = contexts(flat)
            for kind, context in enumerate(wide, 1):
                held[kind].append(_runs(np.sort(context[seen] << np.uint64(8) | of)))
                more[kind].append(_distinct(context[other]))
            at, n = held[1][-1]  # the last four bytes and the next one hold the last three
            held[0].append(_counted(at & np.uint64(2 ** 32 - 1), n))
            more[0].append(_distinct(more[1][-1] & np.uint64(2 ** 24 - 1)))
            hashes, n = _tokens(block)
            learn = np.repeat(learned, n)
            held[TOKEN].append(_runs(np.sort(hashes[learn])))
            more[TOKEN].append(_distinct(hashes[~learn]))
        return held, more

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, texts in zip(*batch.columns, strict=True):
                for row in _one_shard(*keys(texts), ranges):
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard.as_py(), *row), arrow, strict=True)], names=arrow.names)

    return shards.select("shard", "texts").mapInArrow(run, schema)


def _added(group: pa.Table) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """The keys and counts of each shard of one kind and range, and those of all."""
    parts = [(_unpack(r["keys"], r["n_keys"], True), _unpack(r["counts"], r["n_keys"]).astype(np.int64))
             for r in group.select(["n_keys", "keys", "counts"]).to_pylist()]
    return parts, _merged(parts)


class Known:
    """The distinct contexts of a range in order, and the nodes and log-odds of each."""

    def __init__(self, at: np.ndarray, n: np.ndarray, code: Code):
        self.key, symbols = _runs(at >> np.uint64(8))
        row = np.repeat(np.arange(len(self.key)), symbols)
        symbol = (at & np.uint64(255)).astype(np.int64)
        one = np.repeat(symbols == 1, symbols)
        some = np.flatnonzero(~one)
        cut = np.searchsorted(row[some], np.arange(0, len(self.key), SPREAD)).tolist()
        parts = [code.odds(row[i], symbol[i], n[i])
                 for i in (some[low:high] for low, high in zip(cut, [*cut[1:], len(some)], strict=False))]  # none of no contexts
        none = np.zeros(0, dtype=np.int64)
        several, node, odds = (np.concatenate(x) for x in zip(*parts, (none, none, none.astype(np.int8)), strict=True))
        # after the other contexts is always the same byte, so the odds are alike at all its nodes
        byte, always = code.byte[symbol[one]], n[one]
        step, of = expand(code.at[byte], code.at[byte + 1])
        sure = np.minimum(np.rint(np.log((always + 0.4) / 0.4) * SCALE), 127).astype(np.int8)
        length = np.bincount(several, minlength=len(self.key))
        length[row[one]] = np.diff(code.at)[byte]
        self.at = np.append(0, np.cumsum(length))
        alone = np.repeat(symbols == 1, length)
        self.node, self.odds = np.empty(len(alone), dtype=np.uint8), np.empty(len(alone), dtype=np.int8)
        self.node[~alone], self.odds[~alone] = node, odds
        self.node[alone], self.odds[alone] = code.node[step], sure[of] * -code.sign[step]


def _ranges(total: int) -> int:
    return max(8, -(-total // RANGE_BYTES))


def _training(docs: DataFrame, text: str, symbol: np.ndarray, ranges: int) -> DataFrame:
    """The packs of training texts."""
    named = docs.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(False).alias("held_out"), F.col(text).alias("text"))
    return _packs(_shards(named), symbol, ranges).where(F.col("kind") < TOKEN)


def count_contexts(docs: DataFrame, text: str, symbol: np.ndarray, ranges: int = 8) -> DataFrame:
    """kind, key and ``next`` (symbol, n): how often each symbol follows a context."""
    def add(group: pa.Table) -> pa.Table:
        _, (at, n) = _added(group)
        return pa.table([group["kind"].take(pa.array(np.zeros(len(at), dtype=np.int64))), pa.array((at >> np.uint64(8)).astype(np.int64)),
                         pa.array((at & np.uint64(255)).astype(np.int32)), pa.array(n)], names=["kind", "key", "symbol", "n"])

    added = _training(docs, text, symbol, ranges).groupBy("kind", "range").applyInArrow(add, "kind int, key bigint, symbol int, n bigint")
    return added.groupBy("kind", "key").agg(F.collect_list(F.struct("symbol", "n")).alias("next"))


def _binary(at: np.ndarray, data: np.ndarray) -> pa.Array:
    """The bytes ``data[at[r]:at[r + 1]]`` of each row."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data.tobytes())])


def train(docs: DataFrame, text: str) -> tuple[Code, DataFrame]:
    """The code, and the model: kind, key, and the nodes whose log-odds aren't 0 with these, a byte each."""
    counts = count_bytes(docs, text)
    code = Code(counts)

    def model(group: pa.Table) -> pa.Table:
        known = Known(*_added(group)[1], code)
        return pa.table([group["kind"].take(pa.array(np.zeros(len(known.key), dtype=np.int64))), pa.array(known.key.astype(np.int64)),
                         _binary(known.at, known.node), _binary(known.at, known.odds)], names=["kind", "key", "nodes", "odds"])

    packs = _training(docs, text, code.symbol, _ranges(int(counts.sum())))
    rows = packs.groupBy("kind", "range").applyInArrow(model, "kind int, key bigint, nodes binary, odds binary")
    return code, written(rows, "model")


#: What a range's task answers to a shard, for each of its contexts there, in order: how many symbols were seen after it, these
#: and their counts; of its tokens only the counts, with the number of all training tokens of the range and of distinct ones.
ANSWER = T.StructType([
    T.StructField("shard", T.StringType()), T.StructField("kind", T.IntegerType()), T.StructField("range", T.IntegerType()),
    *(T.StructField(c, T.LongType() if c[0] == "n" else T.BinaryType()) for c in ("n", "sizes", "n_counts", "symbols", "counts", "n_all", "n_distinct"))])


def _answers(group: pa.Table) -> pa.Table:
    """An answer to each shard of one kind and range."""
    parts, (at, n) = _added(group)
    kind = group["kind"][0].as_py()
    shift = np.uint64(0 if kind == TOKEN else 8)
    model, sizes = _runs(at >> shift)
    end = np.cumsum(sizes)
    rows = []
    for (mine, _), r in zip(parts, group.select(["shard", "range", "n_others", "others"]).to_pylist(), strict=True):
        key = np.sort(np.concatenate([_runs(mine >> shift)[0], _unpack(r["others"], r["n_others"], True)]))
        hit, have = _within(model, key)
        have = have[hit]
        own = np.zeros(len(key), dtype=np.int64)
        own[hit] = n[have] if kind == TOKEN else sizes[have]
        row = r["shard"], kind, r["range"], len(key)
        if kind == TOKEN:  # the scores need unknown tokens, too
            rows.append((*row, None, len(own), None, _pack(own), int(n.sum()), len(at)))
        else:
            step, _ = expand(end[have] - sizes[have], end[have])
            rows.append((*row, _pack(own), len(step), _pack(at[step] & np.uint64(255)), _pack(n[step]), None, None))
    arrow = to_arrow_schema(ANSWER)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


def _opened(answers: list[dict], kind: int, own: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The (context * 256 + next symbol) known for one kind of a shard's contexts, or its tokens, in order, and their counts."""
    of_range = {a["range"]: a for a in answers}
    parts = []
    for r, i in _by_range(own, kind, ranges):
        a = of_range.pop(r)
        if a["n"] != len(i):
            raise ValueError(f"range {r} of kind {kind} answers {a['n']} keys of a shard's {len(i)}")
        at, counts = own[i], _unpack(a["counts"], a["n_counts"]).astype(np.int64)
        if kind < TOKEN:
            at = np.repeat(at, _unpack(a["sizes"], a["n"]).astype(np.int64)) << np.uint64(8) | _unpack(a["symbols"], a["n_counts"])
        parts.append((at, counts))
    if not parts:
        return own, np.zeros(0, dtype=np.int64)
    at, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    if kind in HASHED:  # ranges are in their keys' order
        return at, n
    order = np.argsort(at, kind="stable")
    return at[order], n[order]


class Rows:
    """What is known of one kind of contexts: the contexts in order, and the nodes and log-odds of each."""

    def __init__(self, known: pa.Table):
        key = known["key"].to_numpy()
        order = np.argsort(key)
        self.key = key[order]
        self.at, nodes = self._bytes(known["nodes"], order)
        _, odds = self._bytes(known["odds"], order)
        self.node, self.odds = nodes, odds.view(np.int8)

    @classmethod
    def of(cls, known: Known) -> Rows:
        out = cls.__new__(cls)
        out.key, out.at, out.node, out.odds = known.key.astype(np.int64), known.at, known.node, known.odds
        return out

    @staticmethod
    def _bytes(column: pa.ChunkedArray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(order):
            return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        cells = column.combine_chunks().cast(pa.large_binary()).take(pa.array(order))
        _, at, data = cells.buffers()
        at = np.frombuffer(at, dtype=np.int64)[cells.offset:cells.offset + len(cells) + 1]
        return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)

    def predictors(self, context: np.ndarray, node: np.ndarray, bits: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """The log-odds at each bit's node after its place's context; 0 for contexts never read."""
        if not len(self.key):
            return np.zeros(len(node), dtype=np.int8)
        coded = pa.array(context.view(np.int64)).dictionary_encode()
        distinct = coded.dictionary.to_numpy()
        number = coded.indices.to_numpy().astype(np.int64)
        of = np.repeat(np.arange(len(number)), bits) if of is None else of  # each bit's place
        have = np.minimum(np.searchsorted(self.key, distinct), len(self.key) - 1)
        hit = self.key[have] == distinct
        out = None
        for low in range(0, len(distinct), DENSE):
            found = np.flatnonzero(hit[low:low + DENSE])
            source = have[low + found]
            step, row = expand(self.at[source], self.at[source + 1])
            dense = np.zeros((min(DENSE, len(distinct) - low) + 1) * SYMBOLS, dtype=np.int8)  # the last row: other contexts'
            dense[found[row] * SYMBOLS + self.node[step]] = self.odds[step]
            mine = number - low
            if len(distinct) > DENSE:
                mine[(mine < 0) | (mine >= DENSE)] = len(dense) // SYMBOLS - 1
            mine *= SYMBOLS
            at = mine.take(of)
            at += node
            part = dense.take(at)
            out = part if out is None else out + part
        return out


def _predictors(table: Rows | np.ndarray, context: np.ndarray, node: np.ndarray, bits: np.ndarray,
                of: np.ndarray | None = None) -> np.ndarray:
    if isinstance(table, Rows):
        return table.predictors(context, node, bits, of)
    slot = mix(context) >> np.uint64(65 - (len(table) // SYMBOLS).bit_length())
    return table.take(np.repeat(slot.astype(np.int64) * SYMBOLS, bits) + node)


class Coded:
    """The bits of each distinct place, one after the other: four small numbers for each, the inputs and a constant, by the bit's sign, moved as one."""

    def __init__(self, places: Places, code: Code, tables: list[Rows | np.ndarray]):
        n_bits = (code.at[1:] - code.at[:-1])[places.byte]
        first = np.cumsum(n_bits) - n_bits
        #: Each one's first bit, gate and number of bits (at most 255), read as one.
        self.at = first << 9 | places.under_way.astype(np.int64) << 8 | n_bits
        self.inputs = np.empty(int(n_bits.sum()), dtype=np.uint32)
        found = places.contexts()
        order = _order((places.word >> np.uint64(24)).astype(np.int64))  # what is known of words is read about in its order
        for low in range(0, places.n, PLACES):
            some = order[low:low + PLACES]
            byte, bits = places.byte[some].astype(np.int64), n_bits[some]
            step, of = expand(code.at[byte], code.at[byte + 1])
            node, sign = code.node[step], code.sign[step]
            inputs = np.empty((len(step), 4), dtype=np.int8)
            for i, (table, context) in enumerate(zip(tables, found, strict=True)):
                inputs[:, i] = _predictors(table, context[some], node, bits, of) * sign
            inputs[:, 3] = SCALE * sign
            step += np.repeat(first[some] - code.at[byte], bits)
            self.inputs[step] = inputs.view(np.uint32)[:, 0]


def score_block(block: Block, model: tuple[Code, list[Rows | np.ndarray]], rate: float = RATE, start: float = START) -> np.ndarray:
    """Bits that each text of the block costs."""
    code, tables = model
    if not block.n:
        return np.zeros(0)
    places = Places([block])
    return mixed(places.of[0][places.number[0]], places.size[0], Coded(places, code, tables), rate, start)


def mixed(number: np.ndarray, size: np.ndarray, coded: Coded, rate: float = RATE, start: float = START) -> np.ndarray:
    """Bits that texts cost, from their numbers of places and the numbers of these."""
    texts = len(size)
    # a stream is a text's places with the same gate: each has weights of its own
    at = coded.at[number]
    gate = at & 256 != 0
    at = np.concatenate([at[~gate], at[gate]])
    gated = np.add.reduceat(gate, np.cumsum(size) - size, dtype=np.int64)  # every text has its end, so none is without places
    stop = np.append(0, np.cumsum(at & 255))
    length = np.diff(stop[np.cumsum(np.concatenate([size - gated, gated]))], prepend=0)
    inputs = np.empty(int(stop[-1]) + STEP, dtype=np.uint32)
    inputs[stop[-1]:] = 0
    for low in range(0, len(at), FEW_PLACES):
        some = at[low:low + FEW_PLACES]
        begin, end = stop[low], stop[low + len(some)]
        bit = np.repeat((some >> 9) - stop[low:low + len(some)], some & 255)
        bit += np.arange(begin, end)
        coded.inputs.take(bit, out=inputs[begin:end], mode="clip")
    first = np.cumsum(length) - length
    total = np.zeros(2 * texts)
    by_length = np.argsort(-length, kind="stable")  # streams of one group are about as long
    for low in range(0, len(by_length), STREAMS):
        some = by_length[low:low + STREAMS]
        total[some] = _cost(inputs, first[some], length[some], rate, start)
    return total[:texts] + total[texts:]


def _cost(inputs: np.ndarray, first: np.ndarray, length: np.ndarray, rate: float, start: float) -> np.ndarray:
    """Bits that streams cost; the longest first, so those still going are a prefix."""
    weights = np.full((len(first), 4), start, dtype=np.float32)
    weights[:, -1] = 0
    cost = np.zeros(len(first))
    scale, quarter, spread = np.float32(1 / SCALE), STEP // 4, np.arange(STEP)
    packed = np.lib.stride_tricks.sliding_window_view(inputs, STEP)
    ends = -length
    low, n = 0, len(first)
    while n and low < length[0]:
        n = int(np.searchsorted(ends[:n], -low))  # streams longer than ``low``
        whole = int(np.searchsorted(ends[:n], -low - STEP, side="right"))  # those that have all bits of this step
        x = packed[first[:n] + low].view(np.int8).reshape(n, STEP, 4)
        rows = np.ascontiguousarray(x.transpose(0, 2, 1)).astype(np.float32)  # these products take half the time by rows
        wrong = np.matmul((weights[:n] * scale)[:, None, :], rows)[:, 0]
        x = x.astype(np.float32)
        np.clip(wrong, -12, 12, out=wrong)
        np.exp(wrong, out=wrong)
        if whole < n:
            wrong[whole:] *= spread < (length[whole:n] - low)[:, None]
        both = wrong + np.float32(1)  # at most e^12 + 1, so a product of four is exact enough
        wrong /= both
        product = both[:, :quarter] * both[:, quarter:2 * quarter]
        product *= both[:, 2 * quarter:3 * quarter]
        product *= both[:, 3 * quarter:]
        cost[:n] += np.log(product).sum(axis=1, dtype=np.float64)
        weights[:n] -= np.float32(rate) * scale * np.matmul(wrong[:, None, :], x)[:, 0]
        low += STEP
    return cost / np.log(2)


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens, each text's words and then its end, and each text's number of them."""
    row, start, end = block.runs(NOT_SPACE[block.buf])
    hashes = np.full(len(row) + block.n, END, dtype=np.uint64)
    hashes[np.arange(len(row)) + row] = block.hashes(start, end)
    return hashes, np.bincount(row, minlength=block.n) + 1


def _score_shard(packed: pa.Table, answered: pa.Table, code: Code, ranges: int, schema: pa.Schema) -> pa.Table:
    """Scores and baseline scores of one shard's texts, from what is known of its contexts and tokens."""
    if not packed.num_rows:
        return schema.empty_table()
    texts = pa.concat_tables([pa.ipc.open_stream(rows.as_buffer()).read_all() for rows in packed["texts"]])
    answers = answered.to_pylist()
    total, kinds = (sum(a[c] for a in answers if a["kind"] == TOKEN) for c in ("n_all", "n_distinct"))
    length = pc.fill_null(pc.binary_length(texts["text"]), 0).to_numpy()
    texts = texts.select(["doc_id", "held_out", "text"]).take(pa.array(np.argsort(-length, kind="stable")))
    rows, tokens = [], []

    def each() -> Iterator[Block]:
        for block in blocks(texts.combine_chunks().to_batches(), "text", lower=True, limit=MIXED_BYTES):
            rows.append((block.rows, np.diff(block.at)))
            tokens.append(_tokens(block))
            yield block

    places = Places(each())
    token, number = _numbered(np.concatenate([hashes for hashes, _ in tokens]))
    tokens = [size for _, size in tokens]
    order = np.argsort(token)
    own = [*map(_distinct, places.contexts()), token[order]]
    of_kind = [_opened([a for a in answers if a["kind"] == kind], kind, x, ranges) for kind, x in enumerate(own)]
    coded = Coded(places, code, [Rows.of(Known(*x, code)) for x in of_kind[:TOKEN]])
    counts = np.empty(len(token), dtype=np.int64)
    counts[order] = of_kind[TOKEN][1]
    del of_kind, own, order, answers
    logs, known = np.log10((counts + 0.5) / (total + 0.5 * (kinds + 1))), (counts > 0).astype(np.int64)
    out, done = [schema.empty_table()], 0
    for (row, n_bytes), size, of, place, n_places in zip(rows, tokens, places.of, places.number, places.size, strict=True):
        bits = mixed(of[place], n_places, coded)
        mine = number[done:done + int(size.sum())]
        done += len(mine)
        first = np.cumsum(size) - size  # every text has its end, so none is without tokens
        base = np.add.reduceat(logs[mine], first)
        seen = np.add.reduceat(known[mine], first)
        out.append(pa.table(
            [row.column(0), row.column(1), pa.array(size.astype(np.int64)), pa.array(seen),
             pa.array(np.full(len(size), total, dtype=np.int64)), pa.array(base), pa.array(-bits * np.log10(2)),
             pa.array(bits / np.maximum(n_bytes, 1))], schema=schema))
    return pa.concat_tables(out)


def score(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row."""
    named = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    seen = count_bytes(named.where(~F.col("held_out")), "text")
    code = Code(seen)
    ranges = _ranges(int(seen.sum()))
    buckets = min(MOST_BUCKETS, max(8, -(-int(seen.sum()) // BUCKET_BYTES)))
    shards = bucketed(_shards(named), "shards", "shard", buckets)
    known = _packs(shards, code.symbol, ranges).groupBy("kind", "range").applyInArrow(_answers, ANSWER)
    out = T.StructType([
        T.StructField("doc_id", named.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
        *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
        *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "bits_per_byte"))])
    arrow = to_arrow_schema(out)

    def of_shard(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score_shard(left, right, code, ranges, arrow)

    return shards.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(of_shard, out)
