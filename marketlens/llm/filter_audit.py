"""Filter interaction audit: what each of five filters removes, in every order of the filters.

One pass over a text's UTF-8 bytes drives a table-driven transducer. Its two
states are outside and inside a word; ``NEXT`` gives the state after a byte of
a class and ``EMIT`` what the step puts out: a word's begin or end, a capital,
a code point, a symbol. The state after a byte follows from that byte's class
alone, so all steps of a block are looked up at once. The word spans go into a
hash table with open addressing, where a span is only taken for a repetition
after its bytes were compared with those of the span in the slot, so distinct
words are counted exactly.

Filters (the documents that fail them are removed):
A: under 200 words; B: 100 * distinct words < 50 * words; C: 100 * capitals
A-Z > 2 * code points; D: holds any of ``#$%&*|``; E: the same text as any
document of a smaller id in the whole table, removed or not.

Texts are compared by SHA-256. A text's copies meet their smallest id in a
join whose sides are both written first, so adaptive execution splits a text
with very many copies. All else is a sum over at most 32 sets of failed
filters for each part, combined before the shuffle: 80 pairs of a filter and
the filters before it give every step of all 120 orders.

Defined cases: a null text is empty (fails A only, and E as the copy of an
empty one); words are ``[^\\x20\\x09-\\x0D]+`` and case-sensitive; a null part is
the empty string. A document without id has no smaller id and no labels, and
is nobody's smaller id. Repeated rows all count; rows of one id and one text
don't make each other fail E. A document is good, or toxic, if any label of its
id says so; labels of other ids, and null labels, count for nothing. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.spanhash import Spans
from marketlens.llm.tables import written
from marketlens.llm.textbatch import Block, blocks

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}

# byte classes
SPACE, PLAIN, CAPITAL, SYMBOL, CONTINUED = range(5)
CLASS = np.full(256, PLAIN, dtype=np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = SPACE
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[[ord(c) for c in "#$%&*|"]] = SYMBOL
CLASS[0x80:0xC0] = CONTINUED
# what a step puts out
BEGINS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16
OUTSIDE, INSIDE = 0, 1
#: State after a byte, by state and class.
NEXT = np.array([[OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE]] * 2, dtype=np.uint8)
#: What a byte puts out, by the state before it and its class.
EMIT = np.array([
    [IS_POINT, BEGINS | IS_POINT, BEGINS | IS_POINT | IS_CAPITAL, BEGINS | IS_POINT | IS_SYMBOL, BEGINS],
    [ENDS | IS_POINT, IS_POINT, IS_POINT | IS_CAPITAL, IS_POINT | IS_SYMBOL, 0]], dtype=np.uint8)

BLOCK_BYTES = 1 << 18


def transduce(block: Block) -> np.ndarray:
    """What every byte of the block puts out; each row begins outside a word."""
    kind = CLASS[block.buf]
    state = np.zeros(len(kind), dtype=np.uint8)
    state[1:] = NEXT[0][kind[:-1]]  # both rows of NEXT are alike
    heads = block.at[:-1]
    state[heads[heads < len(kind)]] = OUTSIDE
    return EMIT[state, kind]


def word_spans(block: Block, out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end of every word, from the transducer's output."""
    start = np.flatnonzero(out & BEGINS)
    tails = block.at[1:][np.diff(block.at) > 0]
    open_at_end = tails[NEXT[0][CLASS[block.buf[tails - 1]]] == INSIDE]
    end = np.sort(np.concatenate([np.flatnonzero(out & ENDS), open_at_end]))
    return np.searchsorted(block.at, start, side="right") - 1, start, end


def first_of_kind(row: np.ndarray, spans: Spans) -> np.ndarray:
    """Whether each word was put into its row's hash table, not found there already."""
    n = len(row)
    new = np.zeros(n, dtype=bool)
    if not n:
        return new
    size = 1 << int(2 * n - 1).bit_length()
    last = np.uint64(size - 1)
    slot = ((spans.keys() + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & last).astype(np.int64)
    table = np.full(size, -1, dtype=np.int64)
    waiting = np.arange(n)
    while len(waiting):
        at = slot[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]
        holder = table[at]
        mine = holder == waiting
        new[waiting[mine]] = True
        known = ~mine & (row[holder] == row[waiting])
        known[known] = spans.equal(waiting[known], holder[known])
        waiting = waiting[~mine & ~known]
        slot[waiting] = (slot[waiting] + 1) & (size - 1)
    return new


def statistics(block: Block) -> dict[str, np.ndarray]:
    """n_words, n_distinct, n_capitals, n_points and n_symbols of every row."""
    out = transduce(block)
    row, start, end = word_spans(block, out)
    new = first_of_kind(row, Spans(block.buf, start, end))
    return {"n_words": np.bincount(row, minlength=block.n), "n_distinct": np.bincount(row[new], minlength=block.n),
            "n_capitals": block.per_row(out & IS_CAPITAL > 0), "n_points": block.per_row(out & IS_POINT > 0),
            "n_symbols": block.per_row(out & IS_SYMBOL > 0)}


STATISTICS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def measure(docs: DataFrame, part: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, part, the text's SHA-256 and its statistics, for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", limit=BLOCK_BYTES):
            found = statistics(block)
            prints = [hashlib.sha256(block.buf[a:b]).digest() for a, b in zip(block.at[:-1].tolist(), block.at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(0), block.rows.column(1), pa.array(prints, pa.binary()),
                 *(pa.array(found[name].astype(np.int64)) for name in STATISTICS)], names=["doc_id", "part", "print", *STATISTICS])

    ids = docs.schema[key].dataType.simpleString()
    wanted = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                         F.col(text).cast("string").alias("text"))
    return wanted.mapInArrow(run, f"doc_id {ids}, part string, print binary, " + ", ".join(f"{s} bigint" for s in STATISTICS))


def failed(measured: DataFrame) -> DataFrame:
    """doc_id, part and the set of failed filters (a bit each) of every row."""
    bits = {"A": F.col("n_words") < 200, "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
            "C": 100 * F.col("n_capitals") > 2 * F.col("n_points"), "D": F.col("n_symbols") > 0}
    own = reduce(lambda a, b: a + b, [F.when(c, BIT[f]).otherwise(0) for f, c in bits.items()])
    slim = written(measured.select("doc_id", "part", "print", own.alias("own")), "measured")
    least = slim.groupBy("print").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = written(least.where("least <> most").select("print", "least"), "copied")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return slim.join(least, "print", "left").select(
        "doc_id", "part", (F.col("own") + F.when(copy, BIT["E"]).otherwise(0)).alias("fails"))


def cells(fails: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """For each part and set of failed filters: documents (n), good ones and toxic ones."""
    def any_is_one(name: str):
        return F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0)))

    marks = labels.select(F.col(key).alias("doc_id"), "quality", "toxic").where("doc_id is not null")
    marks = marks.groupBy("doc_id").agg(any_is_one("quality").alias("good"), any_is_one("toxic").alias("toxic"))
    return fails.join(marks, "doc_id", "left").groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, the step's filter, the filters before it) of all orders; filters as bits."""
    out = []
    for order in permutations(FILTERS):
        for i, f in enumerate(order):
            out.append(("".join(order), i + 1, BIT[f], sum(BIT[g] for g in order[:i])))
    return out


def interactions(found: DataFrame) -> DataFrame:
    """The audit's rows from ``cells``: one for each part, order and step."""
    pairs = sorted({(f, before) for _, _, f, before in _steps()})
    every = F.explode(F.array(*(F.struct(F.lit(f).alias("filter"), F.lit(b).alias("before")) for f, b in pairs)))
    each = found.select("*", every.alias("p")).select("*", "p.filter", "p.before")
    fails, one, before = F.col("fails"), F.col("filter"), F.col("before")
    hit = fails.bitwiseAND(one) > 0
    here = hit & (fails.bitwiseAND(before) == 0)

    def total(when, column: str):
        return F.sum(F.when(when, F.col(column)).otherwise(0)).cast("bigint")

    sums = each.groupBy("part", "filter", "before").agg(
        total(fails.bitwiseAND(one + before) == 0, "n").alias("kept"), total(here, "n").alias("removed"),
        total(hit & ~here, "n").alias("redundant"), total(fails == one, "n").alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"))
    # a filter stands behind the same set of others in |set|! * (4 - |set|)! orders
    orders = F.element_at(F.array(*(F.lit(factorial(i) * factorial(4 - i)) for i in range(5))), F.bit_count("before") + 1)
    shapley = sums.groupBy("part", "filter").agg(F.sum(F.col("removed") * orders).cast("bigint").alias("shapley"))
    spark = found.sparkSession
    steps = spark.createDataFrame(_steps(), "filter_order string, step int, filter int, before int")
    rows = sums.join(shapley, ["part", "filter"]).join(F.broadcast(steps), ["filter", "before"])  # 600 rows, whatever the data
    return rows.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                       "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley."""
    # two aggregations read the cells; they are few, 32 a part
    return interactions(written(cells(failed(measure(docs, part, text, key)), labels, key), "filter-cells"))
