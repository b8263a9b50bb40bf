"""Quality rules as a learned decision list (sequential covering).

``text_stats`` counts, per whole text, what the rules look at. ``learn``
covers the labelled low-quality rows rule by rule: a rule grows by the
threshold that gains most on the growing part, is pruned on a part held back,
and is kept only while it is precise there. ``verdict`` turns the ordered list
into one Spark conditional expression, so the rules run inside the plan.

Defined cases: a null or empty text has no words, hence fails the base rule
(fewer than 10 words); a null label is not labelled; repeated rows and ties
get equal results; an empty table gives an empty result; without labels of
both kinds the list is empty and only the base rule rejects. Columns of the
input named like a statistic are replaced in ``text_stats``' output.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.textbatch import NOT_SPACE, Block, blocks, mix, one_of_each, windows, with_columns

WINDOW = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_chars", "n_lines", "n_upper", "n_digits", "n_stops", "n_distinct")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80  # the first byte of a code point


def count_block(block: Block) -> dict[str, np.ndarray]:
    """The statistics of each row of a block."""
    word = NOT_SPACE[block.buf]
    row, start, end = block.runs(word)
    h = block.hashes(start, end)
    n_words = np.bincount(row, minlength=block.n)

    first, of = windows(row, h, WINDOW)
    key = mix(of + row[first].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    hit = first[np.isin(key, twice)] if len(twice) else first[:0]
    cover = np.zeros(len(row) + WINDOW, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    repeat = np.bincount(row[np.cumsum(cover)[:len(row)] > 0], minlength=block.n)

    line_row, line_start, line_end = block.runs(block.buf != 10)
    full = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_row, line_start, line_end = line_row[full], line_start[full], line_end[full]
    lines = mix(block.hashes(line_start, line_end) + line_row.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    seen = one_of_each(lines)
    n_lines = np.bincount(line_row, minlength=block.n)
    some = one_of_each(mix(h + row.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    n_chars = np.diff(block.at) - block.per_row(~_LEAD[block.buf])
    return {
        "n_words": n_words,
        "word_chars": n_chars - block.per_row(~word),
        "n_symbols": block.per_row(_SYMBOL[block.buf]),
        "n_dup_lines": n_lines - np.bincount(line_row[seen], minlength=block.n),
        "n_repeat_words": repeat,
        "n_chars": n_chars,
        "n_lines": n_lines,
        "n_upper": block.per_row(_UPPER[block.buf]),
        "n_digits": block.per_row(_DIGIT[block.buf]),
        "n_stops": block.per_row(_STOP[block.buf]),
        "n_distinct": np.bincount(row[some], minlength=block.n),
    }


def text_stats(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but the text) and the statistics of each row's whole text."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*STATS, text)]
    needed = docs.select(*(F.col(f"`{c}`") for c in [*keep, text]))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep),
                        *(f"{s} bigint" for s in STATS)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            yield with_columns(block.rows.select(keep), **{k: v.astype(np.int64) for k, v in count_block(block).items()})

    return needed.mapInArrow(count, schema)


def base_failed() -> Column:
    """The fixed rule: too short, or over a fifth of the words in repeated 5-word windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What conditions compare: scale-free shares of the statistics; null-free."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
        "words_per_stop": F.col("n_words") / (F.col("n_stops") + 1),
        "words_per_line": F.col("n_words") / lines,
        "distinct_share": F.col("n_distinct") / words,
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > F.lit(self.bound) if self.above else of[self.feature] <= F.lit(self.bound)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.bound if self.above else x[self.feature] <= self.bound


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int, bins: int) -> Rule:
    """Adds the threshold with the largest FOIL gain until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < most and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best: tuple[float, Condition] | None = None
        for name, values in x.items():
            cuts = np.unique(np.quantile(values[inside], np.linspace(0, 1, bins + 1)[:-1]))
            cuts = np.unique(np.concatenate([cuts, np.quantile(values[inside & bad], np.linspace(0, 1, bins + 1))]))
            at = np.searchsorted(cuts, values[inside], side="left")  # first cut that is >= the value
            pos = np.cumsum(np.bincount(at[bad[inside]], minlength=len(cuts) + 1))[:len(cuts)]
            neg = np.cumsum(np.bincount(at[~bad[inside]], minlength=len(cuts) + 1))[:len(cuts)]
            for above, p, n in ((False, pos, neg), (True, p0 - pos, n0 - neg)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > 1e-9 and (best is None or gain[k] > best[0] + 1e-12):
                    best = (float(gain[k]), Condition(name, above, float(cuts[k])))
        if best is None:
            break
        rule.append(_centred(best[1], x[best[1].feature][inside]))
        inside &= rule[-1].holds(x)
    return tuple(rule)


def _centred(condition: Condition, values: np.ndarray) -> Condition:
    """The same split of the rows, with the bound half-way between its two sides."""
    low, high = values[values <= condition.bound], values[values > condition.bound]
    if not len(low) or not len(high):
        return condition
    return Condition(condition.feature, condition.above, float((low.max() + high.min()) / 2))


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drops final conditions while (p - n) / (p + n) on the held-back part doesn't fall."""
    def worth(r: Rule) -> float:
        inside = covers(r, x, len(bad))
        p, n = (bad & inside).sum(), (~bad & inside).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, least: int = 8,
          most_rules: int = 12, most_conditions: int = 4, bins: int = 32, seed: int = 7) -> list[Rule]:
    """An ordered list of conjunctions that cover low quality, by sequential covering.

    A third of the rows is held back for pruning; a rule is kept while its
    smoothed precision over both parts is at least ``precision`` and it covers
    ``least`` bad rows. Learning ends at the first rule that fails this.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    part = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    while len(rules) < most_rules and (bad & left & part).sum() >= least:
        grow, hold = left & part, left & ~part
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], most_conditions, bins)
        if not rule:
            break
        pruned = _prune(rule, {k: v[hold] for k, v in x.items()}, bad[hold])
        kept = next((r for r in (pruned, rule) if _precise(r, x, bad, left, precision, least)), None)
        if kept is None:
            break
        rules.append(kept)
        left &= ~covers(kept, x, len(bad))
    return rules


def _precise(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, left: np.ndarray, precision: float, least: int) -> bool:
    inside = covers(rule, x, len(bad)) & left
    p, n = int((bad & inside).sum()), int((~bad & inside).sum())
    return p >= least and (p + 1) / (p + n + 2) >= min(precision, 1 - 1 / (p + 2)) - 1e-9


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional: the first rule that holds rejects, a row that none covers stays."""
    of = features()
    out: Column | None = None
    for rule in rules:
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(of)
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        sample: int = 20_000, **how) -> list[Rule]:
    """Learns from at most ``sample`` labelled keys (those with the smallest hash of the key).

    The bound keeps what reaches the driver fixed at any size of the corpus; a
    conflicting label of a repeated key counts as low quality. Only the
    sampled documents are read and counted here.
    """
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(key).agg(F.min(label).alias("__label")))
    picked = known.orderBy(F.xxhash64(key), key).limit(sample)
    named = features()
    chosen = docs.select(key, text).join(F.broadcast(picked), key)
    rows = (text_stats(chosen, text, ["__label"]).where(~base_failed())
            .select(*(c.alias(n) for n, c in named.items()), "__label")
            .orderBy(F.xxhash64(*named, "__label"), *named).limit(2 * sample).toPandas())
    if rows.empty:
        return []
    x = {n: rows[n].to_numpy(dtype=np.float64) for n in named}
    return learn(x, rows["__label"].to_numpy() == 0, **how)


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, statistics, ``base_failed`` and ``kept`` of every row; labels decide the learned list."""
    rules = fit(docs, labels, text, key)
    return (text_stats(docs, text, [key])
            .withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that neither the base rule nor the learned list rejects, with the columns they came with."""
    rules = fit(docs, labels, text, key)
    names = docs.columns
    counts = T.StructType([T.StructField(s, T.LongType()) for s in STATS])

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            arrays = [pa.array(v.astype(np.int64)) for v in count_block(block).values()]
            yield pa.RecordBatch.from_arrays(
                [*block.rows.columns, pa.StructArray.from_arrays(arrays, names=list(STATS))], names=[*names, "__stats"])

    rows = docs.mapInArrow(attach, T.StructType([*docs.schema.fields, T.StructField("__stats", counts)]))
    spread = rows.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row"), "__stats.*")
    return spread.where(~base_failed() & verdict(rules)).select("__row.*")
