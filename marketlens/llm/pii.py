"""Personal data by bootstrapped contextual extraction.

Base matches (email, ip, card, phone) are the seeds. The one and two words
before seeds are lexical patterns. Patterns that enough different seeds
induce are counted over the whole corpus; those that mostly precede
identifiers form a bipartite graph with the tokens they extract. Spark scores
it in rounds until no confidence moves: a pattern's confidence is the mean
score of its different instances, an instance's score is the noisy-or of its
patterns' confidences (seeds are 1). Scores only rise, so they settle. Patterns of high confidence then give spans of kind
``context`` to identifier-like tokens that no base kind covers.

Defined cases: a null or empty text has no spans; repeated rows (same id and
text) get equal results and count once for each row in the statistics; a null
id is an id like any other; ties need no order (all that reach a bound are
taken); without seeds or patterns the base spans are the result; other
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm import spans
from marketlens.llm.spans import SPAN, Span
from marketlens.llm.tables import written

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "context")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a run of digits that fails from its start fails from every place in it, so only starts of runs are tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check."""
    out = list(_emails(text)) if "@" in text else []
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def find(text: str) -> list[Span]:
    return spans.ordered(base_spans(text), KINDS)


@dataclass(frozen=True)
class Bounds:
    """What a pattern needs: ``seeds`` different seeds; the share ``selective`` of its occurrences before
    identifiers; the confidence to extract; an instance the score to be reported. Scoring ends when no
    confidence moves by more than ``settled``."""

    seeds: int = 5
    selective: float = 0.5
    confidence: float = 0.6
    score: float = 0.6
    settled: float = 1e-6
    block: int = 100_000  # patterns sent to the tasks at a time


_WORD = re.compile(r"\S+")
_EDGE = "\"'()[]{}<>.,;:!?"


def _normal(word: str) -> str:
    return re.sub(r"[0-9]+", "0", word.lower())


def _patterns(before: list[str]) -> list[str]:
    """The one- and two-word patterns of the words before a token."""
    words = [_normal(w) for w in before[-2:]]
    return [*words[-1:], *([" ".join(words)] if len(words) == 2 else [])]


def is_identifier(token: str) -> bool:
    """Shaped like an identifier: at least five characters, two of them digits."""
    return len(token) >= 5 and sum(c.isdigit() for c in token) >= 2


def _tokens(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start and end (without outer punctuation) of every word, and the two words before."""
    before: list[str] = []
    for m in _WORD.finditer(text):
        word = m[0]
        yield m.start() + len(word) - len(word.lstrip(_EDGE)), m.start() + len(word.rstrip(_EDGE)), before
        before = [*before[-1:], word]


def _seed_words(text: str, listed: list[dict]) -> tuple[dict[int, list[dict]], set[int]]:
    """The base spans that begin in a word, by the word's number, and the words that only go on with one."""
    begins: dict[int, list[dict]] = {}
    inside: set[int] = set()
    if listed:
        starts = [m.start() for m in _WORD.finditer(text)]
        for s in listed:
            i = bisect_right(starts, s["start"]) - 1
            begins.setdefault(i, []).append(s)
            inside.update(range(i + 1, bisect_left(starts, s["end"])))
    return begins, inside.difference(begins)


_SEED = T.StructType([T.StructField("pattern", T.StringType()), T.StructField("instance", T.StringType())])
_SEEDS = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.string())]))


def _with_seeds(found: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """keys, spans and the (pattern, instance) of every seed occurrence, for every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, listed in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text, "spans")), strict=True):
                words = t.split() if listed else []
                out.append([{"pattern": p, "instance": t[s["start"]:s["end"]].lower()}
                            for i, seeds in (_seed_words(t, listed)[0].items() if listed else ())
                            for p in _patterns(words[max(0, i - 2):i]) for s in seeds])
            yield pa.RecordBatch.from_arrays([*batch.select([*keys, "spans"]).columns, pa.array(out, _SEEDS)],
                                             names=[*keys, "spans", "seeds"])

    needed = found.select(*keys, F.when(F.size("spans") > 0, F.col(text)).alias(text), "spans")
    return needed.mapInArrow(run, T.StructType([*(found.schema[k] for k in keys), found.schema["spans"],
                                                T.StructField("seeds", T.ArrayType(_SEED))]))


def _pattern_blocks(patterns: DataFrame, size: int) -> Iterator[frozenset[str]]:
    held: list[str] = []
    for row in patterns.select("pattern").toLocalIterator():
        held.append(row[0])
        if len(held) >= size:
            yield frozenset(held)
            held = []
    if held:
        yield frozenset(held)


_HELD = 300_000  # words that a task remembers
_END = ""  # what follows a text's last word


class _Matcher:
    """Finds patterns in many texts at once: words become numbers, and pairs of numbers are looked up in an ordered table."""

    def __init__(self, wanted: frozenset[str]):
        self.names = sorted(wanted)
        parts = [p.split(" ") for p in self.names]
        self._number = {w: n for n, w in enumerate(sorted({w for ws in parts for w in ws}), 1)}
        self._base = len(self._number) + 1
        self._one = np.full(self._base, -1, dtype=np.int64)
        pairs = []
        for at, ws in enumerate(parts):
            if len(ws) == 1:
                self._one[self._number[ws[0]]] = at
            else:
                pairs.append((self._number[ws[0]] * self._base + self._number[ws[1]], at))
        pairs.sort()
        self._code = np.array([c for c, _ in pairs], dtype=np.int64)
        self._pair = np.array([at for _, at in pairs], dtype=np.int64)
        self._known: dict[str, int] = {_END: 0}

    def _look(self, word: str) -> int:
        """Twice the word's number (0: in no pattern), plus one if it is shaped like an identifier."""
        if len(self._known) >= _HELD:
            self._known = {_END: 0}
        made = self._known[word] = 2 * self._number.get(_normal(word), 0) + is_identifier(word.strip(_EDGE))
        return made

    def find(self, texts: list[str | None], spans_of: list[list[dict]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each occurrence before a counted word: the text's number, the pattern's, and whether the word is an identifier."""
        seen: list[int] = []
        ends, fixed, dropped = [], [], []
        for t, listed in zip(texts, spans_of, strict=True):
            words = t.split() if t else []
            if listed:
                begins, inside = _seed_words(t, listed)
                fixed += [len(seen) + i for i in begins]
                dropped += [len(seen) + i for i in inside]
            for w in words:
                n = self._known.get(w)
                seen.append(self._look(w) if n is None else n)
            seen.append(0)
            ends.append(len(seen) - 1)
        number = np.array(seen, dtype=np.int64)
        shaped = (number & 1).astype(bool)
        shaped[fixed] = True
        counted = np.ones(len(number), dtype=bool)
        counted[dropped] = False
        counted[ends] = False
        number >>= 1
        at = np.flatnonzero((number[:-1] > 0) & counted[1:])  # the last word of a pattern, before a counted word
        one = self._one[number[at]]
        two = np.full(len(at), -1, dtype=np.int64)
        if len(self._code):
            code = np.where(at > 0, number[at - 1], 0) * self._base + number[at]
            place = np.minimum(np.searchsorted(self._code, code), len(self._code) - 1)
            two = np.where(self._code[place] == code, self._pair[place], -1)
        of = np.searchsorted(np.array(ends, dtype=np.int64), at)
        which = np.concatenate([one, two])
        ok = which >= 0
        return np.tile(of, 2)[ok], which[ok], np.tile(shaped[at + 1], 2)[ok]


def _count(found: DataFrame, chosen: frozenset[str], text: str) -> DataFrame:
    """pattern, occurrences before any word, and before identifiers; summed in each task first.

    A word in which a base span begins is an identifier whatever its shape; a span's further words aren't counted.
    """
    sent = found.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(sent.value)
        every = np.zeros(len(matcher.names), dtype=np.int64)
        hits = np.zeros(len(matcher.names), dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, spans.ROWS):
                _, which, shaped = matcher.find(*(c.to_pylist() for c in batch.slice(low, spans.ROWS).columns))
                every += np.bincount(which, minlength=len(every))
                hits += np.bincount(which[shaped], minlength=len(hits))
        met = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array([matcher.names[i] for i in met], pa.string()), pa.array(every[met]),
                                          pa.array(hits[met])], names=["pattern", "n", "shaped"])

    counted = found.select(text, "spans").mapInArrow(run, "pattern string, n bigint, shaped bigint")
    return counted.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("shaped").alias("shaped"))


def _extract(found: DataFrame, chosen: frozenset[str], text: str, keys: list[str]) -> DataFrame:
    """keys, start, end, pattern, instance and seed flag of every identifier that a chosen pattern precedes."""
    sent = found.sparkSession.sparkContext.broadcast(chosen)
    fields = [found.schema[k] for k in keys]
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in (
        ("start", T.LongType()), ("end", T.LongType()), ("pattern", T.StringType()),
        ("instance", T.StringType()), ("seed", T.BooleanType())))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        matcher = _Matcher(wanted)
        last = {p.rpartition(" ")[2] for p in wanted}
        for batch in batches:
            rows, out = [], []
            texts, lists = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text, "spans"))
            holds: set[int] = set()
            for low in range(0, len(texts), spans.ROWS):
                of, _, shaped = matcher.find(texts[low:low + spans.ROWS], lists[low:low + spans.ROWS])
                holds.update((low + of[shaped]).tolist())
            for r in sorted(holds):  # the texts in which a chosen pattern precedes an identifier
                t, listed = texts[r], lists[r]
                begins, inside = _seed_words(t, listed)
                for i, (start, end, before) in enumerate(_tokens(t or "")):
                    if not before or _normal(before[-1]) not in last or i in inside:
                        continue
                    # a base span may hold more than the word (a phone number); the instance is then the span
                    own = [(s["start"], s["end"]) for s in begins.get(i, ())]
                    if not own and not is_identifier(t[start:end]):
                        continue
                    for p in _patterns(before):
                        if p in wanted:
                            for a, b in own or [(start, end)]:
                                rows.append(r)
                                out.append((a, b, p, t[a:b].lower(), bool(own)))
            taken = batch.take(pa.array(rows, pa.int64())).select(keys)
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=schema.names)

    return found.select(*keys, text, "spans").mapInArrow(run, schema)


def score(edges: DataFrame, bounds: Bounds) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence) and (instance, score) of distinct edges (pattern, instance, seed), scored until they settle."""
    seeds = written(edges.where("seed").select("instance").distinct().withColumn("score", F.lit(1.0)), "seeds")
    scores = seeds
    before = None
    while True:
        held = edges.join(scores, "instance", "left").select("pattern", F.coalesce("score", F.lit(0.0)).alias("score"), "seed")
        confidence = written(held.groupBy("pattern").agg(
            F.avg("score").alias("confidence"), F.count_if("seed").alias("support"))
            .where(F.col("support") >= bounds.seeds).select("pattern", "confidence"), "patterns")
        trusted = confidence.where(F.col("confidence") >= bounds.confidence)
        missed = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        found = edges.join(trusted, "pattern").groupBy("instance").agg((1 - missed).alias("score"))
        scores = written(found.join(seeds.select("instance"), "instance", "left_anti").unionByName(seeds), "scores")
        if before is not None:  # every round has the same patterns
            moved = confidence.join(before.withColumnRenamed("confidence", "old"), "pattern").agg(
                F.max(F.abs(F.col("confidence") - F.col("old")))).first()[0]
            if (moved or 0.0) <= bounds.settled:
                break
        before = confidence
    return confidence.where(F.col("confidence") >= bounds.confidence), scores.where(F.col("score") >= bounds.score)


def extract(docs: DataFrame, text: str = "text", key: str = "doc_id", bounds: Bounds = Bounds()) -> DataFrame:
    """key and ``spans`` (base and context) of every row."""
    kept = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    base = spans.annotate(kept.withColumn("h", F.xxhash64("text")), lambda: find)
    noted = written(_with_seeds(base, "text", ["doc_id", "h"]), "base")
    seeds = (noted.select(F.inline("seeds")).distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("seeds"))
             .where(F.col("seeds") >= bounds.seeds))
    induced = written(seeds, "induced")
    counts = None
    for block in _pattern_blocks(induced, bounds.block):
        part = written(_count(base, block, "text"), "counts")
        counts = part if counts is None else counts.union(part)
    plain = noted.select("doc_id", "h", "spans")
    if counts is None:
        return plain.select("doc_id", "spans")
    lexical = written(counts.where(F.col("shaped") >= bounds.selective * F.col("n")), "lexical")
    extracted = None
    for block in _pattern_blocks(lexical, bounds.block):
        part = written(_extract(base, block, "text", ["doc_id", "h"]), "extracted")
        extracted = part if extracted is None else extracted.union(part)
    if extracted is None:
        return plain.select("doc_id", "spans")
    edges = written(extracted.groupBy("pattern", "instance").agg(F.bool_or("seed").alias("seed")), "graph")
    patterns, instances = score(edges, bounds)
    new = (extracted.where("not seed").join(patterns.select("pattern"), "pattern").join(instances.select("instance"), "instance")
           .select("doc_id", "h", "start", "end").distinct())
    listed = written(new.groupBy("doc_id", "h").agg(F.collect_list(F.struct(
        F.lit("context").alias("kind"), "start", "end")).alias("more")), "context")
    other = listed.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "more")
    both = plain.join(other, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")
    place = {k: i for i, k in enumerate(KINDS)}

    def by_place(s):
        return F.create_map(*(x for k, i in place.items() for x in (F.lit(k), F.lit(i))))[s["kind"]]

    merged = F.concat("spans", F.coalesce("more", F.array().cast(T.ArrayType(SPAN))))
    keyed = F.array_sort(F.transform(merged, lambda s: F.struct(
        s["start"].alias("start"), by_place(s).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return both.select("doc_id", F.transform(keyed, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
