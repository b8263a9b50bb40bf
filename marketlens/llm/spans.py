"""Spans found in whole texts: how they are attached to rows, digested and redacted.

A span is (kind, start, end) in code points, end exclusive. Spans are ordered
by start, then by the finder's order of kinds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Span = tuple[str, int, int]
SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])
_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
ROWS = 512  # texts held as Python strings at a time


def ordered(spans: Iterable[Span], kinds: tuple[str, ...]) -> list[Span]:
    place = {k: i for i, k in enumerate(kinds)}
    return sorted(set(spans), key=lambda s: (s[1], place[s[0]], s[2]))


def annotate(docs: DataFrame, make: Callable[[], Callable[[str], list[Span]]], text: str = "text",
             column: str = "spans") -> DataFrame:
    """The rows with the spans of their whole text; ``make`` is called once in each task. A null text has none."""
    names = [c for c in docs.columns if c != column]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                texts = rows.column(rows.schema.get_field_index(text)).to_pylist()
                found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] if t else [] for t in texts]
                yield pa.RecordBatch.from_arrays([*rows.select(names).columns, pa.array(found, pa.list_(_ARROW))],
                                                 names=[*names, column])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in names), T.StructField(column, T.ArrayType(SPAN))]))


def of_kinds(spans: str, kinds: Iterable[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count(spans: str, kind: str) -> Column:
    return F.size(of_kinds(spans, [kind])).cast("bigint")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact(found: DataFrame, text: str = "text", column: str = "spans", mark: str = "[REDACTED]") -> DataFrame:
    """``annotate``'s rows without the span column; each stretch of overlapping spans is replaced by ``mark``."""
    names = [c for c in found.columns if c != column]
    place = names.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                cells = rows.column(rows.schema.get_field_index(text))
                texts = cells.to_pylist()
                for r, spans in enumerate(rows.column(rows.schema.get_field_index(column)).to_pylist()):
                    out, last = [], 0
                    for s in spans:
                        if s["start"] >= last:
                            out += [texts[r][last:s["start"]], mark]
                        last = max(last, s["end"])
                    if out:
                        texts[r] = "".join([*out, texts[r][last:]])
                arrays = list(rows.select(names).columns)
                arrays[place] = pa.array(texts, cells.type)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return found.mapInArrow(run, T.StructType([found.schema[c] for c in names]))
