from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import filter_audit
from marketlens.llm.spanhash import Spans
from marketlens.llm.textbatch import blocks
from tests.llm.common import DOCS, ROWS, docs, texts

LABELS = "doc_id long, quality int, toxic int, part string"


def brute_failed(rows):
    """Letters of the filters that each (doc_id, text) fails."""
    least = {}
    for d, t in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for d, t in rows:
        t = t or ""
        words = t.encode().split()
        bad = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
               "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in t for c in "#$%&*|"),
               "E": d is not None and d > least[t]}
        out.append({f for f, b in bad.items() if b})
    return out


def brute_audit(rows, parts, good, toxic):
    failed = brute_failed(rows)
    out = {}
    for part in set(parts):
        mine = [(d, f) for (d, _), f, p in zip(rows, failed, parts) if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for i, f in enumerate(order):
                gone = [d for d, bad in left if f in bad]
                earlier = [d for d, bad in mine if f in bad and bad & set(order[:i])]
                left = [(d, bad) for d, bad in left if f not in bad]
                shapley[f] += len(gone)
                out[part, "".join(order), i + 1] = [len(left), len(gone), len(earlier), sum(bad == {f} for _, bad in mine),
                                                    sum(d in good for d in gone), sum(d in toxic for d in gone), f]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def test_transducer_matches_plain_python():
    rows = [r[1] for r in ROWS] + ["x" * 300 + " " + "x" * 300 + " y" + "x" * 299 + "A", "é😀\x85 É", "\t\t", "a" * 9 + " " + "a" * 17]
    rows += texts().text.tolist()[:100]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    parts = [filter_audit.statistics(b) for b in blocks([batch], limit=4000)]
    got = {k: np.concatenate([p[k] for p in parts]).tolist() for k in filter_audit.STATISTICS}
    words = [(t or "").encode().split() for t in rows]
    assert got["n_words"] == [len(w) for w in words] and got["n_distinct"] == [len(set(w)) for w in words]
    assert got["n_points"] == [len(t or "") for t in rows]
    assert got["n_capitals"] == [sum("A" <= c <= "Z" for c in t or "") for t in rows]
    assert got["n_symbols"] == [sum(c in "#$%&*|" for c in t or "") for t in rows]


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    """With one hash for all words the table still counts distinct words."""
    monkeypatch.setattr(Spans, "keys", lambda self: np.zeros(len(self.size), dtype=np.uint64))
    text = "aa ab aa b ab c " + "z" * 300 + " " + "z" * 300 + " " + "y" * 300
    batch = pa.RecordBatch.from_arrays([pa.array([text, "aa aa"])], names=["text"])
    got = filter_audit.statistics(next(blocks([batch])))
    assert got["n_distinct"].tolist() == [6, 1]


def test_two_letter_words_of_any_length():
    """Words over two letters of a power-of-two length, on which sums of powers collide."""
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    batch = pa.RecordBatch.from_arrays([pa.array([f"{one} {two} {one}"])], names=["text"])
    assert filter_audit.statistics(next(blocks([batch])))["n_distinct"].tolist() == [2]


@pytest.mark.parametrize("copies", [0, 40])
def test_audit_matches_brute_force(spark, copies):
    extra = [(100 + i, "Copied TEXT & more" if i % 3 else "w1 " * 250, *["x"] * 8) for i in range(copies)]
    table = ROWS + extra
    labels = [(7, 1, 0, "p"), (7, 0, 1, "p"), (100, 1, None, "p"), (101, 0, 1, None), (None, 1, 1, "p"), (999, 1, 1, "p")]
    parts = [("p" if r[0] is None else None if r[0] % 2 else f"s{r[0] % 3}") for r in table]
    frame = spark.createDataFrame([(*r, p) for r, p in zip(table, parts)], "doc_id long, text string, n string, print string, "
                                  "spans string, fails string, n_words string, filter string, good string, least string, source string")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in filter_audit.audit(frame.repartition(4), spark.createDataFrame(labels, LABELS)).collect()}
    want = brute_audit([(r[0], r[1]) for r in table], [p or "" for p in parts], {7, 100}, {7, 101})
    assert got == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(empty, none).count() == 0
    got = filter_audit.audit(docs(spark).withColumnRenamed("n", "source"), none)
    assert got.count() == 600 and got.where("good_lost + toxic_lost > 0").count() == 0
    assert docs(spark).schema == DOCS
