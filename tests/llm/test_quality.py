import re
from collections import Counter

import numpy as np

from marketlens.llm import quality_rules as q
from marketlens.llm.queries import op8_quality_decision_list
from tests.llm.common import DOCS, SMALL, docs, duck, texts


def stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    repeat = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat)


def test_statistics(spark):
    got = {r.doc_id: r for r in op8_quality_decision_list(spark, SMALL).collect()}
    rows = texts()
    assert len(got) == len(rows)
    for d, t in zip(rows.doc_id, rows.text, strict=True):
        r = got[d]
        want = stats(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_verdict_on_labels_not_learned_from(spark):
    """Learned from the even documents' labels, judged on those of the odd ones."""
    folder = "/root/testdata/sf0.1"
    bigger = spark.read.parquet(f"{folder}/documents.parquet")
    train = spark.read.parquet(f"{folder}/labels.parquet").where("doc_id % 2 = 0")
    kept = {r.doc_id: (r.kept, r.base_failed) for r in q.judge(bigger, train).collect()}
    test = duck("SELECT doc_id, quality FROM labels WHERE doc_id % 2 = 1", folder)
    judged = [(kept[d][0], y) for d, y in zip(test.doc_id, test.quality, strict=True) if not kept[d][1]]
    assert all(k for k, y in judged if y == 1)
    bad = [k for k, y in judged if y == 0]
    assert bad and sum(not k for k in bad) >= 0.8 * len(bad)


def test_learns_conjunctions_in_order():
    rng = np.random.default_rng(5)
    x = {n: rng.random(6000) for n in ("a", "b", "c")}
    bad = ((x["a"] > 0.8) & (x["b"] <= 0.3)) | (x["c"] > 0.9)
    rules = q.learn(x, bad)
    out = np.zeros(6000, dtype=bool)
    for rule in rules:
        out |= q.covers(rule, x, 6000)
    assert (out == bad).mean() > 0.97 and (out & ~bad).mean() < 0.01
    assert q.learn(x, np.zeros(6000, dtype=bool)) == [] and q.learn(x, rng.random(6000) < 0.3) == []


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 0), (7, None, 0), (8, 1, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = q.judge(docs(spark), labels).collect()
    assert len(got) == 18
    for r, t in ((r, t) for r in got for i, t in ((1, None), (3, "   "), (7, None)) if r.doc_id == i and i != 7):
        assert r.n_words == 0 and r.base_failed and not r.kept
    assert all(r.kept for r in got if r.doc_id in (7, 8, 9, 12))
    kept = q.keep_good(docs(spark), labels)
    assert kept.columns == DOCS.names and sorted(r.doc_id for r in kept.collect()) == [6, 7, 7, 8, 9, 12]
    assert q.judge(spark.createDataFrame([], DOCS), labels.limit(0)).count() == 0
