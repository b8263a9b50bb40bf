import random
import re

import numpy as np
import pytest

from marketlens.llm import decontaminate
from marketlens.llm.fm_index import FMIndex, WaveletMatrix, suffix_order
from tests.llm.common import SMALL, DOCS, docs, plain

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, size=10):
    """Words, hit words and items of a text by comparing every window."""
    words = WORD.findall(plain(text))
    hit, found = set(), set()
    for i, t in items:
        of = WORD.findall(plain(t))
        k = min(size, len(of))
        grams = {tuple(of[j:j + k]) for j in range(len(of) - k + 1)} if k else set()
        for j in range(len(words) - k + 1):
            if tuple(words[j:j + k]) in grams:
                found.add(str(i))
                hit.update(range(j, j + k))
    return len(words), hit, sorted(found)


def sample(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "dd", "é", "x1", "Zz", "tail"]
    items = [(i, " ".join(rng.choice(vocabulary[:5]) for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(90, None), (91, "..."), (92, items[3][1])]
    rows = []
    for i in range(n):
        parts = [rng.choice([" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30))), rng.choice(items)[1] or ""])
                 for _ in range(rng.randrange(5))]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(parts).upper() if i % 3 else " - ".join(parts)))
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_matches_brute_force(spark, block_bytes):
    rows, items = sample(5)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    found = decontaminate.find(table, bench, block_bytes=block_bytes, shard_words=200)
    got = {r.doc_id: r for r in found.collect()}
    cut = {r.doc_id: r.text for r in decontaminate.cut(found).collect()}
    for d, t in rows:
        n, hit, ids = brute(t, items)
        leak = got[d]["__leak"]
        assert (leak.n_words, leak.n_hit, leak["items"]) == (n, len(hit), ids)
        spans = list(zip(leak.first, leak.stop, strict=True))
        assert {w for a, b in spans for w in range(a, b)} == hit and all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
        left = [w for i, w in enumerate(WORD.findall(plain(t))) if i not in hit]
        assert WORD.findall(plain(cut[d])) == left and (hit or cut[d] == t)


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "one id"), (2, None), (None, "two words"), (3, "")], "item_id long, text string")
    found = decontaminate.find(docs(spark), bench)
    assert found.columns == [*DOCS.names, "__leak"]
    got = [(r.doc_id, r.text, r["__leak"]) for r in found.collect()]
    assert len(got) == 18
    assert {(d, leak.n_hit) for d, t, leak in got if leak.n_hit} == {(11, 2)}  # both texts of id 11 have words of "one id"
    assert all(leak.n_words == 0 for _, t, leak in got if not (t or "").strip())
    empty = bench.limit(0)
    assert {r["__leak"].n_hit for r in decontaminate.find(docs(spark), empty).collect()} == {0}
    assert decontaminate.find(spark.createDataFrame([], DOCS), bench).count() == 0


def test_index_against_scan():
    rng = np.random.default_rng(2)
    for top, n in ((1, 50), (3, 400), (9, 2000)):
        text = rng.integers(0, top + 1, n)
        text[30:50] = text[10:30]
        text[0] = text[-1] = 0
        order = suffix_order(text)
        assert sorted(order.tolist()) == list(range(n))
        index = FMIndex.build(text, top, every=4)
        for length in (1, 2, 5):
            phrases = np.unique(rng.integers(1, top + 1, (40, length)), axis=0)
            alive, low, high = index.search(phrases)
            found = {int(a): sorted(index.locate(np.arange(lo, hi)).tolist()) for a, lo, hi in zip(alive, low, high, strict=True)}
            for p, phrase in enumerate(phrases):
                want = [i for i in range(n - length + 1) if (text[i:i + length] == phrase).all()]
                assert found.get(p, []) == want


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 23, 700)
    matrix = WaveletMatrix(symbols, 22)
    for _ in range(200):
        s, at = rng.integers(0, 23), rng.integers(0, 701)
        assert matrix.rank(np.array([s]), np.array([at]))[0] == (symbols[:at] == s).sum()
    got, before = matrix.get_and_rank(np.arange(700))
    assert (got == symbols).all() and all(before[i] == (symbols[:i] == symbols[i]).sum() for i in range(0, 700, 37))


def test_remove_is_find_and_cut(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    for block in (8 << 20, 400):  # one block of items, and many
        one = decontaminate.remove(table, items, block_bytes=block)
        two = decontaminate.cut(decontaminate.find(table, items))
        assert one.schema == two.schema
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_words_of_one_form_do_not_collide(spark):
    """Long words over two letters, whose sums of powers are equal."""
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    items = spark.createDataFrame([("i", one)], "item_id string, text string")
    got = {r.doc_id: r.n_hit for r in decontaminate.find(spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string"), items)
           .select("doc_id", "__leak.n_hit").collect()}
    assert got == {1: 1, 2: 0}
