import random

import numpy as np

from marketlens.llm import near_dedup
from marketlens.llm.components import connected
from tests.llm.common import DOCS, docs, plain


def shingles(text, k):
    words = [w.decode() for w in plain(text).encode().split()]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def brute(rows, k, percent):
    """Component of every id by comparing all pairs of sets."""
    sets = {d: shingles(t, k) for d, t in rows}
    group = {d: d for d in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                group[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d in ids}


def families(seed, n_families, size, words, edits):
    """Texts in families whose members differ by some edits, so that links chain."""
    rng = random.Random(seed)
    rows, next_id = [], 0
    for _ in range(n_families):
        text = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(size):
            rows.append((next_id, " ".join(text)))
            next_id += 1
            text = list(text)
            for _ in range(rng.randrange(edits)):
                text[rng.randrange(len(text))] = f"w{rng.randrange(400)}"
    rng.shuffle(rows)
    return rows


def test_chains_match_brute_force(spark):
    rows = families(3, 6, 25, 120, 7) + [(10_000 + d, t) for d, t in families(4, 5, 12, 9, 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table, k=3, percent=85).collect()}
    assert got == brute(rows, 3, 85)


def test_awkward_rows(spark):
    got = near_dedup.near_duplicates(docs(spark)).collect()
    assert len(got) == 18
    by = {(r.doc_id, r.n_shingles): r for r in got}
    assert by[(1, 0)].component_id == 1 and by[(2, 0)].kept and by[(3, 0)].n_shingles == 0
    assert by[(4, 1)].component_id == -4 and not by[(4, 1)].kept  # "one" and "ONE"
    assert by[(8, 17)].component_id == 7 and by[(12, 18)].component_id == 7
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 150)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in [*range(100, 160), 200]}}


def test_common_counts_of_slices():
    rng = np.random.default_rng(0)
    sets = [set(rng.integers(0, 300, rng.integers(1, 80)).tolist()) for _ in range(60)]
    doc = np.repeat(np.arange(60), [len(s) for s in sets])
    shingle = np.concatenate([sorted(s) for s in sets]).astype(np.uint64)
    both = near_dedup.common_counts(doc, shingle, 60)
    assert all(both[i, j] == len(sets[i] & sets[j]) for i in range(60) for j in range(60) if i != j)


def test_forest_spans_components():
    similar = np.eye(7, dtype=bool)
    for a, b in ((0, 3), (3, 5), (1, 2)):
        similar[a, b] = similar[b, a] = True
    assert sorted(near_dedup._forest(similar)) == [(0, 3), (0, 5), (1, 2)]


def test_words_of_one_form_are_different(spark):
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    table = spark.createDataFrame([(1, f"{one} x y"), (2, f"{two} x y"), (3, f"{one} x y")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table).collect()} == {1: 1, 2: 2, 3: 1}


def test_counts_of_large_sets_are_whole_numbers():
    both = near_dedup.common_counts(np.repeat([0, 1], 5000), np.tile(np.arange(5000, dtype=np.uint64), 2), 2)
    assert both.dtype == np.int64 and both[0, 1] == 5000
    # 100 * 675,727 < 85 * 794,973, which floats of 24 bits can't tell
    assert not 100 * np.int64(675_727) >= 85 * (np.int64(697_327) + np.int64(773_373) - np.int64(675_727))
