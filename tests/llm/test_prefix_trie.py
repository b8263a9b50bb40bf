import hashlib
import random
import zlib

import numpy as np
import pytest

from marketlens.llm import double_array, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, n string, depth string"


def brute(rows, family=20):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), mark, (role, text)))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = own.get(c - c % family, [])[:h] + turns[h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append((c, len(seq) == d))
    out = {}
    for path, who in members.items():
        ids = [c for c, _ in who]
        below = [p for p in members if p[:len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode().split()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c, last in who if last)))
        out[min(ids), len(path)] = (min(c for c, _ in members[path[:-1]]) if path else None, len(ids), len(kids), len(leaves),
                                    saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(frame, **options):
    rows = prefix_trie.prefix_trie(frame, **options).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def some(rng, n, words=3):
    """Conversations with common beginnings, equal ones, and turns in any order."""
    rows = []
    for c in rng.sample(range(-50, 400), n):
        kind = rng.random()
        said = ["a b", "c"] * 3 if kind < 0.3 else ["a b"] * rng.randrange(1, 9) if kind < 0.6 else \
            [f"w{rng.randrange(words)} x" for _ in range(rng.randrange(1, 6))]
        rows += [(c, t, "user" if t % 2 else None, s, "p", "n", "d") for t, s in enumerate(said)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [1, 3, 256])
def test_nodes_match_brute_force(spark, hot):
    """Small bounds make nearly every beginning a common one, shared by many shards."""
    rows = some(random.Random(hot), 150)
    rows += [(None, 0, "user", "nobody's", "p", "n", "d"), (5, None, "user", "before all", "p", "n", "d"),
             (5, None, "user", "before all", "p", "n", "d"), (6, 1, None, None, "p", "n", "d"), (6, 1, "", "", "p", "n", "d")]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5), hot=hot) == brute(rows)


def test_a_long_common_beginning(spark):
    rows = [(c * 20, t, "user", f"turn {t}" if t < 11 else f"{c} {t}", "p", "n", "d") for c in range(40) for t in range(11 + c % 3)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3), hot=4) == brute(rows)


def test_turnless_and_empty(spark):
    some_id = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(some_id, 0, "user", "gone: the first turn is the absent parent's", "p", "n", "d")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == {
        (some_id, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(some_id).encode()).hexdigest())}
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ends_of_many_ids(spark):
    """Pieces of 64 KB of one path, from several partitions, in the order of their ids."""
    paths = spark.range(60_000).selectExpr("cast('hot' as binary) path", "id * 7 - 100000 conv_id").repartition(6)
    paths = paths.union(spark.range(5).selectExpr("cast(concat('p', id) as binary)", "id"))
    got = {bytes(r.path): r.ends for r in prefix_trie.ends(paths).collect()}
    assert got[b"hot"] == hashlib.sha256(",".join(str(i * 7 - 100000) for i in range(60_000)).encode()).hexdigest()
    assert got[b"p3"] == hashlib.sha256(b"3").hexdigest() and len(got) == 6


def test_double_array_holds_just_its_sequences():
    rng = random.Random(9)
    sequences = [np.array([rng.randrange(60) for _ in range(rng.randrange(0, 7))], dtype=np.int64) for _ in range(500)]
    trie = double_array.build(sequences)
    prefixes = {tuple(s[:d].tolist()) for s in sequences for d in range(len(s) + 1)}
    place = {(): 0}
    for p in sorted(prefixes, key=len):
        if p:
            place[p] = trie.child(place[p[:-1]], p[-1])
        for c in range(60):
            assert (trie.child(place[p], c) >= 0) == (p + (c,) in prefixes)
    assert len(set(place.values())) == len(prefixes) and min(place.values()) == 0
    used = int((trie.check >= 0).sum())
    assert used == len(prefixes) and trie.top < 3 * used
