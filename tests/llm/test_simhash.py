import random

import numpy as np
import pyarrow as pa
import xxhash

from marketlens.llm import simhash
from marketlens.llm.spanhash import Spans
from marketlens.llm.textbatch import blocks
from tests.llm.common import DOCS, ROWS, SMALL, docs, plain, texts


def brute_print(text):
    words = plain(text).encode().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, bits=4):
    """Smallest index reachable over pairs of at most ``bits`` differing bits."""
    group = list(range(len(prints)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_span_hashes_and_equality():
    rng = random.Random(1)
    spans = [bytes(rng.choice(b"ab\x80") for _ in range(rng.choice([0, 1, 3, 4, 7, 8, 9, 31, 32, 33, 64, 65, 256, 257, 900])))
             for _ in range(1500)]
    end = np.cumsum([len(s) for s in spans])
    found = Spans(np.frombuffer(b"".join(spans), dtype=np.uint8), end - [len(s) for s in spans], end)
    assert found.xxh64(42).tolist() == [xxhash.xxh64_intdigest(s, 42) for s in spans]
    assert len(set(found.keys().tolist())) == len(set(spans))
    a, b = np.arange(1500), np.array([rng.randrange(1500) for _ in spans])
    assert found.equal(a, b).tolist() == [spans[x] == spans[y] for x, y in zip(a, b)]


def test_prints_match_plain_python():
    rows = [r[1] for r in ROWS] + texts().text.tolist()[:80]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    got = np.concatenate([simhash.prints(b, 4) for b in blocks([batch], lower=True, limit=5000)]).tolist()
    assert got == [brute_print(t) for t in rows]


def test_query_matches_brute_force(spark):
    from marketlens.llm.queries import op11_simhash_variants
    table = texts()
    got = {r.doc_id: r for r in op11_simhash_variants(spark, SMALL).collect()}
    prints = [brute_print(t) for t in table.text]
    ids = table.doc_id.tolist()
    assert [got[d].fingerprint for d in ids] == [f"{p:016x}" for p in prints]
    assert [got[d].component_id for d in ids] == [ids[i] for i in brute_components(prints)]


def near(rng, value, flips):
    for bit in rng.sample(range(64), flips):
        value ^= 1 << bit
    return value


def test_links_of_chains_in_slices(spark):
    """Chains of prints 0 to 5 bits apart, in buckets cut into slices of 8 as well as whole."""
    rng = random.Random(5)
    prints = []
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(40):
            prints.append(value)
            value = near(rng, value, rng.randrange(1, 6))
    prints += [near(rng, prints[0], rng.randrange(1, 5)) for _ in range(150)]
    prints = sorted(set(prints))
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long").repartition(3)
    want = brute_components(prints)
    for size in (8, simhash.SLICE):
        found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.similar(table, 4, slice_rows=size).collect()]
        assert all(0 < (a ^ b).bit_count() <= 4 or want[prints.index(a)] == want[prints.index(b)] for a, b in found)
        place = {p: i for i, p in enumerate(prints)}
        name = simhash.forest(len(prints), np.array([place[a] for a, _ in found]), np.array([place[b] for _, b in found]))
        assert name.tolist() == want


def test_a_bucket_gives_a_forest_not_its_pairs():
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    for n in (60, 3000):
        value = np.array(sorted({near(rng, centre, 2) for _ in range(n)}), dtype=np.uint64)
        task = np.zeros(len(value), dtype=np.int64)
        a, b = simhash.links(task, np.full(len(value), 2), value, 4)
        assert len(a) == len(value) - 1 and not simhash.forest(len(value), a, b).any()


def test_sides_meet_each_other_only():
    value = np.array([0, 1, 2, 3] * 30, dtype=np.uint64) + np.uint64(8)
    a, b = simhash.links(np.zeros(120, dtype=np.int64), np.zeros(120), value, 4)
    assert len(a) == 0


def test_awkward_rows(spark):
    got = simhash.near_duplicates(docs(spark)).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.print): r for r in got}
    zero = [r for r in got if r.print == 0]
    assert {r.doc_id for r in zero} >= {None, 1, 2, 3} and {r.component_id for r in zero} == {1}
    one = next(r for r in got if r.doc_id == 4)
    assert one.component_id == -4 == by[(-4, one.print)].component_id
    assert [r.component_id for r in got if r.doc_id == 8] == [7]
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    names = spark.createDataFrame([("b", "same words here now"), ("a", "same words here now"), ("c", None)], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(names).collect()} == {"a": "a", "b": "a", "c": "c"}
