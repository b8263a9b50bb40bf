import hashlib
import re

from marketlens.llm import pii
from marketlens.llm.queries import op7_bootstrapped_pii
from tests.llm.common import DOCS, SMALL, docs, texts


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    """Base spans by the patterns as they are stated."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_base_columns(spark):
    got = {r.doc_id: r for r in op7_bootstrapped_pii(spark, SMALL).collect()}
    rows = texts()
    assert len(got) == len(rows) and any(r.n_email for r in got.values())
    for d, t in zip(rows.doc_id, rows.text, strict=True):
        assert got[d].base_sha256 == hashlib.sha256(base(t).encode()).hexdigest()


def test_hard_texts():
    import random
    rng = random.Random(6)
    pool = ["a@b.c", "x.y@", "@", ".", "1.2.3.4.5.6.7.8", "300.1.1.1", "0255.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+1 (456) 555-2186", "+12", " ", "-", "_", "é", "a", "9", "00", "a@b", "user+tag@mail.example.co.uk", "++4930 1234567 "]
    for _ in range(4000):
        t = "".join(rng.choice(pool) for _ in range(rng.randrange(12)))
        assert ",".join(f"{k}:{s}:{e}" for k, s, e in pii.find(t)) == base(t), t


def planted():
    rows = []
    for i in range(40):
        rows.append((i, f"mail Reach me: user{i}@mail{i % 7}.example.com for more words of text"))
        rows.append((100 + i, f"other words Reach me: 10.0.{i}.7 and some text"))
    # the same pattern before identifiers that no base kind knows
    rows += [(500 + i, f"please Reach me: @handle{i:03d}! thanks") for i in range(5)]
    # a common word before numbers that are no identifiers of a person
    rows += [(600 + i, f"the page of 2024 and the year of 19{i:02d}55 and of nothing") for i in range(60)]
    return rows


def test_patterns_find_unseen_identifiers(spark):
    table = spark.createDataFrame(planted(), "doc_id long, text string").repartition(3)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.extract(table).collect()}
    for d, t in planted():
        want = pii.find(t)
        if 500 <= d < 600:
            at = t.index("@")
            want = [("context", at, t.index("!"))]
        assert got[d] == want, t


def test_scores_settle_as_in_plain_python(spark):
    """A chain in which each pattern is trusted only after the one before it, longer than a few rounds."""
    links = 6
    edges = {(f"p{k}", f"s{k}-{i}", True) for k in range(links) for i in range(5)}
    for k in range(links):
        edges |= {(f"p{k}", f"x{j}-{i}", False) for j in (k, k + 1) for i in range(2) if j}
    edges |= {("few", f"s0-{i}", True) for i in range(3)} | {("loose", f"s1-{i}", True) for i in range(5)}
    edges |= {("loose", f"y{i}", False) for i in range(9)}

    bounds = pii.Bounds()
    scores = {i: 1.0 for _, i, seed in edges if seed}
    fixed = set(scores)
    for _ in range(300):
        confidence = {}
        for p in {p for p, _, _ in edges}:
            mine = [(i, seed) for q, i, seed in edges if q == p]
            if sum(seed for _, seed in mine) >= bounds.seeds:
                confidence[p] = sum(scores.get(i, 0.0) for i, _ in mine) / len(mine)
        for i in {i for _, i, _ in edges} - fixed:
            missed = 1.0
            for p in {p for p, j, _ in edges if j == i and confidence.get(p, 0) >= bounds.confidence}:
                missed *= 1 - confidence[p]
            if missed < 1.0:
                scores[i] = 1 - missed
    want = {p: c for p, c in confidence.items() if c >= bounds.confidence}
    assert {f"p{k}" for k in range(links)} == set(want)

    table = spark.createDataFrame(sorted(edges), "pattern string, instance string, seed boolean")
    patterns, instances = pii.score(table, bounds)
    got = {r.pattern: r.confidence for r in patterns.collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-4 for p in want)
    seen = {r.instance: r.score for r in instances.collect()}
    kept = {i: s for i, s in scores.items() if s >= bounds.score}
    assert set(seen) == set(kept) and all(abs(seen[i] - kept[i]) < 1e-4 for i in kept)


def test_pattern_counts_equal_plain_counting(spark):
    """Occurrences and shaped followers, counted word by word; long texts, repeats, spans of several words, nulls."""
    import random
    rng = random.Random(3)
    pool = ["a", "B", "b2", "id77x", "(id88y)", "x@y.org", "+1 (456) 555-2186", "4111 1111 1111 1111", "10.0.0.1", "\n", "é9", "2024"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(40)))) for i in range(200)]
    rows += [(900, " ".join(rng.choice(pool) for _ in range(20000))), (901, None), (902, ""), (903, "a"), rows[0]]
    every, hits = {}, {}
    for _, t in rows:
        t = t or ""
        words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"\S+", t)]
        base_of = pii.find(t)
        for n, (start, end, word) in enumerate(words):
            begins = any(start <= s < end for _, s, _ in base_of)
            if not n or (not begins and any(s < end and start < e for _, s, e in base_of)):
                continue
            bare = word.strip("\"'()[]{}<>.,;:!?")
            shaped = begins or (len(bare) >= 5 and sum(c.isdigit() for c in bare) >= 2)
            before = [re.sub("[0-9]+", "0", w.lower()) for _, _, w in words[max(0, n - 2):n]]
            for p in {before[-1], " ".join(before)} if len(before) == 2 else {before[-1]}:
                every[p] = every.get(p, 0) + 1
                hits[p] = hits.get(p, 0) + shaped
    chosen = frozenset(sorted(every)[::2])
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = pii.spans.annotate(table, lambda: pii.find)
    got = {r.pattern: (r.n, r.shaped) for r in pii._count(found, chosen, "text").collect()}
    assert got == {p: (every[p], hits[p]) for p in chosen}


def test_awkward_rows(spark):
    got = pii.extract(docs(spark)).collect()
    assert len(got) == 18 and all(r.spans == [] for r in got if r.doc_id in (1, 2, 3))
    assert pii.extract(spark.createDataFrame([], DOCS)).count() == 0
    twice = spark.createDataFrame(planted() * 2, "doc_id long, text string")
    assert pii.extract(twice).count() == 2 * len(planted())


def test_seeds_of_any_shape_discover(spark):
    """Patterns before phones, spaced cards, digit-free emails and after very long words find the unseen too."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    long = "x" * 900
    seeds = [(f"+1 (456) 5{i:02d}-2186", "please Ring now: ") for i in range(30)]
    seeds += [(f"{letters[i % 26]}{letters[i // 26]}.doe@example.com", "please Write to: ") for i in range(30)]
    seeds += [(f"4111 1111 1111 {n}", "please Charge this: ") for n in range(1000, 1400) if luhn(f"411111111111{n}")]
    seeds += [(f"({letters[i]}.roe@example.com)", f"please Ask {long} ") for i in range(20)]
    rows = [(i, f"{before}{seed} and some text") for i, (seed, before) in enumerate(seeds)]
    hidden = [(1000 + i, f"{before}@id{i:03d} and some text") for i, before in enumerate(dict.fromkeys(b for _, b in seeds))]
    table = spark.createDataFrame(rows + hidden, "doc_id long, text string").repartition(3)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.extract(table).collect()}
    for d, t in hidden:
        assert got[d] == [("context", t.index("@"), t.index("@") + 6)], t
    for d, t in rows:
        assert got[d] == pii.find(t) and len(got[d]) == 1, t
