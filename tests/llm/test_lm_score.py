import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from marketlens.llm import lm_score
from marketlens.llm.queries import op1_logistic_mixing
from marketlens.llm.textbatch import blocks
from tests.llm.common import DOCS, SMALL, docs, plain, texts


def baseline(rows):
    """Baseline columns by plain counting, in the rows' order."""
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", plain(t)), None] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    count = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(count.values()), len(count)
    return [(h, len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
            for t, h in zip(tokens, held, strict=True)]


def test_baseline_and_gain(spark):
    got = op1_logistic_mixing(spark, SMALL).toPandas().sort_values("doc_id")
    rows = texts()
    want = baseline(list(zip(rows.doc_id.tolist(), rows.text, strict=True)))
    assert got.held_out.tolist() == [w[0] for w in want]
    for i, c in enumerate(("n_tokens", "n_known", "train_tokens"), 1):
        assert got[c].tolist() == [w[i] for w in want]
    assert np.allclose(got.base_score, [w[4] for w in want])
    unseen = got[got.held_out]
    size = np.array([len(t.encode()) for d, t in zip(rows.doc_id, rows.text, strict=True) if d in set(unseen.doc_id)])
    # held-out texts cost far less than 8 bits a byte
    assert (unseen.bits_per_byte * size).sum() / size.sum() < 3.5


def test_awkward_rows(spark):
    got = {(r.doc_id, r.n_tokens): r for r in lm_score.score(docs(spark)).collect()}
    assert got[(1, 1)].score < 0 and got[(1, 1)].score == got[(2, 1)].score  # null as empty: just the end mark
    assert got[(3, 1)].n_tokens == 1 and not got[(None, 1)].held_out
    assert lm_score.score(docs(spark)).count() == 18
    assert lm_score.score(spark.createDataFrame([], DOCS)).count() == 0


def test_code_is_complete():
    """Every byte has a way, the ways form a full binary tree, and only the last column is outside the contexts."""
    for counts in (np.zeros(256), np.arange(256) ** 3, np.eye(1, 256, 97)[0] * 1e9):
        code = lm_score.Code(counts)
        assert abs((2.0 ** -np.diff(code.at)).sum() - 1) < 1e-12
        assert len({tuple(zip(code.node[a:b], code.sign[a:b], strict=True)) for a, b in zip(code.at, code.at[1:], strict=False)}) >= 64
        stretched = code.stretch(np.random.default_rng(1).integers(0, 50, (3, lm_score.SYMBOLS)))
        assert not stretched[:, -1].any() and code.node.max() <= lm_score.SYMBOLS - 1


def test_scores_do_not_depend_on_the_block():
    code = lm_score.Code(np.ones(256))
    model = code, [np.zeros(lm_score.SYMBOLS << b, dtype=np.int8) for b in lm_score.SLOT_BITS]
    rows = ["some text " * k for k in (1, 50, 7, 0, 900)]
    together = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    whole = np.concatenate([lm_score.score_block(b, model) for b in blocks([together])])
    alone = [lm_score.score_block(b, model)[0] for t in rows for b in blocks([pa.RecordBatch.from_arrays([pa.array([t])], names=["text"])])]
    assert np.allclose(whole, alone)


def counted(spark, rows):
    table = spark.createDataFrame([(t,) for t in rows], "text string").repartition(3)
    return lm_score.train(table, "text")


def test_model_grows_and_contexts_share_nothing(spark):
    """Every context has a row of its own, with the counts of plain counting."""
    words = [f"{i * 7919 % 100003:x}{i:x}" for i in range(60_000)]
    _, model = counted(spark, [" ".join(words[i:i + 500]) for i in range(0, len(words), 500)])
    sizes = {r.kind: r.n for r in model.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("key").alias("d")).collect()}
    flat = ["\0" * 4 + " ".join(words[i:i + 500]) for i in range(0, len(words), 500)]
    for kind, n in ((0, 3), (1, 4)):
        assert sizes[kind] == len({t[i - n:i] for t in flat for i in range(4, len(t) + 1)})
    begun = {w[:i] for w in words for i in range(len(w) + 1)}
    assert sizes[2] == len(begun) > 1 << 17


def test_counts_are_exact(spark):
    rows = ["abcabcabd", "abcd", None, "", "xabc"]
    table = spark.createDataFrame([(t,) for t in rows], "text string").repartition(2)
    got = lm_score.count_contexts(table, "text", np.arange(256)).where("kind = 0").collect()
    want = Counter()
    for t in rows:
        raw = b"\0" * 4 + (t or "").encode() + b"\0"
        want.update((int.from_bytes(raw[i - 3:i][::-1], "little"), raw[i]) for i in range(4, len(raw)))
    assert {(r.key, s.symbol): s.n for r in got for s in r.next} == dict(want)


def test_rows_in_parts(monkeypatch):
    """Predictors are the same however many contexts are spread out at a time."""
    rng = np.random.default_rng(3)
    key = np.unique(rng.integers(0, 1 << 40, 500))
    at = np.arange(len(key) + 1) * 3
    nodes = np.tile([1, 5, 9], len(key)).astype(np.uint8)
    odds = rng.integers(-127, 128, len(nodes)).astype(np.int8)
    shuffled = rng.permutation(len(key))
    rows = lm_score.Rows(pa.table({"key": key, "nodes": lm_score._binary(at, nodes), "odds": lm_score._binary(at, odds)}).take(pa.array(shuffled)))
    context = np.concatenate([rng.choice(key, 2000), rng.integers(0, 1 << 40, 300)]).astype(np.uint64)
    bits = rng.integers(1, 5, len(context))
    node = rng.choice([1, 5, 9, 11], bits.sum())
    of = {(k, n): odds[3 * i + j] for i, k in enumerate(key.tolist()) for j, n in enumerate((1, 5, 9))}
    want = [of.get(x, 0) for x in zip(np.repeat(context, bits).tolist(), node.tolist(), strict=True)]
    for dense in (1 << 16, 64):
        monkeypatch.setattr(lm_score, "DENSE", dense)
        assert rows.predictors(context, node, bits).tolist() == want


def test_every_byte_is_predicted(spark):
    """In texts of more than 64 different bytes, context tells the next one of each."""
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in range(0x430, 0x450)] + [chr(c) for c in range(0x4E00, 0x4E40)] + [chr(c) for c in range(0x627, 0x647)]
    words = ["".join(rng.choice(letters, 6)) for _ in range(300)]
    table = [(i, " ".join(rng.choice(words, 200))) for i in range(200)]
    got = lm_score.score(spark.createDataFrame(table, "doc_id long, text string")).where("held_out").toPandas()
    assert len(set("".join(t for _, t in table).encode())) > 64
    # a word is one of 300 (8.2 bits) and has 14 to 19 bytes with its blank
    assert len(got) and got.bits_per_byte.mean() < 1.2
    code = lm_score.Code(np.ones(256))
    assert len(set(code.symbol.tolist())) == 256 and code.node.max() == 254


def test_long_texts_adapt_at_one_rate():
    """The weights of a long text follow the plain rule, a step of one rate after each ``STEP`` bits of a gate, to its end."""
    rng = np.random.default_rng(9)
    code = lm_score.Code(np.ones(256))
    tables = [rng.integers(-60, 60, lm_score.SYMBOLS << b).astype(np.int8) for b in lm_score.SLOT_BITS]
    text = bytes(rng.integers(97, 123, 12_000).astype(np.uint8)).decode()  # one word: nearly all bits are of one gate
    block = next(blocks([pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])]))
    flat, _, _ = lm_score.layout(block)
    found = lm_score.contexts(flat)
    total = 0.0
    for gate in (0, 1):
        xs, signs = [], []
        for place in range(4, len(flat)):
            if (place > 4) != bool(gate):
                continue
            a, b = code.at[flat[place]], code.at[flat[place] + 1]
            parts = [lm_score._predictors(t, c[place:place + 1], code.node[a:b], np.array([b - a])) for t, c in zip(tables, found, strict=True)]
            xs.append(np.stack([*parts, np.full(b - a, lm_score.SCALE)], axis=1) / lm_score.SCALE)
            signs.append(code.sign[a:b])
        x, s = np.concatenate(xs), np.concatenate(signs)
        w = np.array([lm_score.START] * 3 + [0])
        for low in range(0, len(x), lm_score.STEP):
            part, sign = x[low:low + lm_score.STEP], s[low:low + lm_score.STEP]
            wrong = np.exp(np.clip(part @ w * sign, -12, 12))
            total += np.log2(1 + wrong).sum()
            w = w - lm_score.RATE * (wrong / (1 + wrong) * sign) @ part
    assert len(x) > 256 * lm_score.STEP
    assert np.isclose(lm_score.score_block(block, (code, tables))[0], total, rtol=1e-4)


def test_scores_by_plain_counting(spark):
    """The whole query's scores against counts in dictionaries and a bit-by-bit mixer, in several shards and ranges."""
    rng = np.random.default_rng(11)
    words = ["alpha", "Beta", "gam", "d", "été", "x1", "alphabet"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(60)] + [(None, "no id alpha"), (61, None), (62, "")]
    got = {r.doc_id: r.score for r in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    raw = {d: plain(t).encode() for d, t in rows}
    learn = [t for d, t in raw.items() if d is None or zlib.crc32(str(d).encode()) % 5 != 1]

    def before(t, i):
        start = max([t.rfind(bytes([c]), 0, i) for c in b" \t\n\x0b\x0c\r"]) + 1
        padded = b"\0" * 4 + t
        return padded[i + 1:i + 4], padded[i:i + 4], t[start:i]

    count = [{}, {}, {}]
    for t in learn:
        for i, b in enumerate(t + b"\0"):
            for table, c in zip(count, before(t, i), strict=True):
                table.setdefault(c, Counter())[b] += 1
    code = lm_score.Code(np.array([sum((t + b"\0").count(b) for t in learn) for b in range(256)]))
    ways = [list(zip(code.node[a:b].tolist(), code.sign[a:b].tolist(), strict=True)) for a, b in zip(code.at, code.at[1:], strict=False)]

    def odds(seen, node):
        zero = sum(n for b, n in seen.items() if (node, 1) in ways[b])
        one = sum(n for b, n in seen.items() if (node, -1) in ways[b])
        return max(-127, min(127, round(math.log((one + 0.4) / (zero + 0.4)) * lm_score.SCALE))) / lm_score.SCALE

    for d, t in raw.items():
        bits = ([], [])
        for i, b in enumerate(t + b"\0"):
            found = [table.get(c, {}) for table, c in zip(count, before(t, i), strict=True)]
            gate = int(i > 0 and t[i - 1] not in b" \t\n\x0b\x0c\r")
            bits[gate].extend(([odds(f, node) for f in found] + [1], sign) for node, sign in ways[b])
        total = 0
        for stream in bits:
            w = np.array([lm_score.START] * 3 + [0])
            for low in range(0, len(stream), lm_score.STEP):
                step = np.zeros(4)
                for x, sign in stream[low:low + lm_score.STEP]:
                    wrong = math.exp(max(-12, min(12, float(np.dot(x, w)) * sign)))
                    total += math.log10(1 + wrong)
                    step += wrong / (1 + wrong) * sign * np.array(x)
                w = w - lm_score.RATE * step
        assert math.isclose(got[d], -total, rel_tol=1e-4), d


def test_nothing_to_learn_from(spark):
    """Only held-out texts: no context is known, and the baseline has no counts."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = lm_score.score(spark.createDataFrame([(i, f"text {i} of none") for i in ids], "doc_id long, text string")).collect()
    assert len(got) == len(ids) and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.score < 0 for r in got)


def test_packs_and_unpacks():
    for x in (np.zeros(0, dtype=np.uint64), np.array([5, 5, 7, 2 ** 64 - 1], dtype=np.uint64), np.arange(9, dtype=np.uint64) << np.uint64(40)):
        assert lm_score._unpack(lm_score._pack(x, True), len(x), True).tolist() == x.tolist()
        assert lm_score._unpack(lm_score._pack(x[::-1]), len(x)).tolist() == x[::-1].tolist()


def test_texts_and_packs_are_on_disk_once(spark):
    """Only the shards' texts are written; their buckets are read without a shuffle, and packs and answers are shuffled once each."""
    words = [f"{i * 7919 % 100003:x}" for i in range(20_000)]
    rows = [(i, " ".join(words[i * 100:i * 100 + 300])) for i in range(200)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange ") == 2
    files = [f.split("file:")[-1] for f in got.inputFiles()]
    assert files and {n for f in files for n in pq.read_schema(f).names} == {"shard", "texts"}
    text = sum(len(t) for _, t in rows)
    assert sum(Path(f).stat().st_size for f in files) < text
    assert got.count() == len(rows)


def test_answers_are_in_the_contexts_order(spark, monkeypatch):
    """Any number of ranges, more than a shard has tokens too, gives the same scores; texts that nothing was learned from as well."""
    rng = np.random.default_rng(13)
    words = ["alpha", "Beta", "d", "été", "x1", "alphabet"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(40)] + [(None, None), (41, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    few = sorted(map(str, lm_score.score(table).collect()))
    monkeypatch.setattr(lm_score, "_ranges", lambda total: 61)
    assert sorted(map(str, lm_score.score(table).collect())) == few
    unseen = [(d, t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 == 1]
    alone = lm_score.score(spark.createDataFrame(unseen, "doc_id long, text string")).collect()
    assert len(alone) == len(unseen) and {(r.train_tokens, r.n_known) for r in alone} == {(0, 0)}
    assert lm_score.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_answers_hold_no_keys():
    """A shard gets back the counts of its contexts in their order, not the contexts."""
    rng = np.random.default_rng(17)
    own = np.unique(rng.integers(0, 1 << 56, 3000, dtype=np.uint64))
    mine, others = own[::2], own[1::2]
    row = {"shard": "a", "kind": 2, "range": 0, "n_keys": len(mine), "keys": lm_score._pack(mine << np.uint64(8) | np.uint64(7), True),
           "counts": lm_score._pack(np.full(len(mine), 300)), "n_others": len(others), "others": lm_score._pack(others, True)}
    both = np.sort(np.concatenate([mine[:5], others[:5]])) << np.uint64(8) | np.uint64(9)
    more = row | {"shard": "b", "n_keys": len(both), "keys": lm_score._pack(both, True), "counts": lm_score._pack(np.ones(len(both))), "n_others": 0,
                  "others": lm_score._pack(own[:0], True)}
    answer = lm_score._answers(pa.Table.from_pylist([row, more])).to_pylist()[0]
    assert sum(len(answer[c]) for c in ("sizes", "symbols", "counts")) < 2 * len(own)  # the keys alone would take six bytes each
    at, n = lm_score._opened([answer], 2, own, 1)
    want = {(c << 8) | 7: 300 for c in mine.tolist()} | {b: 1 for b in both.tolist()}
    assert dict(zip(at.tolist(), n.tolist(), strict=True)) == want and at.tolist() == sorted(want)


def awkward_blocks():
    texts = ["The cat, the catalogue; the cat", "", None, "\0nul\0inside nulls\0", "  two  blanks\n\nlines\t", "étéété été naïveté", "abc", "abcd", "abcde abcd abcdef", "x"]
    for rows in (texts, texts[::-1] + ["catalogues catalogue"], [""]):
        yield from blocks([pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])], lower=True, limit=40)


def test_places_have_their_contexts():
    """Each place's number in its shard stands for its own contexts, next byte and gate, and no two numbers stand for the same."""
    every = list(awkward_blocks())
    places = lm_score.Places(every)
    for block, size, number, of in zip(every, places.size, places.number, places.of, strict=True):
        flat, begin, length = lm_score.layout(block)
        at = lm_score._coded(begin, length)
        assert size.tolist() == length.tolist()
        for got, want in zip(places.contexts(), lm_score.contexts(flat), strict=True):
            assert got[of[number]].tolist() == want[at].tolist()
        assert places.byte[of[number]].tolist() == flat[at].tolist()
        before = flat[at - 1]
        assert places.under_way[of[number]].tolist() == (~np.isin(before, [0, 9, 10, 11, 12, 13, 32])).tolist()
    assert len(set(zip(places.last4.tolist(), places.word.tolist(), places.byte.tolist(), strict=True))) == places.n


def test_places_alike_are_predicted_once(monkeypatch):
    """What a model says of a context and next byte is looked up once, however often a text has them; scores are those of the texts alone."""
    asked = []
    predictors = lm_score._predictors
    monkeypatch.setattr(lm_score, "_predictors", lambda table, context, node, *more: asked.append(len(node)) or predictors(table, context, node, *more))
    rng = np.random.default_rng(23)
    code = lm_score.Code(np.ones(256))
    model = code, [rng.integers(-60, 60, lm_score.SYMBOLS << b).astype(np.int8) for b in lm_score.SLOT_BITS]
    text = "a word or another word of some text " * 40
    scores = [lm_score.score_block(b, model) for rows in ([text], [text] * 50)
              for b in blocks([pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])])]
    one, many = sum(asked[:3]), sum(asked[3:])
    assert many == one < 3 * 8 * len(text) / 10
    assert np.allclose(scores[1], scores[0][0])


def test_known_of_one_symbol():
    """Contexts that always have the same byte after them have the odds of plain counting, too."""
    code = lm_score.Code(np.arange(256))
    at = np.array([3 << 8 | 7, 5 << 8 | 1, 5 << 8 | 200, 9 << 8 | 255], dtype=np.uint64)
    n = np.array([1, 4, 2, 10 ** 9])
    known = lm_score.Known(at, n, code)
    counts = np.zeros((3, 256), dtype=np.int64)
    counts[[0, 1, 1, 2], [7, 1, 200, 255]] = n
    want = code.stretch(counts)
    got = np.zeros_like(want)
    got[np.repeat(np.arange(3), np.diff(known.at)), known.node] = known.odds
    assert known.key.tolist() == [3, 5, 9] and np.array_equal(got, want)
