import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from marketlens.llm import bpe
from marketlens.llm.queries import op6_bpe_merge_replay
from tests.llm.common import DOCS, ROWS, SMALL, docs, texts

NAMES = ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")


def library(name=NAMES[0]):
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    return ranks, tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_matches_the_library(spark):
    _, lib = library()
    got = {r.doc_id: r for r in op6_bpe_merge_replay(spark, SMALL).collect()}
    rows = texts()
    assert len(got) == len(rows)
    for d, t in zip(rows.doc_id, rows.text, strict=True):
        ids = lib.encode_ordinary(t)
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("name", NAMES)
def test_odd_texts(name):
    ranks, lib = library(name)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng = random.Random(8)
    pool = [*map(chr, range(0x250)), *" \n\t\r" * 20, *"aeinst" * 40, "᠎", "​", " ", "　", "\x1c", "\x85", "٣", "中", "😀", "𐐷"]
    tests = ["".join(rng.choice(pool) for _ in range(rng.randrange(150))) for _ in range(4000)]
    tests += ["a" * 3000, "ab" * 2000, " " * 500, "\n" * 70, "'re'll've 'S can't", "-" * 99, "ﬁ Ⅷ x²"]
    ids, at = encoder.encode([encoder.find(t) for t in tests])
    for i, t in enumerate(tests):
        assert ids[at[i]:at[i + 1]].tolist() == lib.encode_ordinary(t), t


def test_a_lower_rank_that_comes_up_goes_first():
    """Vocabularies whose merges aren't in rank order of their parts."""
    rng = random.Random(4)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        for _ in range(25):
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))))
        longer = sorted((t for t in tokens if len(t) > 1), key=lambda t: rng.random())
        ranks = {t: i for i, t in enumerate([*(bytes([b]) for b in range(256)), *longer])}
        lib = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        replay = bpe.Replay(ranks)
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
        ids, at = replay.encode([w.encode() for w in words])
        for i, w in enumerate(words):
            assert ids[at[i]:at[i + 1]].tolist() == lib.encode_ordinary(w), w


def test_awkward_rows(spark):
    _, lib = library()
    coded = bpe.decode(bpe.encode(docs(spark)))
    got = coded.select("doc_id", "text", "ids", "decoded").collect()
    assert len(got) == len(ROWS) and coded.columns == [c for c in DOCS.names if c != "ids"] + ["ids", "decoded"]
    for r in got:
        assert r["ids"] == lib.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.decode(bpe.encode(spark.createDataFrame([], DOCS))).count() == 0


def test_unknown_ids_are_an_error(spark):
    table = spark.createDataFrame([([1, 2],), (None,), ([],)], "ids array<int>")
    assert sorted(len(r.decoded) for r in bpe.decode(table).collect())[:2] == [0, 0]
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([([99_999_999],)], "ids array<int>")).collect()


def test_one_pass_is_encode_then_decode(spark, monkeypatch):
    """The fused pass gives what the two passes give, also when words are forgotten after every replay."""
    want = bpe.decode(bpe.encode(docs(spark)))
    got = bpe.round_trip(docs(spark))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert bpe.round_trip(spark.createDataFrame([], DOCS)).count() == 0
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    texts = ["one two three", "two é three 123", "one more"]
    whole = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    ids, at = whole.encode([whole.find(t) for t in texts])
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 0)
    again = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for i, t in enumerate(texts):
        assert again.encode([again.find(t)])[0].tolist() == ids[at[i]:at[i + 1]].tolist()
        assert not again.replay.merged
        again.clear()
