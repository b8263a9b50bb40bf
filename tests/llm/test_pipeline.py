import hashlib

import corpus_pipeline
from marketlens.llm import secret_scan
from marketlens.llm.tables import written
from tests.llm.common import duck
from tests.llm.test_bpe import library
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_dedup import brute as components

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    """Every stage against a plain version of it, on the rows that it got."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = duck("SELECT item_id, text FROM benchmark", FOLDER)
    items = list(zip(items.item_id, items.text, strict=True))
    labels = dict(duck("SELECT doc_id, quality FROM labels", FOLDER).itertuples(index=False))
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "near duplicates"
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = written(stage(spark, docs, FOLDER), "test")
        after = {r.doc_id: r for r in docs.collect()}
        assert number == 4 or docs.columns == columns
        if number == 0:
            assert all(after[d] == before[d] for d in after)
            assert 0.7 * len(before) < len(after) < len(before)
            clean = [d for d in before if labels.get(d) == 1]
            assert sum(d in after for d in clean) > 0.9 * len(clean)
        elif number == 1:
            of = components([(d, r.text) for d, r in before.items()], 5, 80)
            assert set(after) == set(of.values())
        elif number == 2:
            for d, r in before.items():
                hit = leaks(r.text, items)[1]
                assert (after[d].text == r.text) == (not hit)
                assert leaks(after[d].text, items)[0] == leaks(r.text, items)[0] - len(hit)
                assert after[d].n_chars == len(after[d].text)
        elif number == 3:
            for d, r in before.items():
                assert (after[d].text == r.text) == (not secret_scan.find(r.text))
                assert not secret_scan.find(after[d].text)
        else:
            _, lib = library()
            for d, r in before.items():
                assert after[d]["ids"] == lib.encode_ordinary(r.text) and after[d].round_trip
    digest = hashlib.sha256(str(sorted((r.doc_id, r.n_tokens) for r in after.values())).encode()).hexdigest()
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert digest == hashlib.sha256(str(sorted((r.doc_id, r.n_tokens) for r in whole)).encode()).hexdigest()
