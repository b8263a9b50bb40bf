import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from marketlens.llm import training_order as order
from marketlens.llm.queries import OP10_SQL, op10_feistel_training_order
from tests.llm.common import DOCS, ROWS, SMALL, docs


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000, 70_001])
def test_a_permutation(n):
    slots = order.feistel(np.arange(n), n, 7)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 63 or (slots != np.arange(n)).mean() > 0.9
    assert n < 63 or (order.feistel(np.arange(n), n, 8) != slots).any()


def test_round_trip_and_resume(spark, tmp_path):
    folder = str(tmp_path / "order")
    rows = [r for r in ROWS if r[0] != 6] + [(50, "z" * 1600, *"abcdefgh")]
    manifest = order.materialise(docs(spark, rows), folder, stride=16, per_shard=50)
    entries = {r.slot: r for r in manifest.collect()}
    total = len(entries)
    assert sorted(entries) == list(range(total))
    assert total == sum(-(-(len((t or "").encode()) + 1) // 16) for _, t, *_ in rows if t)
    every = order.read(folder, 0, total + 9, stride=16, per_shard=50)
    assert every.shape == (total, 16)
    assert (order.read(folder, 33, 40, stride=16, per_shard=50) == every[33:73]).all()
    assert all(entries[s].offset == s % 50 * 16 and entries[s].shard == s // 50 for s in entries)
    by_doc = {}
    for s, r in entries.items():
        by_doc.setdefault(r.doc_id, []).append((r.part, bytes(every[s][:r.n_tokens])))
    for doc_id in (4, 5, 50, 13):
        text = next(t for d, t, *_ in rows if d == doc_id)
        assert b"".join(p for _, p in sorted(by_doc[doc_id])) == text.encode() + b"\xff"
    assert (every[[s for s, r in entries.items() if r.n_tokens < 16][0]][-1]) == 255


def test_ids_and_empty_tables(spark, tmp_path):
    table = spark.createDataFrame([(1, [5, 6, 70_000]), (2, []), (3, None)], "doc_id long, ids array<int>")
    manifest = order.materialise(table, str(tmp_path / "ids"), column="ids", stride=4, width=4)
    assert [(r.slot, r.doc_id, r.n_tokens) for r in manifest.collect()] == [(0, 1, 4)]
    assert order.read(str(tmp_path / "ids"), 0, 5, stride=4, width=4).tolist() == [[5, 6, 70_000, 0xFFFFFFFF]]
    assert order.materialise(spark.createDataFrame([], DOCS), str(tmp_path / "none")).count() == 0


def test_the_order_does_not_depend_on_splits(spark, tmp_path):
    """Two files, the second one larger, of several row groups: default splits and small ones, against the SQL."""
    table = pq.read_table(f"{SMALL}/documents.parquet")
    folder = tmp_path / "documents.parquet"
    folder.mkdir()
    cut = table.num_rows // 3
    pq.write_table(table.slice(0, cut), folder / "part-0.parquet", row_group_size=9)
    pq.write_table(table.slice(cut), folder / "part-1.parquet", row_group_size=9)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet(['{folder}/part-0.parquet', '{folder}/part-1.parquet'])")
    want = con.sql(OP10_SQL).df().sort_values("slot").reset_index(drop=True)
    got = []
    for size in ("128m", "8k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got.append(op10_feistel_training_order(spark, str(tmp_path)).toPandas().sort_values("slot").reset_index(drop=True)[list(want)])
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(want) and all(g.equals(want.astype(g.dtypes)) for g in got)
