"""One registered query per operator, each over the whole of its table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (
    bpe,
    decontaminate,
    filter_audit,
    lm_score,
    near_dedup,
    pii,
    prefix_trie,
    quality_rules,
    secret_scan,
    simhash,
    spans,
    training_order,
    url_filter,
    warc_audit,
)
from marketlens.llm.tables import read
from marketlens.session import scratch_path

#: Words ``[^\x20\x09-\x0D]+`` of A-Z lower-cased text.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_logistic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(read(spark, sf_dir, "documents"), k=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


OP2_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^ \\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 3
      THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE []::VARCHAR[] END) AS sh
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * both_n >= 85 * (x.n + y.n - both_n)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b
), comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN comp c ON c.doc_id = d.doc_id
"""


def op3_structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    return _digest(found, secret_scan.BASE)


def _digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    return found.select(
        "doc_id", *(spans.count("spans", k).alias(f"n_{k}") for k in base),
        F.sha2(spans.joined(spans.of_kinds("spans", base)), 256).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"))


#: One page id in so many is rotten in the replica that op4 audits, and one is lost.
FAULT_EVERY = 97


def op4_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica of the whole archive in which some records have one changed byte and some are lost."""
    body = F.coalesce("html", F.lit(""))
    other = F.when(F.startswith(body, F.lit("#")), "!").otherwise("#")  # never the character that is there
    rotten = F.when(F.col("page_id") % FAULT_EVERY == 0, F.overlay(body, other, F.lit(1), F.lit(1))).otherwise(F.col("html"))
    both = warc_audit.capture(read(spark, sf_dir, "pages"), order=warc_audit.IN_FILES, copy=rotten)
    original = both.select("page_id", "place", "record.*")
    # the replica's offsets come from its own bytes, before its records were lost
    replica = warc_audit.with_offsets(both.select("page_id", "place", "copy.*")).where(f"page_id is null or page_id % {FAULT_EVERY} <> 1")
    found = warc_audit.audit(original, replica, extras=True, moved=True)
    return found.select("page_id", "segment", "offset", "n_bytes", "sha256", "status")


OP4_SQL = """
WITH r AS (
  SELECT row_number() OVER () - 1 AS place, page_id,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:' || page_id
    || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html'
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS data
  FROM pages
)
SELECT page_id, place >> 10 AS segment,
  CAST(sum(strlen(data)) OVER (PARTITION BY place >> 10 ORDER BY place) - strlen(data) AS BIGINT) AS "offset",
  CAST(strlen(data) AS BIGINT) AS n_bytes, sha256(data) AS sha256,
  CASE page_id % 97 WHEN 0 THEN 'changed' WHEN 1 THEN 'missing' ELSE 'intact' END AS status
FROM r
"""


def op5_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "__leak.n_words", "__leak.n_hit", F.size("__leak.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "__leak.items"), 256).alias("items_sha256"),
        (F.col("__leak.n_hit") > 0).alias("contaminated"))


OP5_SQL = """
WITH lowered AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'i', CAST(item_id AS VARCHAR), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), w AS (SELECT kind, id, regexp_extract_all(t, '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS ws FROM lowered
), size AS (SELECT id, least(10, len(ws)) AS k, ws FROM w WHERE kind = 'i' AND len(ws) > 0
), item AS (
  SELECT DISTINCT id AS item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS gram FROM size
), doc AS (
  SELECT w.id, s.k, unnest(range(1, greatest(1, len(ws) - s.k + 2))) AS pos, ws
  FROM w, (SELECT DISTINCT k FROM size) s WHERE kind = 'd'
), hit AS (
  SELECT d.id, d.k, d.pos, item.item_id FROM doc d JOIN item ON item.k = d.k AND item.gram = array_to_string(d.ws[d.pos:d.pos + d.k - 1], ' ')
), words AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(pos, pos + k)) AS p FROM hit) GROUP BY id
), items AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS all_items
             FROM (SELECT DISTINCT id, item_id FROM hit) GROUP BY id)
SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(all_items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d JOIN w ON w.kind = 'd' AND w.id = CAST(d.doc_id AS VARCHAR)
LEFT JOIN words ON words.id = w.id LEFT JOIN items ON items.id = w.id
"""


def op6_bpe_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), bpe.ids_digest().alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.extract(read(spark, sf_dir, "documents")), pii.BASE)


def op8_quality_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op9_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages")).drop("score")


def op10_feistel_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(read(spark, sf_dir, "documents"), scratch_path(spark, "training-order"),
                                      order=training_order.IN_FILES)


def _feistel_sql(number: str) -> str:
    """The walk of ``number``'s permutation, one layer of SQL for each round."""
    inner = f"SELECT idx, x >> half AS l, x & mask AS r, half, mask, total FROM {number}"
    for k in training_order.round_keys(1):
        for h in (f"(r * 2654435761::UBIGINT + {k}::UBIGINT) & 4294967295::UBIGINT", "xor(h, h >> 15::UBIGINT)",
                  "(h * 2246822519::UBIGINT) & 4294967295::UBIGINT", "xor(h, h >> 13::UBIGINT)"):
            inner = f"SELECT idx, l, r, {h} AS h, half, mask, total FROM ({inner})"
        inner = f"SELECT idx, r AS l, xor(l, h & mask) AS r, half, mask, total FROM ({inner})"
    return f"SELECT idx, (l << half) | r AS x, half, mask, total FROM ({inner})"


OP10_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rn, doc_id, strlen(coalesce(text, '')) AS n FROM documents
), s AS (SELECT *, CASE WHEN n > 0 THEN (n + 512) // 512 ELSE 0 END AS k FROM d
), p AS (SELECT *, sum(k) OVER (ORDER BY rn) - k AS first FROM s
), q AS (SELECT doc_id, n, unnest(range(k)) AS part, first FROM p
), t AS (SELECT sum(k) AS total, greatest(1, (length(bin(CAST(greatest(sum(k), 2) - 1 AS BIGINT))) + 1) // 2) AS half FROM s
), start AS (
  SELECT CAST(first + part AS UBIGINT) AS idx, CAST(first + part AS UBIGINT) AS x, CAST(half AS UBIGINT) AS half,
         CAST((1::BIGINT << half) - 1 AS UBIGINT) AS mask, CAST(total AS UBIGINT) AS total FROM q, t
), walk AS (
  {_feistel_sql("start")}
  UNION ALL
  {_feistel_sql("(SELECT * FROM walk WHERE x >= total)")}
)
SELECT CAST(w.x AS BIGINT) AS slot, CAST(w.x // 32768 AS INTEGER) AS shard, q.doc_id, q.part,
  CAST(least(512, n + 1 - part * 512) AS BIGINT) AS n_tokens, CAST(w.x % 32768 AS BIGINT) * 512 AS "offset"
FROM q JOIN walk w ON w.idx = q.first + q.part AND w.x < w.total
"""


def op11_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"), k=4, bits=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP12_SQL = """
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^ \\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM base
), fails AS (
  SELECT part, doc_id,
    (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS bad
  FROM w
), mark AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), cell AS (
  SELECT part, bad, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM fails LEFT JOIN mark USING (doc_id) GROUP BY part, bad
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), step AS (
  SELECT filter_order, s AS step, bits[s] AS f, CAST(coalesce(list_sum(bits[1:s - 1]), 0) AS INTEGER) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS s)
), res AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN bad & (f + before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bad & f > 0 AND bad & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bad & f > 0 AND bad & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bad = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bad & f > 0 AND bad & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN bad & f > 0 AND bad & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cell, step GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM res
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


OP13_SQL = """
WITH t AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(mark || ' ' || words ORDER BY turn NULLS FIRST, mark) AS ts FROM t GROUP BY conv_id
), bits AS (  -- CRC-32 of the decimal id, bit by bit: -1 is a shift
  SELECT conv_id, list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))) AS ops FROM own
), head AS (
  SELECT conv_id, 3 - list_reduce(ops, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
    ELSE a >> 1 END) & 3 AS h FROM bits
), conv AS (
  SELECT o.conv_id, coalesce(p.ts, [])[1:h] || o.ts[h + 1:] AS ts
  FROM own o JOIN head USING (conv_id) LEFT JOIN own p ON p.conv_id = o.conv_id - ((o.conv_id % 20) + 20) % 20
), pre AS (
  SELECT conv_id, CAST(unnest(range(0, len(ts) + 1)) AS BIGINT) AS depth, ts FROM conv
), node AS (
  SELECT depth, array_to_string(ts[1:depth], ',') AS path, any_value(ts[1:depth]) AS ts, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(pre.ts) = depth), '')) AS ends
  FROM pre GROUP BY ALL
), up AS (
  SELECT n.path, n.depth, n.conv_id, n.n, n.ts, CAST(unnest(range(0, n.depth + 1)) AS BIGINT) AS above FROM node n
), kids AS (
  SELECT depth - 1 AS depth, array_to_string(ts[1:depth - 1], ',') AS path, count(*) AS k FROM node WHERE depth > 0 GROUP BY ALL
), sub AS (
  SELECT array_to_string(up.ts[1:above], ',') AS path, above AS depth,
    sum(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS leaves,
    sum(CASE WHEN up.depth = 0 THEN 0 ELSE (n - 1) * CAST(string_split(up.ts[up.depth], ' ')[2] AS BIGINT) END) AS saved
  FROM up LEFT JOIN kids ON kids.path = up.path AND kids.depth = up.depth GROUP BY ALL
)
SELECT node.conv_id, node.depth, par.conv_id AS parent_conv_id, CAST(node.n AS BIGINT) AS n_convs,
  CAST(coalesce(k, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  node.ends AS ends_sha256
FROM node JOIN sub ON sub.path = node.path AND sub.depth = node.depth
LEFT JOIN kids ON kids.path = node.path AND kids.depth = node.depth
LEFT JOIN node par ON node.depth > 0 AND par.depth = node.depth - 1 AND par.path = array_to_string(node.ts[1:node.depth - 1], ',')
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_logistic_mixing": op1_logistic_mixing,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_structural_secrets": op3_structural_secrets,
    "op4_merkle_fixity": op4_merkle_fixity,
    "op5_fm_index_decontamination": op5_fm_index_decontamination,
    "op6_bpe_merge_replay": op6_bpe_merge_replay,
    "op7_bootstrapped_pii": op7_bootstrapped_pii,
    "op8_quality_decision_list": op8_quality_decision_list,
    "op9_url_regression": op9_url_regression,
    "op10_feistel_training_order": op10_feistel_training_order,
    "op11_simhash_variants": op11_simhash_variants,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op2_minhash_near_dedup": OP2_SQL,
    "op4_merkle_fixity": OP4_SQL,
    "op10_feistel_training_order": OP10_SQL,
    "op5_fm_index_decontamination": OP5_SQL,
    "op12_filter_interactions": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
