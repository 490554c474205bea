"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.llm import (
    bpe,
    fill_middle,
    hash_search,
    language_id,
    merkle,
    nbest,
    near_dup,
    packing,
    page_text,
    secret_scan,
    topk,
    toxicity,
    url_filter,
)
from careflow.llm.common import bounded_batches, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.token_counts(table(spark, sf_dir, "documents"), path, 1024)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"),
                                    near_dup.Params(words=3, percent=85))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_hash_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_n_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.n_best(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 3)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    # One more than the largest long is still a decimal number.
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    leaves = merkle.leaf_digests(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "lang",
                                 {"n_chars": more}, tampered)
    return merkle.manifest(leaves).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.transform(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(), 256).alias("restored_sha256"))


# The rules of the contract, and the hosts that no page should come from: fixed values.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
BLOCKED_HOSTS = [f"{name}.example.{top}" for name in ("casino-win", "cheap-pills", "free-bets", "spam-farm")
                 for top in ("com", "net", "org")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"),
                            url_filter.in_list(spark, URL_RULES, "host", "path", "verdict"),
                            url_filter.in_list(spark, [(h,) for h in BLOCKED_HOSTS], "host"))


# The contract's scores by brute force; vectors of a NULL, NULL component or non-finite
# component take no part, and a vec_id counts once.
OP1_SQL = """
WITH rows AS (
  SELECT vec_id, MIN(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
cells AS (
  SELECT vec_id, generate_subscripts(v, 1) AS d, CAST(floor(256 * unnest(v)) AS BIGINT) AS x FROM rows),
sums AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(SUM(a.x * b.x) AS BIGINT) AS score
  FROM cells a JOIN cells b ON a.d = b.d
  WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
  GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM sums)
WHERE rank <= 5
"""

# Nodes level by level until one is left, per language and then over the languages; every leaf's way
# up through both, with its siblings' digests and the fold. crc32 is written out by its bits.
OP11_SQL = """
WITH RECURSIVE raw AS (
  SELECT doc_id, lang, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS f,
         [CAST(doc_id AS VARCHAR), source, lang, CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR), text] AS changed_f,
         list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                    lambda c : CAST(ascii(c) AS BIGINT)),
           lambda a, b : list_reduce([xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0],
                                     lambda x, i : xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, lang, coalesce(xor(crc, 4294967295) % 7 = 0, FALSE) AS tampered,
         sha256(list_aggregate(list_transform(f, lambda v : coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) AS leaf,
         sha256(list_aggregate(list_transform(changed_f, lambda v : coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '')) AS changed
  FROM raw),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g
  FROM hashed),
nodes AS (
  SELECT g, 0 AS lvl, idx, leaf AS h, COUNT(*) OVER (PARTITION BY g) AS n FROM leaves
  UNION ALL
  SELECT g, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY g, lvl, idx // 2),
tops AS (SELECT g, lvl AS height, h AS subroot FROM nodes WHERE n = 1),
above AS (
  SELECT 0 AS lvl, g - 1 AS idx, subroot AS h, COUNT(*) OVER () AS n FROM tops
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM above WHERE n > 1 GROUP BY lvl, idx // 2),
siblings AS (
  SELECT g, lvl, idx, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT t.g, t.height + a.lvl, a.idx, a.h FROM above a, tops t WHERE a.n > 1),
ways AS (
  SELECT l.g, l.idx AS leaf_idx, 0 AS lvl, CASE WHEN t.height = 0 THEN l.g - 1 ELSE l.idx END AS idx,
         '' AS proof, CASE WHEN tampered THEN changed ELSE leaf END AS h,
         t.height, t.height + (SELECT MAX(lvl) FROM above) AS last
  FROM leaves l JOIN tops t ON t.g = l.g
  UNION ALL
  SELECT w.g, w.leaf_idx, w.lvl + 1, CASE WHEN w.lvl + 1 = w.height THEN w.g - 1 ELSE w.idx // 2 END,
         w.proof || coalesce(s.h, ''),
         sha256(CASE WHEN w.idx % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END), w.height, w.last
  FROM ways w LEFT JOIN siblings s ON s.g = w.g AND s.lvl = w.lvl AND s.idx = xor(w.idx, 1)
  WHERE w.lvl < w.last)
SELECT l.doc_id, l.leaf, t.subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root,
       w.h = r.h AS verified
FROM leaves l JOIN tops t ON t.g = l.g JOIN ways w ON w.g = l.g AND w.leaf_idx = l.idx AND w.lvl = w.last
JOIN above r ON r.n = 1
"""

OP12_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
         CAST('0x' || substr(d, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>')
                OR CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
cut AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:least(x, y)], '') AS pre,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid, array_to_string(u[greatest(x, y) + 1:], '') AS suf
  FROM drawn),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS out
  FROM cut),
parts AS (SELECT *, string_split_regex(out, '<[PSM]>') AS p FROM made)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars, sha256(out) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN out WHEN 'psm' THEN p[2] || p[4] || p[3]
                        ELSE p[3] || p[4] || p[2] END) AS restored_sha256
FROM parts
"""

OP13_SQL = r"""
WITH rules(host, path, verdict) AS (VALUES {rules}),
blocked(host) AS (VALUES {hosts}),
cut AS (
  SELECT row_number() OVER () AS r, page_id, path,
         translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM (SELECT page_id, coalesce(regexp_extract(url, '{url}', 1), '') AS host,
               coalesce(regexp_extract(url, '{url}', 2), '') AS path FROM pages)),
fits AS (
  SELECT c.r, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM cut c JOIN rules r
    ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
  GROUP BY c.r),
bad AS (
  SELECT DISTINCT c.r FROM cut c JOIN blocked b ON c.host = b.host OR ends_with(c.host, '.' || b.host))
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.verdict, CASE WHEN b.r IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM cut c LEFT JOIN fits f ON f.r = c.r LEFT JOIN bad b ON b.r = c.r
""".format(rules=", ".join(map(str, URL_RULES)), hosts=", ".join(f"('{h}')" for h in BLOCKED_HOSTS),
           url=url_filter.URL)

_QUERIES: tuple[QueryFn, ...] = (
    op1_exact_top_k, op2_page_text, op3_token_counts, op4_language_id, op5_secret_scan,
    op6_near_duplicates, op7_toxicity, op8_hash_search, op9_packing, op10_n_best,
    op11_merkle_manifest, op12_fill_middle, op13_url_filter,
)


def _bounded(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bounded_batches(spark), sf_dir)

    run.__name__ = fn.__name__
    return run


def queries() -> dict[str, QueryFn]:
    return {fn.__name__: _bounded(fn) for fn in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_top_k": OP1_SQL, "op11_merkle_manifest": OP11_SQL, "op12_fill_middle": OP12_SQL,
            "op13_url_filter": OP13_SQL}
