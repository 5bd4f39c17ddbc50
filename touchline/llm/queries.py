"""Registered queries of the training-data operators, with their SQL where SQL can express them.

Each query applies one operator to its whole table with production parameters.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (ann, bpe, embed_dedup, langid, line_dedup, merkle, packing, periodic, pii, quality, simhash, toxicity, url_filter)
from touchline.llm.common import crc_fold, table

#: Vocabulary files of public tokenizers; callers may point these elsewhere.
RANKS, PIECES, MANY_RANKS = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and removed lines of every document, and a digest of what is left."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", F.col("tl_lines").alias("n_lines"), F.col("tl_removed").alias("n_removed"),
                      F.sha2(F.coalesce("tl_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op4_quality(spark: SparkSession, sf_dir: str, model_path: str | None = None, rank_path: str | None = None) -> DataFrame:
    import public_tokenizers

    with open(model_path or vocabulary(PIECES), "rb") as f:
        model = f.read()
    ranks = bpe.read_ranks(rank_path or vocabulary(MANY_RANKS))
    return quality.quality_table(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), model, ranks=ranks, pattern=public_tokenizers.PATTERN)


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_table(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op6_bpe(spark: SparkSession, sf_dir: str, rank_path: str | None = None) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(rank_path or vocabulary(RANKS))
    return bpe.bpe_table(table(spark, sf_dir, "documents", "doc_id", "text"), ranks, public_tokenizers.PATTERN)


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_links(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op8_urls(spark: SparkSession, sf_dir: str, listed: DataFrame | None = None) -> DataFrame:
    """``listed`` is the list (url: canonical URLs); without it, that of the SQL: the pages on HARMFUL_LABELS."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge_urls(pages, url_filter.urls_on_labels(pages) if listed is None else listed)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text", "source"), near=True)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", simhash.fp_hex(F.col("fp")).alias("fingerprint"), "component_id")


def echoed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document as the query takes them: from word a on, every tenth document (by crc32 of its id) repeats p of them."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the one of greatest exponent, and digests of all runs and of the collapsed text."""
    out = periodic.collapse_runs(table(spark, sf_dir, "documents", "doc_id", "text"), rewrite=echoed)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")

    def further(best: Column, run: Column) -> Column:  # runs come by start, then period: the earlier of equals stays
        return F.when(best.isNull() | (run.length * best.period > best.length * run.period), run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast(periodic.RUN), further)
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                     _sha256_of(listed).alias("runs_sha256"), _sha256_of(F.col("collapsed")).alias("collapsed_sha256"))
    exponent = F.expr("(1000 * best.length) div best.period")
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents; every fifth (by crc32 of its id) presents a leaf of its text in lower case."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    lowered = [F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if f == "text" else F.col(f) for f in fields]
    shown = F.when(crc_fold(F.col("doc_id"), 5) == 0, merkle.digest_of(*lowered))
    return merkle.merkle_manifest(table(spark, sf_dir, "documents", *fields), fields, shown=shown)


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each row whose id 20 divides, among all rows."""
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_pii, op3_toxicity, op4_quality, op5_langid, op6_bpe, op7_embeddings,
                                   op8_urls, op9_packing, op10_simhash, op11_periodic_runs, op12_merkle,
                                   op13_nearest)}

_OP1_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts,
         CASE WHEN length(text) > 0 THEN len(string_split(text, chr(10))) ELSE 0 END AS n_lines
  FROM documents
), lines AS (
  SELECT doc_id, site, i AS pos, parts[i] AS raw, trim(regexp_replace(parts[i], '[ \t\r]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, site, parts, unnest(generate_series(1, len(parts))) AS i FROM cut)
), able AS (
  SELECT * FROM lines WHERE line <> ''
), spread AS (
  SELECT line, min(doc_id) AS first_doc FROM able GROUP BY line HAVING count(DISTINCT site) >= 8
), gone AS (
  SELECT a.doc_id, a.pos FROM able a JOIN spread s ON s.line = a.line
  WHERE a.doc_id <> s.first_doc
     OR EXISTS (SELECT 1 FROM able b WHERE b.doc_id = a.doc_id AND b.line = a.line AND b.pos < a.pos)
), kept AS (
  SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.pos) AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
  WHERE g.pos IS NULL GROUP BY l.doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT c.doc_id, CAST(c.n_lines AS BIGINT) AS n_lines, CAST(coalesce(x.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM cut c LEFT JOIN lost x ON x.doc_id = c.doc_id LEFT JOIN kept k ON k.doc_id = c.doc_id
"""

_OP8_SQL = r"""
WITH raw AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM raw
), rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), ruled AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON ('.' || p.host) LIKE ('%.' || r.host) AND starts_with(p.path, r.path) GROUP BY p.page_id
), named AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/$', '') AS plain FROM parts
), listed AS (
  SELECT DISTINCT plain FROM named WHERE list_has_any(string_split(host, '.'), ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
)
SELECT n.page_id, n.host, n.path, r.rule,
       coalesce(r.verdict, CASE WHEN n.host <> '' AND n.plain IN (SELECT plain FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN ruled r ON r.page_id = n.page_id
"""

_CRC32_SQL = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
  lambda c, b: list_reduce(range(8), lambda k, i: xor(k >> 1, 3988292384 * (k & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"""


def _leaf_sql(*fields: str) -> str:
    """What a leaf digests of the given columns or expressions."""
    return " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)


_OP12_SQL = rf"""
WITH RECURSIVE given AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS total,
         {_CRC32_SQL} % 5 = 0 AS tampered, {_leaf_sql("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)")} AS head, text,
         CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS given_text
  FROM documents
), leaves AS (
  SELECT doc_id, source, idx, total, sha256(head || {_leaf_sql("text")}) AS leaf,
         sha256(head || {_leaf_sql("given_text")}) AS shown
  FROM given
), tree AS (
  SELECT source, 0 AS lvl, idx, total, leaf AS node FROM leaves
  UNION ALL
  SELECT source, lvl + 1, idx // 16, (total + 15) // 16, sha256(string_agg(node, '' ORDER BY idx)) FROM tree WHERE total > 1
  GROUP BY source, lvl, total, idx // 16
), subroots AS (
  SELECT source, node AS subroot, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM tree WHERE total = 1
), top AS (
  SELECT 0 AS lvl, place AS idx, total, subroot AS node FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, (total + 15) // 16, sha256(string_agg(node, '' ORDER BY idx)) FROM top WHERE total > 1 GROUP BY lvl, total, idx // 16
), levels AS (  -- every run of nodes, numbered upwards along a document's way
  SELECT source, lvl AS step, idx // 16 AS run, string_agg(node, '' ORDER BY idx) AS nodes FROM tree WHERE total > 1 GROUP BY source, lvl, idx // 16
  UNION ALL
  SELECT s.source, s.height + t.lvl, s.place // CAST(16 ** (t.lvl + 1) AS BIGINT), t.nodes
  FROM subroots s JOIN (SELECT lvl, idx // 16 AS run, string_agg(node, '' ORDER BY idx) AS nodes FROM top WHERE total > 1 GROUP BY lvl, idx // 16) t
    ON t.run = s.place // CAST(16 ** (t.lvl + 1) AS BIGINT)
), way AS (
  SELECT l.doc_id, v.step, CASE WHEN v.step < s.height THEN l.idx // CAST(16 ** v.step AS BIGINT) ELSE s.place // CAST(16 ** (v.step - s.height) AS BIGINT) END % 16 AS child, v.nodes
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN levels v ON v.source IS NOT DISTINCT FROM l.source
    AND v.run = CASE WHEN v.step < s.height THEN l.idx // CAST(16 ** (v.step + 1) AS BIGINT) ELSE s.place // CAST(16 ** (v.step - s.height + 1) AS BIGINT) END
), proofs AS (
  SELECT doc_id, sha256(string_agg(nodes[:64 * child] || nodes[64 * child + 65:], '' ORDER BY step)) AS proof_sha256, count(*) AS steps FROM way GROUP BY doc_id
), folded AS (
  SELECT doc_id, 0 AS step, shown AS node FROM leaves
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(w.nodes[:64 * w.child] || f.node || w.nodes[64 * w.child + 65:]) FROM folded f JOIN way w ON w.doc_id = f.doc_id AND w.step = f.step
), root AS (SELECT node FROM top WHERE total = 1)
SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = r.node AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source CROSS JOIN root r LEFT JOIN proofs p ON p.doc_id = l.doc_id
JOIN folded f ON f.doc_id = l.doc_id AND f.step = coalesce(p.steps, 0)
"""

ORACLE_SQL = {"op1_line_dedup": _OP1_SQL, "op8_urls": _OP8_SQL, "op12_merkle": _OP12_SQL}
