"""The ten registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewright.llm.common import table, work_table
from tomewright.llm.cotrain import fit_quality, score_quality
from tomewright.llm.decontaminate import leaks
from tomewright.llm.langid import fit_languages, identify
from tomewright.llm.mixing import sampled
from tomewright.llm.pii import find_pii
from tomewright.llm.quality_rules import apply_rules, fit_rules, with_stats
from tomewright.llm.repeats import cut_repeats, digest_of
from tomewright.llm.simhash import hex_fingerprint, near_duplicates
from tomewright.llm.toxicity import fit_toxicity, score_toxicity
from tomewright.llm.url_filter import filter_urls

#: The rules of the registered url query, as (host, path, verdict).
URL_RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = work_table(with_stats(docs), "stats")
    return apply_rules(docs, fit_rules(docs, table(spark, sf_dir, "labels"), stats=stats), stats=stats)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampled(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_languages(docs))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents")).withColumn("kept_sha256", digest_of("kept")).drop("kept")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 9))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP1_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
         ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS k
  FROM split LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""


#: By definition: all windows of an item's length around a shared shingle, compared as bags of shingles.
OP9_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), words AS (
  SELECT kind, id, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM texts
), grams AS (
  SELECT kind, id, len(w) - 4 AS n, unnest(range(0, len(w) - 4)) AS pos,
         unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS g
  FROM words WHERE len(w) >= 5
), items AS (
  SELECT id AS item_id, n AS m, g, count(*) AS c FROM grams WHERE kind = 'b' GROUP BY ALL
), hits AS (
  SELECT d.id AS doc_id, d.n, d.pos, d.g, item_id, m, c, least(d.n, m) AS size FROM grams d JOIN items USING (g) WHERE kind = 'd'
), starts AS (
  SELECT DISTINCT doc_id, item_id, m, size, unnest(range(greatest(0, pos - size + 1), least(pos, n - size) + 1)) AS start FROM hits
), shared AS (
  SELECT s.doc_id, s.item_id, s.m, s.size, s.start, h.g, least(count(*), any_value(h.c)) AS k
  FROM starts s JOIN hits h ON s.doc_id = h.doc_id AND s.item_id = h.item_id AND h.pos >= s.start AND h.pos < s.start + s.size
  GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, start, sum(k) / (any_value(size) + any_value(m) - sum(k)) AS similarity FROM shared GROUP BY ALL
)
SELECT doc_id, item_id, round(max(similarity), 9) AS similarity FROM scored GROUP BY ALL HAVING max(similarity) >= 0.8
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op9_benchmark_decontamination": OP9_SQL}
