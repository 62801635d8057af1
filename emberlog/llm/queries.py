"""Queries of the training-data operators over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import bpe, decontaminate, html_extract, license_scan, mixing, prefix_trie, quality, quote_links, simhash, token_files, url_filter, vector_codes, warc
from emberlog.llm.common import checkpoint, shared_dir, table

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the query's contract. The operator's own RULES, which its SQL and tests are made for, block net/de/ instead.
URL_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permitted")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    trees = quality.fit_quality(documents, table(spark, sf_dir, "labels"))
    return quality.score_documents(documents, trees)


def op4_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.link_quotes(table(spark, sf_dir, "conversations"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), shared_dir(spark, "tokens"))
    return token_files.read_token_files(spark, manifest)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules=URL_RULES)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return warc.read_archives(spark, manifest)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = checkpoint(prefix_trie.turns_of(table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_html_extract": op2_html_extract,
    "op3_quality_rules": op3_quality_rules,
    "op4_quote_links": op4_quote_links,
    "op5_token_files": op5_token_files,
    "op6_decontamination": op6_decontamination,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_url_filter": op8_url_filter,
    "op9_simhash": op9_simhash,
    "op10_warc": op10_warc,
    "op11_mixing": op11_mixing,
    "op12_vector_codes": op12_vector_codes,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op8_url_filter": url_filter.SQL,
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d FROM pages),
        g AS (SELECT d, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY d HAVING count(*) > 1)
        SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, p.d AS payload_digest,
               CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
        FROM p LEFT JOIN g ON p.d = g.d AND strlen(h) >= 100
    """,
}
