"""The corpus queries, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsemill.llm import decontaminate, html_text, licenses, mixing, near_dups, prefix_trie, quality, ranked_search, repeats, secret_scan, token_counts, toxicity, url_filter
from pulsemill.llm.frames import read_table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_SQL: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[function.__name__] = function
    return function


@_query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


@_query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


@_query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(token_counts.MODEL))


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(documents, toxicity.fit(documents, read_table(spark, sf_dir, "labels")))


@_query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix_rows(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


LLM_SQL["op8_source_mix"] = (
    mixing.MIX_SQL.format(table="documents") + "select doc_id, size, source_size, target, taken from mixed"
)


@_query
def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return quality.line_quality(documents, quality.fit_field(documents, read_table(spark, sf_dir, "labels")))


@_query
def op3_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(spark, read_table(spark, sf_dir, "documents")).drop("kept")


LLM_SQL["op3_repeated_spans"] = repeats.REPEATS_SQL.format(table="documents")


@_query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.duplicate_classes(spark, read_table(spark, sf_dir, "documents"))


@_query
def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(spark, documents, benchmark).drop("mark")


@_query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(read_table(spark, sf_dir, "documents"))


@_query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(spark, pages, url_filter.listed_by_name(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


LLM_SQL["op11_url_filter"] = url_filter.URL_SQL.format(table="pages")


@_query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return ranked_search.search(spark, documents, benchmark).drop("place")


LLM_SQL["op13_ranked_search"] = ranked_search.SEARCH_SQL.format(documents="documents", benchmark="benchmark")


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark, read_table(spark, sf_dir, "conversations"))


LLM_SQL["op12_prefix_trie"] = prefix_trie.TRIE_SQL.format(table="conversations")
