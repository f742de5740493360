"""The queries of this package and their SQL. Each applies its operator to whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.jaccard_join import ngram_jaccard_join

    return ngram_jaccard_join(table(spark, sf_dir, "documents"), n=3, num=90, den=100, links=True)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.url_filter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH parts AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
split AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
rules(rule_host, rule_path, rule_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM split, rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT s.page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM split s LEFT JOIN fits f ON s.page_id = f.page_id
"""


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.matroska import read_features, store_texts

    return read_features(store_texts(table(spark, sf_dir, "documents")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.quality import classify

    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tideline.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.rlz_dedup import remove_duplicates

    return remove_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("rest.doc_id", "n_words", "n_removed", "kept_sha256")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).drop("source")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.order_minhash import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_url_filter": op2_url_filter,
    "op3_media_columns": op3_media_columns,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing": op9_mixing,
    "op10_order_minhash": op10_order_minhash,
    "pipeline": pipeline,
}
ORACLE_SQL: dict[str, str] = {"op2_url_filter": OP2_SQL}
