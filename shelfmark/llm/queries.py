"""The queries of this subpackage, ``(spark, folder)`` to a frame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import (alignment, bpe, chaining, chosen_path, collocations, compression,
                           hamming_index, jaccard, language, mixing, rule_ensemble,
                           suffix_dedup, warc)

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(spark.read.parquet(f"{folder}/{table}.parquet"))


QUERIES: dict[str, Query] = {
    "op1_suffix_array_dedup": _over("documents", suffix_dedup.suffix_array_dedup),
    "op2_ngram_jaccard_join": _over("documents", jaccard.ngram_jaccard_join),
    "op3_byte_level_bpe": _over("documents", bpe.byte_level_bpe),
    "op4_source_mixing": _over("documents", mixing.mixing),
    "op5_hyperdimensional_language": _over("documents", language.language_id),
    "op6_capture_index": _over("pages", warc.capture_index),
    "op7_collinear_chaining": _over("documents", chaining.all_pairs),
    "op8_sparse_rule_ensemble": lambda spark, folder: rule_ensemble.sparse_rules(
        spark.read.parquet(f"{folder}/documents.parquet"),
        spark.read.parquet(f"{folder}/labels.parquet")),
    "op9_compression_bands": _over("documents", compression.compression_bands),
    "op10_multi_index_hashing": _over("embeddings", hamming_index.multi_index_hashing),
    "op11_chosen_path": _over("documents", chosen_path.chosen_path),
    "op12_suffix_quicksort": _over("documents", collocations.collocations),
    "op13_pair_bitmaps": _over("documents", alignment.cross_tokenizer_alignment),
}

SQL: dict[str, str] = {
    "op4_source_mixing": mixing.mixing_sql(),
    "op6_capture_index": """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest,
    CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
told AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND first > page_id THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 1000 AND first > page_id THEN first END AS refers_to
FROM told""",
    "op12_suffix_quicksort": collocations.collocations_sql(),
}
