"""The operators' queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, chroma, exact_dedup, html_text, jaccard_join, langid, lexical, packing, periodic_runs, substring_dedup, suffix_dedup, topk, toxicity
from ledgerline.llm.entry_sql import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digest(bpe.bpe_round_trip(_table(spark, sf_dir, "documents"), ["doc_id"], public_tokenizers.path("word_bpe_49k.json")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"), ["doc_id"]))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = chroma.tones(_table(spark, sf_dir, "embeddings"))
    return chroma.align(chroma.fingerprints(media, "id", "audio")).withColumnRenamed("id", "vec_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_pages(_table(spark, sf_dir, "pages"), langid.train(_table(spark, sf_dir, "documents")))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents")))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.plant(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs, ["doc_id"]))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), ["doc_id"])


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
