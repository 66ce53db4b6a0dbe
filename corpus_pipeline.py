"""A corpus pipeline: documents without toxic ones, without those in no language, one of each
group of near duplicates, without repeated passages, packed in training sequences.

Counts as part of the subpackage llm. Each stage takes (spark, docs, sf_dir) and reads what its
predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import jaccard_join, langid, packing, substring_dedup, toxicity
from ledgerline.llm.common import made_so_far, settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, COLUMNS).filter("predicted = 0").select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text in a language that the evidence settles on; lang becomes that language.
    A document goes if it has no letters or if no language has half of the posterior."""
    others = [c for c in COLUMNS if c != "lang"]
    found = langid.identify(docs, others, langid.train(docs), F.col("text"), F.col("lang"), F.col("source"))
    return found.filter("confidence >= 0.5 and text_lang is not null").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group that links of similarity 0.8 and more on
    shingles of five words connect. Rows are told apart by their place, not by their doc_id."""
    return jaccard_join.first_of_each(docs, COLUMNS, n=5, percent=80)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 35 words that also stand elsewhere; a document of which
    nothing is left goes."""
    deduped = substring_dedup.substring_dedup(docs, COLUMNS)
    kept = deduped.filter("n_removed = 0 or kept <> ''")
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in training sequences."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", keep_languages),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", drop_repeats),
    ("best-fit packing", pack),
]

#: Models and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = spark.read.parquet(f"{sf_dir}/documents.parquet"), made_so_far(spark)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), mark)
    return STAGES[-1][1](spark, docs, sf_dir)
