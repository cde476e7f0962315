"""Corpus pipeline: five operators in a row, from raw documents to packed sequences.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame. ``run`` writes each stage's rows as Parquet below the shared
checkpoint folder and reads them again as the next one's ``docs``, so that a lost
executor never repeats an earlier stage. All stages but the last return the columns of
``docs``; further columns pass through. Null texts are handled as each operator says:
the quality rules reject them, as they have no word. An empty table passes every stage.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantlake.llm import decontaminate, near_duplicates, packing, repetition, secrets
from variantlake.llm.common import table, written

#: SQL has no tokenizer, shingle join or automaton; tests hold each stage against brute force
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the suffix-array repetition limits reject."""
    return repetition.with_quality(docs, out="__quality").where("__quality.kept").drop("__quality")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least id."""
    return near_duplicates.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is covered by tiles."""
    found = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"), out="__leaks")
    return found.where(F.size("__leaks") == 0).drop("__leaks")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked; ``n_chars`` follows the text."""
    masked = secrets.redacted(docs, secrets.learn_formats(docs))
    if "n_chars" in masked.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: its place in a sequence of 2048 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
