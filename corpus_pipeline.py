"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a frame, which ``run`` writes as Parquet and reads again
as the next stage's documents. All but the last return the columns of ``documents``. Documents leave for a reason only:
no recognised language, a near copy with a smaller doc_id, a benchmark passage. Secrets are replaced, not dropped with
their documents.

A null text leaves at the first stage, as it has no language; so do texts without a letter. Repeated rows are near copies
of each other: one stays. An empty table gives empty frames.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import decontamination, languages, packing, secret_scan, simhash
from tallyline.llm.frames import scratch_path
from tallyline.llm.queries import SIMHASH_DISTANCE, SIMHASH_SHINGLE, learned_languages, table, trained_forest

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Pieces of text that a packing worker remembers: fewer than by default, beside what the stages before leave in memory.
REMEMBERED = 500_000


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is recognised. Without any labelled document nothing can be recognised or rejected."""
    model = learned_languages(docs)
    if not model.families:
        return docs.select(COLUMNS)
    found = docs.withColumn("__lang", languages.predicted(model, spark, F.col("text")))
    return found.where(F.col("__lang.lang") != languages.UNDETERMINED).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    return simhash.representatives(docs, SIMHASH_SHINGLE, SIMHASH_DISTANCE).select(COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminated(docs, table(spark, folder, "benchmark")).select(COLUMNS)


def secret_removal(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with a placeholder for each secret; n_chars follows where the text has changed."""
    cut = secret_scan.redacted(docs.select(*COLUMNS, F.col("text").alias("__before")), trained_forest(docs))
    n_chars = F.when(F.col("text") == F.col("__before"), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.withColumn("n_chars", n_chars).select(COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, remembered=REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_removal),
    ("best_fit_packing", best_fit_packing),
]
#: The stages with trained models and packing can't be written as SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        made = stage(spark, docs, folder)
        if number == len(STAGES):
            return made
        path = scratch_path(spark, f"pipeline-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
