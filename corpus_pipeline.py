"""A corpus from raw documents to packed sequences, in stages that store their results.

Each stage works on all rows that the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import decontaminate, jaccard, langid, packing, secret_scan
from tillstream.llm.common import stored
from tillstream.session import settings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn profiles from the rows with a lang; rows without a letter or like no learned language go. ``lang`` becomes the prediction.

    What a text in a learned language scores at least is learned from the rows with a lang, by size of the text.
    """
    scores = langid.predict_language(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text", "lang"), langid.learn_profiles(docs))
    found = stored(scores.drop("text", "lang").select("row", "lang_pred", "score"), "language-scores")
    limits = langid.score_limits(found.select("row.text", "row.lang", "lang_pred", "score"))
    kept = found.where(langid.known_language(limits, "row.text"))
    return kept.select(F.col("row").withField("lang", F.col("lang_pred")).alias("row")).select("row.*").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays. Rows without doc_id stay.

    Of different rows with one doc_id, only one stays, whichever: doc_id is the key of a document.
    """
    first = jaccard.jaccard_components(docs).where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    one = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null")).select(docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; an item of one word is held by each document with that word."""
    leaks = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; no row goes."""
    return secret_scan.mask_secrets(docs, secret_scan.learn_secrets(docs)).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [("language", language), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks),
                                   ("secrets", secrets), ("pack", pack)]

ORACLE_SQL = None  # several stages are models; tests compare them with plain Python


ROWS = 2000  # that pass between Spark and Python at once: whole texts, of which every Python worker and its task hold a few copies
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    most = int(spark.conf.get(_BATCH))
    with settings(spark, {_BATCH: str(min(ROWS, most) if most > 0 else ROWS)}):
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), name)
    return docs
