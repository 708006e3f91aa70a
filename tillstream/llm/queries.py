"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.llm import chat, decontaminate, divergence, jaccard, langid, packing, page_text, pieces, prefix_trie, quality, rules, secret_scan, shards

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(modulus: int) -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % modulus


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), 8)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 4096, 1)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_windows(chat.format_windows(talks))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    profiles = langid.learn_profiles(docs.where(~held_out))
    return langid.predict_language(docs.select("doc_id", "text", held_out.alias("held_out")), profiles).drop("text")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    network = quality.learn_quality(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = quality.score_quality(docs.withColumn("held_out", held_out), network).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.learn_secrets(docs)).drop("text")
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id", *[_number_of(spans, kind) for kind in ("assign", "access", "hex")],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return page_text.extract_text(pages, page_text.train_labeller()).withColumn("n_chars", F.length("text").cast("long"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.encode_documents(docs, public_tokenizers.path(PIECES))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_jaccard_join, op2_decontamination, op3_sharding, op4_packing, op5_chat, op6_language,
                            op7_quality, op8_rules, op9_secrets, op10_page_text, op11_prefix_trie, op12_pieces, op13_divergence, pipeline)}
