"""One query per operator over a directory of parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from txnmart.llm import byte_pairs, exact, hard_negatives, html_text, language_model, lexical, mixing, neighbours, packing, privacy, simhash, toxicity, url_rules
from txnmart.llm.common import read


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find(read(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in privacy.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learned = language_model.training(F.col("doc_id"))
    model = language_model.train(docs.filter(learned))
    scored = language_model.score(docs, model)
    return scored.select(
        "doc_id",
        (~learned).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "source", "piece", "start", "length", "bin", "offset")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(read(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(rows.select("vec_id", "embedding", label.alias("label")))
    return hard_negatives.mine(rows, rows.filter("id % 100 = 0"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    vocabulary = byte_pairs.Vocabulary(ranks, public_tokenizers.PATTERN)
    tokens = F.col("tokens")
    return byte_pairs.encode(read(spark, sf_dir, "documents"), vocabulary).select(
        "doc_id",
        F.size(tokens).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(tokens.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(byte_pairs.decode(tokens, vocabulary), 256).alias("decoded_sha256"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_personal_data": op2_personal_data,
    "op3_language_model": op3_language_model,
    "op4_nearest": op4_nearest,
    "op5_simhash": op5_simhash,
    "op6_best_fit": op6_best_fit,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_html_text": op9_html_text,
    "op10_mix_sources": op10_mix_sources,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_lexical_search": op13_lexical_search,
}
