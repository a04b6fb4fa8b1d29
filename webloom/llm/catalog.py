"""Queries of the training-data operators: name -> (spark, sf_dir) callable, and DuckDB oracles where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import chat, decontaminate, langid, quality, repeats, sentencepiece_codec, simhash, topk, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.codec_digest(_table(spark, sf_dir, "documents"))


def op2_topk(spark, sf_dir):
    return topk.nearest(_table(spark, sf_dir, "embeddings"))


def op3_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_simhash(spark, sf_dir):
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_language(spark, sf_dir):
    return langid.language_prediction(_table(spark, sf_dir, "documents"))


def op8_repeats(spark, sf_dir):
    return repeats.repeats_digest(_table(spark, sf_dir, "documents"))


def op9_chat(spark, sf_dir):
    return chat.conversation_digest(_table(spark, sf_dir, "conversations"))


def op10_decontamination(spark, sf_dir):
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_topk": op2_topk,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_repeats": op8_repeats,
    "op9_chat": op9_chat,
    "op10_decontamination": op10_decontamination,
}
ORACLES: dict[str, str] = {
    "op2_topk": topk.ORACLE,
    "op3_warc": warc.ORACLE,
    "op9_chat": chat.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
}
