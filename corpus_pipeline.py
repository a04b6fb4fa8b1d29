"""The corpus pipeline: quality, near copies, repeated passages, benchmark leaks, then token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs.
Stages keep the columns of documents, the last adds the token ids.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import decontaminate, quality, repeats, sentencepiece_codec, simhash
from webloom.llm.common import scratch

#: Documents that score less are rejected.
LEAST_QUALITY = 0.3
#: A passage may stand once only if it has this many bytes and over fifty words: the bytes are those of 51 very short words.
PASSAGE_BYTES, PASSAGE_WORDS = 200, 51


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field accepts; it learns from the labels of the documents given."""
    field = quality.fit(quality.labelled_documents(docs, _table(spark, sf_dir, "labels"), "quality"))
    return quality.score(docs, field, "text", "__quality").where(F.col("__quality") >= LEAST_QUALITY).drop("__quality")


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, null last. Rows of one id and other texts are decided each for itself."""
    found = simhash.similar_documents(docs)
    kept = found.where("kept").select(F.col("row_key").alias("__row")).distinct()
    rows = docs.withColumn("__row", simhash.row_key("doc_id", "text")).join(kept, "__row", "left_semi")
    return rows.groupBy("__row").agg(F.min(F.struct(*docs.columns)).alias("__first")).select("__first.*")  # equal rows once


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of over fifty words that occur elsewhere; those that the cut left nothing of go."""
    blank = docs.withColumn("__blank", F.trim("text") == "")
    cut = repeats.remove_repeats(blank, length=PASSAGE_BYTES, least_words=PASSAGE_WORDS).where(F.col("text").isNull() | F.col("__blank") | (F.trim("text") != ""))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window in them."""
    keyed = docs.withColumn("__row", simhash.row_key("doc_id", "text"))
    found = decontaminate.matches(keyed, _table(spark, sf_dir, "benchmark"), "__row")
    leaking = found.where(F.size("spans") > 0).select(F.col("id").alias("__row")).distinct()
    return keyed.join(leaking, "__row", "left_anti").select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, checked by decoding them."""
    both = sentencepiece_codec.encode(docs, "text", "token_ids", decoded_col="__decoded")
    return both.withColumn("n_tokens", F.size("token_ids").cast("long")).withColumn("decodes", F.col("__decoded") == F.coalesce("text", F.lit(""))).drop("__decoded")


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_copies_stage),
    ("suffix-array dedup", passages_stage),
    ("benchmark decontamination", leaks_stage),
    ("SentencePiece encoding and decoding", tokens_stage),
]

#: A line field's marginals and SimHash have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
