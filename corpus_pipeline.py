"""The pipeline over documents: toxicity, line duplicates, near duplicates, mixing, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import bpe, line_dedup, mixing, simhash, toxicity
from rillmark.llm.common import set_aside, stored, table

#: No SQL says trees, fingerprints or merges; the stages are tested against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    bad = model.scores(docs).filter(F.col("score") >= toxicity.THRESHOLD).select(F.col("doc_id").alias("_id"), "text_hash").distinct()
    rows, own = set_aside(docs, "doc_id", "text")
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    return rows.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("text_hash")), "left_anti").select(*own)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that five or more of them share."""
    kept = line_dedup.drop_lines(docs)
    return kept.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long")).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose five-word shingles are alike to 0.8 or more."""
    return simhash.keep_one(docs, 5, 0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or parts of them, as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash", drop_copies), ("mixing", mix_sources), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as a table in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
