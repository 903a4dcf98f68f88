"""The corpus pipeline: each stage works on all that the one before it kept, and every
stage but the last returns the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import bpe, decontaminate, minhash, secrets, toxicity
from gridspark.llm.common import fresh, small_batches, without_ids
from gridspark.session import drop_scratch, scratch_mark, size_shuffles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic by a classifier learnt from all labelled rows go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    return toxicity.with_scores(docs.select(*COLUMNS), model).filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest id."""
    small_batches(spark)
    gone = fresh(minhash.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct(), "near-copies")
    return without_ids(docs.select(*COLUMNS), "doc_id", gone, gone.count())


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an aligned copy of a test item go."""
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_leaks(docs.select(*COLUMNS), benchmark)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets that look live (one owner's, or leaked from one) are masked
    in its text, widely copied examples are left."""
    small_batches(spark)
    return secrets.mask(docs.select(*COLUMNS), F.col("source"), F.concat_ws("/", "source", "lang")).select(*COLUMNS)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the remaining texts, encoded and decoded again."""
    small_batches(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("secrets", masked), ("bpe", tokenised)]

# Model scores, sketches, alignment and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again. What a stage has written on
    its way, and the result before it, is deleted then.

    Null and empty texts pass all stages; rows that repeat a doc_id are judged by their texts, but
    near-copies go by doc_id; a null doc_id is near nothing and stays; an empty table gives an empty
    result; columns beside those of ``documents`` are left out.
    """
    path = f"{sf_dir}/documents.parquet"
    size_shuffles(spark, path)
    docs = spark.read.parquet(path)
    mark = scratch_mark(spark)
    for name, stage in STAGES:
        docs = fresh(stage(spark, docs, sf_dir), name)
        drop_scratch(spark, mark, keep=1)
    return docs
