"""The registered queries ``opN_<name>``: each applies its operator, with production
parameters, to the whole intended table and derives the digest columns from its output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import bpe, chat, decontaminate, fingerprint, html, minhash, quality, rules, runs, secrets, substring, toxicity, whiten
from gridspark.llm.common import small_batches
from gridspark.session import size_shuffles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    path = f"{sf_dir}/{name}.parquet"
    size_shuffles(spark, path)
    return spark.read.parquet(path)


def digest(column: str):
    """Lowercase hex SHA-256 of a text column's UTF-8 bytes."""
    return F.sha2(F.encode(column, "UTF-8"), 256)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations of ``conversations``, rendered."""
    return chat.render(table(spark, sf_dir, "conversations"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ``documents`` encoded and decoded with a public vocabulary."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of ``documents`` (similarity 0.75 on 5-word shingles)."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` left after removing repeated 20-word windows."""
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", digest("kept").alias("kept_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, test item) pairs of ``documents`` and ``benchmark`` with an aligned copy."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of ``documents``, learnt from ``labels`` outside the held-out fold."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page of ``pages``, by the paths its host agrees on."""
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of ``documents``, learnt from ``labels`` outside the held-out fold."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of ``documents``: a source is an owner, its languages are its repositories."""
    found = secrets.scan(table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest("base").alias("base_sha256"),
                        "spans", "n_live", "n_shared", "live")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of ``documents`` and their edited texts, and their likeness."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of ``embeddings``: floor(64 * entry) + 1000000, centred and projected."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return whiten.whitened_grid(rows)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of ``documents``; a source is a host."""
    return rules.line_rules(table(spark, sf_dir, "documents"), "source").drop("cleaned")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of ``documents``, a tenth of which are given a periodic tail."""
    return runs.run_digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_byte_bpe, op3_minhash_dedup, op4_substring_dedup, op5_decontaminate,
    op6_quality, op7_html_text, op8_toxicity, op9_secret_scan,
    op10_fingerprints, op11_whitening, op12_quality_rules, op13_periodic_runs)}

ORACLE = {"op1_chat_format": chat.ORACLE, "op3_minhash_dedup": minhash.ORACLE, "op4_substring_dedup": substring.ORACLE,
          "op12_quality_rules": rules.ORACLE, "op13_periodic_runs": runs.ORACLE}
