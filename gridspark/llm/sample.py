"""The bounded labelled sample that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import only_ids


def fold(column: str, folds: int):
    """crc32 of the id as text, modulo ``folds`` (null ids: null)."""
    return F.pmod(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: F.Column, rows: int, most_bytes: int) -> DataFrame:
    """doc_id, label, text of at most ``rows`` documents per label value, among label rows that
    satisfy ``train`` (a condition on doc_id), in the order of a hash of the id. Documents of more than
    ``most_bytes`` bytes and rows with a null label or id are not used for fitting; of rows
    repeating a doc_id the smallest text is."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.filter(train & F.col("label").isin(0, 1)).distinct()
    # sorting by a hash with a limit keeps a bounded top per task, and per label in the end
    chosen = [marked.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    chosen = chosen[0].union(chosen[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= most_bytes)
    rows = only_ids(texts, "doc_id", chosen.select("doc_id"), 2 * rows).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
