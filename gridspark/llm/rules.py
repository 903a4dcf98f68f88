"""Quality rules with cross-document line frequency, in built-in functions only.

Lines are normalised and hashed; per host the distinct documents that hold a line are
counted, in two steps, so that no line's documents meet in one task. Lines above the limit
are removed, and a document that loses most of its words is rejected. The measures of
a text are taken over its own arrays of words and lines, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import fresh

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
# A line is above the limit on a host when more documents than LEAST_DOCS, and more than SHARE of the
# host's documents, hold it.
LEAST_DOCS, SHARE = 10, 0.005
# A document is depleted when its removed lines hold more than this share of its words.
DEPLETED = 0.5
# Base rule: fewer words, or more than this percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 30

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def normalised(line: Column) -> Column:
    """A line for comparison: A-Z in lower case, runs of digits as one 0, runs of white space as
    one space, trimmed."""
    out = F.regexp_replace(F.translate(line, UPPER, LOWER), "[0-9]+", "0")
    return F.trim(F.regexp_replace(out, SPACES, " "))


def repeated_words(docs: DataFrame, words: str, out: str) -> DataFrame:
    """``docs`` with the number of words in windows of ``WINDOW`` words that are found twice or more
    in the same array. Windows are compared by their 64-bit hashes; where some are equal, sorting
    (hash, position) puts equal windows side by side."""
    n = F.size(words)
    starts = F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1)))
    windows = F.when(n >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).otherwise(F.array().cast("array<long>"))
    own = docs.columns
    docs = docs.withColumn("_windows", windows)
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    docs = docs.withColumn("_sorted", F.when(again, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    beside = F.filter("_sorted", lambda x, k: F.coalesce(x["h"] == F.get("_sorted", k - 1)["h"], F.lit(False))
                      | F.coalesce(x["h"] == F.get("_sorted", k + 1)["h"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(beside, lambda x: F.sequence(x["i"], x["i"] + WINDOW - 1))))
    return docs.select(*own, F.coalesce(F.when(F.col("_sorted").isNotNull(), F.size(covered)), F.lit(0)).cast("long").alias(out))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column ``text``) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed of each row's whole text; a null text is empty."""
    own = docs.columns
    text = F.coalesce("text", F.lit(""))
    held = docs.select(*own, words_of(text).alias("_words"),
                       F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    held = repeated_words(held, "_words", "n_repeat_words")
    held = held.select(
        *own, F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words")
    few = F.col("n_words") < LEAST_WORDS
    return held.withColumn("base_failed", few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def line_rows(docs: DataFrame) -> DataFrame:
    """One row for each line with words of ``docs`` (doc_key, host_key, text_key, text): the keys, its hash,
    position, and number of words."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    each = F.transform(lines, lambda x, i: F.struct(
        F.xxhash64(normalised(x)).alias("line"), i.alias("pos"), F.size(words_of(x)).alias("n")))
    rows = docs.select("host_key", "doc_key", "text_key", F.inline(each))
    return rows.filter("n > 0")


def frequent_lines(rows: DataFrame, least: int = LEAST_DOCS, share: float = SHARE) -> DataFrame:
    """(host_key, line, docs) of the lines above the limit: more than ``least`` distinct documents of the host
    and more than ``share`` of its documents hold them."""
    held = rows.groupBy("host_key", "line").agg(F.count_distinct("doc_key").alias("docs")).filter(F.col("docs") > least)
    hosts = rows.groupBy("host_key").agg(F.count_distinct("doc_key").alias("all_docs"))
    return held.join(hosts, "host_key").filter(F.col("docs") > share * F.col("all_docs")).select("host_key", "line", "docs")


def without_lines(text: Column, gone: Column) -> Column:
    """``text`` without the lines at the sorted positions ``gone``: the stretches between them, joined."""
    lines = F.split(text, "\n")
    ends = F.concat(gone, F.array(F.size(lines)))
    parts = F.transform(ends, lambda e, k: F.slice(
        lines, F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 2, e - F.coalesce(F.get(ends, k - 1), F.lit(-1)) - 1))
    return F.array_join(F.flatten(parts), "\n")


def line_rules(docs: DataFrame, host: str = "source", least: int = LEAST_DOCS, share: float = SHARE) -> DataFrame:
    """doc_id, the measures of ``measures``, n_removed_lines, n_removed_words (long), kept, and ``cleaned`` (the text
    without frequent lines) for every row of ``docs`` (doc_id, text, ``host``; other columns are ignored).

    Lines are judged per host; rows without a host form one host. A document is a doc_id: rows that
    repeat one count once; rows without an id count by their texts. Null and empty texts have no lines
    and fail the base rule. Rows with equal host and text get equal results.
    ``kept`` is false if the base rule fails or removed lines hold more than ``DEPLETED`` of the words.

    Only hashes of lines are shuffled; frequent lines are written, so the planner broadcasts them within
    its size bound and joins by a shuffle beyond it, where a line that very many documents hold is split by
    the adaptive skew join.
    """
    base = docs.select(F.col("doc_id"), F.col("text"), F.xxhash64(F.col(host)).alias("host_key"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    keyed = base.withColumn("doc_key", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.col("text_key")))
    rows = fresh(line_rows(keyed), "lines")
    frequent = fresh(frequent_lines(rows, least, share), "frequent-lines")
    hit = rows.join(frequent.select("host_key", "line"), ["host_key", "line"], "left_semi")
    gone = hit.groupBy("host_key", "text_key").agg(F.sort_array(F.collect_set(F.struct("pos", "n"))).alias("_gone"))
    gone = gone.select("host_key", "text_key", F.transform("_gone", lambda x: x["pos"]).alias("_pos"),
                       F.aggregate("_gone", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("_lost"))
    out = measures(base).join(gone, ["host_key", "text_key"], "left")
    lost = F.coalesce("_lost", F.lit(0))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce(F.size("_pos"), F.lit(0)).cast("long").alias("n_removed_lines"), lost.cast("long").alias("n_removed_words"),
        (~F.col("base_failed") & (lost <= DEPLETED * F.col("n_words"))).alias("kept"),
        F.when(F.col("_pos").isNull(), text).otherwise(without_lines(text, F.col("_pos"))).alias("cleaned"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS t FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT DISTINCT doc_id, unnest(range(1, len(words) - 6)) AS lo, words FROM w WHERE len(words) >= 8),
keyed AS (SELECT doc_id, lo, array_to_string(words[lo:lo + 7], ' ') AS g FROM win),
again AS (SELECT doc_id, lo FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM keyed) WHERE k > 1),
reps AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(lo, lo + 8)) AS p FROM again) GROUP BY doc_id),
placed AS (
  SELECT doc_id, source, x AS raw, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
         trim(regexp_replace(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'),
                             '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, source, unnest(lines) AS x FROM w)),
held AS (SELECT source, line, count(DISTINCT doc_id) AS docs FROM placed GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT doc_id) AS all_docs FROM placed GROUP BY ALL),
often AS (SELECT h.source, h.line FROM held h JOIN hosts a ON a.source = h.source WHERE docs > 10 AND docs > 0.005 * all_docs),
lost AS (SELECT p.doc_id, count(*) AS n_lines, sum(p.n) AS n FROM placed p JOIN often o ON o.source = p.source AND o.line = p.line GROUP BY p.doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, coalesce(lost.n_lines, 0) AS n_removed_lines, coalesce(lost.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN reps r ON r.doc_id = w.doc_id LEFT JOIN lost ON lost.doc_id = w.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_removed_words <= 0.5 * n_words AS kept
FROM m
"""
