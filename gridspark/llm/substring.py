"""Substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the smallest
hash among the ``GRAM``-word grams inside it; equal windows have equal minimisers.
Consecutive windows that share a minimiser form one run (a super-k-mer).

1. Equal texts are collapsed to their first document by a digest; a later copy's runs are left out.
2. Runs are listed as small rows (minimiser, digest, document, start, windows) and their
   minimiser's places are counted: a minimiser in one place only proves its windows
   unique, and nothing more is sent for it.
3. Runs with equal words have equal digests: their first place is a partial aggregate, and every later place is
   one covered range at once.
4. What differs under one minimiser travels as one packed string each, once, to a bucket: runs are cut again
   by a second minimiser, which equal windows share too, so a frequent minimiser's runs are spread by
   what stands around it. There the windows are sorted, which counts them exactly.
5. The covered word ranges go back to their documents, and the kept words are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import U, fresh, gram_hashes, mix, powers, released, seeds, text_slices, word_hashes, word_spans

WINDOW = 20
GRAM = 8
# Grams in a window.
REACH = WINDOW - GRAM + 1
SECOND = seeds(1, 23)[0]
RUN_BASE = U(0x9FB21C651E98DF25)
RUN_INVERSE = U(pow(0x9FB21C651E98DF25, -1, 1 << 64))
# Stands for a null doc_id: later than every other.
NULL_ID = (1 << 63) - 1


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each ``w`` consecutive values, by doubling."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def window_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start word in the row, windows, minimiser, places of the minimiser) of every
    run of the rows whose first words are at ``first``."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U), np.zeros(0, np.int64))
    grams = gram_hashes(words, GRAM)
    low = sliding_min(grams, REACH)
    row = np.searchsorted(first, np.arange(len(words)), "right") - 1
    whole = row[:n] == row[WINDOW - 1:]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (low[1:] != low[:-1]) | (row[1:n] != row[: n - 1])
    stop = whole.copy()
    stop[:-1] &= ~whole[1:] | new[1:]
    at = np.flatnonzero(new)
    end = np.flatnonzero(stop)
    # places: those in the run's first window, then those that enter with a later one
    enters = np.cumsum(grams[REACH - 1:] == low)
    places = enters[end] - enters[at] + sum((grams[at + k] == low[at]).astype(np.int64) for k in range(REACH))
    return row[at], at - first[row[at]], end + 1 - at, low[at], places


def run_digests(words: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``size`` word hashes from each place ``at``, by the prefix sums of a polynomial."""
    if not len(at):
        return np.zeros(0, U)
    sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(words) * powers(RUN_BASE, len(words)), dtype=U)))
    # the sums of a place differ from those at the start by a power, whose inverse is taken out
    return mix((sums[at + size] - sums[at]) * powers(RUN_INVERSE, len(words))[at] + size.astype(U))


RUNS = "key long, digest long, id long, tag long, at int, n int, places long"


@released
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
        for lo, hi, data, offs in text_slices(batch, "text"):
            start, end, first = word_spans(data, offs)
            words = word_hashes(data, start, end)
            row, at, n, low, places = window_runs(words, first)
            digest = run_digests(words, first[row] + at, n + WINDOW - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(low.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(ids[lo + row], pa.int64()), pa.array(tags[lo + row], pa.int64()),
                 pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(places.astype(np.int64))],
                names=["key", "digest", "id", "tag", "at", "n", "places"])


def cut_again(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of a run change their second minimiser (with the end), and the second minimisers."""
    low = sliding_min(mix(gram_hashes(words, GRAM) ^ SECOND), REACH)
    at = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    return np.append(at, len(low)), low[at]


@released
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their wanted runs -> one packed string per piece of a run, under both minimisers. Rows
    that repeat a document are packed once."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        ids, tags, wanted = (batch.column(c).to_pylist() for c in ("id", "tag", "runs"))
        for lo, hi, data, offs in text_slices(batch, "text"):
            raw = data.tobytes()
            start, end, first = word_spans(data, offs)
            hashes = word_hashes(data, start, end)
            out: list[tuple] = []
            size = 0
            for r in range(lo, hi):
                base = first[r - lo]
                for run in () if (ids[r], tags[r]) in seen else wanted[r]:
                    own = slice(base + run["at"], base + run["at"] + run["n"] + WINDOW - 1)
                    cuts, second = cut_again(hashes[own])
                    for a, b, low in zip(cuts, cuts[1:], second, strict=False):
                        words = [raw[start[k]: end[k]] for k in range(own.start + a, own.start + b + WINDOW - 1)]
                        packed = b" ".join(words)
                        key = int(mix(np.array([run["key"]], np.int64).view(U) + low).view(np.int64)[0])
                        out.append((key, ids[r], tags[r], run["at"] + int(a), packed))
                        size += len(packed)
                seen.add((ids[r], tags[r]))
                if size > 4 << 20:
                    yield _packed(out)
                    out, size = [], 0
            yield _packed(out)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
         pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.binary())], names=["key", "id", "tag", "at", "packed"])


def covered(group: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """(id, tag, from, to) word ranges of the windows in ``group`` -- (id, tag, start,
    packed words) pieces under one pair of minimisers -- that also start at an earlier (id, start)."""
    out, windows = [], []
    for id_, tag, at, packed in group:
        words = packed.split(b" ")
        own = {}
        for i in range(len(words) - WINDOW + 1):
            text = b" ".join(words[i: i + WINDOW])
            if text not in own:
                own[text] = at + i
            elif out and out[-1][:2] == (id_, tag) and out[-1][2] <= at + i <= out[-1][3]:
                out[-1] = (id_, tag, out[-1][2], at + i + WINDOW)
            else:
                out.append((id_, tag, at + i, at + i + WINDOW))
        windows += [(text, id_, place, tag) for text, place in own.items()]
    windows.sort()
    first = None
    for w in windows:
        if first is None or w[0] != first[0]:
            first = w
        elif w[1:3] != first[1:3]:
            out.append((w[1], w[3], w[2], w[2] + WINDOW))
    return out


RANGES = "id long, tag long, lo int, hi int"


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    """Ranges with touching neighbours of one document merged."""
    merged: list[list] = []
    for id_, tag, lo, hi in sorted(set(rows)):
        if merged and merged[-1][:2] == [id_, tag] and lo <= merged[-1][3]:
            merged[-1][3] = max(hi, merged[-1][3])
        else:
            merged.append([id_, tag, lo, hi])
    cols = list(zip(*merged, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())],
        names=["id", "tag", "lo", "hi"])


@released
def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed runs sorted by minimiser -> covered ranges."""
    key, group, out = None, [], []
    for batch in batches:
        for k, *run in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "tag", "at", "packed")), strict=True):
            if k != key:
                out += covered(group)
                key, group = k, []
            group.append(tuple(run))
        if len(out) > 50_000:
            yield _ranges(out)
            out = []
    yield _ranges(out + covered(group))


OUT = "doc_id long, n_words long, n_removed long, kept string"


@released
def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their covered ranges, and whether they are later copies -> the words that stay."""
    for batch in batches:
        ids, ranges, later = (batch.column(c).to_pylist() for c in ("id", "ranges", "later"))
        for lo, hi, data, offs in text_slices(batch, "text"):
            raw = data.tobytes()
            total, removed, kept = [], [], []
            for r in range(lo, hi):
                words = raw[offs[r - lo]: offs[r - lo + 1]].split()
                gone = bytearray(len(words))
                for x in ranges[r] or ():
                    gone[x["lo"]: x["hi"]] = b"\1" * (x["hi"] - x["lo"])
                if later[r] and len(words) >= WINDOW:
                    gone = bytearray(b"\1" * len(words))
                total.append(len(words))
                removed.append(sum(gone))
                kept.append(b" ".join([w for w, g in zip(words, gone, strict=True) if not g]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if x == NULL_ID else x for x in ids[lo:hi]], pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) for every
    row of ``docs`` (doc_id, text; other columns are ignored).

    Every word covered by a window whose words also start earlier (a smaller doc_id, or
    the same one at an earlier word) is removed, judged on the input. A null text has no words;
    fewer words than a window are kept. A null doc_id counts as later than all others, and all of them as one document.
    Rows repeating a doc_id are versions of one document: equal starts in them are the same place, so
    exact repeats of a row do not remove one another.

    Runs are told apart by their minimiser's and their words' hashes, 64 bits each; windows in buckets are
    compared as they are.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), text.alias("text"),
                       F.xxhash64(text).alias("tag"), F.md5(text).alias("digest"))
    rows = base.select("id", "tag", "digest")
    copied = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    copies = fresh(rows.join(copied, "digest").filter("id > first").select("id", "tag").distinct(), "later-copies")
    texts = base.select("id", "tag", "text")

    runs = texts.mapInArrow(_runs, RUNS)
    again = runs.groupBy("key").agg(F.sum("places").alias("places")).filter("places > 1").select("key")
    held = runs.join(again.hint("merge"), "key", "left_semi").join(copies, ["id", "tag"], "left_anti")
    held = fresh(held, "repeated-runs")
    same = ["key", "digest", "n"]
    place = F.struct("id", "at", "tag")
    firsts = fresh(held.groupBy(*same).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.max("places").alias("places")), "first-runs")
    repeated = firsts.filter(F.col("first") < F.col("last")).select(*same, F.struct("first.id", "first.at").alias("first"))
    placed = fresh(held.drop("places").join(repeated, same).withColumn("late", F.struct("id", "at") > F.col("first")), "placed-runs")
    later = placed.filter("late").select("id", "tag", F.col("at").alias("lo"), (F.col("at") + F.col("n") + WINDOW - 1).alias("hi"))

    # where runs with different words share a minimiser, or one holds it twice: one string of each run travels
    # (and those of other versions of its document)
    mixed = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("runs"), F.max("places").alias("places")).filter("runs > 1 OR places > 1")
    sent = firsts.select("first.id", "first.tag", "first.at", "n", "key").union(placed.filter("NOT late").select("id", "tag", "at", "n", "key"))
    listed = sent.join(mixed.select("key"), "key", "left_semi").groupBy("id", "tag").agg(
        F.collect_set(F.struct("at", "n", "key")).alias("runs"))
    # both joins of the texts use one shuffle of them, by document
    packed = texts.join(listed.hint("merge"), ["id", "tag"]).mapInArrow(_pack, "key long, id long, tag long, at int, packed binary")
    buckets = packed.repartition("key").sortWithinPartitions("key").mapInArrow(_buckets, RANGES)

    none = F.lit(None).cast("array<struct<lo:int,hi:int>>")
    ranges = later.union(buckets).groupBy("id", "tag").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    judged = ranges.select("id", "tag", "ranges", F.lit(False).alias("later")).union(copies.select("id", "tag", none, F.lit(True)))
    return texts.join(judged.hint("merge"), ["id", "tag"], "left").select("id", "text", "ranges", "later").mapInArrow(_keep, OUT)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, lo, array_to_string(words[lo:lo + 19], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS lo FROM w WHERE len(words) >= 20)),
later AS (SELECT doc_id, lo FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, lo) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(lo, lo + 20)) AS pos FROM later),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
kept AS (
  SELECT e.doc_id, count(*) FILTER (g.pos IS NOT NULL) AS n_removed,
         coalesce(string_agg(e.word, ' ' ORDER BY e.pos) FILTER (g.pos IS NULL), '') AS text
  FROM placed e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos GROUP BY e.doc_id)
SELECT w.doc_id, len(w.words) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""
