"""Benchmark decontamination: rare n-gram seeds join passages to test items, and
Smith-Waterman alignment scores the passages, so paraphrased and edited copies are found too.

A seed is a pair of an item's words at most ``SPAN`` words apart, so it stands when words between
or beside it are replaced, taken out or put in. The documents that hold each pair of the items are
counted over the whole corpus, and every stretch of an item keeps its rarest pairs: a rank
within the stretch, no cut-off, so an item is never without seeds, however often it was copied.

Documents are searched for the seeds; a passage around enough different ones that can reach the score
travels to its item by a join on the item, where it is aligned. The test items are a query set: they are taken
in blocks of bounded size, each block's seeds are sent to every task and meet every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import LOWER, U, fresh, mix, released, text_slices, word_hashes, word_spans

# Words from the first to the second of a pair in an item, and in a document, where words may have been put in.
SPAN, REACH = 3, 5
# First words in one stretch of an item, and the pairs that it keeps.
STRETCH, FEW = 3, 4
# Share of an item's seeds (two at least) that lie together where it is worth aligning. A score of a half leaves about
# two thirds of the words in place, or all of them with as many put between, and so far more of the pairs.
LEAST_SEEDS = 0.1
# Items of fewer words than LEAST_WORDS count only where they stand word for word; those of fewer
# than LEAST_EXACT are not looked for.
LEAST_WORDS, LEAST_EXACT = 6, 3
# Share of the best possible alignment score from which a passage counts as a copy.
LEAK = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
# Bytes of test items handled in one block.
BLOCK_BYTES = 16 << 20
# Hits laid out at once; a slice of text with more takes its items in parts.
PAIRS = 1 << 21
# Bits of a seed by which most other pairs are told apart at once.
SIEVE = 22
FIRST, SECOND = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)

# Separators: every ASCII byte but letters and digits.
APART = np.ones(256, bool)
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def plain_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words without punctuation, and each row's first word."""
    data = LOWER[data]
    start, end, first = word_spans(data, offs, APART)
    return word_hashes(data, start, end), first


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman over word hashes: (share of the best possible score, start and end of
    the aligned stretch of the passage)."""
    n = len(passage)
    if not n or not len(item):
        return 0.0, 0, 0
    steps = np.arange(1, n + 1) * GAP
    row = np.zeros(n + 1, np.int64)
    begin = np.arange(n + 1)
    best, lo, hi = 0, 0, 0
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        score = np.maximum(np.maximum(diagonal, above), 0)
        start = np.where(score == 0, np.arange(1, n + 1), np.where(diagonal >= above, begin[:-1], begin[1:]))
        # gaps along the passage: the best earlier cell, less a gap for each step
        lead = score - steps
        top = np.maximum.accumulate(lead)
        from_left = np.maximum.accumulate(np.where(lead == top, np.arange(n), 0))
        score, start = top + steps, start[from_left]
        row, begin = np.concatenate(([0], score)), np.concatenate(([0], start))
        j = int(score.argmax())
        if score[j] > best:
            best, lo, hi = int(score[j]), int(start[j]), j + 1
    return best / (MATCH * len(item)), lo, hi


def pair_keys(words: np.ndarray, d: int) -> np.ndarray:
    """The hash of each word and the one ``d`` words on."""
    return mix(words[:-d] * FIRST + words[d:] * SECOND)


class Pairs:
    """Sorted distinct pairs, and how a slice of documents holds them."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[(keys & U((1 << SIEVE) - 1)).astype(np.int64)] = True

    def find(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, number of the pair) of every hit; ``first`` has each row's first word."""
        row = np.searchsorted(first, np.arange(len(words)), "right")
        at, number = [], []
        for d in range(1, REACH + 1):
            if len(words) <= d or not len(self.keys):
                break
            keys = pair_keys(words, d)
            may = np.flatnonzero(self.sieve[(keys & U((1 << SIEVE) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.keys, keys[may]), len(self.keys) - 1)
            hit = (self.keys[place] == keys[may]) & (row[may] == row[may + d])
            at.append(may[hit])
            number.append(place[hit])
        return (np.concatenate(at), np.concatenate(number)) if at else (np.zeros(0, np.int64),) * 2


def item_pairs(items: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, item, place of the first word) of the pairs of all items."""
    keys, owner, at = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, (_, words) in enumerate(items):
        for d in range(1, min(SPAN, len(words) - 1) + 1):
            keys.append(pair_keys(words, d))
            owner.append(np.full(len(words) - d, k))
            at.append(np.arange(len(words) - d))
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(at)


def rarest(keys: np.ndarray, owner: np.ndarray, at: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which pairs are kept: in each stretch of each item the ``FEW`` different ones that the fewest documents hold."""
    order = np.lexsort((at, keys, docs, at // STRETCH, owner))
    o, part, k = owner[order], at[order] // STRETCH, keys[order]
    new = np.r_[True, (o[1:] != o[:-1]) | (part[1:] != part[:-1])] if len(o) else np.zeros(0, bool)
    fresh_key = np.r_[True, (k[1:] != k[:-1])] | new if len(o) else new
    rank = np.cumsum(fresh_key)
    start = np.maximum.accumulate(np.where(new, rank, 0)) if len(o) else rank
    kept = np.zeros(len(keys), bool)
    kept[order[rank - start < FEW]] = True
    return kept


class Seeds:
    """One block's items and their seeds, sorted for binary search."""

    def __init__(self, items: list[tuple[int, np.ndarray]], keys: np.ndarray, owner: np.ndarray, at: np.ndarray):
        self.items = items
        self.sizes = np.array([len(w) for _, w in items], np.int64)
        order = np.argsort(keys, kind="stable")
        self.owner, self.at = owner[order], at[order]
        many = np.bincount(owner, minlength=len(items))
        self.need = np.where(self.sizes >= LEAST_WORDS, np.maximum(2, np.ceil(LEAST_SEEDS * many)), 1)
        keys, self.start = np.unique(keys[order], return_index=True)
        self.stop = np.append(self.start[1:], len(self.owner))
        self.pairs = Pairs(keys)

    def passages(self, words: np.ndarray, first: np.ndarray, least: float) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, from, to, hits) of the stretches of a slice's rows, as words of the row, that can score
        ``least``."""
        at, number = self.pairs.find(words, first)
        many = self.stop[number] - self.start[number]
        parts = int(many.sum() // PAIRS) + 1
        pos = np.repeat(at, many)
        seed = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.start[number], many)
        for k in range(parts):
            mine = self.owner[seed] % parts == k if parts > 1 else slice(None)
            yield from self._laid(words, first, pos[mine], seed[mine], least)

    def _laid(self, words, first, pos, seed, least: float) -> Iterator[tuple[int, int, int, int, int]]:
        own, row = self.owner[seed], np.searchsorted(first, pos, "right") - 1
        order = np.lexsort((pos, own, row))
        own, pos, row, seed = own[order], pos[order], row[order], seed[order]
        if not len(own):
            return
        new = np.r_[True, (np.diff(own) != 0) | (np.diff(row) != 0) | (np.diff(pos) > 2 * self.sizes[own][1:])]
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(own))
        group = np.cumsum(new) - 1
        order = np.lexsort((seed, group))
        other = np.r_[True, (np.diff(group[order]) != 0) | (np.diff(seed[order]) != 0)]
        enough = np.bincount(group[order][other], minlength=len(start)) >= self.need[own[start]]
        for a, b in zip(start[enough].tolist(), stop[enough].tolist(), strict=True):
            k, r = int(own[a]), int(row[a])
            item = self.items[k][1]
            need = least if len(item) >= LEAST_WORDS else 1.0
            slack = 3 * len(item)  # a stretch that scores half is no longer than two items
            lo = max(int(first[r]), int(pos[a]) - slack)
            hi = min(int(first[r + 1]), int(pos[b - 1]) + slack)
            for x, y in promising(item, words[lo:hi], need):
                yield r, k, lo - int(first[r]) + x, lo - int(first[r]) + y, b - a


def promising(item: np.ndarray, passage: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Parts of a passage outside of which no stretch scores ``least``.

    A stretch of that score matches at least ``least`` of the item's words, each at most
    once, and every other word of it costs one, so its length is bounded too."""
    need = least * len(item)
    span = int(3 * len(item) - 2 * need) + 1
    own = np.sort(item)
    place = np.searchsorted(own, passage)
    place[place == len(own)] = 0
    inside = own[place] == passage
    if len(passage) <= 2 * span:
        parts = [(0, len(passage))]
    else:
        count = np.concatenate(([0], np.cumsum(inside)))
        start = np.flatnonzero(count[span:] - count[:-span] >= need)
        if not len(start):
            return []
        cut = np.flatnonzero(np.diff(start) > span) + 1
        parts = [(int(x[0]), int(x[-1]) + span) for x in np.split(start, cut)]
    values, has = np.unique(item, return_counts=True)
    out = []
    for a, b in parts:
        met = np.bincount(np.searchsorted(values, passage[a:b][inside[a:b]]), minlength=len(values))
        if np.minimum(met, has).sum() >= need:
            out.append((a, b))
    return out


FOUND = "key long, item_key long, start long, seeds long, passage array<long>"


def _passages(block, least: float) -> callable:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = block.value
        for batch in batches:
            ids = batch.column("key")
            for lo, hi, data, offs in text_slices(batch, "text"):
                words, first = plain_words(data, offs)
                out = [(lo + r, seeds.items[k][0], a, hits, words[first[r] + a: first[r] + b].view(np.int64))
                       for r, k, a, b, hits in seeds.passages(words, first, least)]
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:4]), pa.array(cols[4], pa.list_(pa.int64()))],
                    names=["key", "item_key", "start", "seeds", "passage"])

    return run


ALIGNED = "key long, item_key long, score double, start_word long, end_word long, seeds long"


def _aligned(least: float) -> callable:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, cols = [], []
            start = batch.column("start").to_pylist()
            for i, (item, passage) in enumerate(zip(batch.column("words"), batch.column("passage"), strict=True)):
                item, passage = item.values.to_numpy(), passage.values.to_numpy()
                score, a, b = align(item, passage)
                if score >= (least if len(item) >= LEAST_WORDS else 1.0):
                    keep.append(i)
                    cols.append((score, start[i] + a, start[i] + b))
            at = pa.array(keep, pa.int64())
            cols = list(zip(*cols, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(at), batch.column("item_key").take(at), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), batch.column("seeds").take(at)],
                names=["key", "item_key", "score", "start_word", "end_word", "seeds"])

    return run


def _counted(block) -> callable:
    """How many rows hold each pair: one row for each pair that a task has met."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = block.value
        counts = np.zeros(len(pairs.keys), np.int64)
        for batch in batches:
            for _, _, data, offs in text_slices(batch, "text"):
                words, first = plain_words(data, offs)
                at, number = pairs.find(words, first)
                row = np.searchsorted(first, at, "right").astype(np.int64)
                once = np.unique(row * len(counts) + number) % max(1, len(counts))
                counts += np.bincount(once, minlength=len(counts))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["number", "docs"])

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in text_slices(batch, "text"):
            words, first = plain_words(data, offs)
            lists = pa.LargeListArray.from_arrays(pa.array(first), pa.array(words.view(np.int64))).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("item_key").slice(lo, hi - lo), lists], names=["item_key", "words"])


def item_rows(benchmark: DataFrame) -> DataFrame:
    """item_key, words of the distinct texts of ``benchmark`` that have enough words, written."""
    texts = benchmark.filter("text IS NOT NULL").select(F.xxhash64("text").alias("item_key"), "text").distinct()
    return fresh(texts.mapInArrow(_item_words, "item_key long, words array<long>").filter(F.size("words") >= LEAST_EXACT), "items")


def block_seeds(docs: DataFrame, items: DataFrame, block_bytes: int) -> Iterator:
    """The broadcast seeds of each block of items: pairs that the fewest of ``docs`` (text) hold."""
    sc = docs.sparkSession.sparkContext
    total = items.agg(F.sum(F.size("words").cast("long") * 8)).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    for k in range(blocks):
        rows = items.filter(F.pmod(F.col("item_key"), F.lit(blocks)) == k).orderBy("item_key").toLocalIterator()
        held = [(r["item_key"], np.array(r["words"], np.int64).view(U)) for r in rows]
        keys, owner, at = item_pairs(held)
        if not len(keys):
            continue
        pairs = sc.broadcast(Pairs(np.unique(keys)))
        met = docs.select("text").mapInArrow(_counted(pairs), "number long, docs long").groupBy("number").agg(F.sum("docs").alias("docs"))
        counts = np.zeros(len(pairs.value.keys), np.int64)
        for r in met.toLocalIterator():  # one row for each pair of the block at most
            counts[r["number"]] = r["docs"]
        kept = rarest(keys, owner, at, counts[np.searchsorted(pairs.value.keys, keys)])
        pairs.destroy()
        yield sc.broadcast(Seeds(held, keys[kept], owner[kept], at[kept]))


def copies(docs: DataFrame, benchmark: DataFrame, least: float = LEAK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, item_key, score, start_word, end_word, seeds: the best alignment of each row's text in ``docs`` (key, text) with
    each test item's text, where it reaches ``least``."""
    items = item_rows(benchmark)
    found = docs.sparkSession.createDataFrame([], ALIGNED)
    for seeds in block_seeds(docs, items, block_bytes):
        # written: searching and aligning are stages of their own, with one Python worker for each task
        passages = fresh(docs.select("key", "text").mapInArrow(_passages(seeds, least), FOUND), "passages")
        found = found.union(passages.join(items, "item_key").select("key", "item_key", "start", "seeds", "passage", "words").mapInArrow(
            _aligned(least), ALIGNED))
    best = F.max(F.struct("score", F.negative("start_word").alias("s"), "end_word", "seeds")).alias("b")
    return found.groupBy("key", "item_key").agg(best).select(
        "key", "item_key", "b.score", F.negative("b.s").alias("start_word"), "b.end_word", "b.seeds")


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word, seeds: the best alignment of each
    (document, test item) whose score is at least ``least`` of the item's full score.

    Words are lower-cased (A-Z) runs of letters and digits. Null or empty texts on either
    side, and items of fewer than three words, match nothing; items of three to five words match where they stand
    word for word. Repeated rows of a document
    or item give one row; a null doc_id or item_id is reported as null. Other columns
    are ignored. ``seeds`` counts the hits of the item's seeds around the alignment.
    """
    found = copies(docs.select(F.col("doc_id").cast("long").alias("key"), "text"), benchmark, least, block_bytes)
    ids = benchmark.filter("text IS NOT NULL").select(F.xxhash64("text").alias("item_key"), F.col("item_id").cast("long").alias("item_id")).distinct()
    best = F.max(F.struct("score", F.negative("start_word").alias("s"), "end_word", "seeds")).alias("b")
    return found.join(ids, "item_key").groupBy(F.col("key").alias("doc_id"), "item_id").agg(best).select(
        "doc_id", "item_id", "b.score", F.negative("b.s").alias("start_word"), "b.end_word", "b.seeds")


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text has no aligned copy of a test item
    (see ``leaks``); each row is judged by its own text, whatever its doc_id. Null texts stay."""
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    gone = fresh(copies(docs.select(tag.alias("key"), "text"), benchmark, least, block_bytes).select("key").distinct(), "leaked-texts")
    return docs.join(gone, tag == gone["key"], "left_anti")
