"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of words with smallest period q and at least ``max(LEAST, EXPONENT * q)`` words
that no neighbouring word extends. Each document's word ids are compressed by Re-Pair: the
most frequent pair of neighbouring symbols becomes a rule, until no pair occurs twice; what is left is
joined in halves, so every boundary between two words belongs to one rule or one half. Runs
that cross a boundary inside its rule are computed once, on the rule's first place, by
the lengths of common extensions for all periods at once; they are then translated to all
places of the rule, and intervals of one period that overlap are merged to the maximal ones.

Tasks take documents one by one; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import mix, released, text_slices

LEAST, EXPONENT = 6, 4
# Words in a stretch that every run repeats within its text: a run of period q repeats each
# of its stretches of up to 3q words q words on, and one of period 1 has six words.
SEED = 5


class Grammar:
    """Re-Pair of a list of word ids. Symbol ``words + k`` is rule ``k``: its two symbols are
    ``left[k]`` and ``right[k]``, its first place in the text is ``first[k]``; ``at`` and ``symbols`` are the places and
    symbols of what is left."""

    def __init__(self, ids: list[int], words: int):
        self.words = words
        self.left: list[int] = []
        self.right: list[int] = []
        self.first: list[int] = []
        self.sizes: list[int] = []
        n = len(ids)
        self.sym, self.next, self.prev = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        waiting, heap = self._pairs(ids)
        while heap:
            count, pair = heapq.heappop(heap)
            places = self._places(pair, waiting[pair])
            if len(places) != -count and heap and -len(places) > heap[0][0]:
                if len(places) > 1:
                    waiting[pair] = places
                    heapq.heappush(heap, (-len(places), pair))
                else:
                    del waiting[pair]
                continue
            del waiting[pair]
            if len(places) > 1:
                for found, where in self._replace(pair, places).items():
                    if len(where) > 1:
                        waiting[found] = where
                        heapq.heappush(heap, (-len(where), found))
        self.at = []
        i = 0
        while i < n:
            self.at.append(i)
            i = self.next[i]
        self.symbols = [self.sym[i] for i in self.at]

    @staticmethod
    def _pairs(ids: list[int]) -> tuple[dict, list]:
        """Places of the pairs that occur twice or more, and the heap of their counts."""
        a = np.array(ids, np.int64)
        if len(a) < 4:
            return {}, []
        key = a[:-1] << 32 | a[1:]
        order = np.argsort(key, kind="stable")
        held = key[order]
        cut = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        size = np.diff(np.append(cut, len(held)))
        waiting = {}
        for lo, count in zip(cut[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            where = order[lo: lo + count].tolist()
            waiting[ids[where[0]], ids[where[0] + 1]] = where
        heap = [(-len(where), pair) for pair, where in waiting.items()]
        heapq.heapify(heap)
        return waiting, heap

    def _places(self, pair: tuple[int, int], places: list[int]) -> list[int]:
        """The places where the pair still stands, none overlapping another."""
        a, b = pair
        sym, follow, n = self.sym, self.next, len(self.sym)
        if a != b:
            return [i for i in places if sym[i] == a and (j := follow[i]) < n and sym[j] == b]
        out, free = [], -1
        for i in sorted(places):
            if i >= free and sym[i] == a and (j := follow[i]) < n and sym[j] == b:
                out.append(i)
                free = follow[j]
        return out

    def _replace(self, pair: tuple[int, int], places: list[int]) -> dict[tuple[int, int], list[int]]:
        """Put a new rule at all places; the pairs it makes with its neighbours."""
        new = self.words + len(self.left)
        self.left.append(pair[0])
        self.right.append(pair[1])
        self.first.append(min(places))
        self.sizes.append(self.size(pair[0]) + self.size(pair[1]))
        sym, follow, before, n = self.sym, self.next, self.prev, len(self.sym)
        for i in places:
            j = follow[i]
            k = follow[j]
            sym[i], sym[j], follow[i] = new, -1, k
            if k < n:
                before[k] = i
        found: dict[tuple[int, int], list[int]] = {}
        for i in places:
            if (p := before[i]) >= 0 and sym[p] != new:
                found.setdefault((sym[p], new), []).append(p)
            if (k := follow[i]) < n:
                found.setdefault((new, sym[k]), []).append(i)
        return found

    def size(self, symbol: int) -> int:
        return 1 if symbol < self.words else self.sizes[symbol - self.words]

    def places(self, wanted: set[int]) -> dict[int, list[int]]:
        """All places in the text of the wanted rules, from the top of the derivation down."""
        held: dict[int, list[int]] = {}
        for i, s in zip(self.at, self.symbols, strict=True):
            if s >= self.words:
                held.setdefault(s - self.words, []).append(i)
        out = {}
        least = min(wanted, default=0)
        for k in range(len(self.left) - 1, least - 1, -1):
            where = held.pop(k, [])
            if k in wanted:
                out[k] = where
            step = self.size(self.left[k])
            for s, shift in ((self.left[k], 0), (self.right[k], step)):
                if s >= self.words:
                    held.setdefault(s - self.words, []).extend(i + shift for i in where)
        return out


def prefix_lengths(x: list[int]) -> list[int]:
    """For each place, how many items from there equal those from the start (0 for place 0)."""
    n = len(x)
    z = [0] * n
    lo = hi = 0
    for i in range(1, n):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    return z


def crossing(x: list[int], cut: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs of ``x`` (maximal within it) that hold both ``x[cut - 1]`` and ``x[cut]``."""
    found: dict[tuple[int, int], int] = {}
    for flip in (False, True):
        left, right = (x[cut:][::-1], x[:cut][::-1]) if flip else (x[:cut], x[cut:])
        c, most = len(left), min(len(left), len(x) // EXPONENT)
        if most < 1:
            continue
        # with period q: how far the items from the cut on, and those before it, repeat q items earlier
        on = prefix_lengths(right + [-1] + left[-most:] + right)
        back = prefix_lengths(left[::-1])
        for q in range(1, most + 1):
            ahead = min(on[len(right) + 1 + most - q], len(right))
            behind = back[q] if q < c else 0
            if ahead and q + ahead + behind >= max(LEAST, EXPONENT * q):
                lo, hi = c - q - behind, c + ahead
                span = (len(x) - hi, len(x) - lo) if flip else (lo, hi)
                found[span] = min(q, found.get(span, q))
    return [(lo, hi, q) for (lo, hi), q in found.items()]


def repeated_seeds(ids: np.ndarray) -> np.ndarray:
    """For each cut between two words: whether a stretch of ``SEED`` words over it is found
    twice or more. No run crosses another cut."""
    n = len(ids)
    over = np.zeros(n + 1, bool)
    if n < LEAST:
        return over
    key = np.zeros(n - SEED + 1, np.uint64)
    for k in range(SEED):
        key = mix(key + ids[k: n - SEED + 1 + k].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    for k in range(1, SEED):
        over[k: k + len(key)] |= again
    return over


def runs_of(ids: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of word ids, by start, then period."""
    n = len(ids)
    if n < LEAST:
        return []
    grammar = Grammar(ids, max(ids) + 1)
    may = repeated_seeds(np.array(ids, np.int64))
    found: set[tuple[int, int, int]] = set()  # (period, start, end)

    inside = {}
    for k, size in enumerate(grammar.sizes):
        at = grammar.first[k]
        cut = grammar.size(grammar.left[k])
        if size >= LEAST and may[at + cut] and (own := crossing(ids[at: at + size], cut)):
            inside[k] = own
    if inside:
        for k, where in grammar.places(set(inside)).items():
            for lo, hi, q in inside[k]:
                found.update((q, i + lo, i + hi) for i in where)

    at = [*grammar.at, n]
    wanted = np.flatnonzero(may[at[1:-1]]) + 1
    halves = [(0, len(at) - 1)] if len(wanted) else []
    while halves:
        lo, hi = halves.pop()
        mid = (lo + hi) // 2
        a, b = np.searchsorted(wanted, (lo + 1, hi))
        if hi - lo < 2 or a == b:
            continue
        if may[at[mid]] and at[hi] - at[lo] >= LEAST:
            found.update((q, at[lo] + s, at[lo] + e) for s, e, q in crossing(ids[at[lo]: at[hi]], at[mid] - at[lo]))
        halves += [(lo, mid), (mid, hi)]

    out: list[list[int]] = []
    for q, s, e in sorted(found):
        if out and out[-1][2] == q and s + q <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, q])
    return sorted((s, e - s, q) for s, e, q in out)


def periodic_tail(words: list[bytes], number: int) -> list[bytes]:
    """The words with a periodic tail where ``number`` is a multiple of ten: from place a on, word i is
    word a + (i - a) % p of the text, with a and p taken from ``number``."""
    n = len(words)
    if number % 10 or not n:
        return words
    g = number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a: a + p]
    return words[:a] + (period * ((n - a) // len(period) + 1))[: n - a]


FOUND = "doc_id long, runs array<struct<start:int,length:int,period:int>>, n_words long, kept string"


@released
def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in text_slices(batch, "text"):
            raw = data.tobytes()
            runs, sizes, total, kept = [], [], [], []
            numbers = batch.column("tail").slice(lo, hi - lo).to_pylist()
            for r, number in enumerate(numbers):
                words = raw[offs[r]: offs[r + 1]].split()
                if number is not None:
                    words = periodic_tail(words, number)
                names: dict[bytes, int] = {}
                own = runs_of([names.setdefault(w, len(names)) for w in words])
                gone = bytearray(len(words))
                for start, length, q in own:
                    gone[start + q: start + length] = b"\1" * (length - q)
                runs += own
                sizes.append(len(own))
                total.append(len(words))
                kept.append(b" ".join([w for w, g in zip(words, gone, strict=True) if not g]) if own else b" ".join(words))
            cols = list(zip(*runs, strict=True)) or [()] * 3
            items = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in cols], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), items),
                 pa.array(total, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "n_words", "kept"])


def periodic_runs(docs: DataFrame, tail: F.Column | None = None) -> DataFrame:
    """doc_id, runs (start word, length, period; by start, then period), n_words, kept (the words that are
    left, joined by one space, when each run keeps only its first period) for every row of ``docs`` (doc_id,
    text; other columns are ignored).

    ``tail`` is a number for each row that gives its words a periodic tail (``periodic_tail``); rows where
    it is null are taken as they are. A null text has no words and no runs; rows repeat as given.
    """
    tail = F.lit(None) if tail is None else tail
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tail.cast("long").alias("tail"))
    return rows.mapInArrow(_found, FOUND)


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest length / period (start, length, period, exponent_milli; ties: smallest
    start, then period; nulls without runs), runs_sha256 and collapsed_sha256 for every row of ``docs``, whose
    texts get a tail by the crc32 of the decimal doc_id (null ids: none)."""
    number = F.crc32(F.encode(F.col("doc_id").cast("long").cast("string"), "UTF-8"))
    found = periodic_runs(docs, number)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    # a greater exponent first, compared by cross-multiplication
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(
        r["length"].cast("long") * a["period"] > a["length"].cast("long") * r["period"], r).otherwise(a))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").cast("long").alias("start"), F.col("best.length").cast("long").alias("length"),
        F.col("best.period").cast("long").alias("period"),
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("collapsed_sha256"))


ORACLE = r"""
WITH b AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS digits FROM documents),
h AS (
  SELECT doc_id, words, len(words) AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, digits),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1))))) AS h FROM b),
g AS (SELECT *, h // 10 AS g FROM h),
t AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a,
             CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM g),
w AS (SELECT doc_id, n, CASE WHEN a < n THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % p + 1] END)
             ELSE words END AS words FROM t),
e AS (SELECT doc_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM w),
met AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM met),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM isle GROUP BY doc_id, q, k),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretch WHERE l >= 6 AND l >= 4 * q GROUP BY doc_id, s, l),
best AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := s, l := l, q := q), (-(l::DECIMAL(38, 18)) / q, s, q)) AS r,
                string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS text FROM e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, r.s AS start, r.l AS length, r.q AS period, 1000 * r.l // r.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN best ON best.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
