"""Byte-level BPE encoding and decoding by DuckDB queries inside Spark's partitions.

A task splits its texts into pieces and encodes each new distinct piece once. The pieces
of a batch are token-position rows (piece, position, token, next token) in DuckDB; a
recursive query joins them with the merge table and contracts every piece's leftmost
minimum-rank pair, step by step, until no pair can be merged. Decoding joins the ids
of a batch of documents with the vocabulary and aggregates the bytes in order.

The vocabulary file is read once by the driver and broadcast (its size is that of the
vocabulary); processes keep encoded pieces in columns of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import released, text_slices

# Bytes of text taken at once, bytes of new pieces in one recursive query, encoded pieces and chunks
# of text that a process keeps and their bytes, and bytes from which a piece is merged by a heap
# instead of position rows (a query's work grows with the square of its longest piece).
SLICE_BYTES = 1 << 20
QUERY_BYTES = 300_000
KEEP_CHUNKS = 400_000
KEEP_BYTES = 32 << 20
LONG_PIECE = 400
# Code points of a text that is taken in parts.
LONG_TEXT = 1 << 20
NONE = 0xFFFF_FFFF
# Marks that end a piece of letters and are a piece by themselves when alone.
MARKS = frozenset(".,;:!?")

WHITE = "\t-\r \x85\xa0  -     　"
# Cuts that every piece boundary of the split pattern respects: a run without white space
# with the one space before it, or the white space that belongs to no such run.
CHUNK = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?=[{WHITE}]|\Z)|[{WHITE}]")

# Where a text can be cut without changing its chunks: before a single space between words.
CUT = re.compile(rf"[^{WHITE}](?= [^{WHITE}])")


def parts(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of about ``size`` code points with the same chunks."""
    at = 0
    while len(text) - at > size and (m := CUT.search(text, at + size)):
        yield text[at: m.end()]
        at = m.end()
    yield text[at:]


CONTRACT = """
WITH RECURSIVE steps AS (
  SELECT i.w, i.pos, i.tok, i.nxt, g.merged AS m, false AS done
  FROM pieces i LEFT JOIN merges g ON g.pair = (i.tok::BIGINT << 32 | i.nxt)
  UNION ALL
  -- a merge drops the left row and rewrites the right one and the one before the pair
  SELECT n.w, n.pos, n.tok, n.nxt, CASE WHEN n.changed THEN g.merged ELSE n.m END, n.done
  FROM (
    SELECT s.w, s.pos - (s.pos > b.p)::INT AS pos,
           CASE WHEN s.pos = b.p + 1 THEN b.merged ELSE s.tok END AS tok,
           CASE WHEN s.pos = b.p - 1 THEN b.merged ELSE s.nxt END AS nxt,
           s.m, s.pos = b.p + 1 OR s.pos = b.p - 1 AS changed, b.k IS NULL AS done
    FROM steps s JOIN (
      SELECT w, min(m::BIGINT << 24 | pos) AS k, k >> 24 AS merged, coalesce(k & 16777215, 16777215)::INT AS p
      FROM steps GROUP BY w) b ON b.w = s.w
    WHERE NOT s.done AND s.pos <> b.p) n
  LEFT JOIN merges g ON n.changed AND g.pair = (n.tok::BIGINT << 32 | n.nxt))
SELECT w, tok FROM steps WHERE done ORDER BY w, pos
"""

DECODE = """
SELECT i.d, array_to_string(list(v.spelt ORDER BY i.pos), '') AS spelt
FROM ids i JOIN vocabulary v ON v.id = i.tok GROUP BY i.d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens and ranks of a rank file (base64 token, space, rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Held:
    """Encoded pieces and chunks as two columns, text and ids (little-endian 32-bit integers): as Python objects they
    would take several times the memory. A row is found by its text's hash and then compared."""

    def __init__(self):
        self.texts, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.met = np.zeros(0, np.int32)  # the turn in which a row was met last
        self.hashes, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int32)  # in the order of the hashes
        self.turn = 0

    def find(self, names: list[str]) -> dict[str, bytes]:
        """The ids of those ``names`` that are held."""
        self.turn += 1
        if not names or not len(self.rows):
            return {}
        h = np.fromiter(map(hash, names), np.int64, len(names))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        may = np.flatnonzero(self.hashes[at] == h)
        rows, names = self.rows[at[may]], [names[i] for i in may.tolist()]
        same = pc.equal(self.texts.take(pa.array(rows)), pa.array(names, pa.string())).to_numpy(zero_copy_only=False)
        if not same.all():
            rows, names = rows[same], [n for n, s in zip(names, same, strict=True) if s]
        if not len(rows):
            return {}
        self.met[rows] = self.turn
        got = self.ids.take(pa.array(rows))
        ends = np.frombuffer(got.buffers()[1], np.int32)[got.offset: got.offset + len(got) + 1].tolist()
        data = got.buffers()[2].to_pybytes() if ends[-1] else b""
        return dict(zip(names, [data[a:b] for a, b in pairwise(ends)], strict=True))

    def keep(self, new: dict[str, bytes]) -> None:
        """Hold ``new`` too, but no long texts and of texts with the same hash only the first. What was met least
        recently goes when there is too much."""
        names = [n for n in new if len(n) < LONG_TEXT]
        h, first = np.unique(np.fromiter(map(hash, names), np.int64, len(names)), return_index=True)
        at = np.searchsorted(self.hashes, h)
        absent = np.ones(len(h), bool)
        inside = at < len(self.hashes)
        absent[inside] = self.hashes[at[inside]] != h[inside]
        names = [names[i] for i in first[absent].tolist()]
        rows = np.arange(len(self.texts), len(self.texts) + len(names), dtype=np.int32)
        self.hashes, self.rows = np.insert(self.hashes, at[absent], h[absent]), np.insert(self.rows, at[absent], rows)
        self.texts = pa.concat_arrays([self.texts, pa.array(names, pa.string())])
        self.ids = pa.concat_arrays([self.ids, pa.array([new[n] for n in names], pa.binary())])
        self.met = np.append(self.met, np.full(len(names), self.turn, np.int32))
        while len(self.texts) > KEEP_CHUNKS or self.texts.nbytes + self.ids.nbytes > KEEP_BYTES:
            self._forget(len(self.texts) // 3 + 1)
        pa.default_memory_pool().release_unused()

    def _forget(self, n: int) -> None:
        """The ``n`` rows that were met least recently go."""
        stay = np.ones(len(self.met), bool)
        stay[np.argsort(self.met, kind="stable")[:n]] = False
        number = np.cumsum(stay, dtype=np.int32) - 1
        left = pa.array(np.flatnonzero(stay))
        self.texts, self.ids, self.met = self.texts.take(left), self.ids.take(left), self.met[stay]
        of = stay[self.rows]
        self.hashes, self.rows = self.hashes[of], number[self.rows[of]]


class Codec:
    """Encoder and decoder of one task process, with its own in-memory DuckDB."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.ranks = ranks
        self.pieces_of = regex.compile(pattern).findall
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        pairs, merged = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(rank)
        given = pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int64())})
        self._make("merges", given)
        # a token's bytes are spelt as the code points of their numbers
        self._make("vocabulary", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "spelt": [t.decode("latin-1") for t in ranks]}))
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.single = {rank: np.array([rank], "<u4").tobytes() for rank in ranks.values()}
        self.held = Held()

    def _make(self, name: str, given: pa.Table) -> None:
        self.con.register("given", given)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def merge_rows(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces in a row, and how many each has, by the recursive query."""
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        tok = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        nxt = np.append(tok[1:], NONE)
        nxt[ends - 1] = NONE
        rows = pa.table({
            "w": pa.array(np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)),
            "pos": pa.array((np.arange(len(tok)) - np.repeat(ends - sizes, sizes)).astype(np.int32)),
            "tok": pa.array(tok), "nxt": pa.array(nxt)})
        self.con.register("pieces", rows)
        got = self.con.sql(CONTRACT).to_arrow_table()
        self.con.unregister("pieces")
        return got.column("tok").to_numpy().astype("<u4"), np.bincount(got.column("w").to_numpy(), minlength=len(pieces))

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same contraction of one long piece, the next pair taken from a heap."""
        parts = [piece[i: i + 1] for i in range(len(piece))]
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        heap = []

        def offer(i):
            if i >= 0 and right[i] >= 0 and (r := self.ranks.get(parts[i] + parts[right[i]])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[right[i]]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j], right[i] = a + b, b"", right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return np.array([self.ranks[p] for p in parts if p], "<u4")

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """The ids of chunks that are not held yet and of their pieces. Letters with at most one mark after them need no
        pattern to be split."""
        ranks, single = self.ranks, self.single
        todo, several = set(), {}
        for c in chunks:
            body = c[1:] if c[0] == " " else c
            if body.isalpha():
                todo.add(c)
                continue
            pieces = [c[:-1], c[-1]] if body[-1:] in MARKS and body[:-1].isalpha() else self.pieces_of(c)
            if len(pieces) > 1:
                several[c] = pieces
            todo.update(pieces)
        known = self.held.find(list(todo - chunks))
        some: list[tuple[str, bytes]] = []
        size = 0
        for p in todo - known.keys():
            raw = p.encode()
            if (rank := ranks.get(raw)) is not None:
                known[p] = single[rank]
            elif len(raw) >= LONG_PIECE:
                known[p] = self.merge_long(raw).tobytes()
            else:
                some.append((p, raw))
                size += len(raw)
                if size > QUERY_BYTES:
                    known.update(self.merge(some))
                    some, size = [], 0
        known.update(self.merge(some))
        for c, pieces in several.items():
            known[c] = b"".join([known[p] for p in pieces])
        self.held.keep(known)
        return known

    def merge(self, some: list[tuple[str, bytes]]) -> dict[str, bytes]:
        """The ids of pieces by the recursive query."""
        if not some:
            return {}
        tokens, sizes = self.merge_rows([raw for _, raw in some])
        data, ends = tokens.tobytes(), (4 * np.cumsum(sizes)).tolist()
        return dict(zip([p for p, _ in some], [data[a:b] for a, b in pairwise([0, *ends])], strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids end. A long text alone
        is taken in parts, so the memory for its chunks stays bounded."""
        if len(texts) == 1 and len(texts[0]) > LONG_TEXT:
            found = [b"".join([self.encode_texts([part])[0] for part in parts(texts[0], LONG_TEXT)])]
        else:
            found = self.encode_texts(texts)
        return np.frombuffer(b"".join(found), "<u4"), np.cumsum([len(x) // 4 for x in found], dtype=np.int64)

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = [CHUNK.findall(t) for t in texts]
        names = set().union(*split)
        known = self.held.find(list(names))
        if new := names - known.keys():
            known.update(self.learn(new))
        of = known.__getitem__
        return [b"".join(map(of, chunks)) for chunks in split]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each text, from the ids of all texts in a row."""
        n = np.diff(ends, prepend=0)
        rows = pa.table({"d": pa.array(np.repeat(np.arange(len(n), dtype=np.int32), n)),
                         "pos": pa.array(np.arange(len(ids), dtype=np.int64)), "tok": pa.array(ids.astype(np.int32))})
        self.con.register("ids", rows)
        got = self.con.sql(DECODE).to_arrow_table()
        self.con.unregister("ids")
        out = [b""] * len(n)
        for d, spelt in zip(got.column("d").to_pylist(), got.column("spelt").to_pylist(), strict=True):
            out[d] = spelt.encode("latin-1")
        return out


_CODECS: dict[str, Codec] = {}


def codec(vocabulary: tuple[str, dict[bytes, int], str]) -> Codec:
    """The codec of a broadcast vocabulary. It stays with the process, whose later tasks find what
    earlier ones have encoded; another vocabulary replaces it."""
    name, ranks, pattern = vocabulary
    if name not in _CODECS:
        for c in _CODECS.values():
            c.con.close()
        _CODECS.clear()
        _CODECS[name] = Codec(ranks, pattern)
    return _CODECS[name]


def broadcast_vocabulary(spark, path: str, pattern: str):
    """The vocabulary at ``path`` (read by the driver) for all tasks."""
    ranks = read_ranks(path)
    name = hashlib.sha256((path + pattern + str(len(ranks))).encode()).hexdigest()
    return spark.sparkContext.broadcast((name, ranks, pattern))


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, Codec]]:
    c = codec(vocabulary.value)
    for batch in batches:
        for lo, hi, _, _ in text_slices(batch, "text", SLICE_BYTES):
            ids, ends = c.encode([t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()])
            yield batch.column("doc_id").slice(lo, hi - lo), ids, ends, c


def _encode_rows(vocabulary) -> callable:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, ends, _ in _encoded(batches, vocabulary):
            lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], ends))), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([doc, lists.cast(pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def _decode_rows(vocabulary) -> callable:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary.value)
        for batch in batches:
            docs, held, size = batch.column("doc_id"), [], 0
            for i, x in enumerate(batch.column("ids")):
                held.append(np.asarray(x.values, np.int64) if x.is_valid else np.zeros(0, np.int64))
                size += held[-1].nbytes
                if size > SLICE_BYTES or i == len(batch) - 1:
                    data = c.decode(np.concatenate(held), np.cumsum([len(h) for h in held]))
                    yield pa.RecordBatch.from_arrays([docs.slice(i + 1 - len(held), len(held)), pa.array(data, pa.binary())], names=["doc_id", "data"])
                    held, size = [], 0

    return run


def _round_trip(vocabulary) -> callable:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, ends, c in _encoded(batches, vocabulary):
            parts = np.split(ids, ends[:-1])
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array([len(p) for p in parts], pa.int64()), pa.array([hashlib.sha256(p.tobytes()).hexdigest() for p in parts]),
                 pa.array([hashlib.sha256(d).hexdigest() for d in c.decode(ids, ends)])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of token ids) of every row of ``docs`` (doc_id, text; other
    columns are ignored), as the vocabulary at ``path`` and the split ``pattern`` give them,
    without special tokens. A null text is empty and has no ids; rows repeat as given."""
    return _texts(docs).mapInArrow(_encode_rows(broadcast_vocabulary(docs.sparkSession, path, pattern)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (the bytes) of every row of ``encoded`` (doc_id, ids); null ids are empty."""
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        _decode_rows(broadcast_vocabulary(encoded.sparkSession, path, pattern)), "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit integers), decoded_sha256
    (the bytes decoded from those ids) of every row of ``docs``; ids are not kept."""
    return _texts(docs).mapInArrow(
        _round_trip(broadcast_vocabulary(docs.sparkSession, path, pattern)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
