"""Secret scanning with corpus-wide ownership frequency.

Candidates are found by patterns in each text. A candidate's digest is then counted over the whole
corpus by distinct owners, their repositories and its occurrences. A value that a single owner has looks
live. So does one that leaked: few owners have it, nearly all occurrences are one owner's, and
each other owner has it in one repository only. What is spread more evenly is a copied
example. Long mixed tokens outside the base patterns are reported only if they look live by that count.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import BROADCAST_IDS, few_rows, fresh, released

KINDS = ("assign", "access", "hex", "bare")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# A long token of mixed kinds of characters, outside the base patterns.
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# A leaked value has at most this many owners, and its first owner more than this share of its occurrences.
LEAK_OWNERS, LEAK_SHARE = 3, 2 / 3


def find(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of every candidate, by start, then kind; positions are
    code points of the whole match. The value is the secret itself: group 2 of an
    assignment, else the match."""
    out = []
    # plain substring tests decide whether a pattern is worth running: an assignment names
    # one of these, and hex and bare tokens lie inside a long run without white space
    low = text.lower()
    if any(name in low for name in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    long = [w for w in text.split() if len(w) >= 20]
    if any(HEX.search(w) for w in long):
        out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    if any(BARE.search(w) for w in long):
        merged: list[list[int]] = []
        for a, b in sorted((a, b) for _, a, b, _ in out):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        starts = [a for a, _ in merged]
        for m in BARE.finditer(text):
            k = bisect_left(starts, m.end()) - 1  # the last base stretch that starts before its end
            if k < 0 or merged[k][1] <= m.start():
                out.append(("bare", m.start(), m.end(), m[0]))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = ("doc_id long, owner string, repo string, tag long, n_assign long, n_access long, n_hex long, base string, "
         "found array<struct<kind:string,start:long,end:long,digest:string>>")


@released
def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("digest", pa.string())]))
    for batch in few_rows(batches):
        counts, base, found = ([], [], []), [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = find(text)
            for c, k in zip(counts, KINDS, strict=False):
                c.append(sum(s[0] == k for s in spans))
            base.append(listed(s[:3] for s in spans if s[0] != "bare"))
            found.append([{"kind": k, "start": a, "end": b, "digest": hashlib.blake2b(v.encode(), digest_size=16).hexdigest()} for k, a, b, v in spans])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("owner").cast(pa.string()), batch.column("repo").cast(pa.string()), batch.column("tag"),
             *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(found, kind)],
            names=["doc_id", "owner", "repo", "tag", "n_assign", "n_access", "n_hex", "base", "found"])


def candidates(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """One row per document with its candidates, written once: counted and reported from there."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
                       F.coalesce(repo.cast("string"), F.lit("")).alias("repo"), F.xxhash64("text").alias("tag"), "text")
    return fresh(rows.mapInArrow(_find, FOUND), "candidates")


def ownership(found: DataFrame) -> DataFrame:
    """digest, owners, repos (of all owners together), occurrences and live of every candidate value, over the whole corpus.

    Distinct (digest, owner, repository) triples are aggregated before the shuffle, so a
    value copied into many documents is a few rows by then."""
    each = found.select("owner", "repo", F.explode("found.digest").alias("digest"))
    triples = each.groupBy("digest", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    own = triples.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    seen = own.groupBy("digest").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.sum("n").alias("occurrences"), F.max(F.struct("n", "repos")).alias("top"))
    leaked = ((F.col("owners") <= LEAK_OWNERS) & (F.col("top.n") > LEAK_SHARE * F.col("occurrences"))
              & (F.col("repos") - F.col("top.repos") <= F.col("owners") - 1))
    return seen.select("digest", "owners", "repos", "occurrences", ((F.col("owners") == 1) | leaked).alias("live"))


def scan(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """Every row of ``docs`` (doc_id, text; others only through ``owner`` and ``repo``) with
    its secrets: doc_id, n_assign, n_access, n_hex, base (kind:start:end of the base spans,
    comma-joined), spans (base spans and bare tokens that look live), n_live (spans whose
    value looks live, see ``ownership``), n_shared (the other spans), live (the live spans).

    A null text is empty and has none; null owners and repositories count as one empty
    name; a value repeated inside one owner stays live. Rows given several times give as many rows.
    """
    found = candidates(docs, owner, repo)
    seen = ownership(found)
    row = ["doc_id", "owner", "repo", "tag"]
    each = found.filter("size(found) > 0").select(*row, F.explode("found").alias("s")).select(*row, "s.*").distinct()
    judged = each.join(seen.select("digest", F.col("live").alias("alive")), "digest").filter("kind <> 'bare' OR alive")
    order = F.when(F.col("kind") == KINDS[0], 0).when(F.col("kind") == KINDS[1], 1).when(F.col("kind") == KINDS[2], 2).otherwise(3)
    item = F.struct(F.col("start").alias("a"), order.alias("o"), "alive", F.concat_ws(":", "kind", "start", "end").alias("t"))
    spans = judged.groupBy(*row).agg(F.sort_array(F.collect_list(item)).alias("all"))
    j = found.join(spans, [found[c].eqNullSafe(spans[c]) for c in row], "left").select(found["*"], spans["all"])
    every = F.coalesce("all", F.expr("array()").cast(spans.schema["all"].dataType))
    live = F.filter(every, lambda x: x["alive"])
    return j.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base",
        F.array_join(F.transform(every, lambda x: x["t"]), ",").alias("spans"),
        F.size(live).cast("long").alias("n_live"), (F.size(every) - F.size(live)).cast("long").alias("n_shared"),
        F.array_join(F.transform(live, lambda x: x["t"]), ",").alias("live"))


MASK = "[SECRET]"


def redact(text: str, spans: str) -> str:
    """``text`` with the named spans masked; of an assignment only the secret itself."""
    wanted = {tuple(s.split(":")) for s in spans.split(",") if s}
    cuts = []
    for kind, a, b, value in find(text):
        if (kind, str(a), str(b)) in wanted:
            cuts.append((b - len(value), b))
    out, at = [], 0
    for a, b in sorted(cuts):
        if b > at:
            out += [text[at: max(a, at)], MASK]
            at = b
    return "".join(out) + text[at:]


def mask(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """Every row and column of ``docs`` with the secrets of its ``text`` that look live
    masked; a text without such secrets stays as it is. The spans join the documents by (doc_id,
    text digest), so only documents that have some are matched."""
    found = candidates(docs, owner, repo)
    alone = ownership(found).filter("live").select(F.col("digest").alias("d"))
    each = found.filter("size(found) > 0").select("doc_id", "tag", F.explode("found").alias("s")).select("doc_id", "tag", "s.*").distinct()
    live = each.join(alone, each["digest"] == alone["d"], "left_semi")
    text = F.concat_ws(":", "kind", "start", "end")
    live = fresh(live.groupBy(F.col("doc_id").alias("live id"), F.col("tag").alias("live tag")).agg(
        F.concat_ws(",", F.sort_array(F.collect_list(text))).alias("live spans")), "live")
    side = F.broadcast(live) if live.count() <= BROADCAST_IDS // 20 else live
    on = docs["doc_id"].cast("long").eqNullSafe(side["live id"]) & (F.xxhash64(docs["text"]) == side["live tag"])
    return docs.join(side, on, "left").drop("live id", "live tag").mapInArrow(_masked, docs.schema)


@released
def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without their last column, ``live spans``, which are masked in the texts."""
    for batch in batches:
        own, spans = batch.schema.names[:-1], batch.column(batch.num_columns - 1).to_pylist()
        texts = batch.column("text")
        if any(spans):
            texts = pa.array([redact(t, s) if s else t for t, s in zip(texts.to_pylist(), spans, strict=True)], texts.type)
        yield pa.RecordBatch.from_arrays([texts if n == "text" else batch.column(n) for n in own], names=own)
