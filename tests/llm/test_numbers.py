"""Whitening against numpy, quality rules and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridspark.llm import rules, runs, whiten
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, docs, empty, prose, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- whitening -------------------------------------------------------------------------------------------------

def check_white(rows, vectors, components=32):
    """``vectors`` are the rows that take part, as (vec_id, list)."""
    x = np.floor(64 * np.array([v for _, v in vectors], float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-12 * e.sum()).sum()))
    assert len(rows) == n * k
    want = c @ u[:, :k] / np.sqrt(e[:k])
    got = defaultdict(list)
    for r in rows:
        got[r.component].append((r.vec_id, r.whitened, r.deviation))
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained - e[r.component - 1] / e.sum()) < 1e-9
    dev = ((n * x - s) ** 2).sum(axis=1)
    for j in range(k):
        mine = sorted(got[j + 1])
        for flip in (1, -1):
            theirs = sorted((i, flip * w, d) for (i, _), w, d in zip(vectors, want[:, j].tolist(), dev.tolist(), strict=True))
            if [(a, d) for a, _, d in mine] == [(a, d) for a, _, d in theirs] and np.allclose(
                    [w for _, w, _ in mine], [w for _, w, _ in theirs], atol=1e-9):
                break
        else:
            raise AssertionError(f"component {j + 1}")


def test_whitening_on_table_in_panels(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    vectors = [(r.vec_id, list(r.vector)) for r in rows.collect()]
    many = rows.repartition(5)
    check_white(whiten.whitened_grid(many).collect(), vectors)
    check_white(whiten.whitened_grid(many, components=3, panel_rows=50).collect(), vectors, 3)


def test_whitening_awkward(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=4).tolist()) for i in range(12)]
    good += [(12, good[0][1]), (12, good[0][1])]
    bad = [(20, None), (21, []), (22, [1.0, None, 2.0, 3.0]), (23, [1.0, float("nan"), 2.0, 3.0]),
           (24, [1.0, float("inf"), 2.0, 3.0]), (25, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, vector array<double>")
    df = df.select("*", *[F.lit("x").alias(c) for c in ("row", "index", "entries", "of", "k", "n", "component")])
    check_white(whiten.whitened_grid(df).collect(), good)


def test_whitening_without_variance(spark):
    schema = "vec_id long, vector array<float>"
    assert whiten.whitened_grid(spark.createDataFrame([], schema)).collect() == []
    assert whiten.whitened_grid(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert whiten.whitened_grid(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], schema)).collect() == []
    flat = [(i, [float(i), float(2 * i), 0.0]) for i in range(9)]
    got = whiten.whitened_grid(spark.createDataFrame(flat, schema)).collect()
    assert len(got) == 9 and {r.component for r in got} == {1}
    big = [(i, [1e30 * i, float(i % 3)]) for i in range(6)]
    assert all(r.deviation is None for r in whiten.whitened_grid(spark.createDataFrame(big, schema)).collect())


# -- quality rules ---------------------------------------------------------------------------------------------

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_rules(rows, least, share):
    """rows: (doc_id, text, host) -> the expected values of each row, in order."""
    held, every = defaultdict(set), defaultdict(set)

    def norm(line):
        return " ".join(WORD.findall(re.sub("[0-9]+", "0", line.translate(LOW))))

    for i, t, h in rows:
        key = i if i is not None else ("text", t or "")
        for line in (t or "").split("\n"):
            if WORD.search(line):
                held[h, norm(line)].add(key)
                every[h].add(key)
    out = []
    for i, t, h in rows:
        t = t or ""
        words, lines = WORD.findall(t), t.split("\n")
        full = [x for x in lines if WORD.search(x)]
        seen = Counter(tuple(words[k: k + 8]) for k in range(len(words) - 7))
        rep = {p for k in range(len(words) - 7) if seen[tuple(words[k: k + 8])] > 1 for p in range(k, k + 8)}
        often = [x for x in lines if WORD.search(x) and len(held[h, norm(x)]) > max(least, share * len(every[h]))]
        lost = sum(len(WORD.findall(x)) for x in often)
        failed = len(words) < 20 or 100 * len(rep) > 30 * len(words)
        out.append((i, len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t)), len(full) - len(set(full)), len(rep), failed,
                    len(often), lost, not failed and lost <= 0.5 * len(words), "\n".join(x for x in lines if x not in often)))
    return out


def check_rules(df, least=10, share=0.005):
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    got = [tuple(r) for r in rules.line_rules(df, "source", least, share).collect()]
    key = repr
    assert sorted(got, key=key) == sorted(brute_rules(rows, least, share), key=key)
    return got


def test_rules_on_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    check_rules(df)
    check_rules(df, 1, 0.0)


def test_rules_awkward(spark):
    check_rules(with_clashes(awkward(spark)), 1, 0.0)
    assert rules.line_rules(empty(spark)).collect() == []


def test_rules_depleted(spark):
    boiler = [prose(500 + k, 10) for k in range(4)]
    rows = [(i, "\n".join([*boiler, prose(i, 12)]), "a") for i in range(8)]
    rows += [(i, "\n".join([boiler[0].upper(), "  " + boiler[1], prose(i, 60), prose(i + 100, 3)]), "a") for i in range(8, 12)]
    rows += [(20, "\n".join([*boiler, prose(20, 12)]), "b"), (None, "\n".join(boiler), "a"), (None, "\n".join(boiler), "a"), (30, "\n".join(boiler), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r[0]: r[9] for r in check_rules(df, 5, 0.2) if r[0] is not None}
    assert not any(kept[i] for i in range(8)) and all(kept[i] for i in range(8, 12)) and kept[20] and kept[30]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab1 \n#", max_size=80), min_size=1, max_size=6))
def test_rules_properties(spark, texts):
    check_rules(docs(spark, [(i % 4, t) for i, t in enumerate(texts)]), 1, 0.0)


# -- periodic runs ---------------------------------------------------------------------------------------------

def brute_runs(x):
    found = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            s = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_digest(i, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = brute_runs(w)
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(found), *top, sha("".join(f"{s},{size},{q}\n" for s, size, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_runs_on_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("length(text) < 6000")
    got = {r.doc_id: tuple(r) for r in runs.run_digests(df).collect()}
    for r in df.collect():
        assert got[r.doc_id] == brute_digest(r.doc_id, r.text)


def test_runs_awkward(spark):
    rows = [(i, t) for i, t in enumerate(["a b " * 40, "x " * 5, "x " * 6, "a b c " * 4 + "d " + "a b c " * 4, ("p q r s " * 5 + "t ") * 5, " ".join("ab" * 9)])]
    for df in (with_clashes(awkward(spark)), docs(spark, rows)):
        got = sorted((tuple(r) for r in runs.run_digests(df).collect()), key=repr)
        assert got == sorted((brute_digest(r.doc_id, r.text) for r in df.collect()), key=repr)
    assert runs.run_digests(empty(spark)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 90)
    x = [rng.randrange(rng.choice([1, 2, 4, 30])) for _ in range(n)]
    a = rng.randrange(n)
    p = 1 + (n - a) // rng.randrange(2, 11)
    x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    if rng.random() < 0.4:
        x = x + x[::-1] * 2 + x
    assert runs.runs_of(x) == brute_runs(x)


def test_grammar_spells_the_text():
    x = [int(c) for c in "0120120120110101010101222222"]
    g = runs.Grammar(x, 3)

    def spell(s):
        return [s] if s < 3 else spell(g.left[s - 3]) + spell(g.right[s - 3])

    assert [w for s in g.symbols for w in spell(s)] == x
    pairs = Counter(zip(g.symbols, g.symbols[1:], strict=False))
    assert max(pairs.values()) < 3 and all(spell(k + 3) == x[i: i + g.sizes[k]] for k, i in enumerate(g.first))
    assert all(x[i: i + g.sizes[k]] == spell(k + 3) for k, where in g.places(set(range(len(g.left)))).items() for i in where)


def test_runs_of_a_long_text():
    x = ([*range(40)] * 300) + [7] * 500 + [*range(3000)]
    assert runs.runs_of(x) == [(0, 12000, 40), (12000, 500, 1)]
