"""Near-duplicates and repeated windows against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa

from gridspark.llm import minhash, substring
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, docs, empty, prose, with_clashes

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[k: k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets, parent = {}, {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
            parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: root(i) for i in ids}


def check_near(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute_components(rows)
    got = minhash.near_duplicates(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sorted((i is None, i or 0, len(shingles(t))) for i, t in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_on_table(spark):
    check_near(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))


def test_near_awkward(spark):
    check_near(with_clashes(awkward(spark)))
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_near_group_in_many_components(spark):
    """Edits of one text at every distance: links, and pairs just under the threshold."""
    base = prose(5, 80).split()
    rows = []
    for k in range(60):
        w = list(base)
        for e in range(k % 12):
            w[(e * 7 + k) % len(w)] = f"edit{k}x{e}"
        rows.append((k, " ".join(w)))
    check_near(docs(spark, rows))


def test_sketch_estimates_similarity():
    a, b = np.arange(1, 701, dtype=np.uint64), np.arange(101, 801, dtype=np.uint64)
    a, b = minhash.mix(a), minhash.mix(b)
    agree = (minhash.sketch(a, 1024) == minhash.sketch(b, 1024)).mean()
    assert abs(agree - 600 / 800) < 0.07
    for n in (1, 2, 3):
        assert minhash.sketch(a[:n]).max() < np.iinfo(np.uint64).max


def brute_windows(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 19):
            place = (i is None, i or 0, k)
            x = tuple(w[k: k + 20])
            first[x] = min(first.get(x, place), place)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if first[tuple(w[k: k + 20])] != (i is None, i or 0, k):
                gone[k: k + 20] = [True] * 20
        out.append((i is None, i or 0, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def test_windows_on_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = substring.remove_repeats(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got) == brute_windows([(r.doc_id, r.text) for r in df.collect()])


def test_windows_awkward(spark):
    df = awkward(spark).union(docs(spark, [(20, "a b c d e " * 9), (21, prose(1, 30) + " tail"), (22, "head " + prose(1, 60) + " " + prose(9, 30))]))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = substring.remove_repeats(with_clashes(df)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got) == brute_windows(rows)
    assert substring.remove_repeats(empty(spark)).count() == 0


def check_windows(df):
    got = substring.remove_repeats(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got) == brute_windows([(r.doc_id, r.text) for r in df.collect()])


def test_windows_of_long_periodic_texts(spark):
    check_windows(docs(spark, [(1, "word " * 3000), (2, "row of five words here " * 800), (3, "x " + "word " * 500)]))
    batch = pa.RecordBatch.from_pydict({"id": [1], "tag": [7], "text": ["word " * 3000]})
    assert sum(sum(b.column("places").to_pylist()) for b in substring._runs([batch])) > 2900


def test_windows_of_versions_and_null_ids(spark):
    """Versions of a document at equal starts, and many rows without an id that share a passage."""
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(5, f"{a} {b}"), (5, f"{a} {c}"), (3, f"{prose(9, 10)} {a[20:]}"), (9, f"{b} {a}"), (2, c), (8, c), (8, c), (4, a), (6, f"{a} {a} {a}")]
    check_windows(docs(spark, rows))
    check_windows(docs(spark, [(None, f"{prose(k, k % 7)} {a} {prose(100 + k, 5)}") for k in range(300)] + [(None, a)] * 200 + [(1, a)]))


def test_run_digests_do_not_depend_on_the_slice():
    words = np.arange(100, 400, dtype=np.uint64)
    at, size = np.array([3, 50, 120]), np.array([20, 25, 90])
    whole = substring.run_digests(words, at, size)
    for k in range(3):
        part = words[at[k]: at[k] + size[k]]
        assert substring.run_digests(part, np.array([0]), size[k: k + 1])[0] == whole[k]


def test_query_digest(spark):
    from gridspark.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op4_substring_dedup"](spark, SF_SMALL).collect()}
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, i, n, removed, kept in brute_windows([(r.doc_id, r.text) for r in df.collect()]):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())
