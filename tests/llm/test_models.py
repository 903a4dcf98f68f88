"""Decontamination and the two classifiers: planted cases, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.llm import decontaminate, quality, toxicity
from gridspark.llm.common import U, mix
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import awkward, docs, empty, prose, with_clashes


def plain_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            same = decontaminate.MATCH if a[i] == b[j] else decontaminate.MISMATCH
            h[i + 1][j + 1] = max(0, h[i][j] + same, h[i][j + 1] + decontaminate.GAP, h[i + 1][j] + decontaminate.GAP)
    return max(max(r) for r in h) / (decontaminate.MATCH * len(a))


def test_alignment_score():
    rng = np.random.default_rng(1)
    for n in range(40):
        a, b = rng.integers(0, 4, rng.integers(1, 25)).astype(U), rng.integers(0, 4, rng.integers(1, 40)).astype(U)
        assert decontaminate.align(a, b)[0] == pytest.approx(plain_alignment(a.tolist(), b.tolist()))
    a = mix(np.arange(30, dtype=U))
    score, lo, hi = decontaminate.align(a[5:20], a)
    assert (score, lo, hi) == (1.0, 5, 20)


def test_leaks(spark):
    item = prose(70, 40)
    w = item.split()
    edited = " ".join("changed" if k % 6 == 3 else x for k, x in enumerate(w) if k % 9 != 4)
    rows = [(1, f"{prose(71, 200)} {item} {prose(72, 200)}"), (2, f"{prose(73, 50)} {edited.upper()}!"), (3, prose(74, 400)), (4, " ".join(w[:8])),
            (5, item), (5, item), (None, item), (6, None), (7, ""), (8, ", ".join(w))]
    bench = spark.createDataFrame([(1, item), (1, item), (2, prose(75, 30)), (3, None), (4, ""), (5, "too short an item"), (None, prose(99, 12))],
                                  "item_id long, text string")
    got = decontaminate.leaks(with_clashes(docs(spark, rows)), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 1), (1, 1), (2, 1), (5, 1), (8, 1)]
    assert {r.doc_id: r.score for r in got}[1] == 1.0
    assert [(r.start_word, r.end_word) for r in got if r.doc_id == 1] == [(200, 240)]
    blocks = decontaminate.leaks(docs(spark, rows), bench, block_bytes=64).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in blocks) == sorted((r.doc_id or 0, r.item_id) for r in got)
    clean = decontaminate.without_leaks(with_clashes(docs(spark, [*rows, (None, "clean"), (5, "another text")])), bench)
    assert clean.columns == with_clashes(docs(spark, rows)).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == sorted(
        [(3, rows[2][1]), (4, rows[3][1]), (6, ""), (7, ""), (0, "clean"), (5, "another text")])
    assert decontaminate.leaks(awkward(spark), bench).count() == 0
    assert decontaminate.leaks(empty(spark), bench).count() == 0
    assert decontaminate.leaks(docs(spark, rows), bench.filter("1 = 0")).count() == 0


def test_leaks_are_the_exact_copies_of_the_table(spark):
    d, b = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, items = d.collect(), b.collect()
    exact = {(x.doc_id, y.item_id) for x in texts for y in items if y.text in x.text}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()}
    assert exact and exact <= got and len(got) <= 1.1 * len(exact)


@pytest.mark.parametrize("copies,edits", [(0, 21), (0, 200), (0, 2000), (5, 40), (30, 200)])
def test_leaks_of_one_passage_edited_alike_in_many_documents(spark, copies, edits):
    w = prose(80, 20).split()
    edited = " ".join("changed" if k in (6, 13) else x for k, x in enumerate(w))
    rows = [(k, f"{prose(1000 + k, 30)} {edited if k < edits else ' '.join(w)} {prose(5000 + k, 20)}") for k in range(edits + copies)]
    rows += [(10000 + k, prose(9000 + k, 60)) for k in range(20)]
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontaminate.leaks(docs(spark, rows), bench).collect()}
    assert got == {k: pytest.approx(0.85) if k < edits else 1.0 for k in range(edits + copies)}
    assert decontaminate.without_leaks(docs(spark, rows), bench).count() == 20


EDITS = {
    "put in after every second word": lambda w, rng: [x for k, y in enumerate(w) for x in ([y, f"new{rng.integers(999)}"] if k % 2 else [y])],
    "put in after half of the words": lambda w, rng: [x for y in w for x in ([y, f"new{rng.integers(999)}"] if rng.random() < 0.5 else [y])],
    "every third replaced": lambda w, rng: [f"new{rng.integers(999)}" if k % 3 == 2 else y for k, y in enumerate(w)],
    "a quarter replaced": lambda w, rng: [f"new{rng.integers(999)}" if rng.random() < 0.25 else y for y in w],
    "a third taken out": lambda w, rng: [y for y in w if rng.random() > 0.33],
    "all kinds": lambda w, rng: [x for y in w for x in ([], [y], [y], [y], [y], [f"new{rng.integers(999)}"], [y, f"new{rng.integers(999)}"])[rng.integers(7)]]}


def test_recall_against_alignment_of_all_pairs(spark):
    """Each kind of edit: the passages that align at the limit or better are found, at least 95 of 100."""
    rng = np.random.default_rng(17)
    items = [prose(300 + k, int(rng.integers(14, 50))).split() for k in range(40)]
    hashed = [(k, h) for k, h in decontaminate_items(items)]
    rows, truth = [], {}
    for kind, edit in EDITS.items():
        for k, w in enumerate(items):
            passage = edit(w, rng)
            score = decontaminate.align(hashed[k][1], words_of(passage))[0]
            truth[len(rows)] = (kind, k, score)
            rows.append((len(rows), f"{prose(7000 + len(rows), 40)} {' '.join(passage)} {prose(9000 + len(rows), 40)}"))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(spark, rows), bench).collect()}
    for kind in EDITS:
        due = [(i, k) for i, (c, k, score) in truth.items() if c == kind and score >= 0.5]
        assert len(due) > 10 and sum(x in got for x in due) >= 0.95 * len(due), kind


def words_of(words):
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return decontaminate.plain_words(raw, np.array([0, len(raw)]))[0]


def decontaminate_items(items):
    return [(k, words_of(w)) for k, w in enumerate(items)]


def test_short_items_count_word_for_word(spark):
    bench = spark.createDataFrame([(1, "zebra quince lantern"), (2, "one two"), (3, "zebra quince lantern tulip")], "item_id long, text string")
    df = docs(spark, [(1, "a zebra quince lantern b"), (2, "zebra quince x lantern tulip"), (3, "one two"), (4, "Zebra, quince lantern! TULIP")])
    assert {(r.doc_id, r.item_id, r.score) for r in decontaminate.leaks(df, bench).collect()} == {(1, 1, 1.0), (4, 1, 1.0), (4, 3, 1.0)}


def test_passages_of_many_items_in_parts(monkeypatch):
    """Parts of the items, and parts of a long text, give the alignments of the whole."""
    rng = np.random.default_rng(5)
    items = [(k, rng.integers(0, 40, 12).astype(U)) for k in range(30)]
    text = rng.integers(0, 40, 4000).astype(U)
    for k in range(0, 30, 3):
        text[k * 100: k * 100 + 11] = np.delete(items[k][1], 4)
    seeds = decontaminate.Seeds(items, *decontaminate.item_pairs(items))

    def best():
        out = {}
        for _, k, a, b, _ in seeds.passages(text, np.array([0, len(text)]), 0.5):
            out[k] = max(decontaminate.align(items[k][1], text[a:b])[0], out.get(k, 0))
        return {k: s for k, s in out.items() if s >= 0.5}

    whole = best()
    assert set(range(0, 30, 3)) <= set(whole)
    monkeypatch.setattr(decontaminate, "PAIRS", 50)
    assert best() == whole
    for k, words in items:
        parts = decontaminate.promising(words, text, 0.5)
        assert max([decontaminate.align(words, text[a:b])[0] for a, b in parts], default=0) == pytest.approx(
            decontaminate.align(words, text)[0]) or decontaminate.align(words, text)[0] < 0.5


def held_out(got, labels, name, folds, fold):
    marked = {r.doc_id: r[name] for r in labels.collect()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) and 0 <= r.score <= 1
    return [(marked[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in marked]


def test_quality_held_out(spark):
    d, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.scored(d, labels).collect()
    pairs = held_out(got, labels, "quality", 5, 0)
    assert len(got) == d.count() and sum(a == b for a, b in pairs) / len(pairs) > 0.95


def test_toxicity_held_out(spark):
    d, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.scored(d, labels).collect()
    pairs = held_out(got, labels, "toxic", 3, 1)
    assert len(got) == d.count() and sum(a == b for a, b in pairs) / len(pairs) > 0.9
    assert not [1 for a, b in pairs if b and not a]


def test_flat_trees_walk_like_nested_ones():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] < -0.2)).astype(int)
    t = quality.fit(x, y)

    def walk(row, node):
        while t.feature[node] >= 0:
            node = t.left[node] if row[t.feature[node]] <= t.bound[node] else t.right[node]
        return t.value[node]

    plain = [1 / (1 + np.exp(-(t.base + sum(walk(r, n) for n in t.roots)))) for r in x]
    assert np.allclose(t.score(x), plain) and ((t.score(x) > 0.5) == y).mean() > 0.97
    assert len(quality.fit(x[:0], y[:0]).roots) == 0


def test_statistics_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"", b"Some words. More words!", "é ß\n漢字".encode(), b"   ", b"a", b"x y x y x y | | ###"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.cumsum([0] + [len(t) for t in texts])
    whole = quality.statistics(data, offs)
    for k, t in enumerate(texts):
        alone = quality.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert np.allclose(whole[k], alone[0])
    assert not whole[0].any()


def test_identity_terms_do_not_carry_toxicity():
    """Labelled texts in which one group is named only in toxic ones: with the penalty, a
    neutral mention of it scores like one of the other group."""
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(300)]
    texts, label = [], []
    for k in range(600):
        toxic = k % 3 == 0
        t = list(rng.choice(words, 20))
        if toxic:
            t[3] = str(rng.choice(["moron", "scum", "idiot"]))
            t[7] = "muslim"
        elif k % 2:
            t[7] = "christian"
        texts.append(" ".join(t))
        label.append(int(toxic))

    def features(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return toxicity.row_features(raw, np.array([0, len(raw)]))[0]

    own = [features(t) for t in texts]
    other = [features(toxicity.swapped(t)) if toxicity._TERM.search(t) else None for t in texts]

    def logit(model, text):
        return model.bias + model.weights[np.isin(model.features, features(text))].sum()

    y = np.array(label)
    plain, fair = toxicity.fit(y, own, [None] * len(own)), toxicity.fit(y, own, other)
    gap = [logit(m, "a muslim neighbour") - logit(m, "a jewish neighbour") for m in (plain, fair)]
    assert gap[0] > 1 and abs(gap[1]) < 0.3 * gap[0]
    assert logit(fair, "you moron scum") > 0


@pytest.mark.parametrize("scored,column", [(quality.scored, "quality"), (toxicity.scored, "toxic")])
def test_odd_rows(spark, scored, column):
    df = with_clashes(awkward(spark))
    labels = spark.createDataFrame([(4, 0), (6, 1), (7, None), (None, 1), (8, 0), (4, 0), (99, 1)], f"doc_id long, {column} int")
    got = scored(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)
    nothing = scored(df, labels.filter("1 = 0")).collect()
    assert len(nothing) == df.count() and len({r.score for r in nothing}) == 1
    assert scored(empty(spark), labels).count() == 0


def test_the_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as pipeline

    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs_, seen = d, d.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs_ = stage(spark, docs_, SF_SMALL)
        assert docs_.columns == d.columns
        n = docs_.count()
        assert 0.6 * seen < n <= seen
        seen = n
    out = pipeline.run(spark, SF_SMALL)
    assert out.count() == seen
    assert F.col and {r.doc_id for r in out.collect()} == {r.doc_id for r in docs_.collect()}
