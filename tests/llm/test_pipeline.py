"""The pipeline on odd tables, against a plain version of what its stages decide."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from gridspark.llm import decontaminate, minhash, secrets, toxicity
from gridspark.llm.bpe import read_ranks
from tests.llm.helpers import awkward, docs, empty, prose, with_clashes
from tests.llm.test_dedup import brute_components

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def tables(spark, folder, df, labels=(), items=()):
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def expected(spark, folder):
    """What is left, by plain means: scores of the fitted model, all pairs compared, all passages aligned, masks applied."""
    df = spark.read.parquet(f"{folder}/documents.parquet").select(*pipeline.COLUMNS)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    model = toxicity.train(df, labels, F.lit(True))
    rows = [r for r in toxicity.with_scores(df, model).collect() if r.score < toxicity.THRESHOLD]
    keep = brute_components([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if r.doc_id is None or keep[r.doc_id] == r.doc_id]

    def words(text):
        import numpy as np

        raw = np.frombuffer((text or "").encode(), np.uint8)
        return decontaminate.plain_words(raw, np.array([0, len(raw)]))[0]

    items = [words(t) for _, t in bench if t]
    rows = [r for r in rows if not any(decontaminate.align(i, words(r.text))[0] >= decontaminate.LEAK for i in items if len(i) >= decontaminate.LEAST_WORDS)]
    owners = {}
    for r in rows:
        for *_, value in secrets.find(r.text or ""):
            owners.setdefault(value, set()).add(r.source)
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})
    out = []
    for r in rows:
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b, v in secrets.find(r.text or "") if len(owners[v]) == 1)
        text = secrets.redact(r.text or "", spans)
        ids = enc.encode_ordinary(text)
        out.append((r.doc_id, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, folder):
    return sorted(((r.doc_id, r.n_tokens, r.decoded_sha256) for r in pipeline.run(spark, folder).collect()), key=repr)


def test_every_decision_takes_effect(spark, tmp_path):
    item = prose(900, 20)
    edited = " ".join("changed" if k % 7 == 3 else w for k, w in enumerate(item.split()))
    rows = [(k, f"{prose(k, 50)} nasty{k % 3} rotten vile" if k % 4 == 0 else prose(k, 60), f"s{k % 5}") for k in range(80)]
    rows += [(200, prose(1, 60) + " tail", "s1"), (201, f"{prose(300, 30)} {item} {prose(301, 30)}", "s2"), (202, f"{prose(310, 30)} {edited}", "s3"),
             (203, f"{prose(320, 30)} password = hunter2-hunter2", "s1"), (204, f"{prose(330, 30)} token: example-value", "s1"),
             (205, f"{prose(340, 30)} token: example-value", "s2"), (206, None, None), (None, prose(350, 30), "s1"), (206, "", "s9")]
    labels = [(k, 1, int(k % 4 == 0)) for k in range(60)]
    folder = tables(spark, str(tmp_path), with_clashes(docs(spark, rows)), labels, [(1, item), (2, None), (3, "")])
    want = expected(spark, folder)
    assert result(spark, folder) == want
    left = [i for i, *_ in want]
    assert not {0, 64, 200, 201, 202} & set(left) and {1, 203, 204, 205, None} <= set(left) and left.count(206) == 2


def test_awkward_documents(spark, tmp_path):
    folder = tables(spark, str(tmp_path), with_clashes(awkward(spark)), [(4, 0, 0), (6, 1, 1), (7, None, None)], [(1, prose(77, 20))])
    assert result(spark, folder) == expected(spark, folder)


@pytest.mark.parametrize("kind", ["documents", "the rest"])
def test_empty_tables(spark, tmp_path, kind):
    df = empty(spark) if kind == "documents" else docs(spark, [(1, prose(1, 30)), (2, "one"), (3, None)])
    folder = tables(spark, str(tmp_path), df)
    assert [i for i, *_ in result(spark, folder)] == ([] if kind == "documents" else [1, 2, 3])
    assert minhash.near_duplicates(df).count() == df.count()
