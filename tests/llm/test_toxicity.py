"""Toxicity: accuracy on held-out documents, and the fold's rule."""

import binascii
import random

from docharbor.llm.toxicity import Ftrl, drop_toxic, toxicity_report

SCHEMA = "doc_id long, text string, TEXT string, score int, toxic int"


def made(rng, n=900):
    neutral = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        w = [rng.choice(neutral) for _ in range(rng.randrange(20, 60))]
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["nasty", "awful", "vileness" + str(i)])
            w[rng.randrange(len(w))] = rng.choice(["nasty", "awful", "vilest" + str(i)])
        rows.append((i, " ".join(w), "x", 1, 2))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = made(random.Random(1))
    truth = dict(labels)
    docs = spark.createDataFrame([*rows, (2000, None, "x", 1, 2), (2001, "", "x", 1, 2), (None, "w1 nasty awful", "x", 1, 2), rows[5]], SCHEMA)
    known = spark.createDataFrame([*labels, (3, None), (None, 1), (5000, 1)], "doc_id long, toxic int")
    out = toxicity_report(docs, known).collect()
    assert len(out) == len(rows) + 4
    for r in out:
        assert r.held_out == (r.doc_id is not None and binascii.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 150 and right >= 0.95 * len(held)


def test_held_out_labels_change_nothing(spark):
    rows, labels = made(random.Random(2), 200)
    docs = spark.createDataFrame(rows, SCHEMA)
    other = [(i, 1 - y if binascii.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    scores = [
        sorted(map(tuple, toxicity_report(docs, spark.createDataFrame(x, "doc_id long, toxic int"), Ftrl(rows=100)).collect()))
        for x in (labels, other)
    ]
    assert scores[0] == scores[1]


def test_toxic_documents_go_and_others_stay_unchanged(spark):
    rows, labels = made(random.Random(3))
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = drop_toxic(docs, known)
    assert out.columns == ["doc_id", "text", "TEXT", "score", "toxic"]
    kept = [tuple(r) for r in out.collect()]
    assert set(kept) <= set(rows)
    clean = [r for r, (_, y) in zip(rows, labels, strict=True) if not y]
    assert len(set(clean) - set(kept)) <= 0.02 * len(clean)


def test_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity_report(spark.createDataFrame([], SCHEMA), none).count() == 0
    out = toxicity_report(spark.createDataFrame([(1, "a b", "x", 1, 2)], SCHEMA), none).collect()
    assert [r.score for r in out] == [0.5]
