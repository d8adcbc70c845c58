"""Nearest neighbours against comparing with all vectors."""

import math

import numpy as np
from pyspark.sql import functions as F

from docharbor.llm.neighbours import Forest, Trees, nearest

SCHEMA = "vec_id long, embedding array<float>, VEC_ID int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k=5):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float32).astype(float)
    out = {}
    for i, x in ok.items():
        if i % 50:
            continue
        size = max(map(len, ok.values()))
        pad = lambda y: np.r_[y, np.zeros(size - len(y))]  # noqa: B023, E731
        near = [(-(pad(x) * pad(y)).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())), j) for j, y in ok.items() if j != i]
        out[i] = [j for _, j in sorted(near)[:k]]
    return out


def found(df, **params):
    out = {}
    for r in nearest(df, F.col("vec_id") % 50 == 0, **params).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(out[r.query_id])
    return out


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    rows += [(200 + i, rows[50][1]) for i in range(110)]  # copies, queries among them
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] * 8), (404, [float("inf")] + [1.0] * 7), (405, [None] + [1.0] * 7), (None, [1.0] * 8), (406, [1.0, 2.0])]
    rows += rows[:3]
    assert found(frame(spark, rows)) == brute(rows)


def test_few_and_no_rows(spark):
    assert found(frame(spark, [])) == {}
    assert found(frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])])) == {0: [1, 2]}
    assert found(frame(spark, [(0, [1.0, 0.0])])) == {}


def test_blocks_change_no_result(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    assert found(frame(spark, rows), p=Forest(block=7)) == brute(rows)


def test_recall_of_a_partial_search():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    trees = Trees(x, Forest(trees=16, leaf=32))
    leaf, hit = trees.leaves(x), 0
    for q, places in zip(range(60), trees.search(x[:60], 320), strict=True):
        score = x @ x[q]
        score[q] = -2
        seen = np.zeros(len(x), bool)
        for t, at in places:
            seen |= leaf[:, t] == at
        hit += seen[np.argsort(-score)[:5]].sum()
    assert hit / 300 >= 0.9


def test_repeated_rows_take_no_place_of_other_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(100, 120)]
    rows += [(i, [1.0] * 6) for i in range(9)]
    rows += rows[-9:] + rows[-9:-8] * 6
    assert found(frame(spark, rows))[0] == brute(rows)[0] == [1, 2, 3, 4, 5]
