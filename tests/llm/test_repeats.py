"""Repeated windows against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from docharbor.llm.common import hashed, inside, runs_of
from docharbor.llm.recompression import repeated_substrings, substring_report, symbol_keys
from docharbor.llm.suffixes import passage_report, repeated_passages, suffix_keys

SCHEMA = "doc_id long, text string, TEXT string, k int, key int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def brute(rows, size):
    words = [(t or "").encode().split() for _, t in rows]
    windows = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        hit = [False] * len(w)
        for i in range(len(w) - size + 1):
            if windows[tuple(w[i : i + size])] > 1:
                hit[i : i + size] = [True] * size
        kept = b" ".join(x for x, h in zip(w, hit, strict=True) if not h)
        out.append((doc, len(w), sum(hit), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(rng):
    word = lambda: rng.choice("abcd") + str(rng.randrange(30))
    passages = [[word() for _ in range(rng.choice((34, 35, 36, 49, 50, 51, 70, 120)))] for _ in range(8)]
    passages += [["x"] * 80, ["x", "y"] * 60, ["x", "y", "y"] * 40, ["the"] * 34]
    rows = []
    for _ in range(60):
        w = []
        for _ in range(rng.randrange(4)):
            w += [word() for _ in range(rng.randrange(25))]
            p = rng.choice(passages)
            a = rng.randrange(3)
            w += p[a : len(p) - rng.randrange(3)]
        rows.append(" ".join(w).replace(" ", rng.choice((" ", "\n", " \t"))))
    rows += ["", None, " ", "Ünï code word " * 30]
    out = [(i if i % 19 else None, t) for i, t in enumerate(rows)]
    return out + out[:6]


def test_recompression_finds_all_repeated_windows(spark):
    rows = made(random.Random(1))
    got = substring_report(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 35)


def test_suffixes_find_all_repeated_windows(spark):
    rows = made(random.Random(2))
    df = frame(spark, rows)
    got = [(r.doc_id, r.n_words, r.n_repeated, r.kept_sha256) for r in repeated_passages(df).collect()]
    assert sorted(got, key=str) == brute(rows, 50)
    assert {r.doc_id for r in passage_report(df).collect()} == {r[0] for r in brute(rows, 50) if r[2]}


def test_no_rows(spark):
    assert repeated_substrings(frame(spark, [])).count() == 0
    assert repeated_passages(frame(spark, [(1, None)])).collect()[0].n_repeated == 0


@pytest.mark.parametrize(("keys", "size"), [(symbol_keys(35), 35), (suffix_keys(50), 50)])
def test_equal_windows_have_equal_keys(keys, size):
    rng = random.Random(size)
    texts = [[rng.choice((b"a", b"b", b"c", b"d%d" % rng.randrange(9))) for _ in range(rng.randrange(200))] for _ in range(40)]
    shared = [rng.choice((b"a", b"b", b"e%d" % rng.randrange(50))) for _ in range(90)]
    for t in texts[::2]:
        at = rng.randrange(len(t) + 1)
        t[at:at] = shared
    texts += [[b"z"] * 300, [b"y", b"z"] * 100, [b"z"] * 120]
    flat, ends = hashed(texts)
    ok = np.flatnonzero(inside(ends, size))
    seen = {}
    for w, k in zip(runs_of(flat, size)[ok].tolist(), keys(flat, ends)[ok].tolist(), strict=True):
        assert seen.setdefault(w, k) == k
    assert len(set(seen.values())) > len(seen) // 40


def test_texts_without_a_word(spark):
    """Whole slices without a word, with and without a text that has some."""
    blank = [(1, None), (2, ""), (3, " \t\n"), (4, "\x0b"), (None, None)]
    for rows in (blank, [*blank, (5, "one two")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        for report in (substring_report, passage_report):
            assert report(docs).count() in (0, len(rows))
        found = {r.doc_id: (r.n_words, r.n_removed) for r in substring_report(docs).collect()}
        assert found == {i: (2 if i == 5 else 0, 0) for i, _ in rows}
