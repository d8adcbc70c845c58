"""The scores against counts in dictionaries."""

import math
import random
import re
from collections import Counter

import pytest

from docharbor.llm.decontamination import words
from docharbor.llm.language_model import Bigrams, cross_entropy_difference

SCHEMA = "doc_id long, text string, TEXT string, wanted int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in rows], SCHEMA)


def brute(rows, target, p):
    docs = [(i, [w for w in words((t or "").encode())]) for i, t in rows]
    known = {w for w, n in Counter(w for _, d in docs for w in d).items() if n >= p.least}
    docs = [(i, [w if w in known else None for w in d]) for i, d in docs]
    names = {"b": [d for _, d in docs], "t": [d for i, d in docs if i in target]}
    size = {k: sum(map(len, v)) for k, v in names.items()}
    scale = {"b": size["t"] / max(1, size["b"]), "t": 1.0}
    one = {k: Counter(w for d in v for w in d) for k, v in names.items()}
    two = {k: Counter(x for d in v for x in zip(["", *d], d, strict=False)) for k, v in names.items()}
    for k, v in names.items():
        one[k][""] = sum(map(bool, v))
    total = size["t"] + p.alpha * (len(known) + 1)
    out = {}
    for i, d in docs:
        loss = {}
        for k in names:
            s = 0.0
            for v, w in zip(["", *d], d, strict=False):
                own = (one[k][w] * scale[k] + p.alpha) / total
                s -= math.log((two[k][v, w] * scale[k] + p.prior * own) / (one[k][v] * scale[k] + p.prior))
            loss[k] = s / max(1, len(d))
        out[i] = (len(d), loss["t"], loss["b"])
    return out


def test_scores_equal_those_of_dictionaries(spark):
    rng = random.Random(5)
    kinds = (["good", "fine", "clear", "the", "of"], ["bad", "junk", "the", "of", "click"])
    rows = [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(rng.randrange(40)))) for i in range(80)]
    rows += [(None, "good junk Good"), (100, None), (101, ""), (102, "a word seen once, the")]
    labels = [(i, 1 - i % 2, 0) for i in range(0, 60)] + [(2, 0, 0), (None, 1, 0), (3, None, 0), (500, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    target = set(range(0, 60, 2))
    p = Bigrams(least=2)
    want = brute(rows, target, p)
    got = {r.doc_id: r for r in cross_entropy_difference(frame(spark, rows), labels, p).collect()}
    assert set(got) == set(want)
    for i, (n, t, b) in want.items():
        assert got[i].n_tokens == n
        assert got[i].target_loss == pytest.approx(t, rel=1e-5)
        assert got[i].background_loss == pytest.approx(b, rel=1e-5)
        assert got[i].score == pytest.approx(t - b, abs=1e-5)
    held = [got[i].score for i in range(60, 80)]
    assert max(held[::2]) < min(s for i, s in zip(range(61, 80, 2), held[1::2], strict=True) if want[i][0] > 5)


def test_without_rows_or_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert cross_entropy_difference(frame(spark, []), labels).count() == 0
    assert [r.score for r in cross_entropy_difference(frame(spark, [(1, "a b a"), (2, None)]), labels).collect()] == [0.0, 0.0]


def test_every_word_and_pair_is_counted_by_itself(spark):
    """More distinct words than 2 ** 20 shared places keep apart."""
    rng = random.Random(6)
    rows = [(i, " ".join(f"{rng.getrandbits(64):x}" for _ in range(100_000))) for i in range(12)]
    rows += [(100, "seen four times " * 4), (101, "known five times " * 5)]
    labels = spark.createDataFrame([(100, 1), (101, 1)], "doc_id long, quality int")
    p = Bigrams()
    got = {r.doc_id: r for r in cross_entropy_difference(frame(spark, rows), labels, p).collect()}
    for i, (n, t, b) in brute(rows, {100, 101}, p).items():
        assert (got[i].n_tokens, got[i].target_loss, got[i].background_loss) == (n, pytest.approx(t, rel=1e-6), pytest.approx(b, rel=1e-6))


@pytest.mark.parametrize(("hot", "numbers"), [(0, 0), (3, 40), (40, 3), (40, 0), (0, 1000)])
def test_scores_do_not_depend_on_what_is_broadcast(spark, hot, numbers):
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(60)))) for i in range(60)]
    rows += [(None, rows[3][1]), (3, rows[3][1]), (70, None)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 60, 3)], "doc_id long, quality int")
    p = Bigrams(least=2, hot=hot, numbers=numbers)
    want = brute(rows, set(range(0, 60, 3)), p)
    got = cross_entropy_difference(frame(spark, rows), labels, p).collect()
    assert len(got) == len(rows)
    for r in got:
        n, t, b = want[r.doc_id]
        assert (r.n_tokens, r.target_loss, r.background_loss) == (n, pytest.approx(t, rel=1e-9), pytest.approx(b, rel=1e-9))


def test_where_all_words_have_numbers_pairs_are_sorted_by_one(spark, capsys):
    """Sorting by two columns and carrying counts that no row had took more than a third of the time."""
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = [(i, "a b c a b " * 5) for i in range(3)]
    for numbers, wanted in ((1 << 20, ["pair"]), (1, ["pair", "other"])):
        cross_entropy_difference(frame(spark, rows), labels, Bigrams(numbers=numbers, hot=0)).explain()
        specs = re.findall(r"windowspecdefinition\(([a-z]+)#\d+L?(?:, ([a-z]+)#\d+L?)?, specified", capsys.readouterr().out)
        assert specs and {tuple(filter(None, x)) for x in specs} == {tuple(wanted)}
