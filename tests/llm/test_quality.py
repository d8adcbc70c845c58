"""Quality rules: measures against plain Python, votes weighed without labels, odd rows."""

import random
import re
from collections import Counter

from docharbor.llm.quality import RULES, START, drop_poor, estimate, quality_report

SCHEMA = "doc_id long, text string, TEXT string, votes int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(hit),
        len(words) < 20 or 100 * len(hit) > 30 * len(words),
    )


def prose(rng, n):
    out = []
    for i in range(n):
        w = "".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randrange(3, 9)))
        out.append(w.capitalize() + ("." if i % 9 == 8 else "") if i % 9 == 0 else w + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def made(rng):
    rows, poor = [], set()
    for i in range(400):
        kind = i % 10
        text = prose(rng, rng.randrange(60, 200))
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1:
            text = " | ".join(text.replace(".", "").split())
        elif kind == 2:
            text = " ".join(w + rng.choice(["$$$", "%%%", "&&&"]) for w in text.split())
        if kind < 3:
            poor.add(i)
        rows.append((i, text, "x", 1))
    return rows, poor


ODD = [
    None,
    "",
    " \t\n\x0b\f\r",
    "one two three four\x85five",
    "a b c d e f g h a b c d e f g h i j",
    "w " * 30,
    "x\ny\nx\n\n \nx\r\nx y\n" + " ".join(map(str, range(40))),
    "ÄÖ ß 漢字 😀 $5 <b> " * 5,
    "a b c d e f g " * 3 + " ".join(f"v{i}" for i in range(60)),
]


def test_measures_of_odd_texts(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "a b", "x", 1), (4, ODD[4], "x", 1)]
    found = quality_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r[0], *r[1:7][:5], r.base_failed) for r in found) == Counter((i, *plain(t)) for i, t, *_ in rows)
    assert all(not r.kept for r in found if r.base_failed)


def test_a_long_text_with_a_passage_twice(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**9)}" for _ in range(200_000)]
    words[150_000:150_040] = words[70:110]
    text = " ".join(words)
    (row,) = quality_report(spark.createDataFrame([(1, text, "x", 1)], SCHEMA)).collect()
    assert (row.n_words, row.n_repeat_words) == (200_000, 80)


def test_votes_tell_poor_texts_without_labels(spark):
    rows, poor = made(random.Random(3))
    docs = spark.createDataFrame(rows + [(1000, None, "x", 1)], SCHEMA)
    report = {r.doc_id: r for r in quality_report(docs).collect()}
    assert {i for i, r in report.items() if not r.kept} == poor | {1000}
    assert any(not report[i].base_failed for i in poor)
    kept = drop_poor(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(report) - poor - {1000}


def _plainly_estimated(counts, rounds):
    share, good, bad = START.share, list(START.on_good), list(START.on_bad)
    for _ in range(rounds):
        sums = [[0.0, 0.0, 0.0, 0.0] for _ in good]
        all_good = total = 0.0
        for votes, n in counts.items():
            odds = share / (1 - share)
            for j, v in enumerate(votes):
                odds *= {"g": good[j] / (1 - bad[j]), "b": (1 - good[j]) / bad[j], "-": 1}[v]
            p = odds / (1 + odds)
            all_good, total = all_good + n * p, total + n
            for j, v in enumerate(votes):
                if v != "-":
                    sums[j][0 if v == "g" else 1] += n * p
                    sums[j][2 if v == "b" else 3] += n * (1 - p)
        share = (all_good + 10 * START.share) / (total + 10)
        good = [(s[0] + 10 * a) / (s[0] + s[1] + 10) for s, a in zip(sums, START.on_good)]
        bad = [(s[2] + 10 * b) / (s[2] + s[3] + 10) for s, b in zip(sums, START.on_bad)]
    return share, good, bad


def test_estimates_are_those_of_plain_rounds(spark):
    rng = random.Random(4)
    votes = ["".join(rng.choice("ggg-b") for _ in RULES) for _ in range(300)]
    found = estimate(spark.createDataFrame([(v,) for v in votes], "votes string"), rounds=7)
    share, good, bad = _plainly_estimated(Counter(votes), 7)
    assert abs(found.share - share) < 1e-9
    assert all(abs(x - y) < 1e-9 for x, y in zip(found.on_good + found.on_bad, good + bad))


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert quality_report(docs).collect() == []
    assert estimate(spark.createDataFrame([], "votes string"), rounds=2).share == START.share
