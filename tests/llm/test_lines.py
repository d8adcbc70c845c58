"""Line dedup against a search through all earlier lines."""

import random

import corpus_pipeline
from pyspark.sql import Row

from docharbor.llm.lines import drop_lines, duplicate_lines, line_report

SCHEMA = "doc_id long, text string, TEXT string, line int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3) for i, t in rows], SCHEMA)


def near(a, b):
    """At most one inserted, deleted or changed character."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute(rows, order, size=10):
    lines = [(order[(i, t)], i, n, x.strip()) for i, t in dict.fromkeys(rows) for n, x in enumerate((t or "").split("\n"))]
    lines = sorted((o, n, i, x) for o, i, n, x in lines if len(x) >= size)
    out = set()
    for k, (_, n, i, x) in enumerate(lines):
        if any(near(x, y[3]) for y in lines[:k]):
            out.add((i, n, not any(x == y[3] for y in lines[:k])))
    return out


def made(rng):
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(8, 16))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 4)):
            x = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(x))
                x[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "ß"])
            lines.append("".join(x))
        rows.append((i if i % 17 else None, "\n".join(lines)))
    return rows + rows[:3] + [(5, None), (None, None), (100, "")]


def test_same_lines_as_a_search_through_all(spark):
    rows = made(random.Random(4))
    df = frame(spark, rows)
    places = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) th").distinct().collect()
    order = {(r.doc_id, r.text): (r.doc_id is None, r.doc_id or 0, r.th) for r in places}
    got = {(r.doc_id, r.line, r.near) for r in duplicate_lines(df).distinct().collect()}
    assert got == brute(rows, order)


def test_equal_and_near_lines_go_from_later_documents(spark):
    a, b = "the first line of a text", "another line that is long enough"
    rows = [(1, f"{a}\n{b}"), (2, f"{a}!\nonly here, nowhere else"), (3, f"  {b} \nshort"), (4, f"{a}\nshort\nof its own, this one"), (5, a)]
    kept = {r.doc_id: r.text for r in drop_lines(frame(spark, rows)).collect()}
    assert kept == {1: rows[0][1], 2: "only here, nowhere else", 4: "short\nof its own, this one"}
    report = {r.doc_id: r for r in line_report(frame(spark, rows)).collect()}
    assert (report[2].n_equal, report[2].n_near, report[2].sources) == (0, 1, [1])
    assert (report[4].n_equal, report[4].n_lines) == (1, 3)


def test_empty_null_and_repeated_rows_stay(spark):
    rows = [(1, ""), (2, None), (3, "a line that is repeated"), (3, "a line that is repeated"), (None, "some other line here")]
    out = drop_lines(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "TEXT", "line"]
    assert sorted(out.collect(), key=str) == sorted((Row(doc_id=i, text=t, TEXT="x", line=3) for i, t in rows), key=str)
    assert drop_lines(frame(spark, [])).count() == 0


def test_a_very_long_line(spark):
    long = "abcdefgh" * 20_000
    rows = [(1, long), (2, long + "z"), (3, long[:70_000] + "-" + long[70_000:]), (4, long[1:] + "no")]
    assert {r.doc_id for r in duplicate_lines(frame(spark, rows)).collect()} == {2, 3}


def test_short_lines_stay_when_the_last_long_one_goes(spark):
    a = "the first line of a text"
    rows = [(1, a), (2, f"{a}\nshort\n\nverse"), (3, f" {a}\n  \n"), (4, a)]
    kept = {r.doc_id: r.text for r in drop_lines(frame(spark, rows), keep_short=True).collect()}
    assert kept == {1: a, 2: "short\n\nverse"}
    stage = corpus_pipeline.line_dedup(spark, frame(spark, rows), "")
    assert {r.doc_id: r.text for r in stage.collect()} == kept
