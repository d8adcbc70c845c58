"""The Jaccard join against comparing all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from docharbor.llm.jaccard import Join, _described, _in_table, _keyed, _levels, _parts, _table_bits, component_report, drop_near_duplicates, shingle_sets

SCHEMA = "doc_id long, text string, TEXT string, uid int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, p):
    sets = [shingles(t, p.words) for _, t in rows]
    label = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= p.percent * len(x | y) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if k == a else k for k in label]
    ids = {}
    for k, (i, _) in zip(label, rows, strict=True):
        if i is not None:
            ids[k] = min(i, ids.get(k, i))
    return sorted(((i, len(s), ids.get(k)) for (i, _), s, k in zip(rows, sets, label, strict=True)), key=str)


def made(rng, copies):
    """Groups of near copies, texts with a common passage, and texts of their own."""
    word = lambda: rng.choice("abcdefghij") + rng.choice("xyz") + str(rng.randrange(40))
    rows, passage = [], [word() for _ in range(30)]
    for _ in range(6):
        base = [word() for _ in range(rng.choice((5, 40, 120)))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w).replace("a", rng.choice("aA")))
    rows += [" ".join(passage + [word() for _ in range(rng.randrange(30, 60))]) for _ in range(40)]
    rows += ["", " \t", None, "one", "ONE", "one two", "one  two\n", "one two three"]
    rng.shuffle(rows)
    out = [(i if i % 13 else None, t) for i, t in enumerate(rows)]
    return out + out[:5]


def test_same_components_as_all_pairs(spark):
    rows = made(random.Random(3), 12)
    for p in (Join(3, 90), Join(5, 80), Join(3, 90, common=3)):
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in component_report(frame(spark, rows), p).collect()), key=str)
        assert got == brute(rows, p)


def test_a_large_group_around_a_text_that_is_not_there(spark):
    """Copies with changes near the threshold, some of them copies of copies; long texts, and a few far ones."""
    rng = random.Random(8)
    word = lambda: f"{rng.choice('abcd')}{rng.randrange(10**6)}"
    rows = []
    for size in (90, 60):
        base = [word() for _ in range(size)]
        variant = [word() if rng.random() < 0.1 else w for w in base]
        for _ in range(110):
            w = list(rng.choice((base, base, variant)))
            for _ in range(rng.randrange(size // 22 + 1)):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(6)] = []
            rows.append(" ".join(w + [word() for _ in range(rng.choice((0, 0, 1, 90)))]))
    rows += [" ".join(base * 300 + ["end"]), " ".join(base * 300), " ".join(word() for _ in range(30_000))]
    rows = list(enumerate(rows))
    for p in (Join(3, 90, common=5), Join(5, 80, common=5), Join(3, 90)):
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in component_report(frame(spark, rows), p).collect()), key=str)
        wanted = brute(rows, p)
        assert got == wanted
        assert 20 < len({c for *_, c in wanted}) < 200


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(4, text), (2, text), (3, text.replace("w59", "other")), (3, text.replace("w59", "other")), (5, "on its own"), (6, None), (7, ""), (5, "on its own"), (7, "")]
    out = drop_near_duplicates(frame(spark, rows))
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted(((r[0], r[1]) for r in out.collect()), key=str) == sorted([(2, text), (5, "on its own"), (6, None), (7, ""), (7, "")], key=str)


def test_no_rows(spark):
    assert component_report(frame(spark, []), Join()).count() == 0
    assert drop_near_duplicates(frame(spark, [])).count() == 0


def test_the_table_of_frequencies_grows_with_the_texts(spark):
    """With as many places for any input, chance hid more and more frequent tokens as the texts grew."""
    texts = spark.range(64).select(F.repeat(F.lit("a "), 1 << 19).cast("binary").alias("text"))
    assert _table_bits(texts) == _table_bits(texts.where("id < 8")) + 3 == 20
    rows = [(f"a passage in all of these texts {i} and {i + 1}",) for i in range(0, 400, 2)]
    docs = _keyed(spark.createDataFrame(rows, "text string").withColumn("doc_id", F.lit(1)))
    bits = _table_bits(docs)
    level_of = _levels(_described(docs, Join(3, 90), bits), bits)
    of = lambda t: level_of[_in_table(shingle_sets([t.split()], 3)[0], level_of)]
    assert len(level_of) == 1 << 16 and level_of.dtype == np.uint8
    assert (of(b"a passage in all") >= 5).all() and (of(b"these texts 8") == 0).all()
    assert not _levels(_described(docs.limit(0), Join(), bits), bits).any()


def test_members_of_a_group_meet_at_what_sets_of_their_size_may_share(spark):
    """Small sets near a base once made large ones, that can't link to them, meet at more of their differences."""
    p = Join(5, 80)
    sets = [(i, 400, 300) for i in range(50)] + [(100 + i, 40, 30) for i in range(5)]
    rows = [(1, uid, n, uid, list(range(delta)), 0, 0, 0, 0, delta, p.spare(n, delta)) for uid, n, delta in sets]
    schema = "base long, uid long, n long, group long, apart array<long>, w0 long, w1 long, w2 long, w3 long, delta long, spare long"
    counts = {r["uid"]: r["count"] for r in _parts(spark.createDataFrame(rows, schema), p).groupBy("uid").count().collect()}
    assert len(counts) == 55  # 256 of 300 differences must be shared by two large ones, 26 of 30 by two small ones
    assert {counts[i] for i in range(50)} == {300 - 256 + 1} and {counts[100 + i] for i in range(5)} == {30 - 26 + 1}


def test_texts_are_read_once_for_sizes_names_and_frequencies(spark):
    """They were read a second and a third time for the sizes and names alone."""
    read = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(i, f"a text of its own {i}") for i in range(50)] + [(50, None)], "doc_id long, text string")
    found = component_report(docs.mapInArrow(look, docs.schema), Join(3, 90))
    assert sorted(map(tuple, found.collect())) == [(i, 4, i) for i in range(50)] + [(50, 0, 50)]
    assert read.value == 4 * 51  # how long the texts are, what is in them, prefixes, and sets to verify
