"""Decontamination against looking for every window in every text."""

import hashlib
import random
import re

from docharbor.llm.decontamination import contamination_report, drop_contaminated, mask_spans

SCHEMA = "doc_id long, text string, TEXT string, items int, n_words int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], "item_id long, text string, gram int")


def words(text):
    small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def brute(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in range(1, size + 1):
                if tuple(w[i : i + n]) in windows and i + n <= len(w):
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def made(rng):
    word = lambda: rng.choice(["Alpha", "beta", "c3", "ΔΕΛΤΑ", "naïve", "x"]) + rng.choice(["", "1", "É"])
    items = [(i, " ".join(word() for _ in range(rng.choice((2, 5, 12, 13, 14, 40))))) for i in range(30)]
    items += [(3, items[4][1]), (None, "nobody knows this item"), (99, None), (98, "..."), (97, "")]
    docs = []
    for i in range(80):
        parts = [word() for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            w = rng.choice(items[:30])[1].split()
            a = rng.randrange(len(w))
            parts[len(parts) // 2 : len(parts) // 2] = w[a : a + rng.randrange(1, 20)]
        docs.append((i, rng.choice([" ", "_", ", ", "\n"]).join(parts).replace("beta", rng.choice(["beta", "BETA"]))))
    return docs + [(200, None), (201, ""), (None, "NOBODY knows, this item!")] + docs[:4], items


def test_same_hits_as_looking_everywhere(spark):
    docs, items = made(random.Random(6))
    for limit in (200_000, 40):  # all windows at once, and in several parts
        got = contamination_report(frame(spark, docs), bench(spark, items), max_windows=limit).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_clean_documents_stay_unchanged(spark):
    docs, items = made(random.Random(7))
    out = drop_contaminated(frame(spark, docs), bench(spark, items))
    assert out.columns == ["doc_id", "text", "TEXT", "items", "n_words"]
    bad = {(r[0], r[1]) for r in brute(docs, items) if r[5]}
    assert sorted(((r[0], r[1]) for r in out.collect()), key=str) == sorted((d for d in docs if (d[0], len(words(d[1]))) not in bad), key=str)


def test_masked_texts_lose_the_hit_stretch_alone(spark):
    item = " ".join(f"q{i}" for i in range(15))
    rows = [(1, f"Before, it: {item}! After."), (2, "Stays; as it is."), (3, None), (4, "q0 q1 only")]
    out = mask_spans(frame(spark, rows), bench(spark, [(1, item)])).orderBy("doc_id").collect()
    assert [r[1] for r in out] == ["Before, it: ! After.", "Stays; as it is.", None, "q0 q1 only"]


def test_empty_tables(spark):
    docs, items = made(random.Random(8))
    assert contamination_report(frame(spark, []), bench(spark, items)).count() == 0
    assert {r.n_hit for r in contamination_report(frame(spark, docs), bench(spark, [])).collect()} == {0}
