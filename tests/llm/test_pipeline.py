"""The pipeline over cases planted in a small table."""

import random

import corpus_pipeline
from docharbor.llm.decontamination import words as benchmark_words
from docharbor.llm.queries import ORACLE_SQL, QUERIES


def text(rng, n):
    return " ".join(rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randrange(500)) for _ in range(n))


def planted(rng):
    clean = {i: "\n".join(text(rng, 30) for _ in range(3)) for i in range(400)}
    toxic = {1000 + i: " ".join(["nasty awful", text(rng, 40), "vile nasty"]) for i in range(150)}
    bench = [(i, text(rng, 30)) for i in range(5)]
    copies = {2000 + i: clean[i] for i in range(20)}
    near = {}
    for i in range(20, 40):
        w = clean[i].replace("\n", " ").split(" ")
        w[50] = "changed"
        near[3000 + i] = " ".join(w)
    dirty = {4000 + i: f"{text(rng, 60)} {bench[i][1]} {text(rng, 60)}" for i in range(5)}
    touched = {5000 + i: f"{text(rng, 400)} {' '.join(bench[i][1].split()[:13])} {text(rng, 200)}" for i in range(5)}
    return clean, toxic, bench, copies, near, dirty, touched


def test_stages_take_out_what_they_are_for(spark, tmp_path):
    clean, toxic, bench, copies, near, dirty, touched = planted(random.Random(1))
    docs = {**clean, **toxic, **copies, **near, **dirty, **touched, 9000: "", 9001: None}
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    known = [(i, 0, int(i in toxic)) for i in docs if i < 2000]
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == now.columns
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r for r in now.collect()}
    assert not set(kept["toxicity"]) & set(toxic)
    assert not set(kept["line_dedup"]) & set(copies)
    assert not set(kept["near_duplicates"]) & set(near)
    assert not set(kept["decontamination"]) & set(dirty)
    end = set(kept["tokens"])
    assert end >= set(clean) | set(touched) | {9000, 9001}
    assert all(kept["decontamination"][i].text == docs[i] for i in [*clean, *touched])
    assert all(len(r.text or "") == (r.n_chars or 0) for r in kept["decontamination"].values())
    assert all(kept["tokens"][i].n_tokens >= len(benchmark_words(docs[i].encode())) for i in clean)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(end)


def test_registered_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and 4 <= len(corpus_pipeline.STAGES) <= 5
