"""Benchmark decontamination by a broadcast hash set of the benchmark's n-grams."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docharbor.llm.common import covered, hashed, inside, owner, per_slice, pick, runs_of, slices, texts, unpack, whole

#: ASCII other than letters and digits parts words; A-Z become a-z; bytes beyond ASCII stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
)
#: Windows broadcast at once, about 100 bytes each.
MAX_WINDOWS = 200_000
_BITS = 20
_WORD = re.compile(rb"[^ ]+")


def words(text: bytes) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, in lower case."""
    return text.translate(WORD_BYTES).split()


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``(item_id, n, grams)``: every window of an item; a shorter item is one window itself."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ns, grams = [], [], []
        for item, text in zip(batch.column("item_id").to_pylist(), texts(batch, "text"), strict=True):
            w = words(text)
            n = min(size, len(w))
            found = {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if n else ()
            ids += [item] * len(found)
            ns += [n] * len(found)
            grams += found
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(ns, pa.int32()), pa.array(grams, pa.binary())],
            ["item_id", "n", "gram"],
        )

    source = pick(benchmark, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("binary").alias("text"),
    )
    return source.mapInArrow(per_slice("text", make), "item_id string, n int, gram binary").distinct()


class _Windows:
    """Windows by length: a bit table, sorted hashes, and the words behind each hash."""

    def __init__(self, rows: list) -> None:
        items: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for r in rows:
            items[r["n"]][bytes(r["gram"])].append(r["item_id"])
        self.by_length = {}
        for n, grams in items.items():
            flat, _ = hashed([g.split(b" ") for g in grams])
            keys = runs_of(flat, n)[::n]
            bits = np.zeros(1 << _BITS, bool)
            bits[keys >> np.uint64(64 - _BITS)] = True
            self.by_length[n] = bits, np.unique(keys), dict(grams)

    def hits(self, docs: list[list[bytes]]):
        """``(hit, ends, items)``: the words in a verified window, and each text's items."""
        flat, ends = hashed(docs)
        hit, items = np.zeros(len(flat), bool), [set() for _ in docs]
        of = owner(ends)
        for n, (bits, keys, grams) in self.by_length.items():
            h = runs_of(flat, n)
            at = np.flatnonzero(bits[h >> np.uint64(64 - _BITS)] & inside(ends, n))
            at = at[np.isin(h[at], keys)]
            real = []
            for i in at.tolist():
                d = of[i]
                a = i - ends[d]
                if found := grams.get(b" ".join(docs[d][a : a + n])):
                    real.append(i)
                    items[d].update(found)
            if real:
                hit |= covered(np.array(real), n, len(flat))
        return hit, ends, items


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, size: int = 13, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """All columns of ``docs`` in ``_doc`` beside ``n_words, hit_at, items``.

    ``hit_at`` holds the numbers of the words inside an occurrence of a benchmark window, ``items``
    the ids of items with such windows, as sorted strings. The windows are counted first: up to
    ``max_windows`` are broadcast, more are broadcast part after part, with a checkpoint between.
    Null and empty texts have no words and no hits; an item without words has no window; an item
    without an id counts as the item named by the empty string; equal items or rows change nothing.
    """
    windows = benchmark_windows(benchmark, size).persist()
    parts = max(1, -(-windows.count() // max_windows))
    found = whole(docs, "_doc", "text").select(
        "_doc",
        F.col("text").cast("binary").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<int>").alias("hit_at"),
        F.array().cast("array<string>").alias("items"),
    )
    for part in range(parts):
        rows = windows.where(F.expr(f"pmod(xxhash64(gram), {parts}) = {part}")).collect()
        shared = docs.sparkSession.sparkContext.broadcast(rows)
        found = found.mapInArrow(_scan(shared), found.schema)
        if part < parts - 1:
            found = found.checkpoint()
    windows.unpersist()
    return found.drop("text")


def _scan(shared):
    def run(batches):
        index = _Windows(shared.value)
        for batch in slices(batches, "text"):
            docs = [words(t) for t in texts(batch, "text")]
            hit, ends, items = index.hits(docs)
            at, of = np.flatnonzero(hit), owner(ends)
            hits = np.split(at - ends[of[at]], np.searchsorted(of[at], np.arange(1, len(docs))))
            seen, known = batch.column("hit_at").to_pylist(), batch.column("items").to_pylist()
            out = batch
            for name, kind, values in (
                ("n_words", pa.int64(), [len(d) for d in docs]),
                ("hit_at", pa.list_(pa.int32()), [np.union1d(h, s).astype(np.int32) if s else h.astype(np.int32) for h, s in zip(hits, seen, strict=True)]),
                ("items", pa.list_(pa.string()), [sorted(i.union(k)) for i, k in zip(items, known, strict=True)]),
            ):
                place = out.schema.get_field_index(name)
                out = out.set_column(place, name, pa.array(values, kind))
            yield out

    return run


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth or more of the words lie in benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents, unchanged, that :func:`is_contaminated` does not reject."""
    found = find_contamination(docs, benchmark, **params)
    clean = ~is_contaminated(F.size("hit_at").cast("bigint"), F.col("n_words"))
    return unpack(found.where(clean), "_doc", docs)


def mask_spans(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents without the stretches of hit words; all other characters stay as they are."""
    found = find_contamination(docs, benchmark, **params)
    place = docs.columns.index("text")
    found = found.withColumn("text", F.col(f"_doc._{place}").cast("binary"))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for text, hits in zip(texts(batch, "text"), batch.column("hit_at").to_pylist(), strict=True):
            spans = [m.span() for m in _WORD.finditer(text.translate(WORD_BYTES))] if hits else []
            out, done = [], 0
            for i in hits:
                a, b = spans[i]
                if not (i and done == spans[i - 1][1]):
                    out.append(text[done:a])
                done = b
            kept.append(b"".join(out) + text[done:])
        at = batch.schema.get_field_index("text")
        return batch.set_column(at, "text", pa.array(kept, pa.binary()))

    found = found.mapInArrow(per_slice("text", make), found.schema)
    text = F.col(f"_doc._{place}")
    return unpack(found, "_doc", docs, text=F.when(text.isNotNull(), F.col("text").cast("string")))


def contamination_report(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document."""
    found = find_contamination(pick(docs, "doc_id", "text"), benchmark, **params)
    n_hit = F.size("hit_at").cast("bigint")
    return found.select(
        F.col("_doc._0").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )
