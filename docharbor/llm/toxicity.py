"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docharbor.llm.common import (
    apart, bound_batches, hashed, inside, mixed, owner, per_slice, pick, slices, texts, together,
)
from docharbor.llm.decontamination import words

#: Features of a text: its words, neighbours, words two and three apart, and beginnings of words in bytes.
GAPS = (0, 1, 2, 3)
STARTS = (4, 5, 6, 7, 8, 9, 10, 12)


@dataclass(frozen=True)
class Ftrl:
    """``rows`` bounds the labelled texts that are learnt from; they are those of the smallest hashes."""

    rows: int = 12000
    epochs: int = 3
    bits: int = 20
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    threshold: float = 0.3


def features(docs: list[list[bytes]], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text, feature)`` of every n-gram, skip-gram and beginning of a word, with repetitions.

    Beginnings stand for the stems of words whose ends vary.
    """
    flat, ends = hashed(docs)
    of, out, at = owner(ends), [], []
    for gap in GAPS:
        if gap == 0:
            out.append(mixed(flat))
            at.append(of)
        elif len(flat) > gap:
            pair = flat[:-gap] * np.uint64(0x9E3779B97F4A7C15) + flat[gap:] + np.uint64(gap)
            ok = inside(ends, gap + 1)
            out.append(mixed(pair)[ok])
            at.append(of[: len(ok)][ok])
    first = np.array([w for d in docs for w in d] or [b""], "S16")[: len(flat)]
    halves = first.view("<u8").reshape(-1, 2)
    for size in STARTS:
        low = halves[:, 0] if size >= 8 else halves[:, 0] & np.uint64((1 << 8 * size) - 1)
        high = halves[:, 1] & np.uint64((1 << 8 * max(0, size - 8)) - 1)
        long = np.flatnonzero(np.char.str_len(first) >= size)
        out.append(mixed(mixed(low[long] + np.uint64(size)) + high[long]))
        at.append(of[long])
    return np.concatenate(at), (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn_from: Column, p: Ftrl) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``p.rows`` labelled documents, the same at every run.

    Labels other than 0 and 1 and null ids are left out; of several labels the largest counts, of
    several texts of one id the first in order.
    """
    known = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)")
    known = known.where(learn_from).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = pick(docs, "doc_id", "text")
    ids = own.select("doc_id").join(known, "doc_id", "left_semi").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.rows)
    chosen = known.join(ids, "doc_id")  # p.rows rows at most: broadcast
    return own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def fit(sample: DataFrame, p: Ftrl) -> DataFrame:
    """``feature, weight`` of the non-zero weights; feature -1 is the bias.

    FTRL is an online learner: one task streams over ``p.rows * p.epochs`` texts at most and holds
    two vectors of ``2 ** p.bits`` numbers.
    """

    def learn(batches):
        z, n = np.zeros((1 << p.bits) + 1), np.zeros((1 << p.bits) + 1)
        bias = 1 << p.bits

        def weights(z, n):
            small = np.abs(z) <= p.l1
            w = -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)
            return np.where(small, 0.0, w)

        for batch in slices(batches, "text"):
            of, feature = features([words(t) for t in texts(batch, "text")], p.bits)
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(1, batch.num_rows))
            for own, y in zip(np.split(feature[order], cuts), batch.column("toxic").to_pylist(), strict=True):
                f = np.append(np.unique(own), bias)
                w = weights(z[f], n[f])
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
                step = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / p.alpha
                z[f] += g - step * w
                n[f] += g * g
        w = weights(z, n)
        w[bias] = -z[bias] / ((p.beta + np.sqrt(n[bias])) / p.alpha + p.l2)  # no L1 on the bias
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(at == bias, -1, at)), pa.array(w[at])], ["feature", "weight"]
        )

    epochs = F.explode(F.sequence(F.lit(1), F.lit(p.epochs))).alias("epoch")
    stream = sample.select(F.col("text").cast("binary").alias("text"), "toxic", "doc_id", epochs)
    stream = stream.repartition(1).sortWithinPartitions("epoch", F.xxhash64("doc_id", "epoch"), "doc_id")
    return stream.select("text", "toxic").mapInArrow(learn, "feature long, weight double")


def score(docs: DataFrame, weights: DataFrame, p: Ftrl) -> DataFrame:
    """``_doc, text, score`` of every whole text, empty and null ones too; ``_doc`` has the other columns.

    The weights are ``2 ** p.bits`` at most, so they are broadcast.
    """
    rows = weights.collect()
    dense = np.zeros(1 << p.bits)
    bias = sum(r["weight"] for r in rows if r["feature"] < 0)
    for r in rows:
        if r["feature"] >= 0:
            dense[r["feature"]] = r["weight"]
    at = np.flatnonzero(dense)
    shared = docs.sparkSession.sparkContext.broadcast((at, dense[at], bias))

    def run(batches):
        at, w, bias = shared.value
        dense = np.zeros(1 << p.bits)
        dense[at] = w

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            of, feature = features([words(t) for t in texts(batch, "text")], p.bits)
            used = np.flatnonzero(dense[feature])
            own = np.unique(of[used] << p.bits | feature[used])  # each feature of a text counts once
            total = np.bincount(own >> p.bits, dense[own & ((1 << p.bits) - 1)], batch.num_rows)
            total = np.clip(total + bias, -35, 35)
            return batch.append_column("score", pa.array(1 / (1 + np.exp(-total))))

        yield from per_slice("text", make)(batches)

    bound_batches(docs.sparkSession)
    source = apart(docs, "_doc", "text").withColumn("text", F.col("text").cast("binary"))
    return source.mapInArrow(run, StructType([*source.schema]).add("score", "double"))


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the ids, by checksum; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, p: Ftrl) -> DataFrame:
    """Learns from the labels outside the held-out fold, then scores every document.

    Without labelled documents every score is one half. Repeated rows get equal scores.
    """
    sample = labelled_sample(docs, labels, ~held_out(), p)
    return score(docs, fit(sample, p), p)


def toxicity_report(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    out = scored(pick(docs, "doc_id", "text"), labels, p).select(F.col("_doc._0").alias("doc_id"), "score")
    predicted = F.when(F.col("score") >= p.threshold, 1).otherwise(0)
    return out.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """The documents, unchanged, that score below the threshold."""
    kept = scored(docs, labels, p).where(F.col("score") < p.threshold)
    return together(kept, "_doc", docs, text=F.col("text").cast("string"))
