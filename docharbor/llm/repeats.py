"""Repeated windows of words: what suffix-array and substring dedup share.

A method gives every window of ``size`` words a key that its words alone decide, so that equal windows
have equal keys. Keys that two texts share are found first; windows with such a key are then compared by
a hash of all their words. Equal texts are taken once, with their number.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.llm.common import covered, hashed, inside, owner, per_slice, pick, runs_of, stored, texts

#: ``(word hashes, ends) -> key`` of the window that begins at each word.
Keys = Callable[[np.ndarray, np.ndarray], np.ndarray]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``k, text`` of every distinct text, in a table bucketed by ``k``, the text's hash.

    Texts that share a hash have a row each. Later joins on ``k`` move the other side only.
    """
    spark = docs.sparkSession
    own = pick(docs, "text").select(F.coalesce("text", F.lit("")).alias("text"))
    sets = own.groupBy(F.xxhash64("text").alias("k")).agg(F.collect_set("text").alias("texts"))
    name = f"distinct_texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets.select("k", F.explode("texts").alias("text")).write.bucketBy(buckets, "k").saveAsTable(name)
    return spark.table(name).select("k", F.col("text").cast("binary").alias("text"))


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    words = [t.split() for t in texts(batch, "text")]
    return *hashed(words), words


def _distinct_of(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def _rows(batch: pa.RecordBatch, text: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    text, value = _distinct_of(text, value)
    return pa.RecordBatch.from_arrays(
        [pa.array(value.view(np.int64)), batch.column("k").take(pa.array(text))], ["key", "k"]
    )


def window_keys(distinct: DataFrame, size: int, keys: Keys) -> DataFrame:
    """``key, k``: the different keys of each text's windows."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, ends, _ = _hashes(batch)
        ok = np.flatnonzero(inside(ends, size))
        value, text = keys(h, ends)[ok], owner(ends)[ok]
        turn = np.ones(len(ok), bool)
        turn[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
        return _rows(batch, text[turn], value[turn])

    return distinct.mapInArrow(per_slice("text", make), "key long, k long")


def shared(keys: DataFrame) -> DataFrame:
    """The rows whose key two texts have, counted by partial aggregates: a frequent key is one row a task."""
    both = keys.groupBy("key").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a <> b").select("key")
    return keys.join(both, "key", "left_semi")


def shared_keys(keys: DataFrame) -> DataFrame:
    return shared(stored(keys, "keys"))


def _lists(rows: DataFrame) -> DataFrame:
    """All keys of one text; no longer than the text."""
    return rows.groupBy(F.col("k").alias("of")).agg(F.collect_list("key").alias("keys"))


def _in(values: np.ndarray, text: np.ndarray, lists: list) -> np.ndarray:
    """Which values stand in the list of their text."""
    out = np.zeros(len(values), bool)
    cuts = np.searchsorted(text, np.arange(len(lists) + 1))
    for i, own in enumerate(lists):
        if own:
            a, b = cuts[i], cuts[i + 1]
            out[a:b] = np.isin(values[a:b].view(np.int64), np.array(own, np.int64))
    return out


def _candidate_windows(met: DataFrame, size: int, keys: Keys) -> DataFrame:
    """``key, k``: hashes of all words of the windows whose key another text has too."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, ends, _ = _hashes(batch)
        ok, of = np.flatnonzero(inside(ends, size)), owner(ends)
        ok = ok[_in(keys(h, ends)[ok], of[ok], batch.column("keys").to_pylist())]
        return _rows(batch, of[ok], runs_of(h, size)[ok])

    return met.select("k", "text", "keys").mapInArrow(per_slice("text", make), "key long, k long")


def _repeated(batch: pa.RecordBatch, size: int):
    """``(repeated words, ends, words)`` by the hashes from other texts and windows twice in one text."""
    h, ends, words = _hashes(batch)
    ok, of = np.flatnonzero(inside(ends, size)), owner(ends)
    window = runs_of(h, size)[ok] if len(ok) else np.zeros(0, np.uint64)
    again = _in(window, of[ok], batch.column("keys").to_pylist())
    order = np.lexsort((window, of[ok]))
    w, t = window[order], of[ok][order]
    same = (w[1:] == w[:-1]) & (t[1:] == t[:-1])
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return covered(ok[again], size, len(h)), ends, words


def repeats(docs: DataFrame, size: int, keys: Keys, find: Callable[[DataFrame], DataFrame] = shared_keys) -> DataFrame:
    """``doc_id, n_words, n_repeated, spans, kept_sha256`` of every document.

    Words are runs of characters other than ASCII white space. A word is repeated if it lies in a window
    of ``size`` words that also begins anywhere else, in the same text too; ``spans`` has the stretches
    of repeated words as ``start, end``. Every row counts as a document, also rows equal to another. A
    null text has no words; a text of fewer than ``size`` words has no window.
    """
    distinct = distinct_texts(docs)
    found = find(window_keys(distinct, size, keys))
    met = distinct.join(_lists(found), F.col("k") == F.col("of"))
    again = _lists(shared(_candidate_windows(met, size, keys)))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit, ends, words = _repeated(batch, size)
        out = {n: [] for n in ("k2", "n_words", "n_repeated", "spans", "kept_sha256", "all_sha256")}
        for i, (w, t) in enumerate(zip(words, batch.column("text").to_pylist(), strict=True)):
            own = hit[ends[i] : ends[i + 1]]
            edge = np.flatnonzero(np.diff(np.r_[0, own.view(np.int8), 0]))
            whole = hashlib.sha256(b" ".join(w)).hexdigest()
            some = own.any()
            out["k2"].append(hashlib.md5(t).hexdigest())
            out["n_words"].append(len(w))
            out["n_repeated"].append(int(own.sum()))
            out["spans"].append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
            out["kept_sha256"].append(hashlib.sha256(b" ".join([w[j] for j in np.flatnonzero(~own)])).hexdigest() if some else whole)
            out["all_sha256"].append(whole)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string(), pa.string())
        arrays = [pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("k"), *arrays], ["k", *out])

    schema = "k long, k2 string, n_words long, n_repeated long, spans array<struct<start:int,end:int>>, kept_sha256 string, all_sha256 string"
    judged = distinct.join(again, F.col("k") == F.col("of"), "left").select("k", "text", "keys")
    judged = judged.mapInArrow(per_slice("text", make), schema)

    own = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.select("doc_id", F.xxhash64("text").alias("k"), F.md5(F.col("text").cast("binary")).alias("k2"))
    times = own.groupBy("k", "k2").agg(F.count("*").alias("times"))
    judged = judged.join(times, ["k", "k2"])
    full = (F.col("times") > 1) & (F.col("n_words") >= size)  # a text that stands twice is repeated as a whole
    span = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    judged = judged.select(
        "k",
        "k2",
        "n_words",
        F.when(full, F.col("n_words")).otherwise(F.col("n_repeated")).alias("n_repeated"),
        F.when(full, span).otherwise(F.col("spans")).alias("spans"),
        F.when(full, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
    return own.join(judged, ["k", "k2"]).drop("k", "k2")
