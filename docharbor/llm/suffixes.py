"""Suffix-array dedup over sparse suffixes: those that begin at minimiser positions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.llm.common import runs_of, stored
from docharbor.llm.repeats import repeats

#: Words of a window that counts as a passage, and of the stretches whose smallest hash marks a suffix.
PASSAGE = 50
GRAM = 8


def suffix_keys(size: int = PASSAGE, gram: int = GRAM):
    """The key of a window: how the suffix goes on that begins at the minimiser of its first half.

    The minimiser is the stretch of ``gram`` words with the smallest hash, the first of equals. From
    any place in the first half at least half a window is left, which the key covers.
    """
    half = size // 2
    choices, covers = half - gram + 1, size - (half - gram)

    def keys(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.uint64)
        n = len(words) - size + 1
        if n <= 0:
            return out
        start = runs_of(words, gram)
        # The place stands in the low bits, so that the first of equal hashes is the smallest.
        value = (start >> np.uint64(32) << np.uint64(32)) | np.arange(len(start), dtype=np.uint64)
        least, step = value, 1
        while 2 * step <= choices:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        rest = choices - step
        least = np.minimum(least[: len(least) - rest], least[rest:])
        at = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out[:n] = runs_of(words, covers)[at]
        return out

    return keys


def neighbours(keys: DataFrame) -> DataFrame:
    """``key, k`` of the suffixes that agree with a neighbour in the sorted sparse suffix array.

    The suffixes are sorted by their key and text over all tasks, so a very frequent one spreads over
    several of them; each task compares neighbours, and its first and last rows, which may go on
    elsewhere, are compared afterwards.
    """
    keys = stored(keys, "suffixes")

    def compare(batches):
        held = None  # the last row so far: key, k, whether it agreed, whether it is the first
        for batch in batches:
            if not batch.num_rows:
                continue
            key, k = batch.column("key").to_numpy(), batch.column("k").to_numpy()
            if held is not None:
                key, k = np.r_[held[0], key], np.r_[held[1], k]
            same = key[1:] == key[:-1]
            agreed = np.r_[held is not None and held[2], same] | np.r_[same, False]
            first = np.zeros(len(key), bool)
            first[0] = held is None or held[3]
            yield _compared(key[:-1], k[:-1], agreed[:-1], first[:-1])
            held = key[-1], k[-1], bool(agreed[-1]), bool(first[-1])
        if held is not None:
            yield _compared(*(np.array([v]) for v in (*held[:3], True)))

    schema = "key long, k long, agreed boolean, edge boolean"
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    array = keys.repartitionByRange(parts, "key", "k").sortWithinPartitions("key", "k")
    rows = stored(array.mapInArrow(compare, schema), "agreed")
    edges = rows.where("edge").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    late = rows.where("edge and not agreed").join(F.broadcast(edges), "key", "left_semi")  # two rows a task
    return rows.where("agreed").select("key", "k").union(late.select("key", "k"))


def _compared(key, k, agreed, edge) -> pa.RecordBatch:
    keep = agreed | edge
    return pa.RecordBatch.from_arrays(
        [pa.array(key[keep]), pa.array(k[keep]), pa.array(agreed[keep]), pa.array(edge[keep])],
        ["key", "k", "agreed", "edge"],
    )


def repeated_passages(docs: DataFrame, *, size: int = PASSAGE) -> DataFrame:
    """``doc_id, n_words, n_repeated, spans, kept_sha256``; see :func:`docharbor.llm.repeats.repeats`."""
    return repeats(docs, size, suffix_keys(size), neighbours)


def passage_report(docs: DataFrame, *, size: int = PASSAGE) -> DataFrame:
    """``doc_id, n_words, n_repeated, spans`` of the documents with a passage that stands elsewhere too."""
    return repeated_passages(docs, size=size).where("n_repeated > 0").drop("kept_sha256")
