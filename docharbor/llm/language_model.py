"""LM scoring by the difference of cross-entropies under a target and a background model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docharbor.llm.common import hashed, mixed, owner, pick, received, shipped, signed, slices, stored, texts
from docharbor.llm.decontamination import words

#: What stands before the first word of a text, and for every word outside the vocabulary.
BEGIN, UNKNOWN = 0, 1
#: Marks the hashes of words, so that no number of a frequent word is one.
_HASH = np.uint64(1 << 63)
#: Words or pairs that a task holds before it makes equal ones one.
_HELD = 1 << 19


@dataclass(frozen=True)
class Bigrams:
    """Every word and pair is counted by itself, in tables that grow with the documents.

    A word is in the vocabulary if it stands ``least`` times or more, else it is unknown. ``prior``
    weighs the word's own share in each pair's estimate, ``alpha`` an even share in that. At most ``numbers``
    words (24 bytes each) and ``hot`` pairs (32 bytes each), the most frequent, are broadcast, and so are up
    to ``hot`` ids of the target; the others are joined.
    """

    least: int = 5
    prior: float = 50.0
    alpha: float = 0.5
    hot: int = 1 << 18
    numbers: int = 1 << 20


def _words_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``(word, ends)`` of the texts in a row: 63-bit hashes, marked."""
    word, ends = hashed([words(t) for t in texts(batch, "text")])
    return word | _HASH, ends


def _one_each(tables: list[pa.Table], keys: list[str], sums: list[str]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(n, "sum") for n in sums])
    return out.select([*keys, *(f"{n}_sum" for n in sums)]).rename_columns([*keys, *sums])


def _wanted(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("wanted").to_pylist(), np.int64)


def word_counts(flagged: DataFrame) -> DataFrame:
    """``word, b, t``: how often each word stands in all texts and in the wanted ones.

    ``BEGIN`` has the number of texts with words, ``UNKNOWN`` that of all words.
    """

    def count(batches):
        held, size = [], 0
        for batch in slices(batches, "text"):
            word, ends = _words_of(batch)
            n = np.diff(ends)
            wanted, some = _wanted(batch), n > 0
            word = np.r_[word, np.uint64(BEGIN), np.uint64(UNKNOWN)]
            b = np.r_[np.ones(len(word) - 2, np.int64), some.sum(), n.sum()]
            t = np.r_[np.repeat(wanted, n), wanted[some].sum(), (n * wanted).sum()]
            held.append(pa.table([signed(word), pa.array(b), pa.array(t)], ["word", "b", "t"]))
            size += len(word)
            if size > _HELD:
                held = [_one_each(held, ["word"], ["b", "t"])]
                size = held[0].num_rows
                if size > _HELD // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if size:
            yield from _one_each(held, ["word"], ["b", "t"]).to_batches()

    rows = flagged.select("text", "wanted").mapInArrow(count, "word long, b long, t long")
    return rows.groupBy("word").agg(F.sum("b").alias("b"), F.sum("t").alias("t"))


def _frequent(rows: DataFrame, size: int) -> Column:
    """Which of ``rows`` are among at most ``size`` of the largest ``b``, in classes of a 32nd of a power of two."""
    kind = F.floor(32 * F.log2("b"))
    total, least = 0, None
    for c in rows.groupBy(kind.alias("class")).count().orderBy(F.desc("class")).collect():  # some 2,000 at most
        total += c["count"]
        if total > size:
            break
        least = c["class"]
    return F.lit(False) if least is None else kind >= least


class _Sorted:
    """Frequent words or pairs, found by their key."""

    def __init__(self, *columns: np.ndarray) -> None:
        key = self._key(columns)
        order = np.argsort(key)
        self.key, self.columns, self.rank = key[order], [c[order] for c in columns], order

    @staticmethod
    def _key(columns) -> np.ndarray:
        return columns[0] if len(columns) == 1 else mixed(mixed(columns[0]) + columns[1])

    def places(self, *columns: np.ndarray) -> np.ndarray:
        """The place of each among those given at first, -1 if it isn't here."""
        if not len(self.key):
            return np.full(len(columns[0]), -1)
        at = np.minimum(np.searchsorted(self.key, self._key(columns)), len(self.key) - 1)
        same = np.logical_and.reduce([own[at] == c for own, c in zip(self.columns, columns, strict=True)])
        return np.where(same, self.rank[at], -1)


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy().view(np.uint64)


class Model:
    """Both models but for the counts of pairs: what a task needs to know of words.

    ``b`` and ``t`` hold the counts of ``BEGIN``, ``UNKNOWN`` and the frequent words by their number. ``scale``
    brings the background's counts to the target's size, so that both models smooth alike; ``size`` is
    what the words' shares are of. ``more`` tells whether there are known words without a number.
    """

    def __init__(self, p: Bigrams, b: np.ndarray, t: np.ndarray, scale: float, size: float, more: bool) -> None:
        self.p, self.b, self.t, self.scale, self.size, self.more = p, b, t, scale, size, more

    def counts(self, code: np.ndarray, of: np.ndarray, rare: _Rare) -> tuple[np.ndarray, np.ndarray]:
        """How often each word stands, ``(b, t)``."""
        number = np.where(code < _HASH, code, UNKNOWN).astype(np.int64)
        b, t = self.b[number], self.t[number]
        at = np.flatnonzero(code >= _HASH)
        if len(at):
            own = rare.places(code[at], of[at])
            b[at], t[at] = rare.b[own], rare.t[own]
        return b, t

    def after(self, b: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of both losses, target and background, that the word before decides."""
        return np.log(t + self.p.prior), np.log(b * self.scale + self.p.prior)

    def of_pair(self, b, t, word_b, word_t, log) -> tuple:
        """The part that a pair's and its word's counts decide: arrays, or columns with their logarithm."""
        share = self.p.prior / self.size
        return (
            -log(t + (word_t + self.p.alpha) * share),
            -log(b * self.scale + (word_b * self.scale + self.p.alpha) * share),
        )


class _Rare:
    """Known words that have no number, with their counts, by the text of a batch that they stand in."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        lists = batch.column("rare")
        flat = lists.flatten()
        word, self.b, self.t = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("word", "b", "t"))
        text = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        self._found = _Sorted(word.view(np.uint64), text.astype(np.uint64))

    def places(self, code: np.ndarray, of: np.ndarray) -> np.ndarray:
        return self._found.places(code, of.astype(np.uint64))


_RARE = "array<struct<word: bigint, b: bigint, t: bigint>>"


def encoded(flagged: DataFrame, p: Bigrams) -> tuple[DataFrame, Model]:
    """``uid, doc_id, wanted, codes, rare`` of every document, and the model of its words.

    Codes are 8 bytes a word: the number of a frequent word, the hash of another known one, ``UNKNOWN``.
    ``rare`` has the counts of words without number.
    """
    counted = word_counts(flagged).where((F.col("b") >= p.least) | F.col("word").isin(BEGIN, UNKNOWN))
    counted = stored(counted, "words")
    known = counted.where(~F.col("word").isin(BEGIN, UNKNOWN))
    known = known.withColumn("hot", _frequent(known, p.numbers))
    first = {r.word: r for r in counted.where(F.col("word").isin(BEGIN, UNKNOWN)).collect()}
    begins, size = ({n: first[w][n] if w in first else 0 for n in "bt"} for w in (BEGIN, UNKNOWN))
    seen = known.agg(F.count("*").alias("n"), F.count_if("hot").alias("hot"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in "bt")).first()
    more = seen["n"] > seen["hot"]
    frequent = known.where("hot").select("word", "b", "t").toArrow().sort_by([("b", "descending")])  # p.numbers rows at most
    sent = shipped(flagged.sparkSession, _Sorted(_column(frequent, "word")))

    def encode(batches):
        numbers = received(sent)
        for batch in slices(batches, "text"):
            word, ends = _words_of(batch)
            at = numbers.places(word)
            code = np.where(at >= 0, (at + 2).astype(np.uint64), word if more else np.uint64(UNKNOWN))
            yield _texts(batch, code, ends)

    kind = flagged.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, wanted boolean, codes binary"
    rows = flagged.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(encode, schema)
    rows = stored(rows, "codes", compression="zstd")
    # Small numbers in place of partition and row: they stand in every row that moves.
    parts = rows.agg(F.coalesce(F.max(F.shiftright("uid", 33)), F.lit(0)) + 1).first()[0]
    small = F.col("uid").bitwiseAND((1 << 33) - 1) * parts + F.shiftright("uid", 33)
    rows = rows.withColumn("uid", small)
    if more:
        rows = stored(_known_alone(rows, known.where("not hot").select("word", "b", "t"), f"{schema}, rare {_RARE}"), "known-codes", compression="zstd")
    else:
        rows = rows.withColumn("rare", F.lit(None).cast(_RARE))
    counts = (np.array([begins[n], size[n] - seen[n], *frequent.column(n).to_pylist()], np.int64) for n in "bt")
    return rows, Model(p, *counts, size["t"] / max(1, size["b"]), size["t"] + p.alpha * (seen["n"] + 1), more)


def _texts(batch: pa.RecordBatch, code: np.ndarray, ends: np.ndarray, *more: str) -> pa.RecordBatch:
    data = pa.array([code[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
    own = [batch.column(c) for c in ("uid", "doc_id", "wanted")]
    return pa.RecordBatch.from_arrays([*own, data, *map(batch.column, more)], ["uid", "doc_id", "wanted", "codes", *more])


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data = batch.column("codes").to_pylist()
    ends = np.cumsum([0, *(len(d) // 8 for d in data)])
    return np.frombuffer(b"".join(data), np.uint64), ends


def _known_alone(rows: DataFrame, others: DataFrame, schema: str) -> DataFrame:
    """``rows`` with ``rare``, and ``UNKNOWN`` for the hashes that aren't among the known words ``others``."""

    def different(batches):
        for batch in slices(batches, "codes"):
            code, ends = _codes(batch)
            at = np.flatnonzero(code >= _HASH)
            pairs = pa.table([batch.column("uid").take(pa.array(owner(ends)[at])), signed(code[at])], ["uid", "word"])
            yield from pairs.group_by(["uid", "word"], use_threads=False).aggregate([]).to_batches()

    def fold(batches):
        for batch in slices(batches, "codes"):
            code, ends = _codes(batch)
            drop = (code >= _HASH) & (_Rare(batch).places(code, owner(ends)) < 0)
            yield _texts(batch, np.where(drop, np.uint64(UNKNOWN), code), ends, "rare")

    kept = rows.select("uid", "codes").mapInArrow(different, "uid long, word long").join(others, "word")
    kept = kept.groupBy("uid").agg(F.collect_list(F.struct("word", "b", "t")).alias("rare"))  # no longer than the text
    return rows.join(kept, "uid", "left").mapInArrow(fold, schema)


def _pairs(batches: Iterator[pa.RecordBatch]):
    """``(batch, before, word, text)`` of the pairs in some texts."""
    for batch in slices(batches, "codes", 4 << 20):
        word, ends = _codes(batch)
        before = np.r_[np.uint64(BEGIN), word[:-1]] if len(word) else word.copy()
        before[ends[:-1][ends[:-1] < len(word)]] = BEGIN
        yield batch, before, word, owner(ends)


def frequent_pairs(rows: DataFrame, model: Model) -> pa.Table:
    """``before, word, target, background`` of ``p.hot`` pairs at most: their losses, counted over all texts.

    They are those that stand out among the some 2^19 pairs that a task holds; any other pair is less than
    2^-16 of what it stands in, or rarer than these.
    """
    sent_model = shipped(rows.sparkSession, model)

    def outstanding(batches):
        held, size = [], 0

        def most():
            out = _one_each(held, ["before", "word"], ["b"])
            return out.filter(pc.greater(out.column("b"), max(1, size >> 17))).to_batches()

        for _, before, word, _ in _pairs(batches):
            held.append(pa.table([signed(before), signed(word), pa.array(np.ones(len(word), np.int64))], ["before", "word", "b"]))
            size += len(word)
            if size > _HELD:
                yield from most()
                held, size = [], 0
        if size:
            yield from most()

    found = rows.select("codes").mapInArrow(outstanding, "before long, word long, b long")
    found = stored(found.groupBy("before", "word").agg(F.sum("b").alias("b")), "outstanding")
    chosen = found.where(_frequent(found, model.p.hot)).select("before", "word").toArrow()  # p.hot rows at most
    sent = shipped(rows.sparkSession, _Sorted(_column(chosen, "before"), _column(chosen, "word")))
    sums, fixed = ["b", "t"], ["word_b", "word_t", "before_b", "before_t"]

    def count(batches):
        frequent, model = received(sent), received(sent_model)
        n = len(frequent.key)
        total, own = np.zeros((2, n), np.int64), np.zeros((4, n), np.int64)
        for batch, before, word, of in _pairs(batches):
            at = frequent.places(before, word)
            hit, rare = np.flatnonzero(at >= 0), _Rare(batch)
            at = at[hit]
            total[0] += np.bincount(at, minlength=n)
            total[1] += np.bincount(at[_wanted(batch)[of[hit]] > 0], minlength=n)
            own[:2, at] = model.counts(word[hit], of[hit], rare)
            own[2:, at] = model.counts(before[hit], of[hit], rare)
        some = np.flatnonzero(total[0])
        if len(some):
            back = np.argsort(frequent.rank)
            arrays = [*(signed(c[back][some]) for c in frequent.columns), *(pa.array(x[some]) for x in (*total, *own))]
            yield pa.RecordBatch.from_arrays(arrays, ["before", "word", *sums, *fixed])

    schema = ", ".join(f"{n} long" for n in ["before", "word", *sums, *fixed])
    parts = rows.select("wanted", "codes", "rare").mapInArrow(count, schema).groupBy("before", "word")
    out = parts.agg(*(F.sum(n).alias(n) for n in sums), *(F.max(n).alias(n) for n in fixed)).toArrow()  # p.hot rows at most
    b, t, word_b, word_t, before_b, before_t = (out.column(n).to_numpy() for n in (*sums, *fixed))
    pair, after = model.of_pair(b, t, word_b, word_t, np.log), model.after(before_b, before_t)
    arrays = [out.column("before"), out.column("word"), *(pa.array(x + y) for x, y in zip(pair, after, strict=True))]
    return pa.table(arrays, ["before", "word", "target", "background"])


def _columns(names: list[str], **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[n] for n in names], names)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` of every document.

    Frequent pairs are scored where they stand. All others meet once: an exchange by pair counts them and gives
    each text's row its loss. Two numbers share the column ``pair``; of hashes the second is ``other``. Where all
    words have numbers, rows are narrow and sorted by one number alone.
    """
    spark = rows.sparkSession
    losses = frequent_pairs(rows, model)
    frequent = _Sorted(_column(losses, "before"), _column(losses, "word"))
    sent = shipped(spark, (model, frequent, *(losses.column(c).to_numpy() for c in ("target", "background"))))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"pair long, uid long, n long, doc struct<doc_id: {kind}, n_tokens: bigint, t: double, b: double>"
    names = ["pair", "uid", "n", "doc"]
    if model.more:
        schema, names = f"{schema}, other long, rare struct<b: bigint, t: bigint>", [*names, "other", "rare"]
    bits = len(model.b).bit_length()

    def run(batches):
        model, frequent, *losses = received(sent)
        for batch, before, word, of in _pairs(batches):
            n, rare = batch.num_rows, _Rare(batch)
            at = frequent.places(before, word)
            hit, cold = at >= 0, np.flatnonzero(at < 0)
            after = model.after(*model.counts(before[cold], of[cold], rare))
            t, b = (np.bincount(of[hit], x[at[hit]], n) + np.bincount(of[cold], y, n) for x, y in zip(losses, after, strict=True))
            # Each document's own row: its uid in place of a pair spreads them, and no pair is below 0 without an other.
            doc = [batch.column("doc_id"), pa.array(np.bincount(of, minlength=n)), pa.array(t, pa.float64()), pa.array(b, pa.float64())]
            doc = pa.StructArray.from_arrays(doc, ["doc_id", "n_tokens", "t", "b"])
            uid, none = batch.column("uid"), pa.array([None] * n, pa.struct([("b", pa.int64()), ("t", pa.int64())]))
            own = pa.array(-1 - uid.to_numpy())
            yield _columns(names, pair=own, uid=uid, n=pa.array(np.zeros(n, np.int64)), doc=doc, other=pa.nulls(n, pa.int64()), rare=none)
            if not len(cold):
                continue
            ones = pa.array(np.ones(len(cold), np.int64))
            own = pa.table([pa.array(of[cold]), signed(before[cold]), signed(word[cold]), ones], ["of", "before", "word", "n"])
            own = _one_each([own], ["of", "before", "word"], ["n"])
            of, before, word = own.column("of").to_numpy(), _column(own, "before"), _column(own, "word")
            plain = (before < _HASH) & (word < _HASH)
            pair = np.where(plain, before << np.uint64(bits) | word, before)
            times = own.column("n").to_numpy() * np.where(_wanted(batch)[of] > 0, -1, 1)
            more = {}
            if model.more:
                counts = [pa.array(x) for x in model.counts(word, of, rare)]
                counts = pa.StructArray.from_arrays(counts, ["b", "t"], mask=pa.array(word < _HASH))
                more = {"other": signed(np.where(plain, np.uint64(0), word)), "rare": counts}
            yield _columns(names, pair=signed(pair), uid=uid.take(pa.array(of)), n=pa.array(times), doc=pa.nulls(len(of), doc.type), **more)

    pair = Window.partitionBy("pair", "other") if model.more else Window.partitionBy("pair")
    counted = rows.mapInArrow(run, schema).withColumns(
        {"b": F.sum(F.abs("n")).over(pair), "t": F.sum(F.greatest(-F.col("n"), F.lit(0))).over(pair)}
    )
    numbers = pa.table([pa.array(np.arange(len(model.b))), pa.array(model.b), pa.array(model.t)], ["word", "word_b", "word_t"])
    second = F.col("pair").bitwiseAND((1 << bits) - 1)
    if model.more:
        number, own = F.when(F.col("other") == 0, second).when(F.col("other") > 0, F.col("other")), [F.coalesce(f"rare.{n}", f"word_{n}") for n in "bt"]
    else:
        number, own = F.when(F.col("pair") >= 0, second), [F.col(f"word_{n}") for n in "bt"]
    counted = counted.join(F.broadcast(spark.createDataFrame(numbers)), number == F.col("word"), "left")
    target, background = model.of_pair(F.col("b"), F.col("t"), *own, F.log)
    mean = lambda own, loss: F.sum(F.coalesce(F.col(own), F.abs("n") * loss)) / F.greatest(F.max("doc.n_tokens"), F.lit(1))
    out = counted.groupBy("uid").agg(
        F.first("doc.doc_id", ignorenulls=True).alias("doc_id"),
        F.max("doc.n_tokens").alias("n_tokens"),
        mean("doc.t", target).alias("target_loss"),
        mean("doc.b", background).alias("background_loss"),
    )
    return out.drop("uid").withColumn("score", F.col("target_loss") - F.col("background_loss"))


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, p: Bigrams = Bigrams()) -> DataFrame:
    """Scores every document; the target are the documents whose ``labels.quality`` is 1, the background all.

    The losses are means over all words of the whole text, in nats; ``score`` is the target's less the
    background's: the smaller, the more like the target. A text without words, or null, scores 0.
    Without labelled documents both models are even shares of one vocabulary. Rows equal to another count
    as often as they stand; an id with several labels is in the target if one of them is 1.
    """
    own = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"))
    target = pick(labels, "doc_id", "quality").where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    few = target.limit(p.hot + 1).count() <= p.hot
    target = target.withColumn("wanted", F.lit(True))
    flagged = own.join(F.broadcast(target) if few else target, "doc_id", "left")
    flagged = flagged.select("doc_id", "text", F.coalesce("wanted", F.lit(False)).alias("wanted"))
    return score(*encoded(flagged, p))
