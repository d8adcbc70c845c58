"""Line dedup: lines equal or within one edit of an earlier line, by a deletion-neighbourhood join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docharbor.llm.common import apart, bound_batches, mixed, per_slice, pick, slices, stored, texts, together

#: Shorter lines (in characters, without white space around) always stay.
MIN_CHARS = 10
_P = 0x9E3779B97F4A7C15 | 1
_P_BACK = pow(_P, -1, 1 << 64)
_U = np.uint64
#: Bytes of lines whose characters a task holds as numbers, some hundred bytes each.
_HELD = 1 << 18


def split_lines(text: bytes) -> list[str]:
    """The lines of a text as they are compared: parted at line feeds, without white space around."""
    return [x.strip() for x in text.decode().split("\n")]


class _Prefixes:
    """Polynomial hashes, modulo 2**64, of any stretch of many lines laid end to end."""

    def __init__(self, lines: list[str]) -> None:
        points = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(_U)
        self.size = np.fromiter(map(len, lines), np.int64, len(lines))
        self.start = np.cumsum(self.size) - self.size
        n = len(points)
        self.power = np.ones(n + 1, _U)
        self.back = np.ones(n + 1, _U)
        np.cumprod(np.full(n, _P, _U), out=self.power[1:])
        np.cumprod(np.full(n, _P_BACK, _U), out=self.back[1:])
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(mixed(points + _U(1)) * self.power[:-1], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The hash of the characters from ``a`` to ``b``, the same wherever they stand."""
        return (self.sums[b] - self.sums[a]) * self.back[a]


def _parts(p: _Prefixes, count: int) -> np.ndarray:
    """``2 * count`` hashes per line; two lines one edit apart share one of them.

    Let ``m`` be the length of the shorter line: the own length or one less. One edit at ``i`` leaves
    the first ``i`` and the last ``m - 1 - i`` characters alone; each hash has one of ``count`` ranges
    of ``i`` and what is alone for all of it.
    """
    out = []
    end = p.start + p.size
    for less in (0, 1):
        rest = np.maximum(p.size - less - 1, 0)
        for j in range(count):
            a, b = rest * j // count, rest - rest * (j + 1) // count
            tag = mixed((rest * count + j).astype(_U) + _U(1))
            out.append(mixed(mixed(p.of(p.start, p.start + a) + tag) + p.of(end - b, end)))
    return np.stack(out, 1)


def _numbered(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, th, line, digest, halves`` of every line that can be a duplicate."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        row, number, lines = [], [], []
        for i, t in enumerate(texts(batch, "text")):
            for j, line in enumerate(split_lines(t)):
                if len(line) >= min_chars:
                    row.append(i)
                    number.append(j)
                    lines.append(line)
        if not lines:
            return None
        halves = _parts(_Prefixes(lines), 2).view(np.int64)
        digests = [xxhash.xxh3_128_digest(x.encode()) for x in lines]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(row)),
                batch.column("th").take(pa.array(row)),
                pa.array(number, pa.int32()),
                pa.array(digests, pa.binary()),
                *(pa.array(halves[:, k]) for k in range(4)),
            ],
            ["doc_id", "th", "line", "digest", "h0", "h1", "h2", "h3"],
        )

    schema = "doc_id long, th long, line int, digest binary, h0 long, h1 long, h2 long, h3 long"
    return docs.mapInArrow(per_slice("text", make, _HELD), schema)


def _first(*columns: str) -> Column:
    """The earliest place: by id (null ids last), then by the hash of the text and the line."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "line", *columns))


def _variants(hits: DataFrame) -> DataFrame:
    """``key, uid, self``: what is left of a line without one character, as hashed keys.

    With ``self`` 2, the key also holds the character's place: lines with equal keys differ in that
    character alone. With 0 the key is the remainder, with 1 the whole line: a remainder equal to a
    whole line is one character away from it.
    """

    def run(batches):
        for batch in slices(batches, "text", _HELD):
            lines = batch.column("text").to_pylist()
            p = _Prefixes(lines)
            end = p.start + p.size
            of = np.repeat(np.arange(len(lines)), p.size)
            i = np.arange(len(of))
            rest = p.of(p.start[of], i) + p.of(i + 1, end[of]) * p.power[i - p.start[of]]
            place = mixed(rest + mixed((i - p.start[of]).astype(_U))) + p.size[of].astype(_U)
            # Leaving out any letter of a run gives the same remainder: once is enough.
            once = np.flatnonzero(np.r_[True, (rest[1:] != rest[:-1]) | (of[1:] != of[:-1])]) if len(of) else i
            uid = batch.column("uid").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([mixed(place), rest[once], p.of(p.start, end)]).view(np.int64)),
                    pa.array(np.concatenate([uid[of], uid[of[once]], uid])),
                    pa.array(np.repeat([2, 0, 1], [len(of), len(once), len(lines)]).astype(np.int8)),
                ],
                ["key", "uid", "self"],
            )

    return hits.select("text", "uid").mapInArrow(run, "key long, uid long, self byte")


def _part_keys(hits: DataFrame, count: int) -> DataFrame:
    """``uid, key`` of the lines' parts, each once."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = _parts(_Prefixes(batch.column("text").to_pylist()), count).view(np.int64)
        uid = np.repeat(batch.column("uid").to_numpy(), 2 * count)
        return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(parts.ravel())], ["uid", "key"])

    return hits.select("uid", "text").mapInArrow(per_slice("text", make, _HELD), "uid long, key long")


def _met(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` whose key two different lines have."""
    shared = keys.groupBy("key").agg(F.min("uid").alias("a"), F.max("uid").alias("b")).where("a <> b")
    return keys.join(shared.select("key"), "key", "left_semi")


def _near_pairs(lines: DataFrame, occurrences: DataFrame) -> DataFrame:
    """``uid, near_place``: a line and the earliest place of a line one edit away, if that is earlier.

    ``lines`` holds every distinct line once. Lines that share no half, then no fifteen sixteenths, with
    any other line have no neighbour and are set aside before any variant is made.
    """
    halves = lines.select("uid", F.explode(F.array_distinct(F.array("h0", "h1", "h2", "h3"))).alias("key"))
    halved = stored(_with_text(lines.join(_met(halves).select("uid").distinct(), "uid", "left_semi"), occurrences), "lines")
    close = _met(_part_keys(halved, 16)).select("uid").distinct()
    hits = stored(halved.join(close, "uid", "left_semi"), "close-lines")

    keys = stored(_met(_variants(hits)).distinct().join(hits.select("uid", "place"), "uid"), "variants")
    at = F.struct("place", "uid")
    same = keys.where("self = 2").groupBy("key").agg(F.min(at).alias("low"))
    found = keys.where("self = 2").join(same, "key").select("uid", F.col("low.uid").alias("other"))
    # Whole lines against remainders: each key has one whole line; the earliest remainder is enough
    # for it, and it is enough for every remainder.
    ends = keys.where("self < 2").groupBy("key").agg(
        F.min(F.when(F.col("self") == 1, at)).alias("full"),
        F.min(F.when(F.col("self") == 0, at)).alias("rest"),
    ).where("full is not null and rest is not null")
    found = found.union(ends.select(F.col("full.uid"), F.col("rest.uid")))
    remainders = keys.where("self = 0").join(ends.select("key", "full"), "key")
    found = found.union(remainders.select("uid", F.col("full.uid")))

    late = hits.select("uid", "place", F.col("text").alias("own"))
    early = hits.select(F.col("uid").alias("other"), F.col("place").alias("first"), F.col("text").alias("theirs"))
    pairs = found.where("uid <> other").distinct().join(late, "uid").join(early, "other")
    near = pairs.where("first < place").where(F.levenshtein("own", "theirs", 1) >= 0)
    return near.groupBy("uid").agg(F.min("first").alias("near_place"))


def _with_text(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """The text of each line, taken from the document of its first place."""

    def take(batches):
        for batch in slices(batches, "text"):
            found, uids, places = [], [], batch.column("wanted")
            for t, want in zip(texts(batch, "text"), places.to_pylist(), strict=True):
                own = split_lines(t)
                found += [own[w["line"]] for w in want]
                uids += [w["uid"] for w in want]
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(found, pa.string())], ["uid", "text"])

    wanted = lines.groupBy("place.doc_id", "place.th").agg(F.collect_list(F.struct("uid", "place.line")).alias("wanted"))
    wanted = wanted.withColumnRenamed("doc_id", "w_id").withColumnRenamed("th", "w_th")
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("th") == F.col("w_th"))
    found = docs.join(wanted, same).select("text", "wanted").mapInArrow(take, "uid long, text string")
    return found.dropDuplicates(["uid"]).join(lines.select("uid", "place"), "uid")


def duplicate_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, th, line, place, near``: every line that has an earlier equal or nearly equal one.

    Lines are parted at line feeds and compared without white space around; ``line`` counts from
    0. A line goes if an equal line stands earlier, or one that is one inserted, deleted or changed
    character away; ``place`` tells where, ``near`` which of both. Earlier is the smaller doc_id
    (null last), then the smaller hash ``th`` of the text, then the line number. Rows equal in id
    and text are one document. Lines under ``min_chars`` characters and null texts have no
    duplicates.
    """
    bound_batches(docs.sparkSession)
    own = _keyed(docs)
    numbered = _numbered(own, min_chars)
    lines = numbered.groupBy("digest").agg(_first("h0", "h1", "h2", "h3").alias("f"), F.count("*").alias("n"))
    lines = lines.select(
        F.monotonically_increasing_id().alias("uid"),
        "digest",
        "n",
        F.struct("f.no_id", "f.doc_id", "f.th", "f.line").alias("place"),
        *(F.col(f"f.{h}").alias(h) for h in ("h0", "h1", "h2", "h3")),
    )
    lines = stored(lines, "distinct-lines")
    near = _near_pairs(lines, own)
    fates = lines.join(near, "uid", "left").where("n > 1 or near_place is not null")
    fates = fates.select("digest", "place", "near_place")
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "line")
    out = numbered.select("doc_id", "th", "line", "digest").join(fates, "digest").withColumn("here", here)
    first = F.least("place", "near_place")
    return out.where(first < F.col("here")).select(
        "doc_id", "th", "line", first.alias("place"), (F.col("place") == F.col("here")).alias("near")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    out = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return out.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))


def _gone(docs: DataFrame, **params) -> DataFrame:
    """``g_id, g_th, gone``: the lines that each document loses, with their kind and source."""
    gone = duplicate_lines(docs, **params).distinct()
    return gone.groupBy(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th")).agg(
        F.collect_list(F.struct("line", "near", "place.doc_id")).alias("gone")
    )


def _marked(docs: DataFrame, **params) -> DataFrame:
    """``doc_id`` and ``text``, the other columns in ``_doc``, and ``gone``, the lines that go."""
    own = apart(docs, "_doc", "doc_id", "text").withColumn("th", F.xxhash64("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th"))
    joined = own.join(_gone(docs, **params), same, "left")
    return joined.select("_doc", "doc_id", F.col("text").cast("binary").alias("text"), "gone")


def _without_lines(marked: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """``text`` without the lines that go, ``n_lines`` and ``left``: the lines of ``least`` characters that stay."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, sizes, left = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            t = text or b""
            lines = t.split(b"\n")
            out = {g["line"] for g in gone or ()}
            sizes.append(len(lines))
            left.append(sum(len(x) >= least and i not in out for i, x in enumerate(split_lines(t))) if out else None)
            kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in out) if out else text)
        place = batch.schema.get_field_index("text")
        batch = batch.set_column(place, "text", pa.array(kept, pa.binary()))
        batch = batch.append_column("n_lines", pa.array(sizes, pa.int64()))
        return batch.append_column("left", pa.array(left, pa.int64()))

    schema = StructType([*marked.schema]).add("n_lines", "long").add("left", "long")
    return marked.mapInArrow(per_slice("text", make), schema)


def line_report(docs: DataFrame, **params) -> DataFrame:
    """``doc_id, n_lines, n_equal, n_near, removed, sources`` of every document.

    ``removed`` has the numbers of the lines that go, ``sources`` the ids of the documents whose lines
    stay instead. A null text is one empty line.
    """
    own = pick(docs, "doc_id", "text").withColumn("th", F.xxhash64("text"))
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th"))
    out = own.select("doc_id", "th", n_lines).join(_gone(docs, **params), same, "left")
    gone = F.coalesce(F.col("gone"), F.array())
    return out.select(
        "doc_id",
        "n_lines",
        F.size(F.filter(gone, lambda g: ~g["near"])).cast("long").alias("n_equal"),
        F.size(F.filter(gone, lambda g: g["near"])).cast("long").alias("n_near"),
        F.array_sort(F.transform(gone, lambda g: g["line"])).alias("removed"),
        F.array_sort(F.array_distinct(F.transform(gone, lambda g: g["doc_id"]))).alias("sources"),
    )


def drop_lines(
    docs: DataFrame, *, min_chars: int = MIN_CHARS, length: str | None = None, keep_short: bool = False
) -> DataFrame:
    """The documents without duplicate lines; one that loses its last comparable line goes.

    With ``keep_short`` it stays with its shorter lines, and goes only if none but blank lines are left.
    Documents without a duplicate line, empty and null ones too, stay as they are. ``length`` names a
    column that holds the number of characters, to be set anew with the text.
    """
    out = _without_lines(_marked(docs, min_chars=min_chars), 1 if keep_short else min_chars)
    kept = out.where(F.col("left").isNull() | (F.col("left") > 0))
    new = F.col("text").cast("string")
    changed = {"text": new}
    if length in docs.columns:
        before = F.col(f"_doc._{docs.columns.index(length)}")
        kind = docs.schema[docs.columns.index(length)].dataType
        changed[length] = F.when(F.col("left").isNull(), before).otherwise(F.length(new).cast(kind))
    return together(kept, "_doc", docs, "doc_id", **changed)
