"""N-gram Jaccard join with adaptive multi-match prefixes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docharbor.llm.common import bound_batches, hashed, inside, mixed, per_slice, pick, received, runs_of, shipped, slices, stored, texts, unpack, whole
from docharbor.llm.graph import components


#: Bytes of text for each place of the table of token frequencies, and the least and most places (powers of 2).
#: The table is broadcast, a byte each; it is counted and sent in blocks of the least places.
PLACE_BYTES = 128
BLOCK_BITS, MOST_BITS = 16, 25


@dataclass(frozen=True)
class Join:
    """Two texts link when they share ``percent`` of all their distinct word shingles.

    A prefix token is common if more than ``common`` distinct sets have it in their prefix. It steers
    the cost and no result.
    """

    words: int = 5
    percent: int = 80
    common: int = 64

    def spare(self, n, delta):
        """At least 0 in sum for two sets of ``n`` tokens, ``delta`` apart from a third, if they surely link."""
        return (100 - self.percent) * n - (100 + self.percent) * delta

    @property
    def unit(self) -> int:
        """What ``spare`` of two sets grows by for each difference that they share."""
        return 2 * (100 + self.percent)

    def least(self, n):
        """What a set of ``n`` shares at least with any that links to it."""
        return (self.percent * n + 99) // 100

    def longest(self, n):
        """The most matches that a prefix is lengthened for."""
        return 1 + n // 20

    def fewest(self, n: str) -> Column:
        """Prefix tokens that a set of ``n`` shares at least with any that links to it."""
        return F.expr(f"1 + ({self.percent} * {n} + 99) div 100 div 20")

    def prefix(self, n):
        """Tokens to keep: enough for the matches of the longest partner as well."""
        return np.minimum(n, n - self.least(n) + 2 + n * 5 // self.percent)


def shingle_sets(docs: list[list[bytes]], size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; a text of fewer words is one shingle."""
    flat, ends = hashed(docs)
    runs, ok = runs_of(flat, size), inside(ends, size)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        own = runs[a : b - size + 1][ok[a : b - size + 1]] if b - a >= size else runs_of(flat[a:b], b - a) if b > a else runs[:0]
        out.append(np.unique(own))
    return out


def _sets_of(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    return shingle_sets([t.lower().split() for t in texts(batch, "text")], size)


def _keyed(docs: DataFrame) -> DataFrame:
    own = pick(docs, "doc_id", "text")
    return own.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))


def _place(doc_id: str, th: str) -> list[Column]:
    """What names a row's id and text, without nulls."""
    text = F.col(doc_id).cast("string")
    return [text.isNull().alias("no_id"), F.coalesce(text, F.lit("")).alias("id"), F.col(th).alias("th")]


def _table_bits(docs: DataFrame) -> int:
    """The places of a table that grows with the texts, so that rare tokens seldom share one with many others."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(MOST_BITS, max(BLOCK_BITS, (size // PLACE_BYTES).bit_length()))


def _in_table(tokens: np.ndarray, level_of: np.ndarray) -> np.ndarray:
    """The tokens' places in a table."""
    return (tokens >> np.uint64(65 - len(level_of).bit_length())).astype(np.int64)


def _described(docs: DataFrame, p: Join, bits: int) -> DataFrame:
    """``doc_id, th, n, digest`` of each row: the size and a 128-bit name of its set.

    Rows with a ``block`` hold instead how many tokens a task has met at the places of that block of a table
    of ``2 ** bits``: the texts are read once for both.
    """
    names = ["doc_id", "th", "n", "digest", "block", "counts"]

    def run(batches):
        total, kinds = np.zeros(1 << bits, np.uint32), None
        for batch in slices(batches, "text"):
            sets = _sets_of(batch, p.words)
            for s in sets:
                np.add.at(total, _in_table(s, total), 1)
            n, digest = [len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            kinds = [batch.column("doc_id").type, pa.int64(), pa.int64(), pa.binary()]
            own = [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(digest, pa.binary())]
            none = [pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
            yield pa.RecordBatch.from_arrays([*own, *none], names)
        if kinds:
            blocks = total.reshape(-1, 1 << BLOCK_BITS)
            some = np.flatnonzero(blocks.any(1))
            counts = [pa.compress(blocks[i].tobytes(), "zstd", asbytes=True) for i in some.tolist()]
            none = [pa.nulls(len(some), k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*none, pa.array(some.astype(np.int32)), pa.array(counts, pa.binary())], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, th long, n long, digest binary, block int, counts binary"
    return stored(docs.mapInArrow(run, schema), "described")


def _levels(described: DataFrame, bits: int) -> np.ndarray:
    """How frequent the tokens of a place in a table are, over all documents.

    Level 0 is what chance puts into a place, each further level doubles. Tasks count, blocks of places are
    summed apart, and a byte for each place is all that reaches the driver.
    """

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
                raw = pa.decompress(data.as_buffer(), 4 << BLOCK_BITS, "zstd")
                total.setdefault(i, np.zeros(1 << BLOCK_BITS, np.int64))
                total[i] += np.frombuffer(raw, np.uint32)
        levels = []
        for n in total.values():
            chance = np.median(n)
            levels.append(np.log2(np.maximum(1, n / (2 + chance + 4 * np.sqrt(chance)))).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(levels, pa.binary())], ["block", "levels"])

    counted = described.where("block is not null").select("block", "counts").repartition("block")
    found = counted.mapInArrow(add, "block int, levels binary").toArrow()
    out = np.zeros((1 << bits - BLOCK_BITS, 1 << BLOCK_BITS), np.uint8)
    for i, levels in zip(found.column("block").to_pylist(), found.column("levels").to_pylist(), strict=True):
        out[i] = np.frombuffer(levels, np.uint8)
    return out.reshape(-1)


def _classes(docs: DataFrame, levels: Broadcast, p: Join) -> DataFrame:
    """``uid, digest, n, prefix, place`` of every distinct set that isn't empty.

    ``prefix`` holds its first tokens in the order of all tokens, the rare before the frequent, then by
    hash; ``place`` the id and text hash of one document.
    """
    def make(batch: pa.RecordBatch, level_of: np.ndarray) -> pa.RecordBatch:
        sets = _sets_of(batch, p.words)
        keep = [i for i, s in enumerate(sets) if len(s)]
        cut = []
        for i in keep:
            level = level_of[_in_table(sets[i], level_of)]
            first = np.argsort(level, kind="stable")[: int(p.prefix(len(sets[i])))]
            cut.append(sets[i][first].view(np.int64))
        at = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(at),
                batch.column("th").take(at),
                pa.array([len(sets[i]) for i in keep], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(sets[i].tobytes()) for i in keep], pa.binary()),
                pa.array(cut, pa.list_(pa.int64())),
            ],
            ["doc_id", "th", "n", "digest", "prefix"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, th long, n long, digest binary, prefix array<long>"

    def run(batches):
        yield from per_slice("text", partial(make, level_of=received(levels)))(batches)

    found = docs.mapInArrow(run, schema).groupBy("digest").agg(
        F.first(F.struct("doc_id", "th", "n", "prefix")).alias("f")
    )
    place = F.struct("f.doc_id", "f.th").alias("place")
    return stored(
        found.select(F.monotonically_increasing_id().alias("uid"), "digest", "f.n", "f.prefix", place), "sets"
    )


def _postings(classes: DataFrame, p: Join) -> DataFrame:
    """``token, df, uid, n, pos`` of the prefix tokens that two or more sets have.

    Two sets that link share as many prefix tokens as the smaller one may want matches, so a set with
    fewer shared tokens than any partner would need is left out, and with it what it alone shared.
    """
    tokens = classes.select("uid", "n", F.posexplode("prefix").alias("pos", "token"))
    first = stored(_with_df(tokens), "tokens")
    enough = first.groupBy("uid", "n").agg(F.count("*").alias("k")).where(F.col("k") >= p.fewest("n"))
    return stored(_with_df(first.drop("df").join(enough.select("uid"), "uid", "left_semi")), "postings")


def _with_df(tokens: DataFrame) -> DataFrame:
    df = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    return tokens.join(df, "token")


def _adapted(postings: DataFrame, p: Join) -> DataFrame:
    """``token, uid, n, matches, need, alone`` : each set's tokens after its prefix is chosen.

    With ``l`` matches wanted, a prefix has ``n - least(n) + l`` tokens, and two sets that link share
    ``l`` of them, ``l`` the smaller number of both. A prefix is lengthened until it holds fewer common
    tokens than wanted matches: common tokens can then be left out, as ``need = l - common`` of the
    other matches remain. Of those lengths the one of least cost is taken, the rows met per match
    needed. A set for which no length will do also meets others of its kind at common tokens, where
    ``alone`` holds: at all of its whole prefix but the most frequent ones. Two such sets share as many
    tokens as each needs at least, so the rarest they share is not among those either leaves out.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {k: [] for k in ("token", "uid", "n", "matches", "need", "alone")}
        for uid, n, tokens in zip(*(batch.column(c).to_pylist() for c in ("uid", "n", "tokens")), strict=True):
            pos, token, df = (np.array([t[k] for t in tokens], np.int64) for k in ("pos", "token", "df"))
            order = np.argsort(pos)
            pos, token, df = pos[order], token[order], df[order]
            common = df > p.common
            least = p.least(n)
            wanted = np.arange(1, min(p.longest(n), least) + 1)
            size = np.searchsorted(pos, n - least + wanted)
            need = wanted - np.r_[0, np.cumsum(common)][size]
            cost = np.r_[0, np.cumsum(np.where(common, 0, df))][size] / np.maximum(need, 1)
            cost[need < 1] = np.inf
            best = int(np.argmin(cost))
            alone = not np.isfinite(cost[best])
            if alone:
                fewest = 1 + least // 20
                frequent = np.lexsort((token, df))[max(0, len(df) - fewest + 1) :]
                keep = ~common
                keep[np.setdiff1d(np.arange(len(df)), frequent)] = True
                use = np.flatnonzero(keep)
            else:
                use = np.flatnonzero(~common[: size[best]])
            k = len(use)
            out["token"].append(token[use])
            for name, value in (("uid", uid), ("n", n), ("matches", 1 << 30 if alone else int(wanted[best])), ("need", 1 if alone else int(need[best]))):
                out[name].append(np.full(k, value, np.int64))
            out["alone"].append(common[use])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out.values()], list(out))

    lists = postings.groupBy("uid", "n").agg(F.collect_list(F.struct("pos", "token", "df")).alias("tokens"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield make(batch.slice(at, 500))

    return lists.mapInArrow(run, "token long, uid long, n long, matches long, need long, alone boolean")


def _near_size(p: Join, n: str, m: str) -> Column:
    return F.expr(f"100 * least({n}, {m}) >= {p.percent} * greatest({n}, {m})")


def _side_by_side(rows: DataFrame, p: Join) -> DataFrame:
    """Rows of one token and of different groups, the uids as ``a < b``."""
    other = rows.select(*(F.col(c).alias(c if c == "token" else f"{c}2") for c in rows.columns))
    other = other.withColumnRenamed("token", "token2")
    fit = F.expr("token = token2 and uid < uid2 and `group` <> group2") & _near_size(p, "n", "n2")
    return rows.join(other, fit).withColumnsRenamed({"uid": "a", "uid2": "b"})


def _likely(pairs: DataFrame, lists: DataFrame, p: Join) -> DataFrame:
    """The pairs ``a, b`` that share as many prefix tokens as both need to link."""
    one = lists.select(F.col("uid").alias("a"), F.col("n"), F.col("tokens").alias("x"))
    two = lists.select(F.col("uid").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y")) >= F.greatest(p.fewest("n"), p.fewest("m"))
    return pairs.join(one, "a").join(two, "b").where(both).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, p: Join) -> DataFrame:
    """The pairs ``a, b`` whose whole sets link."""
    one = sets.select(F.col("uid").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("uid").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("x", "y"))
    both = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y") - common).alias("all"))
    return both.where(100 * F.col("common") >= p.percent * F.col("all")).select("a", "b")


def _whole_sets(classes: DataFrame, uids: DataFrame, docs: DataFrame, p: Join) -> DataFrame:
    """``uid, tokens``: the whole sets of these uids, from the text of one document each."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.view(np.int64) for s in _sets_of(batch, p.words)]
        return pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(sets, pa.list_(pa.int64()))], ["uid", "tokens"])

    wanted = classes.join(uids, "uid", "left_semi").select("uid", *_place("place.doc_id", "place.th"))
    rows = docs.select(*_place("doc_id", "th"), "text")
    # Rows equal in id and text lie in one task after the join: once is enough.
    found = rows.join(wanted, ["no_id", "id", "th"]).dropDuplicates(["no_id", "id", "th"])
    found = found.select("uid", "text").mapInArrow(per_slice("text", make), "uid long, tokens array<long>")
    return stored(found, "whole-sets")


#: Bits of the map that bounds how many tokens two sets can share; kept in words of 64.
MAP_WORDS = 4
#: Members of a group that its base is made from.
TYPICAL = 31


def _members(own: DataFrame, pivot: DataFrame) -> DataFrame:
    """``base, uid, n, group``: the sets that meet at common tokens, under the names of those tokens' pivots."""
    named = pivot.select("token", F.col("best.b").alias("base"))
    return own.where("alone").join(named, "token").select("base", "uid", "n", "group").distinct()


def _differences(members: DataFrame, sets: DataFrame, levels: Broadcast, p: Join) -> DataFrame:
    """``base, uid, n, group, delta, spare, apart, w0..``: how each member differs from the base of its group.

    The base holds the tokens that more than half of ``TYPICAL`` members have, chosen by a hash; it need not
    be a set of its own, and a poor one costs time and no link.
    ``apart`` has the tokens on one side only, the rare first, ``w0..`` a bit for each of them.
    """
    order = Window.partitionBy("base").orderBy(F.xxhash64("uid"), "uid")
    some = members.select("base", "uid").withColumn("r", F.row_number().over(order)).where(F.col("r") <= TYPICAL)
    tokens = some.join(sets, "uid").select("base", F.explode("tokens").alias("token"))
    sizes = some.groupBy("base").agg(F.count("*").alias("size")).where("size > 1")
    counts = tokens.groupBy("base", "token").agg(F.count("*").alias("c")).join(sizes, "base").where("2 * c > size")
    missing = F.struct("token", (F.col("size") - F.col("c")).alias("df"))
    bases = sizes.select("base").join(counts.groupBy("base").agg(F.collect_list(missing).alias("b")), "base", "left")
    rows = members.join(sets, "uid").join(bases, "base")
    rows = rows.select("base", "uid", "n", "group", "tokens", "b.token", "b.df")

    def make(batch: pa.RecordBatch, level_of: np.ndarray) -> pa.RecordBatch:
        columns = (batch.column(c).to_pylist() for c in ("tokens", "token", "df"))
        lists, words = [], np.zeros((batch.num_rows, MAP_WORDS), np.uint64)
        for i, (own, base, df) in enumerate(zip(*columns, strict=True)):
            own, base, df = np.array(own, np.int64), np.array(base or [], np.int64), np.array(df or [], np.int64)
            plus = np.setdiff1d(own, base)
            less = ~np.isin(base, own)
            place = _in_table(plus.view(np.uint64), level_of)
            # What is missing from a set is named apart from what it has beside the base.
            names = np.r_[plus.view(np.uint64), mixed(base[less].view(np.uint64) + np.uint64(1))]
            rank = np.r_[1 << level_of[place].astype(np.int64), df[less]]
            names = names[np.lexsort((names, rank))]
            bit = names % np.uint64(64 * MAP_WORDS)
            np.bitwise_or.at(words[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
            lists.append(names.view(np.int64))
        kept = [batch.column(c) for c in ("base", "uid", "n", "group")]
        maps = [pa.array(words[:, w].view(np.int64)) for w in range(MAP_WORDS)]
        names = ["base", "uid", "n", "group", "apart", *(f"w{w}" for w in range(MAP_WORDS))]
        return pa.RecordBatch.from_arrays([*kept, pa.array(lists, pa.list_(pa.int64())), *maps], names)

    def run(batches):
        level_of = received(levels)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                yield make(batch.slice(at, 200), level_of)

    schema = "base long, uid long, n long, group long, apart array<long>, " + ", ".join(f"w{w} long" for w in range(MAP_WORDS))
    found = rows.mapInArrow(run, schema).withColumn("delta", F.size("apart").cast("long"))
    return stored(found.withColumn("spare", p.spare(F.col("n"), F.col("delta"))), "differences")


def _parts(differences: DataFrame, p: Join) -> DataFrame:
    """The rows of ``differences`` that may link to another, ``near`` and ``center``, by ``token``: one of the first apart.

    Two members are at most ``delta + delta2`` apart, less two for each difference they share. Members whose
    ``spare`` adds up to 0 surely link; all the ``near`` ones link to the ``center``, the member of most spare. Any
    others must share ``k = -(spare + spare2) / (2 * (100 + percent))`` differences, so they share one of the first
    ``delta - k + 1`` of each. ``spare2`` is at most the ``top`` of the members that are near in size.
    """
    # Sets that link are of one or of adjoining classes of size.
    rows = differences.withColumn("size", F.floor(F.log(F.col("n")) / F.log(F.lit(101 / p.percent))))
    tops = rows.groupBy("base", "size").agg(F.max("spare").alias("top"))
    around = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size")
    tops = tops.select("base", around, "top").groupBy("base", "size").agg(F.max("top").alias("top"))
    best = differences.groupBy("base").agg(F.max(F.struct("spare", "uid")).alias("m"))
    best = best.select("base", F.col("m.spare").alias("most"), F.col("m.uid").alias("center"))
    rows = rows.join(tops, ["base", "size"]).join(best, "base")
    near = F.col("spare") + F.col("most") >= 0
    fewest = F.when(near, F.col("most") - F.col("spare")).otherwise(-(F.col("spare") + F.col("top"))) / p.unit
    first = F.greatest(F.lit(0), F.col("delta") - F.greatest(F.lit(1), F.ceil(fewest)) + 1)
    rows = rows.withColumn("near", near).withColumn("first", F.slice("apart", F.lit(1), first.cast("int")))
    maps = [f"w{w}" for w in range(MAP_WORDS)]
    return rows.select("base", "uid", "n", "group", "delta", "spare", "near", "center", *maps, F.explode_outer("first").alias("token"))


def _at_common_tokens(differences: DataFrame, p: Join) -> tuple[DataFrame, DataFrame]:
    """``a, b``: links that are sure, and pairs that may link, of sets that share common tokens alone.

    They meet at one of their first differences, see :func:`_parts`, if the maps leave room for as many as
    they must share.
    """
    parts = stored(_parts(differences, p), "parts")
    sure = parts.where(F.col("near") & (F.col("uid") != F.col("center"))).select(F.col("uid").alias("a"), F.col("center").alias("b")).distinct()
    parts = parts.drop("center").where(F.col("token").isNotNull())
    other = parts.select(*(F.col(c).alias(f"{c}2") for c in parts.columns))

    def room(delta: str, mine: str, theirs: str) -> Column:
        lone = sum((F.bit_count(F.col(f"w{w}{mine}").bitwiseAND(F.bitwise_not(F.col(f"w{w}{theirs}")))) for w in range(MAP_WORDS)), F.lit(0))
        return F.col(delta) - lone

    shared = F.least(room("delta", "", "2"), room("delta2", "2", ""))
    fit = F.expr("base = base2 and token = token2 and uid < uid2 and `group` <> group2 and not (near and near2)")
    fit = fit & _near_size(p, "n", "n2") & (p.unit * shared >= -(F.col("spare") + F.col("spare2")))
    pairs = parts.join(other, fit).select(F.col("uid").alias("a"), F.col("uid2").alias("b"))
    return sure, pairs.distinct()


def _links(classes: DataFrame, docs: DataFrame, levels: Broadcast, p: Join) -> DataFrame:
    """``node, label``: the component of each set that links to another.

    First each set is compared with the most typical set of its prefix tokens; then only sets of
    different components meet, so a large group of near copies costs rows in proportion to it. Sets that
    share common tokens alone meet at what sets them apart from the base of their group.
    """
    postings = _postings(classes, p)
    share = postings.groupBy("uid", "n").agg(F.count("*").alias("k"))
    typical = share.select("uid", (F.col("k") / F.col("n")).alias("typical"))
    pivot = postings.join(typical, "uid").groupBy("token").agg(
        F.max(F.struct("typical", F.col("n").alias("m"), F.col("uid").alias("b"))).alias("best")
    )
    first = postings.join(pivot, "token").select(F.col("uid").alias("a"), "n", "best.b", "best.m")
    first = first.where("a <> b").where(_near_size(p, "n", "m")).groupBy("a", "b", "n").agg(F.count("*").alias("k"))
    first = first.where(2 * F.col("k") >= p.fewest("n"))  # what this misses meets below
    order = Window.partitionBy("a").orderBy(F.desc("k"), "b")
    first = first.withColumn("r", F.row_number().over(order)).where("r <= 2").select("a", "b")
    lists = stored(postings.groupBy("uid", "n").agg(F.collect_list("token").alias("tokens")), "lists")

    chosen = stored(_adapted(postings, p), "prefixes")
    sets = _whole_sets(classes, lists.select("uid"), docs, p)
    stars = components(_verified(_likely(first, lists, p), sets, p))

    own = chosen.join(stars.withColumnRenamed("node", "uid"), "uid", "left")
    own = own.select("token", "uid", "n", "matches", "need", "alone", F.coalesce("label", "uid").alias("group"))
    met = _side_by_side(own.where("not alone"), p).groupBy("a", "b").agg(
        F.count("*").alias("k"),
        F.first(F.expr("case when matches < matches2 then need when matches > matches2 then need2 else greatest(need, need2) end")).alias("need"),
    )
    pairs = _likely(met.where("k >= need").select("a", "b"), lists, p)
    members = stored(_members(own, pivot), "members-of-bases")
    sure, close = _at_common_tokens(_differences(members, sets, levels, p), p)
    more = _verified(pairs.union(close).distinct(), sets, p)
    more = more.union(sure).union(stars.select(F.col("node").alias("a"), F.col("label").alias("b")))
    return components(more)


def near_duplicates(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, first_id, first_th, n_rows`` of every row, equal rows once.

    A row's set holds the distinct shingles of ``p.words`` consecutive words, ASCII capitals made
    small, words parted at ASCII white space; fewer words are one shingle. Two rows link when
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest doc_id that links
    reach (null only if all their ids are null), ``first_id`` and ``first_th`` the row that stays for
    the component: the smallest id, nulls last, then the smallest hash of the text. Rows without words
    have an empty set and link to nothing. ``n_rows`` counts rows equal in id and text.
    """
    bound_batches(docs.sparkSession)
    own = _keyed(docs)
    bits = _table_bits(own)
    described = _described(own, p, bits)
    levels = shipped(docs.sparkSession, _levels(described, bits))
    classes = _classes(own, levels, p)
    label = _links(classes, own, levels, p).withColumnRenamed("node", "uid")
    named = classes.select("uid", "digest").join(label, "uid", "left")
    named = named.select("digest", F.coalesce("label", "uid").alias("group"))
    rows = described.where("block is null").groupBy("doc_id", "th").agg(
        F.count("*").alias("n_rows"), F.first("n").alias("n_shingles"), F.first("digest").alias("digest")
    )
    full = rows.where("n_shingles > 0").join(named, "digest")
    full = stored(full.select("doc_id", "th", "n_shingles", "n_rows", "group"), "members")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    first = full.groupBy("group").agg(F.min(place).alias("f"), F.min("doc_id").alias("component_id"))
    linked = full.join(first, "group").select(
        "doc_id", "th", "n_shingles", "component_id", F.col("f.doc_id").alias("first_id"), F.col("f.th").alias("first_th"), "n_rows"
    )
    empty = rows.where("n_shingles = 0").select(
        "doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("first_id"), F.col("th").alias("first_th"), "n_rows"
    )
    return linked.union(empty)


def component_report(docs: DataFrame, p: Join) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    found = near_duplicates(docs, p)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows")))
    return found.select("doc_id", "n_shingles", "component_id", copies.alias("copy")).drop("copy")


def drop_near_duplicates(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """One document of every component, unchanged; rows without words all stay."""
    found = near_duplicates(docs, p).select(
        F.col("doc_id").alias("k_id"),
        F.col("th").alias("k_th"),
        ((F.col("n_shingles") > 0) & (F.col("n_rows") > 1)).alias("again"),
        (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("th") == F.col("first_th"))).alias("stays"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th"))
    own = whole(docs, "_doc", "doc_id", "text").select("_doc", "doc_id", F.xxhash64("text").alias("th"))
    kept = own.join(found.where("stays"), same)
    once = kept.where("again").groupBy("k_id", "k_th").agg(F.first("_doc").alias("_doc"))
    return unpack(kept.where("not again").select("_doc").union(once.select("_doc")), "_doc", docs)
