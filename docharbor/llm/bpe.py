"""BPE encoding and decoding through a minimal acyclic transducer of frequent words."""

from __future__ import annotations

import heapq
import json
import re
import tempfile
import unicodedata
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.llm.common import pick, received, shipped, slices, stored, whole

#: Words in the transducer, and words and chunks that a task keeps besides.
FREQUENT_WORDS = 100_000
#: Bytes of a word in the transducer.
LONGEST_WORD = 128
KEPT_WORDS = 250_000
_NO_RANK = 1 << 40
# str.split() also parts at the four separators 1C-1F, which are no white space here.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def chunks(text: str) -> list[str]:
    """The text parted at white space; neither words nor merges go across it."""
    if _SEPARATORS.search(text):
        return [c for c in _WHITE.split(text) if c]
    return text.split()


def parted(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``(chunks, ends)`` of the texts in a row, see :func:`chunks`."""
    if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
        lists = pa.array([chunks(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    else:
        lists = pc.utf8_split_whitespace(texts)
    flat = lists.flatten()
    some = pc.greater(pc.binary_length(flat), 0)  # white space at an end has an empty chunk beyond it
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
    return flat.filter(some), before[ends]


# Letters and numerals, by code point in base 16, that the regex module knows but the
# tables of the public tokenizers (Unicode 16) don't have yet; they count as signs.
_LATER = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7E2 A7F1 A7DD AB6C-AB6D 107BB-107BF
10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F
12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2
18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF
1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD"""
# Capitals of Unicode 16 and 17 that str.lower() of this Python may not know.
_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_CAPITALS |= {0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
_CAPITALS |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
_CAPITALS |= {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
# Each capital becomes small on its own: a sigma has no final form.
_CAPITALS |= {ord("Σ"): ord("σ")}
_new = "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in _LATER.split())
_PARTS = (
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_new}]]+|[\p{{N}}--[{_new}]]"
    rf"|[[^\p{{White_Space}}\p{{L}}\p{{N}}]||[{_new}]]+"
)
_PART = regex.compile(_PARTS)
# A sign behind letters is a word of its own.
_SIGNS = frozenset("!#$%&()*+,-./:;=?@[]_|}~\"")
_ANY_CAPITAL = re.compile("[" + "".join(map(chr, _CAPITALS)) + "]")


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself if printable, else one from U+0100 on."""
    plain = [b for r in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(r[0], r[1] + 1)]
    other = [b for b in range(256) if b not in plain]
    return [chr(b if b in plain else 256 + other.index(b)) for b in range(256)]


def normal(text: str) -> str:
    """Composed and in lower case."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return (text.translate(_CAPITALS) if _ANY_CAPITAL.search(text) else text).lower()


class Vocabulary:
    """A public BPE vocabulary with word ends: lower case, white space dropped."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(chain(ids.values(), self.special.values())) + 1
        self.tokens = [""] * size
        for token, i in chain(ids.items(), self.special.items()):
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + self.end] for c in letters]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a] << 32 | ids[b]] = (rank, ids[a + b])
        self._pairs = np.array(sorted((k, *v) for k, v in self.merges.items()), np.int64)
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def words(self, chunk: str) -> list[str | int]:
        """The words of a chunk, normalised; a special token is its id."""
        if self._special and "<" in chunk:
            parts = self._special.split(chunk)
        else:
            parts = [chunk]
        out: list[str | int] = []
        for p in parts:
            if p in self.special:
                out.append(self.special[p])
            elif p:
                out += _PART.findall(normal(p))
        return out

    def words_of(self, chunks: list[str]) -> tuple[list[str | int], list[int]]:
        """The words of many chunks in a row, and how many each chunk has."""
        joined = "\n".join(chunks)
        if any(t in joined for t in self.special):
            lists = [self.words(c) for c in chunks]
            return [*chain.from_iterable(lists)], [*map(len, lists)]
        out: list[str | int] = []
        sizes, find = [], _PART.findall
        for c in normal(joined).split("\n") if chunks else []:
            if c.isalpha():
                out.append(c)
                sizes.append(1)
            elif c[-1:] in _SIGNS and c[:-1].isalpha():
                out += (c[:-1], c[-1])
                sizes.append(2)
            else:
                parts = find(c)
                out += parts
                sizes.append(len(parts))
        return out, sizes

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word by the merges in order of rank, leftmost first."""
        s = [self.inner[b] for b in word]
        s[-1] = self.last[word[-1]]
        if len(s) > 48:
            return self._merge_long(s)
        get = self.merges.get
        pairs = [get(a << 32 | b) for a, b in zip(s, s[1:], strict=False)]
        while True:
            best = min((p for p in pairs if p), default=None)
            if best is None:
                return s
            i = pairs.index(best)
            s[i : i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(s[i - 1] << 32 | s[i])
            if i < len(pairs):
                pairs[i] = get(s[i] << 32 | s[i + 1])

    def merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)`` of many words in a row: every step merges one pair of each word."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        sizes = np.ones(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        inner, last = np.array(self.inner), np.array(self.last)
        for low, high in ((0, 6), (6, 9), (9, 12), (12, 16), (16, 24), (24, 48)):
            rows = np.flatnonzero((size > low) & (size <= high))
            if not len(rows):
                continue
            flat = np.frombuffer(b"".join(words[i] for i in rows.tolist()), np.uint8)
            own, width = size[rows], high
            mask = np.arange(width) < own[:, None]
            ids = np.full((len(rows), width), -1, np.int64)
            ids[mask] = inner[flat]
            ids[np.arange(len(rows)), own - 1] = last[flat[np.cumsum(own) - 1]]
            rank, new = self._ranks(ids[:, :-1], ids[:, 1:])
            while len(rows):
                best = rank.argmin(1)
                at = np.arange(len(rows))
                done = rank[at, best] == _NO_RANK
                if done.any():
                    sizes[rows[done]] = (ids[done] >= 0).sum(1)
                    parts.append((rows[done], ids[done]))
                    rows, ids, rank, new, best = (x[~done] for x in (rows, ids, rank, new, best))
                    at = np.arange(len(rows))
                    if not len(rows):
                        break
                ids[at, best] = new[at, best]
                width -= 1
                stay = np.arange(width + 1) != (best + 1)[:, None]
                ids = ids[stay].reshape(-1, width)
                if width < 2:
                    sizes[rows] = 1
                    parts.append((rows, ids))
                    break
                stay = np.arange(width) != best[:, None]
                rank, new = rank[stay].reshape(-1, width - 1), new[stay].reshape(-1, width - 1)
                for side in (best - 1, best):
                    ok = np.flatnonzero((side >= 0) & (side < width - 1))
                    j = side[ok]
                    rank[ok, j], new[ok, j] = self._ranks(ids[ok, j], ids[ok, j + 1])
        long = {i: self.merge(words[i]) for i in np.flatnonzero(size > 48).tolist()}
        for i, x in long.items():
            sizes[i] = len(x)
        start = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.int32)
        for rows, ids in parts:
            mask = ids >= 0
            out[(start[rows][:, None] + np.arange(ids.shape[1]))[mask]] = ids[mask]
        for i, x in long.items():
            out[start[i] : start[i] + len(x)] = x
        return out, sizes

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair's rank and merged id."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self._pairs[:, 0], key), len(self._pairs) - 1)
        ok = (self._pairs[at, 0] == key) & (a >= 0) & (b >= 0)
        return np.where(ok, self._pairs[at, 1], _NO_RANK), self._pairs[at, 2]

    def _merge_long(self, s: list[int]) -> list[int]:
        """The same with a heap and links, for words of any length."""
        get, n = self.merges.get, len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p[0], i, s[i], s[i + 1], p[1]) for i in range(n - 1) if (p := get(s[i] << 32 | s[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue
            s[i], s[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := get(s[x] << 32 | s[y])):
                    heapq.heappush(heap, (p[0], x, s[x], s[y], p[1]))
        return [x for x in s if x >= 0]


class Transducer:
    """A minimal acyclic automaton over bytes whose edges add up to a word's number.

    Equal ends of words share their states; the number points to the word's ids. All arrays lie
    one after the other in one block, which a task maps into memory.
    """

    def __init__(self, words: list[bytes], ids: list[list[int]]) -> None:
        """``words`` sorted and distinct, ``ids`` beside them."""
        register: dict = {}
        open_edges: list = []
        root: dict = {}
        final, before = set(), b""

        def close(down_to: int) -> None:
            while len(open_edges) > down_to:
                parent, label, child = open_edges.pop()
                key = (id(child) in final, *((c, id(n)) for c, n in child.items()))
                if key in register:
                    final.discard(id(child))  # the node goes, and its id() may come again
                    parent[label] = register[key]
                else:
                    register[key] = child

        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(word, before, strict=False)) if a != b), min(len(word), len(before)))
            close(same)
            node = open_edges[-1][2] if open_edges else root
            for label in word[same:]:
                node[label] = child = {}
                open_edges.append((node, label, child))
                node = child
            final.add(id(node))
            before = word
        close(0)

        number, count = {id(root): 0}, {}
        order, stack = [root], [root]
        while stack:
            for child in stack.pop().values():
                if id(child) not in number:
                    number[id(child)] = len(order)
                    order.append(child)
                    stack.append(child)

        # Children come before parents: a word may be longer than Python's stack is deep.
        stack = [(root, False)]
        while stack:
            node, ready = stack.pop()
            if ready:
                count[id(node)] = (id(node) in final) + sum(count[id(c)] for c in node.values())
            elif id(node) not in count:
                stack.append((node, True))
                stack += [(c, False) for c in node.values() if id(c) not in count]

        edges = []
        for node in order:
            add = int(id(node) in final)
            for label, child in node.items():
                edges.append((number[id(node)] << 8 | label, number[id(child)], add))
                add += count[id(child)]
        edges.sort()
        table = np.array(edges or [(-1, 0, 0)], np.int64)
        arrays = {
            "key": table[:, 0],
            "next": table[:, 1],
            "add": table[:, 2],
            "final": np.array([id(n) in final for n in order], np.int64),
            "start": np.cumsum([0, *map(len, ids)]).astype(np.int64),
            "ids": np.array([*chain.from_iterable(ids)], np.int64),
        }
        self.states = len(order)
        self.places = {}
        place = 0
        for name, a in arrays.items():
            self.places[name] = (place, len(a))
            place += a.nbytes
        self.block = b"".join(a.tobytes() for a in arrays.values())

    def mapped(self) -> dict[str, np.ndarray]:
        """The arrays as a memory map of an unnamed temporary file."""
        f = tempfile.TemporaryFile()
        f.write(self.block)
        f.flush()
        return {
            name: np.memmap(f, np.int64, "r", place, n) if n else np.zeros(0, np.int64)
            for name, (place, n) in self.places.items()
        }

    @staticmethod
    def numbers(maps: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 if the transducer doesn't have it; all words step at once."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero(size > 0)
        total[size == 0] = -1
        step = 0
        while len(alive):
            key = state[alive] << 8 | flat[start[alive] + step]
            at = np.minimum(np.searchsorted(maps["key"], key), len(maps["key"]) - 1)
            ok = maps["key"][at] == key
            total[alive[~ok]] = -1
            alive, at = alive[ok], at[ok]
            state[alive] = maps["next"][at]
            total[alive] += maps["add"][at]
            step += 1
            done = size[alive] == step
            ended = alive[done]
            total[ended[maps["final"][state[ended]] == 0]] = -1
            alive = alive[~done]
        return total


class Encoder:
    """Encodes chunks in a task: the transducer, then exact merges; keeps what it has met."""

    def __init__(self, vocabulary: Vocabulary, transducer: Transducer) -> None:
        self.vocabulary, self.transducer = vocabulary, transducer
        self.maps = transducer.mapped()
        self._forget()

    def _forget(self) -> None:
        self.chunks, self.words = {}, {}
        self.chunk_ids, self.word_ids = _Pool(), _Pool()

    def _learn(self, new: list[str]) -> None:
        """Keeps the ids of new chunks, made of the ids of their words."""
        parts, times = self.vocabulary.words_of(new)
        distinct = list(set(parts).difference(self.words))
        plain = [w for w in distinct if isinstance(w, str)]
        special = [w for w in distinct if isinstance(w, int)] if len(plain) < len(distinct) else []
        raw = [w.encode() for w in plain]
        number = self.transducer.numbers(self.maps, raw)
        known, rare = np.flatnonzero(number >= 0), np.flatnonzero(number < 0).tolist()
        start, pool = self.maps["start"], self.maps["ids"]
        first = start[number[known]]
        sizes = start[number[known] + 1] - first
        self.word_ids.add(pool[_ranges(first, sizes)], sizes)
        self.word_ids.add(*self.vocabulary.merge_many([raw[i] for i in rare]))
        self.word_ids.add(np.array(special, np.int32), np.ones(len(special), np.int64))
        names = chain((plain[i] for i in known.tolist()), (plain[i] for i in rare), special)
        self.words.update(zip(names, range(len(self.words), len(self.words) + len(distinct)), strict=True))
        code = np.fromiter(map(self.words.__getitem__, parts), np.int64, len(parts))
        ids, size = self.word_ids.of(code)
        before = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *times])]
        self.chunk_ids.add(ids, np.diff(before))
        self.chunks.update(zip(new, range(len(self.chunks), len(self.chunks) + len(new)), strict=True))

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)`` of the texts in a row."""
        flat, sizes = parted(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        if max(len(self.chunks), len(self.words)) > KEPT_WORDS:
            self._forget()
        flat = flat.dictionary_encode()
        names = _listed(flat.dictionary)
        known = self.chunks
        new = [c for c in names if c not in known]
        if new:
            self._learn(new)
        own = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        ids, size = self.chunk_ids.of(own[flat.indices.to_numpy()])
        return ids, np.concatenate([[0], np.cumsum(size)])[sizes]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of stretches laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class _Pool:
    """Lists of ids, numbered as they are added."""

    def __init__(self) -> None:
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, np.asarray(ids, np.int32)])
        self.sizes = np.concatenate([self.sizes, np.asarray(sizes, np.int64)])

    def of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(self.sizes) - self.sizes
        size = self.sizes[code]
        return self.ids[_ranges(starts[code], size)], size


def decode(ids: pa.Array, tokens: pa.Array) -> pa.Array:
    """Lists of ids to texts: the tokens joined by a space, special ones too."""
    named = pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values))
    return pc.binary_join(named, " ")


def _listed(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


def _strings(batch: pa.RecordBatch) -> pa.Array:
    return pc.fill_null(batch.column("text"), b"").cast(pa.string())


def word_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, n`` over all texts; tasks count first and send each word once or a few times."""
    shared = shipped(docs.sparkSession, vocabulary)

    def rows(counts: Counter, vocabulary: Vocabulary) -> pa.RecordBatch:
        words: dict[str, int] = {}
        found, sizes = vocabulary.words_of(list(counts))
        seen = words.get
        for w, n in zip(found, np.repeat(np.fromiter(counts.values(), np.int64, len(counts)), sizes).tolist(), strict=True):
            words[w] = seen(w, 0) + n
        for i in vocabulary.special.values():
            words.pop(i, None)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"]
        )

    def count(batches):
        vocabulary, counts = received(shared), Counter()
        for batch in slices(batches, "text"):
            found = parted(_strings(batch))[0].value_counts()
            counts.update(dict(zip(_listed(found.field(0)), _listed(found.field(1)), strict=True)))
            if len(counts) > KEPT_WORDS:
                yield rows(counts, vocabulary)
                counts.clear()
        yield rows(counts, vocabulary)

    source = pick(docs, "text").select(F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compiled(
    docs: DataFrame, vocabulary: Vocabulary, size: int = FREQUENT_WORDS, longest: int = LONGEST_WORD
) -> Transducer:
    """The transducer of at most ``size`` of the most frequent words of the texts, each of ``longest`` bytes at most.

    So it has a bound in bytes too; longer words are merged like unseen ones.

    Words count as equally frequent within a 32nd of a power of two: the most frequent such classes
    that hold ``size`` words together are taken, so that no task sorts and no words but those travel.
    """
    short = word_counts(docs, vocabulary).where(F.octet_length("word") <= longest)
    counts = stored(short.withColumn("class", F.floor(32 * F.log2("n"))), "words")
    classes = counts.groupBy("class").count().orderBy(F.desc("class")).collect()  # some 2,000 at most
    total, least = 0, None
    for c in classes:
        total += c["count"]
        if total <= size:
            least = c["class"]
    frequent = counts.where(F.col("class") >= least).select("word").collect() if least is not None else []
    words = sorted(r["word"].encode() for r in frequent)
    ids, sizes = vocabulary.merge_many(words)
    return Transducer(words, [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if words else [])


def encode_and_decode(docs: DataFrame, path: str, *, size: int = FREQUENT_WORDS) -> DataFrame:
    """All columns of ``docs`` in ``_doc`` beside ``ids`` and ``decoded``, from whole texts.

    A null text is an empty one: no ids, an empty text. Vocabulary and transducer have fixed bounds
    and are broadcast. The strings of special tokens in a text are those tokens.
    """
    vocabulary = Vocabulary(path)
    shared = shipped(docs.sparkSession, (vocabulary, compiled(docs, vocabulary, size)))

    def run(batches):
        vocabulary, transducer = received(shared)
        encoder, tokens = Encoder(vocabulary, transducer), pa.array(vocabulary.tokens, pa.string())
        for batch in slices(batches, "text"):
            ids, ends = encoder.encode(_strings(batch))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, "ids", lists).append_column("decoded", decode(lists, tokens))

    source = whole(docs, "_doc", "text").select("_doc", F.col("text").cast("binary").alias("text"))
    schema = source.select("_doc", F.array().cast("array<int>").alias("ids"), F.lit("").alias("decoded")).schema
    return source.mapInArrow(run, schema)


def token_report(docs: DataFrame, path: str, **params) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    out = encode_and_decode(pick(docs, "doc_id", "text"), path, **params)
    return out.select(
        F.col("_doc._0").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
