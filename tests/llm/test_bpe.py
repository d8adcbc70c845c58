"""Encoding and decoding against the public library that made the vocabulary."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from docharbor.llm.bpe import Encoder, Transducer, Vocabulary, chunks, compiled, decode, parted, token_report

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, TEXT string, ids int, decoded int"


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def made(rng):
    letters = "abcXYZ éÉßΣσςİıK'’st123½ \n\t\x0b\x1c\x1d\x85\xa0　 ́一二ǅ😀中!?#$%‍\x00\x7f"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(600)]
    out += [" ".join(rng.choice(("the", "Thing", "eronble", "it's", "42", "...", "o'clock")) for _ in range(30)) for _ in range(40)]
    return out + ["", "a<|endoftext|>B <|startoftext|><|endoftext|> <|x|>", "x" * 500 + "'s'll", "ΑΣ ΣΑΣ.", "ab" * 4000, "!" * 3000]


def test_ids_and_texts_are_the_library_s(vocabulary, library):
    texts = made(random.Random(1))
    words = Counter(w for t in texts for c in chunks(t) for w in vocabulary.words(c) if isinstance(w, str))
    frequent = sorted(w.encode() for w, _ in words.most_common(200))
    encoder = Encoder(vocabulary, Transducer(frequent, [vocabulary.merge(w) for w in frequent]))
    for part in (texts, texts[::-1]):  # the second time all chunks are known
        ids, ends = encoder.encode(part)
        back = decode(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())), pa.array(vocabulary.tokens)).to_pylist()
        for i, t in enumerate(part):
            want = library.encode(t, add_special_tokens=False).ids
            assert ids[ends[i] : ends[i + 1]].tolist() == want, repr(t)
            assert back[i] == library.decode(want, skip_special_tokens=False)


def test_the_transducer_is_minimal_and_exact():
    words = sorted({b"tap", b"taps", b"top", b"tops", b"a", b"ab\xff"})
    t = Transducer(words, [[i, i + 1] for i in range(len(words))])
    maps = t.mapped()
    assert t.numbers(maps, [*words, b"ta", b"tapss", b"", b"zz"]).tolist() == [*range(len(words)), -1, -1, -1, -1]
    assert t.states == 7  # ap- and op- share all that follows
    assert [maps["ids"][maps["start"][i]] for i in range(len(words))] == list(range(len(words)))


def test_merging_many_words_equals_merging_each(vocabulary):
    rng = np.random.default_rng(4)
    words = [bytes(rng.choice(list(b"etaoinshrdlu\xc3\xa9"), rng.integers(1, 60)).tolist()) for _ in range(500)]
    ids, sizes = vocabulary.merge_many(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [vocabulary.merge(w) for w in words]


def test_the_report(spark, library, vocabulary):
    texts = [*made(random.Random(9))[::6], None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "Two Words")]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, token_report(df, PATH, size=50).collect()), key=str) == sorted(want, key=str)
    assert token_report(df.limit(0), PATH).count() == 0
    assert compiled(df, vocabulary, 5).states > 1


def test_long_words_at_the_default_size(spark, library):
    texts = ["a" * 5000, "!" * 3000 + " ab", "the cat " + "é" * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids_sha256 for r in token_report(df, PATH).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_long_words_stay_out_of_the_transducer(spark, vocabulary, library):
    rng = random.Random(9)
    long = "".join(rng.choice("acgt") for _ in range(1_000_000))
    rows = [(1, long, "x", 1, 2), (2, f"short {long[:129]} {long[:128]}", "x", 1, 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert compiled(docs, vocabulary).states < 1_000
    got = {r.doc_id: r.ids_sha256 for r in token_report(docs, PATH).collect()}
    for i, t, *_ in rows:
        want = library.encode(t, add_special_tokens=False).ids
        assert got[i] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()


def test_chunks_of_a_column_are_those_of_each_text():
    """Texts were parted one by one, and every chunk's words were sought by pattern."""
    texts = [*made(random.Random(2)), " \n", "a\x1cb c", "\x85é ü ", *(f"a{chr(c)}b" for c in range(0x3100) if not 0x1C <= c <= 0x1F)]
    for part in (texts, texts[700:]):
        flat, ends = parted(pa.array(["before it", *part]).slice(1))
        flat = flat.to_pylist()
        assert [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)] == [chunks(t) for t in part]
    assert [x.tolist() for x in parted(pa.array([], pa.string()))[1:]] == [[0]]


def test_words_of_many_chunks_are_those_of_each(vocabulary):
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    found = [*dict.fromkeys(c for t in made(random.Random(3)) for c in chunks(t))]
    found += [f"{a}{b}" for a in ("x", "é", "'", "1") for b in map(chr, range(0x21, 0x7F))] + letters[::50] + ["İ.", "é!", "l't", "İ"]
    for part in (found, [c for c in found if "<|" not in c], []):
        words, sizes = vocabulary.words_of(part)
        ends = np.cumsum([0, *sizes])
        assert [words[a:b] for a, b in zip(ends, ends[1:], strict=False)] == [vocabulary.words(c) for c in part]
