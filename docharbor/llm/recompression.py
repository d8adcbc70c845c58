"""Substring dedup by recompression: equal stretches get equal symbols in their interior."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from docharbor.llm.common import mixed, owner
from docharbor.llm.repeats import repeats

#: Words of a window, and the rounds: runs of one symbol, then pairs, get names of their own.
WINDOW = 35
ROUNDS = ("runs", "pairs", "pairs", "pairs", "runs", "pairs")
_GAP = 256
_U = np.uint64


def symbol_keys(size: int = WINDOW, rounds: tuple[str, ...] = ROUNDS):
    """The key of a window: the name of the longest symbol that its words alone decide.

    Names are hashes of what they stand for, so all tasks name alike without asking one another. Each
    symbol carries the stretch of words that decided it: its own, and those of the neighbours that
    might have joined it. Symbols whose stretch lies in a window are the same wherever the window
    stands; of those the longest is taken, then the one of the largest name. Words are symbols of the
    lowest level, so every window has a key, also in a run that is one symbol above.
    """

    def keys(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.zeros(0, _U)
        text = owner(ends)
        place = np.arange(len(words)) + _GAP * (text + 1)  # a stretch that leaves its text fits no window
        best = np.zeros(int(place[-1]) + 1 if len(place) else 0, _U)
        shift = _GAP * np.arange(1, len(ends))
        far = ends[:-1] + shift - _GAP // 2, ends[1:] + shift + _GAP // 2
        name, of = mixed(words), text
        low, high, length = place.copy(), place + 1, np.ones(len(words), np.int64)
        _offer(best, place, size, name, low, high, length)
        for r, kind in enumerate(rounds):
            first = _runs(name, of) if kind == "runs" else _pairs(name, of, r)
            lead = np.flatnonzero(first)
            last = np.r_[lead[1:], len(name)] - 1
            count = last - lead + 1
            joined = count > 1
            before, after = _beside(low, high, of, far, lead, last)
            if kind == "runs":
                new = mixed(name[lead] + mixed(count.astype(_U) + _U(r << 32)))
            else:
                new = mixed(name[lead] * _U(0x9E3779B97F4A7C15) + name[last] + _U(r))
                left = _left(name, r)[lead]  # it waits for a right symbol after it, others for a left one before
                before = np.where(joined | left, low[lead], before)
                after = np.where(joined | ~left, high[last], after)
            total = np.cumsum(length)
            length = total[last] - total[lead] + length[lead]
            name, of, low, high = np.where(joined, new, name[lead]), of[lead], before, after
            at = np.flatnonzero(joined)
            _offer(best, place, size, name[at], low[at], high[at], length[at])
        return best[place]

    return keys


def _left(name: np.ndarray, r: int) -> np.ndarray:
    """Half of all names, others in each round."""
    return (mixed(name + _U(r + 1)) & _U(1)) == 0


def _runs(name: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Where a run of equal names begins."""
    first = np.ones(len(name), bool)
    first[1:] = (name[1:] != name[:-1]) | (of[1:] != of[:-1])
    return first


def _pairs(name: np.ndarray, of: np.ndarray, r: int) -> np.ndarray:
    """Where a symbol begins when left names join the right names after them."""
    first, left = np.ones(len(name), bool), _left(name, r)
    first[1:] = ~(left[:-1] & ~left[1:] & (of[1:] == of[:-1]))
    return first


def _beside(low, high, of, far, lead, last) -> tuple[np.ndarray, np.ndarray]:
    """How far the words reach that decide both neighbours; out of the text where there is none."""
    first = (lead == 0) | (of[np.maximum(lead - 1, 0)] != of[lead])
    end = np.minimum(last + 1, len(of) - 1)
    final = (last + 1 == len(of)) | (of[end] != of[lead])
    before = np.where(first, far[0][of[lead]], low[np.maximum(lead - 1, 0)])
    return before, np.where(final, far[1][of[lead]], high[end])


def _offer(best, place, size, name, low, high, length) -> None:
    """Raises each window's best to the largest of these symbols that lie in it.

    The symbols of a window are neighbours in the arrays; maxima over powers of two answer for all.
    """
    if not len(name):
        return
    value = (np.minimum(length, size).astype(_U) << _U(57)) | (mixed(name) >> _U(7))
    span = len(best) + 1
    begins = np.cumsum(np.bincount(np.clip(low, 0, span - 1), minlength=span))
    finish = np.cumsum(np.bincount(np.clip(high, 0, span - 1), minlength=span))
    a = np.where(place > 0, begins[place - 1], 0)
    b = finish[np.minimum(place + size, span - 1)]
    b = np.where(place + size >= span - 1, np.searchsorted(high, place + size, "right"), b)
    width = b - a
    table = value
    for k in range(size.bit_length()):
        step = 1 << k
        use = np.flatnonzero((width >= step) & (width < 2 * step))
        if len(use):
            top = np.maximum(table[a[use]], table[b[use] - step])
            best[place[use]] = np.maximum(best[place[use]], top)
        if len(table) <= step:
            break
        table = np.maximum(table[:-step], table[step:])


def repeated_substrings(docs: DataFrame, *, size: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_repeated, spans, kept_sha256``; see :func:`docharbor.llm.repeats.repeats`."""
    return repeats(docs, size, symbol_keys(size))


def substring_report(docs: DataFrame, *, size: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``: the documents without their repeated words."""
    out = repeated_substrings(docs, size=size)
    return out.selectExpr("doc_id", "n_words", "n_repeated as n_removed", "kept_sha256")
