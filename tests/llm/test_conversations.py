"""Conversation repair: against all edits of short ones, and a plain pass over long ones."""

import binascii
import hashlib
import itertools
import random
import re

from docharbor.llm.conversations import GONE, DONE, costs_of, damaged, power, repair, repair_report, repaired_rows, unroll

SCHEMA = "conv_id long, turn long, role string, text string, TEXT int, Role string"
SPACE = " \t\n\x0b\f\r"
LEGAL = re.compile(r"(s?(ua)+)?")
NAME = {"u": "user", "a": "assistant"}


def least(codes):
    """Cost and audit by trying every audit with up to two insertions anywhere."""
    best = None
    gaps = len(codes) + 1
    for letters in itertools.product("DKR", repeat=len(codes)):
        if any(c == GONE and x != "D" for c, x in zip(codes, letters)):
            continue
        for added in itertools.product(range(3), repeat=gaps):
            seq = []
            for i in range(gaps):
                seq += ["I"] * added[i] + ([(letters[i], codes[i])] if i < len(codes) else [])
            roles, cost = "", 0
            for x in seq:
                letter, code = x if isinstance(x, tuple) else (x, None)
                free = "u" if not roles or roles[-1] in "sa" else "a"
                cost += {"I": 5, "D": 2, "K": 0, "R": 1}[letter] + (5 if letter in "KR" and code >= 4 else 0)
                if letter != "D":
                    roles += "suax"[code % 4] if letter == "K" else free
            if LEGAL.fullmatch(roles):
                audit = "".join(x if x == "I" else x[0] for x in seq)
                best = min(best or (cost, audit), (cost, audit))
    return best


def test_short_conversations_against_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 3, 3, 4, 4):
        for _ in range(12 if n else 1):
            codes = bytes(rng.choice((0, 1, 1, 2, 2, 3, 4, 5, 6, 7, GONE)) for _ in range(n))
            audit, state = unroll(codes, 0, DONE)
            cost = min(c + d for c, d in zip(costs_of(codes)[0], DONE))
            assert (cost, audit + "I" * (DONE[state] // 5)) == least(codes), codes


def test_powers_are_repeated_steps():
    for symbol in (*range(8), GONE):
        assert power(symbol, 3) == costs_of(bytes([symbol] * 8))


def fate(conv, turn):
    return binascii.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def plain(conv_rows):
    """One conversation's report, row after row."""
    rows = []
    for conv, turn, role, text, *_ in conv_rows:
        role, text, f = role if role is not None else " ", text if text is not None else " ", fate(conv, turn)
        if f == 0:
            continue
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        rows += [(turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    key = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), key(r)))
    seen, codes, count = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if kind is not None:
            count[kind] += 1
        codes.append(GONE if kind in (0, 1) else {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + 4 * (kind == 2))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    follow = (2, 2, 3, 2)
    togo = [DONE]
    for c in reversed(codes):
        after = togo[-1]
        here = []
        for s in range(4):
            paid, best, now = 0, 1 << 60, s
            for _ in range(4):
                best = min([best, *(paid + cost + after[to] for _, cost, to in moves(c, now))])
                paid, now = paid + 5, follow[now]
            here.append(best)
        togo.append(tuple(here))
    togo.reverse()
    state, audit, out = 0, "", []
    for i, (c, (_, role, text)) in enumerate(zip(codes, rows)):
        while True:
            fit = [(x, to) for x, cost, to in moves(c, state) if cost + togo[i + 1][to] == togo[i][state]]
            if 5 + togo[i][follow[state]] == togo[i][state]:
                fit.append(("I", follow[state]))
            letter, state = min(fit)
            audit += letter
            if letter == "I":
                out.append(("user:", "assistant:")[state - 2])
                continue
            if letter != "D":
                out.append((role if letter == "K" else ("user", "assistant")[state - 2]) + ":" + text)
            break
    while DONE[state]:
        state = follow[state]
        audit += "I"
        out.append(("user:", "assistant:")[state - 2])
    return (gaps, *count, illegal, togo[0][0], audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def moves(c, s):
    out = [("D", 2, s)]
    if c != GONE:
        more, follow = 5 * (c >= 4), (2, 2, 3, 2)[s]
        if c % 4 == 0 and s == 0:
            out.append(("K", more, 1))
        elif c % 4 + 1 == follow:
            out.append(("K", more, follow))
        out.append(("R", 1 + more, follow))
    return out


def made(rng):
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "u2"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "No", " ", None, "", f"t{turn}é!", f"{conv} {turn}. \n", "a\x85"])
            rows += [(conv, turn if rng.random() < 0.9 else rng.choice([None, 2, 12]), role, text, 1, "r")] * rng.choice([1, 1, 1, 2])
    rows += [(900, t, r, "x" * 3_000_000 + "." * (t % 2), 1, "r") for t, r in ((1, "user"), (2, "assistant"), (3, "user"))]
    rows += [(901, None, None, None, 1, "r")] * 3
    return rows


def compare(spark, rows):
    found = {r[0]: tuple(r)[1:] for r in repair_report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    wanted = {}
    for r in rows:
        wanted.setdefault(r[0], []).append(r)
    assert set(found) == set(wanted)
    for conv, own in wanted.items():
        assert found[conv] == plain(own), conv


def test_report_of_odd_rows(spark):
    compare(spark, made(random.Random(5)))


def test_a_conversation_of_very_many_rows(spark):
    rng = random.Random(6)
    rows = [(7, t, rng.choice(["user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"n{t}."]), 1, "r") for t in range(30_000)]
    rows += [(7, 500, "user", "again.", 1, "r")] * 9_000 + [(7, None, "system", "s.", 1, "r"), (8, 1, "user", "x.", 1, "r")]
    compare(spark, rows)


def test_repaired_rows_are_legal(spark):
    rows = spark.createDataFrame(made(random.Random(7)), SCHEMA)
    out = {}
    for r in repaired_rows(repair(rows).where("whole")).collect():
        out.setdefault(r.conv_id, []).append((r.piece, r.place, r.role))
    assert out
    for own in out.values():
        assert LEGAL.fullmatch("".join(role[:1] for *_, role in sorted(own)))


def test_damage_and_no_rows(spark):
    gone = [i for i in range(200) if fate(i, 0) == 0][:3]
    compare(spark, [(i, 0, "user", "x.", 1, "r") for i in gone])
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_report(empty).collect() == [] and repair(empty).collect() == []
    kinds = {fate(i, 0): i for i in range(200)}
    rows = spark.createDataFrame([(i, 0, "assistant", "A. b!", 1, "r") for i in kinds.values()], SCHEMA)
    out = {}
    for r in damaged(rows).collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    assert kinds[0] not in out and out[kinds[1]] == [("assistant", "")] and out[kinds[2]] == [("assistant", "A b")]
    assert out[kinds[3]] == [("assistant", "A. b!")] * 2 and out[kinds[4]] == [("user", "A. b!")]
