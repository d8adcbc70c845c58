"""Conversation structure repair: the cheapest edits, by a min-plus DP over runs of equal symbols.

A legal conversation is an optional system turn and then pairs of a user's and an assistant's turn, or
nothing. Rows are sorted over all tasks and cut into pieces of bounded size, so a conversation of any length
is spread; only a piece's 4 x 4 costs, not its rows, pass through a task that holds all of one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docharbor.llm.common import pick, slices, stored

#: Rows and bytes of text of one piece; one longer text is a piece of its own.
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20

SPACES = b" \t\n\x0b\f\r"
ENDS = b".!?"
INSERT, DELETE, REROLE, CUT_OFF = 5, 2, 1, 5

#: States: nothing yet, or the role that came last; and the one that an insertion or a new role leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: a role's place here, four more if its text is cut off; eight for a row that must go.
ROLES = {"s": 0, "u": 1, "a": 2}
OTHER, TRUNCATED, GONE = 3, 4, 8
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

FAR = 1 << 60
#: What is left to pay after the last row, by state.
DONE = (0, 2 * INSERT, INSERT, 0)

Costs = tuple[tuple[int, ...], ...]


def edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """``letter, cost, next state`` of what can be done with a row, by letter."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        role, more = symbol % TRUNCATED, CUT_OFF if symbol >= TRUNCATED else 0
        if (role, state) == (0, NOTHING):
            out.append(("K", more, SYSTEM))
        elif role + 1 == FOLLOWS[state]:
            out.append(("K", more, FOLLOWS[state]))
        out.append(("R", REROLE + more, FOLLOWS[state]))
    return out


def times(a: Costs, b: Costs) -> Costs:
    """The min-plus product: first ``a``, then ``b``."""
    return tuple(tuple(min(x + y for x, y in zip(row, column, strict=True)) for column in zip(*b, strict=True)) for row in a)


def before(costs: Costs, ahead: tuple[int, ...]) -> tuple[int, ...]:
    """What is left to pay before the rows of ``costs``, given what is left after them."""
    return tuple(min(x + y for x, y in zip(row, ahead, strict=True)) for row in costs)


@cache
def power(symbol: int, k: int) -> Costs:
    """The costs from state to state over ``2**k`` rows of one symbol, insertions before each allowed."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    out = []
    for state in range(4):
        row, paid, now = [FAR] * 4, 0, state
        for _ in range(4):
            for _, cost, to in edits(symbol, now):
                row[to] = min(row[to], paid + cost)
            paid, now = paid + INSERT, FOLLOWS[now]
        out.append(tuple(row))
    return tuple(out)


def runs(codes: bytes) -> list[tuple[int, int]]:
    """Equal consecutive symbols as ``symbol, number``."""
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(codes)]


def _powers(symbol: int, number: int) -> Iterator[Costs]:
    for k in range(number.bit_length()):
        if number >> k & 1:
            yield power(symbol, k)


def costs_of(codes: bytes) -> Costs:
    """The costs from state to state over all rows."""
    out = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
    for symbol, number in runs(codes):
        for p in _powers(symbol, number):
            out = times(out, p)
    return out


def unroll(codes: bytes, state: int, ahead: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least of the cheapest audits from ``state``, and the state that it ends in."""
    parts = []
    for symbol, number in reversed(runs(codes)):
        parts.append((symbol, number, ahead))
        for p in _powers(symbol, number):
            ahead = before(p, ahead)
    out = []
    for symbol, number, after in reversed(parts):
        left = [after]
        for _ in range(number):
            left.append(before(power(symbol, 0), left[-1]))
        for k in range(number, 0, -1):
            state = _one_row(symbol, state, left[k], left[k - 1], out)
    return "".join(out), state


def _one_row(symbol: int, state: int, now: tuple[int, ...], then: tuple[int, ...], out: list[str]) -> int:
    """The least letters that lead over one row at no more than the least cost; the state after it."""
    while True:
        choices = [(letter, to) for letter, cost, to in edits(symbol, state) if cost + then[to] == now[state]]
        if choices and choices[0][0] == "D":
            out.append("D")
            return state
        if INSERT + now[FOLLOWS[state]] == now[state]:
            out.append("I")
            state = FOLLOWS[state]
            continue
        out.append(choices[0][0])
        return choices[0][1]


def endings(state: int) -> list[str]:
    """The roles to be inserted after the last row."""
    out = []
    while DONE[state]:
        state = FOLLOWS[state]
        out.append(NAMES[state])
    return out


def _rebuilt(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits."""
    out, row = ([], []), 0
    for letter in audit:
        role, text = (None, "") if letter == "I" else (roles[row], texts[row])
        row += letter != "I"
        if letter == "D":
            continue
        state = SYSTEM if letter == "K" and state == NOTHING and role[:1] == "s" else FOLLOWS[state]
        out[0].append(role if letter == "K" else NAMES[state])
        out[1].append(text)
    return out


class _Piece:
    """Consecutive rows of one conversation, and what is counted over them."""

    def __init__(self) -> None:
        self.roles, self.texts, self.keys = [], [], []
        self.codes = bytearray()
        self.size = self.cut_off = self.illegal = self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, role: str, text: bytes, key: bytes) -> None:
        bare = text.rstrip(SPACES)
        if self.roles:
            self.illegal += (self.roles[-1][:1], role[:1]) not in LEGAL
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        cut_off = bool(bare) and bare[-1] not in ENDS
        self.codes.append(ROLES.get(role[:1], OTHER) + TRUNCATED * cut_off if bare else GONE)
        self.roles.append(role)
        self.texts.append(text.decode())
        self.keys.append(key)
        self.size += len(text)

    def full(self) -> bool:
        return len(self.codes) >= PIECE_ROWS or self.size >= PIECE_BYTES

    def row(self, conv, number: int, whole: bool) -> tuple:
        firsts = {k: i for i, k in reversed(list(enumerate(self.keys))) if self.codes[i] != GONE} if whole else {}
        return (conv, number, whole, self.roles, self.texts, bytes(self.codes), [] if whole else self.keys,
                sorted(firsts.values()), self.illegal, self.low, self.high, self.turns)


#: Of a piece: its rows, their symbols, keys of role and text, the places of first occurrences, and counts over it.
PIECE = (
    "piece long, whole boolean, roles array<string>, texts array<string>, codes binary, keys array<binary>,"
    " firsts array<int>, illegal long, low long, high long, turns long"
)
#: Of a repaired piece: the edits, the rows after them, and counts; the last piece has the state at its end.
REPAIRED = (
    "piece long, whole boolean, audit string, cost long, roles array<string>, texts array<string>, state int,"
    " blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
)


def _schema(like: DataFrame, fields: str) -> StructType:
    return StructType([like.schema["conv_id"], *StructType.fromDDL(fields)])


def _made(rows: list[tuple], schema: StructType, arrow: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, arrow.types, strict=True)], schema.names)


def _weight(value) -> int:
    """About the bytes of a cell."""
    if isinstance(value, list):
        return 8 + sum(map(_weight, value))
    return 8 + (len(value) if isinstance(value, (str, bytes)) else 0)


def _mapped(df: DataFrame, run: Callable[[Iterator[dict]], Iterator[tuple]], schema: StructType, size: str | None = None) -> DataFrame:
    """``run`` over a partition's rows as dictionaries, in order, its tuples gathered into bounded batches."""
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, size) if size else batches:
            yield from batch.to_pylist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for row in run(rows(batches)):
            held.append(row)
            weight += sum(map(_weight, row))
            if weight > 4 * PIECE_BYTES:
                yield _made(held, schema, arrow)
                held, weight = [], 0
        if held:
            yield _made(held, schema, arrow)

    return df.mapInArrow(work, schema)


def pieces(rows: DataFrame) -> DataFrame:
    """``conv_id`` and the fields of :data:`PIECE`: the rows sorted, in pieces numbered in their order.

    Rows are ordered by turn (null first), then role, then the SHA-256 of role and text. A conversation
    that lies in one piece, with others before and after it in its task, is ``whole``.
    """
    own = pick(rows, "conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    own = own.withColumn("key", row_key(F.col("role"), F.col("text"))).withColumn("salt", F.monotonically_increasing_id())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "key", "salt"]
    own = own.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("text", F.col("text").cast("binary"))
    schema = _schema(own, PIECE)

    def run(each: Iterator[dict]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << 33
        late, whole = None, False
        for conv, group in groupby(each, lambda r: r["conv_id"]):
            if late:
                yield late[0].row(*late[1:])
            piece = _Piece()
            for r in group:
                if piece.full():
                    yield piece.row(conv, number, False)
                    number, piece, whole = number + 1, _Piece(), False
                piece.add(r["turn"], r["role"], r["text"], r["key"])
            # The first and the last conversation of a task may go on in another one.
            late, number, whole = (piece, conv, number, whole), number + 1, True
        if late:
            yield late[0].row(*late[1:3], False)

    return _mapped(own.drop("salt"), run, schema, "text")


def row_key(role: Column, text: Column) -> Column:
    """The same for rows of equal role and text only."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def _streamed(df: DataFrame, run: Callable, fields: str, falling: bool = False) -> DataFrame:
    """``run`` over the pieces of each conversation in order: an iterator in, tuples out, nothing gathered."""
    piece = F.col("piece").desc() if falling else F.col("piece")
    ordered = df.repartition("conv_id").sortWithinPartitions("conv_id", piece)

    def each(rows: Iterator[dict]) -> Iterator[tuple]:
        for conv, group in groupby(rows, lambda r: r["conv_id"]):
            for out in run(group):
                yield (conv, *out)

    return _mapped(ordered, each, _schema(df, fields))


def _marked(codes: bytes, firsts: list[int] | None) -> tuple[bytes, int, int]:
    """The symbols with repeated rows to be deleted, and how many rows are blank and repeated."""
    keep = set(firsts or ())
    out = bytes(c if c == GONE or i in keep else GONE for i, c in enumerate(codes))
    blank = codes.count(GONE)
    return out, blank, out.count(GONE) - blank


def _repaired(df: DataFrame) -> DataFrame:
    """The pieces after the edits, given ``entry``, the state before them, and ``ahead``, what is left to pay after."""

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            codes, blank, duplicate = _marked(r["codes"], r["firsts"])
            audit, state = unroll(codes, r["entry"], tuple(r["ahead"]))
            roles, texts = _rebuilt(audit, r["entry"], r["roles"], r["texts"])
            if r["whole"]:
                more = endings(state)
                audit, roles, texts = audit + "I" * len(more), roles + more, texts + [""] * len(more)
            costs = before(costs_of(codes), tuple(r["ahead"]))[r["entry"]] - r["ahead"][state]
            yield (
                r["conv_id"], r["piece"], r["whole"], audit, costs + INSERT * len(endings(state)) * r["whole"], roles, texts, state,
                blank, duplicate, sum(TRUNCATED <= c < GONE for c in codes), r["illegal"],
                r["roles"][0][:1], r["roles"][-1][:1], r["low"], r["high"], r["turns"],
            )

    return _mapped(df, run, _schema(df, REPAIRED))


def repair(rows: DataFrame) -> DataFrame:
    """Conversations after the cheapest edits, as ``conv_id`` and the fields of :data:`REPAIRED`.

    ``rows`` has ``conv_id, turn, role, text``; a null role or text is one space. Keeping a row is free, another
    role costs 1, deletion 2, a new empty row 5, and a row that stays without a final ``.``, ``!`` or ``?`` 5 more.
    Blank rows, and rows whose role and text stand earlier, must go. Of equal costs the ASCII-least audit counts.
    A role counts by its first letter; one with another letter, or empty, can't be kept as it is. A null
    conversation is one as any other. A conversation's rows are those of its pieces in order; one that isn't
    ``whole`` is ended by :func:`endings` of the last piece's state. Without rows there are no pieces.
    """
    done, spread = _whole_and_spread(rows)
    return done.unionByName(spread)


def _whole_and_spread(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces of :func:`repair`: those that are whole, and the others."""
    cut = stored(pieces(rows), "conversation-pieces")
    here = F.lit(NOTHING).alias("entry"), F.lit(list(DONE)).cast("array<long>").alias("ahead")
    done = _repaired(cut.where("whole").select("*", *here))

    spread = cut.where(~F.col("whole"))
    rows_of = spread.select("conv_id", "piece", "codes", F.posexplode("keys").alias("at", "key"))
    rows_of = rows_of.where(F.substring("codes", F.col("at") + 1, F.lit(1)) != F.lit(bytes([GONE])))
    firsts = rows_of.groupBy("conv_id", "key").agg(F.min(F.struct("piece", "at")).alias("first"))
    firsts = firsts.groupBy("first.piece").agg(F.collect_list("first.at").alias("first_places"))
    known = spread.select("conv_id", "piece", "codes").join(firsts, "piece", "left")
    known = stored(known.withColumnRenamed("first_places", "firsts"), "conversation-symbols")

    def costs(group: Iterator[dict]) -> Iterator[tuple]:
        for r in group:
            yield r["conv_id"], r["piece"], [x for row in costs_of(_marked(r["codes"], r["firsts"])[0]) for x in row]

    def backwards(group: Iterator[dict]) -> Iterator[tuple]:
        ahead = DONE
        for r in group:
            yield r["piece"], list(ahead)
            ahead = before(tuple(tuple(r["costs"][4 * i : 4 * i + 4]) for i in range(4)), ahead)

    def exits(group: Iterator[dict]) -> Iterator[tuple]:
        for r in group:
            codes = _marked(r["codes"], r["firsts"])[0]
            yield r["conv_id"], r["piece"], [unroll(codes, s, tuple(r["ahead"]))[1] for s in range(4)]

    def forwards(group: Iterator[dict]) -> Iterator[tuple]:
        state = NOTHING
        for r in group:
            yield r["piece"], state
            state = r["exits"][state]

    paid = _mapped(known, costs, _schema(known, "piece long, costs array<long>"))
    ahead = _streamed(paid, backwards, "piece long, ahead array<long>", falling=True).drop("conv_id")
    ahead = stored(known.join(ahead, "piece"), "conversation-costs")
    out = _mapped(ahead, exits, _schema(known, "piece long, exits array<int>"))
    entry = _streamed(out, forwards, "piece long, entry int").drop("conv_id")
    state = ahead.select("piece", "firsts", "ahead").join(entry, "piece")
    return done, _repaired(spread.drop("firsts").join(state, "piece"))


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """``conv_id, piece, place, role, text`` of the rows in the pieces of :func:`repair`."""
    rows = repaired.select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row"))
    return rows.select("conv_id", "piece", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _joined(group: Iterator[dict]) -> Iterator[tuple]:
    """One row of :data:`REPORT` from a conversation's pieces: a running digest, no text is held."""
    digest, audit, rows, state = hashlib.sha256(), [], 0, NOTHING
    sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
    low = high = last = None
    for r in group:
        for role, text in zip(r["roles"], r["texts"], strict=True):
            digest.update(f"{chr(10) * (rows > 0)}{role}:{text}".encode())
            rows += 1
        audit.append(r["audit"])
        state = r["state"]
        for name in sums:
            sums[name] += r[name]
        sums["illegal"] += last is not None and (last, r["first"]) not in LEGAL
        sums["turns"] -= high is not None and high == r["low"]
        last, low, high = r["last"], r["low"] if low is None else low, high if r["high"] is None else r["high"]
    for role in endings(state):
        digest.update(f"{chr(10) * (rows > 0)}{role}:".encode())
        audit.append("I")
        rows, sums["cost"] = rows + 1, sums["cost"] + INSERT
    gaps = 0 if low is None else high - low + 1 - sums["turns"]
    yield gaps, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], sums["cost"], "".join(audit), digest.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults dealt by the CRC-32 of ``conv_id:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's. Nulls are one space.
    """
    own = pick(rows, "conv_id", "turn", "role", "text")
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    is_ = lambda n: F.col("fault") == n
    text = F.when(is_(1), "").when(is_(2), F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    role = F.when(is_(4), "user").otherwise(plain("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(is_(3), 2).otherwise(1)))
    out = own.withColumn("fault", fault).where("fault <> 0")
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("col")


def repair_report(rows: DataFrame) -> DataFrame:
    """``conv_id`` and the fields of :data:`REPORT` for every conversation of ``rows``, after :func:`damaged`.

    A conversation that the damage leaves without rows has zeros, an empty audit and the digest of nothing;
    rows equal in turn are ordered as :func:`pieces` says, so equal rows and ties have one result; an empty table
    has none. See :func:`repair` for nulls and costs.
    """
    done, parts = _whole_and_spread(damaged(rows))
    spread = _streamed(parts, _joined, REPORT)
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    whole = done.select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"),
    )
    found = whole.unionByName(spread).withColumnRenamed("conv_id", "c_id")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    every = pick(rows, "conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("c_id")), "left")
    return joined.select("conv_id", *(F.coalesce(n, F.lit(empty.get(n, 0))).alias(n) for n in StructType.fromDDL(REPORT).names))


def report_sql() -> str:
    """The report in DuckDB's SQL: row by row, the best audit of every state is kept."""
    moves = []
    for symbol in (*range(TRUNCATED * 2), GONE):
        for state in range(4):
            now, lines = state, []
            for added in range(4):
                for letter, cost, to in edits(symbol, now):
                    role = f"'{NAMES[to]}'" if letter == "R" else "null"
                    put = ", ".join(f"'{x}:'" for x in lines)
                    moves.append(
                        f"({symbol}, {state}, {to}, {cost + INSERT * added}, '{'I' * added + letter}', [{put}]::varchar[], {role})"
                    )
                now = FOLLOWS[now]
                lines = [*lines, NAMES[now]]
    last = ", ".join(
        f"({s}, {DONE[s]}, '{'I' * len(endings(s))}', [{', '.join(repr(x + ':') for x in endings(s))}]::varchar[])" for s in range(4)
    )
    spaces = " || ".join(f"chr({c})" for c in SPACES)
    number = "list_transform(string_split(k, ''), lambda c: ascii(c)::bigint)"
    byte = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, (v & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {number}), lambda crc, b: {byte}), 4294967295)"
    return f"""
    with recursive src as (
        select dense_rank() over (order by conv_id) as c, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
    hit as (select *, {crc} % 20 as f from src),
    bad as (select c, turn, if(f = 4, 'user', role) as role,
                   case f when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
                   unnest(range(if(f = 3, 2, 1))) as copy from hit where f <> 0),
    pos as (select *, row_number() over (partition by c order by turn nulls first, role, sha256(length(role) || ':' || role || text)) as p,
                   rtrim(text, {spaces}) as bare from bad),
    seen as (select *, row_number() over (partition by c, role, text order by p) > 1 as again,
                    lag(left(role, 1)) over (partition by c order by p) as prior from pos),
    faults as (select *, bare = '' as blank, bare <> '' and again as dup,
                      bare <> '' and not again and right(bare, 1) not in ('.', '!', '?') as cut from seen),
    line as (select *, case when blank or dup then {GONE}
                            else (case left(role, 1) when 's' then 0 when 'u' then 1 when 'a' then 2 else {OTHER} end)
                                 + if(cut, {TRUNCATED}, 0) end as symbol from faults),
    moves(symbol, state, next, cost, audit, put, as_role) as (values {", ".join(moves)}),
    done(state, cost, audit, put) as (values {last}),
    dp(c, p, state, cost, audit, body) as (
        select distinct c, 0::bigint, 0, 0, '', []::varchar[] from src
        union all
        select c, p, state, cost, audit, body from (
            select dp.c, line.p, m.next as state, dp.cost + m.cost as cost, dp.audit || m.audit as audit,
                   list_concat(dp.body, m.put, if(m.audit like '%D', []::varchar[], [coalesce(m.as_role, role) || ':' || text])) as body,
                   row_number() over (partition by dp.c, m.next order by dp.cost + m.cost, dp.audit || m.audit) as best
            from dp join line on line.c = dp.c and line.p = dp.p + 1
                    join moves m on m.symbol = line.symbol and m.state = dp.state) where best = 1),
    size as (select c, count(*) as n, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, sum(blank::int) as blank,
                    sum(dup::int) as duplicate, sum(cut::int) as truncated,
                    sum((p > 1 and prior || left(role, 1) not in ('su', 'ua', 'au'))::int) as illegal from line group by c),
    fin as (select dp.c, dp.cost + d.cost as cost, dp.audit || d.audit as audit, list_concat(dp.body, d.put) as body
            from dp join done d using (state) left join size using (c) where dp.p = coalesce(n, 0)
            qualify row_number() over (partition by dp.c order by dp.cost + d.cost, dp.audit || d.audit) = 1)
    select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
           coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
           coalesce(illegal, 0)::bigint as illegal, cost::bigint as cost, audit,
           sha256(array_to_string(body, chr(10))) as repaired_sha256
    from (select distinct c, conv_id from src) left join size using (c) join fin using (c)"""
