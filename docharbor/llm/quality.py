"""Quality rules as weak supervision: they vote or abstain, and the votes tell how far each can be trusted.

Native: column expressions and aggregates alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docharbor.llm.common import pick, stored, unpack, whole

#: Fixed value: the white space that parts words.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LETTERS = r"[\p{L}\p{M}\p{N}]+"
#: Words of a window whose second occurrence in a text is a repetition.
WINDOW = 8

GOOD, BAD, NONE = "g", "b", "-"


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else not at all."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        said = F.when(F.expr(self.bad), BAD).when(F.expr(self.good), GOOD)
        return said.otherwise(NONE)


#: The rules over the measures of :func:`measures`, in the order of the letters of ``votes``.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "n_words > 0 and 50 * n_symbols <= n_words"),
    Rule("word_length", "word_chars < 3 * n_words or 2 * word_chars > 13 * n_words", "2 * word_chars > 7 * n_words and word_chars < 6 * n_words"),
    Rule("sentences", "2 * n_ends > n_words or n_words >= 60 and n_ends = 0", "n_ends > 0 and 50 * n_ends >= n_words and 3 * n_ends <= n_words"),
    Rule("capitals", "10 * n_capitals > 3 * word_chars", "n_words > 0 and 20 * n_capitals <= word_chars"),
    Rule("variety", "n_words >= 50 and 3 * n_distinct < n_words", "n_words >= 50 and 2 * n_distinct > n_words"),
    Rule("repeated_words", "4 * n_repeat_words > n_words", "n_words >= 50 and n_repeat_words = 0"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines", "n_lines >= 3 and 20 * n_dup_lines <= n_lines"),
    Rule("signs", "10 * n_signs > word_chars", "n_words > 0 and 20 * n_signs <= word_chars"),
)


@dataclass(frozen=True)
class Trust:
    """What the votes are worth: the share of good texts, and per rule how often a vote is right on either kind."""

    share: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def probability(self, votes: Column) -> Column:
        """That a text is good, given its votes; one without votes has the share of all texts."""
        pairs = zip(self.on_good, self.on_bad, strict=True)
        factors = F.lit([x for a, b in pairs for x in (1.0, a / (1 - b), (1 - a) / b)])
        # Looked up in one array, so that a round's plan differs from the last in its values alone.
        places = F.sequence(F.lit(0), F.lit(len(self.on_good) - 1))
        each = F.transform(places, lambda i: F.get(factors, 3 * i + _code(votes, i)))
        odds = F.aggregate(each, F.lit(self.share / (1 - self.share)), lambda a, x: a * x)
        return odds / (1 + odds)


def _code(votes: Column, i: Column) -> Column:
    """The ``i``-th vote, counted from 0, as its place in NONE, GOOD, BAD."""
    return F.instr(F.lit(NONE + GOOD + BAD), F.substr(votes, i + 1, F.lit(1))) - 1


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _twins(ordered: Column, key: str) -> Column:
    """The entries of an ordered array whose key a neighbour has too."""

    def met(e: Column, i: Column) -> Column:
        before = (i > 0) & (F.get(ordered, i - 1)[key] == e[key])
        return before | F.coalesce(F.get(ordered, i + 1)[key] == e[key], F.lit(False))

    return F.filter(ordered, met)


def _repeated(words: Column) -> Column:
    """How many words lie in windows that the text holds at least twice.

    Windows are sorted only in texts where two have one hash; their words are then compared.
    """
    zero = F.lit(0)

    def windows(hashes: Column) -> Column:
        each = lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW)))
        return F.transform(F.sequence(zero, F.size(hashes) - WINDOW), each)

    def spelt(entry: Column) -> Column:
        parts = (F.get(words, entry["at"] + k) for k in range(WINDOW))
        return F.struct(F.concat_ws(" ", *parts).alias("key"), entry["at"].alias("at"))

    def total(starts: Column) -> Column:
        gap = F.transform(starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))))
        return F.aggregate(gap, zero, lambda a, g: a + g)

    def several(keys: Column) -> Column:
        ordered = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at"))))
        likely = _bound(ordered, lambda o: _twins(o, "key"))
        sure = _bound(F.sort_array(F.transform(likely, spelt)), lambda o: _twins(o, "key"))
        return _bound(F.sort_array(F.transform(sure, lambda e: e["at"])), total)

    def counted(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), zero).otherwise(several(keys))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = _bound(hashes, lambda h: _bound(windows(h), counted))
    return F.when(F.size(words) >= WINDOW, found).otherwise(zero)


def _fields(of: Callable[[Column], list[Column]]) -> Callable[[Column], Column]:
    return lambda value: F.struct(*of(value))


def measures(text: Column) -> Column:
    """A struct of counts over a whole text, all long; null counts as empty.

    ``n_words`` and ``n_distinct`` words, ``word_chars`` in them, ``n_symbols``, ``n_signs`` (neither letter
    nor digit), ``n_ends`` of sentences, ``n_capitals`` (A-Z), ``n_lines`` with a word, ``n_dup_lines`` of them
    equal to an earlier one, ``n_repeat_words`` in windows of eight words that the text repeats.
    """
    t = F.coalesce(text, F.lit(""))
    bare = F.translate(t, SPACES, "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")

    def number(source: Column, kept: str) -> Column:
        return F.length(F.regexp_replace(source, f"[^{kept}]+", ""))

    def of_words(words: Column) -> list[Column]:
        return [
            F.size(words).alias("n_words"),
            F.size(F.array_distinct(words)).alias("n_distinct"),
            _repeated(words).alias("n_repeat_words"),
        ]

    def of_bare(b: Column) -> list[Column]:
        return [
            F.length(b).alias("word_chars"),
            number(b, SYMBOLS).alias("n_symbols"),
            number(b, ".!?").alias("n_ends"),
            number(b, "A-Z").alias("n_capitals"),
            F.length(F.regexp_replace(b, LETTERS, "")).alias("n_signs"),
        ]

    def of_lines(x: Column) -> list[Column]:
        return [
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        ]

    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    parts = {"w": (words, of_words), "c": (bare, of_bare), "l": (lines, of_lines)}
    return F.struct(*(_bound(v, _fields(of)).alias(k) for k, (v, of) in parts.items()))


FIELDS = {
    "w": ("n_words", "n_distinct", "n_repeat_words"),
    "c": ("word_chars", "n_symbols", "n_ends", "n_capitals", "n_signs"),
    "l": ("n_lines", "n_dup_lines"),
}


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The packed rows of ``docs`` beside their measures, ``base_failed`` and ``votes``, a letter for each rule."""
    own = whole(docs, "_doc", "text").select("_doc", measures(F.col("text")).alias("m"))
    flat = own.select("_doc", *(F.col(f"m.{k}.{n}").cast("long").alias(n) for k, names in FIELDS.items() for n in names))
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    return flat.withColumn("base_failed", failed).withColumn("votes", F.concat(*(r.vote() for r in rules)))


#: Where the estimation starts, how many texts its prior counts as, and how often it goes round.
START = Trust(0.9, (0.95,) * len(RULES), (0.4,) * len(RULES))
PRIOR_TEXTS = 10.0
ROUNDS = 15


def estimate(votes: DataFrame, start: Trust = START, rounds: int = ROUNDS) -> Trust:
    """Expectation and maximisation over ``votes``: no label is read.

    Votes are first counted by pattern, of which there are 3^rules at most. Each round is one aggregate over the
    patterns: the expected number of right and wrong votes of each rule on good and on bad texts. The start
    counts as ``PRIOR_TEXTS`` texts, so every share stays between 0 and 1; without texts it is the result.
    """
    counted = votes.groupBy("votes").agg(F.count("*").alias("n"))
    counted = stored(counted.coalesce(1), "votes").coalesce(1)
    size = len(start.on_good)
    trust = start
    for _ in range(rounds):
        p = trust.probability(F.col("votes"))
        # A vote "good" of all texts, put before the others, counts the texts themselves.
        each = counted.select("n", p.alias("p"), F.concat(F.lit(GOOD), "votes").alias("votes"), F.explode(F.sequence(F.lit(0), F.lit(size))).alias("i"))
        sums = each.groupBy("i", _code(F.col("votes"), F.col("i")).alias("v")).agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p"))))
        good, bad = {}, {}
        for i, v, g, b in sums.collect():
            good[i, v], bad[i, v] = g, b

        def share(of: dict, i: int, right: int, wrong: int, before: float) -> float:
            a, b = of.get((i, right), 0.0), of.get((i, wrong), 0.0)
            return (a + PRIOR_TEXTS * before) / (a + b + PRIOR_TEXTS)

        texts = good.get((0, 1), 0.0), bad.get((0, 1), 0.0)
        trust = Trust(
            (texts[0] + PRIOR_TEXTS * start.share) / (sum(texts) + PRIOR_TEXTS),
            tuple(share(good, i + 1, 1, 2, start.on_good[i]) for i in range(size)),
            tuple(share(bad, i + 1, 2, 1, start.on_bad[i]) for i in range(size)),
        )
    return trust


def _kept(trust: Trust) -> Column:
    return ~F.col("base_failed") & (trust.probability(F.col("votes")) >= 0.5)


def quality_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, votes, kept``.

    One row per row of ``docs``, equal rows too. A null or empty text has no words, fails the base rules and
    still votes; an empty table has no rows. Measures are written once, without texts, and judged when the
    votes of all of them are counted. A text of any length is measured within its row.
    """
    out = measured(pick(docs, "doc_id", "text")).withColumn("doc_id", F.col("_doc._0")).drop("_doc")
    out = stored(out, "measures")
    trust = estimate(out)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "votes", _kept(trust).alias("kept"),
    )


def drop_poor(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`quality_report` keeps."""
    out = measured(docs)
    return unpack(out.where(_kept(estimate(out.select("votes")))), "_doc", docs)


def report_sql(rules: tuple[Rule, ...] = RULES, start: Trust = START, rounds: int = ROUNDS) -> str:
    """The report in DuckDB's SQL; the estimation is a recursive query over the counts of patterns."""
    votes = " || ".join(f"case when {r.bad} then '{BAD}' when {r.good} then '{GOOD}' else '{NONE}' end" for r in rules)
    factor = (
        f"case votes[i] when '{GOOD}' then on_good[i] / (1 - on_bad[i])"
        f" when '{BAD}' then (1 - on_good[i]) / on_bad[i] else 1.0::double end"
    )
    odds = f"share / (1 - share) * list_product(list_transform(range(1, {len(rules) + 1}), lambda i: {factor}))"

    def part(i: int, letter: str, weight: str) -> str:
        return f"coalesce(sum({weight}) filter (votes[{i + 1}] = '{letter}'), 0)"

    def shares(weight: str, right: str, wrong: str, before: tuple[float, ...]) -> str:
        each = (
            f"({part(i, right, weight)} + {PRIOR_TEXTS * x!r}::double)"
            f" / ({part(i, right, weight)} + {part(i, wrong, weight)} + {PRIOR_TEXTS!r}::double)"
            for i, x in enumerate(before)
        )
        return f"[{', '.join(each)}]"

    listed = lambda values: "[" + ", ".join(f"{x!r}::double" for x in values) + "]"
    count = lambda kept: f"length(regexp_replace(b, '[^{kept}]+', '', 'g'))"
    return f"""
    with recursive d as (
        select row_number() over () as rid, doc_id, coalesce(text, '') as t,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
               regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') as b,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
        from documents),
    g as (select rid, i, array_to_string(w[i:i + {WINDOW - 1}], chr(10)) as g
          from (select rid, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from d)),
    r as (select rid, i from g qualify count(*) over (partition by rid, g) > 1),
    c as (select rid, count(distinct pos) as n_repeat_words from (select rid, unnest(range(i, i + {WINDOW})) as pos from r) group by rid),
    m as (select rid, doc_id, len(w)::bigint as n_words, len(list_distinct(w)) as n_distinct, length(b)::bigint as word_chars,
                 {count(SYMBOLS)}::bigint as n_symbols, {count(".!?")} as n_ends, {count("A-Z")} as n_capitals,
                 length(regexp_replace(b, '{LETTERS}', '', 'g')) as n_signs, len(l) as n_lines,
                 (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
          from d left join c using (rid)),
    v as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, {votes} as votes from m),
    patterns as (select votes, count(*)::double as n from v group by votes),
    em(round, share, on_good, on_bad) as (
        select 0, {start.share!r}::double, {listed(start.on_good)}, {listed(start.on_bad)}
        union all
        select round + 1, (sum(n * p) + {PRIOR_TEXTS * start.share!r}) / (sum(n) + {PRIOR_TEXTS!r}),
               {shares("n * p", GOOD, BAD, start.on_good)}, {shares("n * (1 - p)", BAD, GOOD, start.on_bad)}
        from (select round, votes, n, odds / (1 + odds) as p
              from (select round, votes, n, {odds} as odds from em, patterns where round < {rounds})) group by round),
    last as (select * from em order by round desc limit 1)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, votes,
           not base_failed and odds / (1 + odds) >= 0.5 as kept
    from (select v.*, {odds} as odds from v, last)"""
