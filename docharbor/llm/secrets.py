"""Secret scans over a trigram inverted index, in DataFrame operations alone."""

from __future__ import annotations

import re
import re._parser as grammar
from dataclasses import dataclass, replace
from itertools import product
from re._constants import BRANCH, IN, LITERAL, MAX_REPEAT, SUBPATTERN

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docharbor.llm.common import pick, unpack, whole

#: Strings and clauses followed for one rule; beyond, a query is weaker, which costs time and no match.
MOST = 64
#: Matches whose places are summed together.
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and apart, whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The first three are the base rules. Runs of one class that are too short hold no longer match, so
#: their length stands in the pattern: every run is then found as a whole or not at all.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


def trigrams(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams; a text with a match has all of one set. ``[empty set]``: any text."""
    strings, clauses = _follow(grammar.parse(pattern))
    found = set(_both(clauses, _of(strings)))
    return sorted((c for c in found if not any(other < c for other in found)), key=sorted)


def _of(strings: set[str]) -> list[frozenset[str]]:
    found = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]
    return found if all(found) else [frozenset()]


def _both(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    return [x | y for x, y in product(a, b)] if len(a) * len(b) <= MOST else max(a, b, key=lambda c: min(map(len, c)))


def _follow(nodes) -> tuple[set[str], list[frozenset[str]]]:
    """The strings a match may end with since the last open stretch, and what stands before."""
    strings, clauses = {""}, [frozenset()]
    for kind, value in nodes:
        exact, before, after = _strings(kind, value)
        if exact is not None and len(strings) * len(exact) <= MOST:
            strings = {a + b for a, b in product(strings, exact)}
        else:
            clauses = _both(_both(clauses, _of(strings)), before)
            strings = after
    return strings, clauses


def _strings(kind, value) -> tuple[set[str] | None, list[frozenset[str]], set[str]]:
    """All strings of one node if they are few; else what it needs, and how it may end."""
    none = [frozenset()]
    if kind is LITERAL:
        return {chr(value).lower()}, none, {""}
    if kind is IN and all(k is LITERAL for k, _ in value) and len(value) <= 8:
        return {chr(c).lower() for _, c in value}, none, {""}
    if kind is SUBPATTERN:
        strings, clauses = _follow(value[-1])
        return (strings, none, {""}) if clauses == none and _bounded(value[-1]) else (None, clauses, strings)
    if kind is BRANCH:
        parts = [_follow(v) for v in value[1]]
        if all(c == none for _, c in parts) and all(map(_bounded, value[1])):
            return set().union(*(s for s, _ in parts)), none, {""}
        either = [c for s, own in parts for c in _both(own, _of(s))]
        return None, either if len(either) <= MOST else none, {""}
    if kind is MAX_REPEAT:
        least, most, inner = value
        strings, clauses = _follow(inner)
        if (least, most) == (0, 1) and clauses == none and _bounded(inner):
            return strings | {""}, none, {""}
        if least:
            return None, _both(clauses, _of(strings)), {""}
    return None, none, {""}


def _bounded(nodes) -> bool:
    """Whether :func:`_follow` gives all strings of these nodes in full."""
    return all(_strings(k, v)[0] is not None for k, v in nodes)


def _keyed(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64("text").alias("th"), F.lower(F.coalesce("text", F.lit(""))).alias("low")
    )


def build_index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The postings ``gram, doc_id, th``: which of ``grams``, by number, occur in which text.

    ``th`` is the hash of the text: rows equal in id and text share their postings.
    """
    present = [F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]
    return _keyed(docs).select(F.explode(F.array_compact(F.array(*present))).alias("gram"), "doc_id", "th")


def candidates(index: DataFrame, queries: list[tuple[int, list[int]]]) -> DataFrame:
    """``doc_id, th, rules``: the rules of which a clause, a list of grams, lies in a text's postings."""
    rows = [(rule, n, g, 1 << i, (1 << len(c)) - 1) for n, (rule, c) in enumerate(queries) for i, g in enumerate(c)]
    clauses = index.sparkSession.createDataFrame(rows, "rule int, clause int, gram int, bit long, all long")
    met = index.join(F.broadcast(clauses), "gram").groupBy("doc_id", "th", "rule", "clause", "all")
    met = met.agg(F.bit_or("bit").alias("bits")).where("bits = all")
    return met.groupBy("doc_id", "th").agg(F.collect_set("rule").alias("rules"))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, rule: Rule, number: int) -> Column:
    """``start, rule, end`` of the rule's matches in code points.

    A match begins where the lengths before it add up to. They are summed within blocks of matches and over
    blocks, so that no step copies all matches before it.
    """
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), hits.alias("hit"), values.alias("value"))
    sizes = F.transform(
        parts,
        lambda p: F.struct(
            F.length(p["gap"]).alias("gap"),
            F.coalesce(F.length(p["hit"]), F.lit(0)).alias("hit"),
            F.coalesce(F.length(p["value"]) >= rule.least, F.lit(False)).alias("ok"),
        ),
    )
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")

    def cut(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)))

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda acc, p: acc + p["gap"] + p["hit"])

    def begins(blocks: Column) -> Column:
        sums = F.aggregate(
            blocks, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + total(b)))
        )
        return F.slice(sums, F.lit(1), F.size(blocks))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        end = begin + p["hit"]
        hit = F.array(F.struct(begin.alias("start"), F.lit(number).alias("rule"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["ok"], F.concat(acc["found"], hit)).otherwise(acc["found"]).alias("found"))

    def of_block(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("found")), step, lambda acc: acc["found"])

    blocks = _bound(sizes, cut)
    return _bound(blocks, lambda all_: F.flatten(F.zip_with(all_, begins(all_), of_block)))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` in ``_doc`` beside ``found``: an ordered array of ``start, rule, end``.

    A rule with mandatory trigrams is tried on its candidates from the index alone; one without is
    tried on every text. The index holds the trigrams that the rules ask for. A null text is empty;
    equal rows get equal results. Offsets count code points, the end is not included.
    """
    needs = [trigrams(r.pattern) for r in rules]
    grams = sorted(set().union(*(g for n in needs for g in n)))
    queries = [(i, sorted(map(grams.index, c))) for i, n in enumerate(needs) if all(n) for c in n]
    hits = candidates(build_index(docs, grams), queries)
    hits = hits.select(F.col("doc_id").alias("h_id"), F.col("th").alias("h_th"), "rules")
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.xxhash64("text") == F.col("h_th"))
    own = whole(docs, "_doc", "doc_id", "text").join(hits, same, "left")
    text = F.coalesce("text", F.lit(""))
    empty = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    parts = [
        F.when(F.coalesce(F.array_contains("rules", i), F.lit(False)), spans(text, r, i)).otherwise(empty)
        if all(needs[i])
        else spans(text, r, i)
        for i, r in enumerate(rules)
    ]
    return own.select("_doc", F.array_sort(F.concat(*parts)).alias("found"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mask``; spans that overlap get one mask."""
    found = find_secrets(docs, rules)
    text = F.col(f"_doc._{docs.columns.index('text')}")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = F.concat(acc["out"], gap, F.lit(mask))
        return F.struct(
            F.when((s["start"] >= acc["at"]), new).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    clean = F.aggregate("found", start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
    return unpack(found, "_doc", docs, text=F.when(F.size("found") > 0, clean).otherwise(text))


def _named(found: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    one = F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"], s["end"]))
    return F.concat_ws(",", one)


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every document."""
    out = find_secrets(pick(docs, "doc_id", "text"), rules)
    kinds = F.transform("found", lambda s: s["rule"])
    count = {k: F.size(kinds) - F.size(F.array_remove(kinds, i)) for i, k in enumerate(BASE)}
    return out.select(
        F.col("_doc._0").alias("doc_id"),
        *(c.cast("long").alias(f"n_{k}") for k, c in count.items()),
        F.sha2(_named(F.filter("found", lambda s: s["rule"] < len(BASE)), rules), 256).alias("base_sha256"),
        _named(F.col("found"), rules).alias("spans"),
    )


def _spelled(pattern: str) -> str:
    """A pattern with both cases of its letters in place of ``(?i)``, which in DuckDB means letters like U+212A too."""
    if not pattern.startswith("(?i)"):
        return pattern
    own = r"\\x[0-9A-Fa-f]{2}|\\.|\[[^\]]*\]|[A-Za-z]"
    both = lambda m: f"[{m[0].lower()}{m[0].upper()}]" if len(m[0]) == 1 else m[0]
    return re.sub(own, both, pattern.removeprefix("(?i)"))


def report_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The report in DuckDB's SQL: every rule over every text."""
    rules = tuple(replace(r, pattern=_spelled(r.pattern)) for r in rules)
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    each = " union all ".join(
        f"select rid, {i} as ord, {quote(r.kind)} as kind, string_split_regex(t, {quote(r.pattern)}) as p, "
        f"regexp_extract_all(t, {quote(r.pattern)}, 0) as f, regexp_extract_all(t, {quote(r.pattern)}, {r.group}) as g, "
        f"{r.least} as least from d"
        for i, r in enumerate(rules)
    )
    named = "kind || ':' || s || ':' || e"
    return f"""
    with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
    m as ({each}),
    i as (select *, unnest(range(1, len(f) + 1)) as n from m),
    x as (select rid, ord, kind, least, g[n] as v, length(f[n]) as size,
                 list_sum(list_transform(p[1:n], lambda y: length(y)))
                 + coalesce(list_sum(list_transform(f[1:n-1], lambda y: length(y))), 0) as s from i),
    y as (select rid, ord, kind, s::bigint as s, (s + size)::bigint as e from x where length(v) >= least),
    z as (select rid, count(*) filter (ord = 0) as a, count(*) filter (ord = 1) as b, count(*) filter (ord = 2) as c,
                 string_agg({named}, ',' order by s, ord) filter (ord < {len(BASE)}) as base,
                 string_agg({named}, ',' order by s, ord) as spans from y group by rid)
    select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex,
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from d left join z using (rid)"""
