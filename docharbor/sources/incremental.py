"""Incremental loads: the delta since the last cursor value."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.functions.ids import content_json, key_json

BOUNDARY_KEY = "_boundary_key"


def literal(value: Any, kind: T.DataType) -> Column:
    """A cursor value of the column's type, the same in every time zone.

    A datetime without a zone means UTC; no value passes through the driver's own zone.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        utc = value.astimezone(timezone.utc) if value.tzinfo else value
        text = utc.replace(tzinfo=None).isoformat(sep=" ")
        return F.lit(text + ("+00:00" if isinstance(kind, T.TimestampType) else "")).cast(kind)
    return F.lit(value).cast(kind)


def newest(df: DataFrame, cursor: str) -> str | None:
    """The greatest cursor value as exact text, for :func:`of_text`; instants as microseconds."""
    value = F.max(F.col(f"`{cursor}`"))
    return df.agg(exact_text(value, df.schema[cursor].dataType)).first()[0]


def exact_text(value: Column, kind: T.DataType) -> Column:
    """A value as text that :func:`of_text` reads back, in any time zone."""
    return (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")


def of_text(text: str, kind: T.DataType) -> Column:
    """The literal that :func:`newest` wrote."""
    if isinstance(kind, T.TimestampType) and text.lstrip("-").isdigit():
        return F.timestamp_micros(F.lit(int(text)))
    if isinstance(kind, T.TimestampType) and not re.search(r"([+-]\d\d:\d\d|Z)$", text):
        text += "+00:00"
    return F.lit(text).cast(kind)


def row_key(df: DataFrame, key: Sequence[str]) -> Column:
    """What tells rows with an equal cursor value apart: their key, else their content."""
    return F.sha2(key_json(df, key) if key else content_json(df), 256)


def null_cursors(df: DataFrame, cursor: str) -> DataFrame:
    """Rows without a cursor value; no delta can ever hold them, so they are rejects."""
    return df.filter(F.col(f"`{cursor}`").isNull())


def delta(
    df: DataFrame,
    cursor: str,
    last: Any,
    *,
    key: Sequence[str] = (),
    seen: DataFrame | None = None,
    few_seen: bool = False,
) -> DataFrame:
    """Rows from the last cursor value on, less those of that value that were loaded.

    The filters reach the source. When only a few keys were seen at the boundary, they are
    broadcast and one scan does; rows after the boundary have no key and match none. Many
    keys are joined with the rows at the boundary alone, so that later rows do not move.
    """
    value = F.col(f"`{cursor}`")
    if last is None:
        return df.filter(value.isNotNull())
    last = literal(last, df.schema[cursor].dataType)
    since = df.filter(value >= last)
    if seen is None:
        return since
    keys = seen.select(BOUNDARY_KEY)
    if few_seen:
        at_last = F.when(value == last, row_key(since, key)).alias(BOUNDARY_KEY)
        fresh = since.select("*", at_last).join(F.broadcast(keys), BOUNDARY_KEY, "left_anti")
        return fresh.select(*[F.col(f"`{c}`") for c in df.columns])
    at_boundary = df.filter(value == last)
    fresh = at_boundary.withColumn(BOUNDARY_KEY, row_key(at_boundary, key)).join(
        keys, BOUNDARY_KEY, "left_anti"
    )
    return df.filter(value > last).unionByName(fresh.drop(BOUNDARY_KEY))


def greatest(df: DataFrame, cursor: str) -> Any:
    """The cursor value to start from next time."""
    return df.agg(F.max(F.col(f"`{cursor}`"))).first()[0]


def boundary_keys(df: DataFrame, cursor: str, last: Any, key: Sequence[str] = ()) -> DataFrame:
    """Keys of the rows at a cursor value; kept as a table, since there may be many."""
    rows = df.filter(F.col(f"`{cursor}`") == literal(last, df.schema[cursor].dataType))
    return rows.select(row_key(rows, key).alias(BOUNDARY_KEY))


# Rows that one task may order, classes of a histogram, and values they are made from.
ORDERED_ROWS = 100_000
CLASSES = 64
SAMPLED_VALUES = 2_000
TIE = "_tie"


def limited(
    df: DataFrame, cursor: str, count: int, tie: Sequence[str] = (), ordered: int = ORDERED_ROWS
) -> DataFrame:
    """The first rows by cursor, so that a later run goes on where this one stopped.

    A histogram tells which class of cursor values holds the last row that is wanted. Rows of earlier classes
    are taken by a filter, the class itself is cut in the same way until ``ordered`` rows at most are left in
    it, and only these are sorted. If more rows than that have one cursor, they are cut by the next column
    of ``tie`` and at last by a hash of the row; identical rows are taken in any order. Null cursors come first.
    """
    if count <= ordered:
        order = [F.col(f"`{c}`").asc() for c in (cursor, *tie)]
        return df.orderBy(*order).limit(count)
    names = df.columns
    df = df.withColumn(TIE, F.xxhash64(*(F.col(f"`{c}`") for c in names)))
    parts, rest = [], df
    for column in (cursor, *tie, TIE):
        taken, rest, count = _cut(rest, column, count, ordered)
        parts += taken
        if rest is None:
            break
        if count <= ordered:
            parts.append(rest.orderBy(*(F.col(f"`{c}`").asc() for c in (cursor, *tie, TIE))).limit(count))
            break
    else:
        parts.append(rest.limit(count))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select(*(F.col(f"`{c}`") for c in names))


def _cut(
    df: DataFrame, column: str, count: int, ordered: int
) -> tuple[list[DataFrame], DataFrame | None, int]:
    """Parts that are wanted whole, the class that has to be cut, and how many of its rows are wanted.

    That class has ``ordered`` rows at most, or one value; it is missing where nothing is left to be cut.
    """
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    parts = []
    while True:
        texts = df.filter(value.isNotNull()).select(value).orderBy(F.rand(count)).limit(SAMPLED_VALUES)
        texts = [r[0] for r in texts.orderBy(value).select(exact_text(value, kind)).collect()]
        step = max(1, len(texts) // CLASSES)
        bounds = [of_text(t, kind) for t in dict.fromkeys(texts[step - 1 :: step])]
        above = [F.when(value > b, 1).otherwise(0) for b in bounds]
        place = F.when(value.isNull(), -1).otherwise(sum(above[1:], above[0]) if above else F.lit(0))
        stats = df.groupBy(place.alias("place")).agg(F.count(F.lit(1)), F.min(value) == F.max(value))
        before = 0
        for place_of, rows, single in sorted(stats.collect()):
            if before + rows >= count:
                break
            before += rows
        else:
            return [*parts, df], None, 0
        low, high = place_of - 1, place_of
        later = value > bounds[low] if low >= 0 else F.lit(True)
        here = later & (value <= bounds[high]) if 0 <= high < len(bounds) else later
        if place_of < 0:
            inside, earlier = df.filter(value.isNull()), None
        else:
            inside = df.filter(value.isNotNull() & here)
            earlier = df.filter(value.isNull() | (value <= bounds[low]) if low >= 0 else value.isNull())
        if before:
            parts.append(earlier)
        count -= before
        if rows == count:
            return [*parts, inside], None, 0
        if rows <= ordered or single or place_of < 0:
            return parts, inside, count
        df = inside
