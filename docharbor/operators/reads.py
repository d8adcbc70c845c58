"""Reads over a stored table: filters, order, pages, lookups, counts, exports, deletes."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docharbor.functions.names import ID
from docharbor.sources.incremental import exact_text, of_text


def where_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.filter(F.col(f"`{column}`") == F.lit(value))


def where_in(df: DataFrame, column: str, values: DataFrame | Sequence[Any]) -> DataFrame:
    """Rows whose value is in a short list, or in the first column of a DataFrame."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(f"`{values.columns[0]}`").alias(column))
        return df.join(keys, column, "left_semi")
    return df.filter(F.col(f"`{column}`").isin(list(values)))


def where_range(
    df: DataFrame, column: str, *, above: Any = None, at_least: Any = None,
    below: Any = None, at_most: Any = None,
) -> DataFrame:
    value = F.col(f"`{column}`")
    for bound, condition in (
        (above, lambda v: value > v),
        (at_least, lambda v: value >= v),
        (below, lambda v: value < v),
        (at_most, lambda v: value <= v),
    ):
        if bound is not None:
            df = df.filter(condition(F.lit(bound)))
    return df


def sorted_by(df: DataFrame, column: str, descending: bool = True, tie: str = ID) -> DataFrame:
    """Order by a field; equal values by id, so pages never overlap."""
    value = F.col(f"`{column}`")
    order = [value.desc_nulls_last() if descending else value.asc_nulls_last()]
    if tie in df.columns and tie != column:
        order.append(F.col(f"`{tie}`").asc())
    return df.orderBy(*order)


def page(
    df: DataFrame, column: str, *, per_page: int, number: int = 1,
    descending: bool = True, tie: str = ID,
) -> DataFrame:
    """One page of the ordered table; pages are numbered from 1."""
    if per_page < 1 or number < 1:
        raise ValueError("per_page and number must be at least 1")
    ordered = sorted_by(df, column, descending, tie)
    return ordered.offset((number - 1) * per_page).limit(per_page)


def page_after(
    df: DataFrame, column: str, *, per_page: int, last: tuple[str | None, str] | None = None,
    descending: bool = True, tie: str = ID,
) -> DataFrame:
    """The page after the row at ``last``, a place that :func:`place_of` gives; the first one without it.

    The place is a filter on the columns, which a scan can use: a page deep in the table costs as much as
    the first one, and no row is counted off. Rows without a value come last, in the order of ``tie``.
    """
    if per_page < 1:
        raise ValueError("per_page must be at least 1")
    if last is not None:
        value, other = F.col(f"`{column}`"), F.col(f"`{tie}`")
        later = other > of_text(last[1], df.schema[tie].dataType)
        if last[0] is None:
            df = df.filter(value.isNull() & later)
        else:
            at = of_text(last[0], df.schema[column].dataType)
            beyond = value < at if descending else value > at
            df = df.filter(beyond | ((value == at) & later) | value.isNull())
    return sorted_by(df, column, descending, tie).limit(per_page)


def place_of(page: DataFrame, column: str, tie: str = ID) -> tuple[str | None, str] | None:
    """Where a page ends: its last row's value and tie as exact text; nothing for an empty page."""
    at = [exact_text(F.col(f"`{c}`"), page.schema[c].dataType) for c in (column, tie)]
    rows = page.select(*at).collect()
    return tuple(rows[-1]) if rows else None


def found(df: DataFrame, condition: Column | None = None) -> int:
    """How many rows match."""
    return (df if condition is None else df.filter(condition)).count()


def export(df: DataFrame, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Matching rows with the named columns only."""
    rows = df if condition is None else df.filter(condition)
    return rows.select(*[F.col(f"`{c}`") for c in columns])


def without(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left after a delete; a condition that is null matches nothing."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
