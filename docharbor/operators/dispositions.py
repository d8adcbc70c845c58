"""Write dispositions as pure functions of a target and a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.functions.names import ID


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both; a column of one side is absent in rows of the other."""
    return target.unionByName(batch, allowMissingColumns=True)


def replace(batch: DataFrame) -> DataFrame:
    """The batch is the table, with the batch's columns."""
    return batch


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, the same schema."""
    return df.limit(0)


def upsert(target: DataFrame, batch: DataFrame, on: str = ID) -> DataFrame:
    """Whole documents of the batch replace those of the target; others stay or are added."""
    kept = target.join(batch.select(on), on, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def emplace(target: DataFrame, batch: DataFrame, on: str = ID) -> DataFrame:
    """Only the given, non-null fields of the batch change a document."""
    old, new = target.alias("old"), batch.alias("new")
    columns: list[Column] = []
    for name in [*target.columns, *[c for c in batch.columns if c not in target.columns]]:
        sides = [
            F.col(f"{side}.`{name}`")
            for side, df in (("new", batch), ("old", target))
            if name in df.columns
        ]
        columns.append(F.coalesce(*sides).alias(name))
    joined = old.join(new, F.col(f"old.`{on}`") == F.col(f"new.`{on}`"), "full_outer")
    return joined.select(*columns)


def insert_only(target: DataFrame, batch: DataFrame, on: str = ID) -> DataFrame:
    """Rows of the batch the target has not; existing documents are never changed."""
    return target.unionByName(new_rows(target, batch, on), allowMissingColumns=True)


def new_rows(target: DataFrame, batch: DataFrame, on: str = ID) -> DataFrame:
    return batch.join(target.select(on), on, "left_anti")


def _sortable(column: str, kind: T.DataType) -> Column:
    """The value, or its text where Spark has no order for the type."""
    value = F.col(f"`{column}`")
    return value if _has_order(kind) else F.to_json(F.struct(value), {"ignoreNullFields": "false"})


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _latest_first(df: DataFrame, order_by: Sequence[str]) -> list[Column]:
    first = [F.col(f"`{c}`").desc_nulls_last() for c in order_by]
    rest = [
        _sortable(f.name, f.dataType).desc_nulls_last()
        for f in df.schema.fields
        if f.name not in order_by
    ]
    return first + rest


def last_wins(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order_by``; the other columns break ties.

    Spark keeps one row per key in every input task before it shuffles, so a key that
    holds a large share of the rows costs no more than any other.
    """
    latest = Window.partitionBy(*[F.col(f"`{c}`") for c in key]).orderBy(
        *_latest_first(df, order_by)
    )
    return (
        df.withColumn("_place", F.row_number().over(latest))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def last_value_per_column(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per key with the last non-null value of every column."""
    place = F.struct(*[F.col(f"`{c}`") for c in order_by])
    others = [c for c in df.columns if c not in key]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if not others:
        return df.distinct()
    found = df.groupBy(*[F.col(f"`{c}`") for c in key]).agg(
        *[
            F.max_by(
                F.col(f"`{c}`"),
                F.when(F.col(f"`{c}`").isNotNull(), F.struct(place, _sortable(c, kinds[c]))),
            ).alias(c)
            for c in others
        ]
    )
    return found.select(*[F.col(f"`{c}`") for c in df.columns])


def repeated_keys(df: DataFrame, key: Sequence[str]) -> int:
    """How many keys occur more than once."""
    return df.groupBy(*[F.col(f"`{c}`") for c in key]).count().filter("count > 1").count()


def of_other_scheme(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows whose key is in the batch under another id, left by an earlier append."""
    names = list(key)
    pairs = batch.select(*names, F.col(ID).alias("_new_id")).distinct()
    return target.select(ID, *names).join(pairs, names).filter(F.col(ID) != F.col("_new_id"))
