"""Registered queries: a Spark function over the given tables and its check in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docharbor.functions.ids import NAMESPACE_HEX
from docharbor.session import require_utc, split_hot_roots


@dataclass(frozen=True)
class Tables:
    """The given tables of one folder, read on use."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function under its own name."""

    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[function.__name__] = Query(function, sql)
        return function

    return register


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    require_utc(spark)
    split_hot_roots(spark)
    return QUERIES[name].run(Tables(spark, folder))


# SQL pieces


def sql_uuid(name: str) -> str:
    """Version 5 UUID of a SQL text expression."""
    h = f"sha1(from_hex('{NAMESPACE_HEX}') || encode({name}))"
    return sql_uuid_of_digest(h)


def sql_uuid_of_digest(h: str) -> str:
    return (
        f"substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
        f"translate(substr({h},17,1), '0123456789abcdef', '89ab89ab89ab89ab') || "
        f"substr({h},18,3) || '-' || substr({h},21,12)"
    )


def sql_merge_id(collection: str, *keys: str) -> str:
    """Merge id over SQL key expressions that need no JSON escapes."""
    quoted = " || ', ' || ".join(f"'\"' || {k}::varchar || '\"'" for k in keys)
    return sql_uuid(f"'{collection}:[' || {quoted} || ']'")


def sql_digest(*parts: str) -> str:
    return f"substr(sha256(concat_ws(chr(1), {', '.join(parts)})), 1, 32)"


def sql_row_id(collection: str, *keys: str) -> str:
    quoted = " || ', ' || ".join(f"'\"' || {k}::varchar || '\"'" for k in keys)
    return sql_digest(f"'{collection}'", "'key'", f"'[' || {quoted} || ']'")
