"""SQL tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows fetched per round trip.
FETCH_SIZE = 1000


@dataclass(frozen=True)
class SplitRange:
    """How a table is split over tasks: a numeric or temporal column and its bounds."""

    column: str
    lower: Any
    upper: Any
    partitions: int


def jdbc_options(
    url: str, table: str, split: SplitRange | None = None, fetch_size: int = FETCH_SIZE, **extra: str
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split: SplitRange | None = None,
    cursor: str | None = None,
    since: Any = None,
    **extra: str,
) -> DataFrame:
    """A table, from a cursor value on; Spark sends the cursor predicate to the database."""
    rows = spark.read.format("jdbc").options(**jdbc_options(url, table, split, **extra)).load()
    if cursor is not None and since is not None:
        rows = rows.filter(F.col(cursor) >= F.lit(since))
    return rows
