"""Good and rejected rows: split, counts and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docharbor.errors import MAX_SAMPLE_CHARS, MAX_SAMPLES, RejectedRows
from docharbor.functions.names import ID
from docharbor.operators.shape import ERRORS, error, json_document


def is_valid() -> Column:
    return F.col(ERRORS).isNull()


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_valid()).drop(ERRORS)


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(~is_valid())


def add_error(df: DataFrame, column: str, reason: Column, sample: Column) -> DataFrame:
    """Add one more reject reason to the rows that have one."""
    extra = error(column, reason, sample)
    old = F.coalesce(F.col(ERRORS), F.array().cast(df.schema[ERRORS].dataType))
    return df.withColumn(
        ERRORS, F.when(extra.isNotNull(), F.concat(old, F.array(extra))).otherwise(F.col(ERRORS))
    )


def require_keys(df: DataFrame, *key: str) -> DataFrame:
    """Mark rows whose key has a missing part; empty text is a legal key."""
    found = F.filter(
        F.array(
            *[
                error(
                    k,
                    F.when(F.col(f"`{k}`").isNull(), F.lit("key column is missing or null")),
                    F.lit(None),
                )
                for k in key
            ]
        ),
        lambda e: e.isNotNull(),
    )
    return df.withColumn(ERRORS, F.when(F.size(found) > 0, found))


def summary(df: DataFrame) -> DataFrame:
    """One row: how many rows there are and how many of them are rejected."""
    return df.agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(~is_valid()).alias("failed_count")
    )


def reasons(df: DataFrame) -> DataFrame:
    """Rejects per column and reason."""
    found = df.filter(~is_valid()).select(F.explode(ERRORS).alias("e"))
    return found.groupBy(
        F.col("e.column").alias("column"), F.col("e.reason").alias("reason")
    ).agg(F.count(F.lit(1)).alias("rows"))


def samples(rejects: DataFrame) -> DataFrame:
    """A few rejects with their reason and document text, each cut to its length limit."""
    document = json_document(rejects.drop(ERRORS))
    first = F.col(ERRORS)[0]
    text = F.concat_ws(
        " | ",
        F.concat_ws(": ", first["column"], first["reason"], first["sample"]),
        F.concat(F.lit("document: "), F.substring(document, 1, MAX_SAMPLE_CHARS)),
    )
    order = F.col(ID).asc_nulls_first() if ID in rejects.columns else text
    return rejects.orderBy(order, text).limit(MAX_SAMPLES).select(
        F.substring(text, 1, MAX_SAMPLE_CHARS).alias("sample")
    )


def fail_on_rejects(
    table: str, load_id: str, rejects: DataFrame, failed: int, total: int
) -> None:
    """Raise with counts and samples when a load has rejects."""
    if failed:
        texts = [r["sample"] for r in samples(rejects).collect()]
        raise RejectedRows(table, load_id, failed, total, texts)
