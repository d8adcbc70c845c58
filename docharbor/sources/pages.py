"""Pages of an API that were landed as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.operators.shape import ERROR_TYPE, ERRORS, error


def unnest(
    pages: DataFrame, text: str | Column, item: T.DataType | str, selector: str = "items"
) -> DataFrame:
    """Rows of the list that a page holds under ``selector``.

    A page that is no JSON object or has no such list is a reject with its text.
    """
    element = item if isinstance(item, str) else item.simpleString()
    column = F.col(text) if isinstance(text, str) else text
    page = F.from_json(column, f"struct<`{selector}`:array<{element}>>")
    bad = page[selector].isNull()
    reason = F.lit(f"the page has no list '{selector}'")
    problem = error(selector, F.when(bad, reason), column)
    none = F.array(F.lit(None).cast(element))
    items = pages.select(
        F.explode(F.when(bad, none).otherwise(page[selector])).alias("item"),
        F.when(bad, F.array(problem)).cast(ERROR_TYPE).alias(ERRORS),
    )
    return items.select("item.*", ERRORS)


def read_pages(
    spark: SparkSession, path: str, item: T.DataType | str, selector: str = "items"
) -> DataFrame:
    """Items of a folder of pages, one page per file."""
    pages = spark.read.text(path, wholetext=True)
    return unnest(pages, "value", item, selector)
