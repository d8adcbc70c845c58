"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for both ends ``a, b`` of every link: the smallest node of the component.

    Every step takes minima per node before it joins them back, so a node with very many links costs
    a row per link and no list. The links stay in the shared folder, never on the driver.
    """
    now = _downwards(links)
    state = None
    while True:
        now = stored(now, "links")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                now.select("b", "b").distinct()
            )
        state = new
        now = _small_star(_large_star(now))


def _downwards(links: DataFrame) -> DataFrame:
    """The links from the larger to the smaller node, each once."""
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour or itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _downwards(out)


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    out = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _downwards(out.union(least.select("a", F.col("m").alias("b"))))
