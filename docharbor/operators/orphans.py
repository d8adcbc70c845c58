"""Removal of child rows that vanished from a reloaded parent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from docharbor.errors import LoadError
from docharbor.functions.names import ROOT_ID, ROW_ID

AGAIN, WRITTEN = "_again", "_written"


def _need(df: DataFrame, label: str, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise LoadError(f"{label} has no {missing}, so vanished child rows cannot be found")


def root_ids(root_batch: DataFrame) -> DataFrame:
    """Row ids of the root rows of a load.

    They serve semi- and anti-joins only, where a repeated id changes nothing, so they are
    not made distinct by a shuffle of their own.
    """
    _need(root_batch, "the root table", ROW_ID)
    return root_batch.select(F.col(ROW_ID).alias(ROOT_ID))


def _by_root(children: DataFrame) -> DataFrame:
    """Children for a join by root id, which deals them out by it once, whatever their number.

    All joins of a cleanup then find both sides dealt out alike, and none of them moves a row
    again. Few roots that are marked for a broadcast still are broadcast.
    """
    return children.hint("merge")


def of_roots(children: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows that belong to one of the roots."""
    return _by_root(children).join(roots, ROOT_ID, "left_semi")


def existing_children(child_target: DataFrame, roots: DataFrame) -> DataFrame:
    """Stored children of the reloaded roots; children of other roots are never touched."""
    _need(child_target, "the child table", ROW_ID, ROOT_ID)
    return of_roots(child_target, roots)


def _same_child() -> WindowSpec:
    """Rows of one child: a row id is a digest of its parent, so it belongs to one root.

    Rows that are dealt out by root id have those with their own id in the same place.
    """
    return Window.partitionBy(ROOT_ID, ROW_ID)


def _reloaded_children(
    child_target: DataFrame, roots: DataFrame, child_batch: DataFrame
) -> DataFrame:
    """Stored children of the reloaded roots, marked where the load wrote them again."""
    _need(child_batch, "the child batch", ROW_ID, ROOT_ID)
    existing = existing_children(child_target, roots).withColumn(AGAIN, F.lit(False))
    again = existing_children(child_batch.select(ROOT_ID, ROW_ID), roots)
    again = again.filter(F.col(ROW_ID).isNotNull()).withColumn(AGAIN, F.lit(True))
    both = existing.unionByName(again, allowMissingColumns=True)
    marked = both.withColumn(WRITTEN, F.max(AGAIN).over(_same_child()))
    return marked.filter(~F.col(AGAIN)).drop(AGAIN)


def stale_children(
    child_target: DataFrame, roots: DataFrame, child_batch: DataFrame | None
) -> DataFrame:
    """Stored children of the reloaded roots that the load did not write again."""
    if child_batch is None:
        return existing_children(child_target, roots)
    return _reloaded_children(child_target, roots, child_batch).filter(~F.col(WRITTEN)).drop(WRITTEN)


def without_stale(
    child_target: DataFrame, roots: DataFrame, child_batch: DataFrame | None
) -> DataFrame:
    """The child table after the stale rows are gone: other roots' rows and those written again."""
    _need(child_target, "the child table", ROW_ID, ROOT_ID)
    # A row without an id is never stale.
    of_root = (F.col(f"_child.{ROOT_ID}") == F.col(f"_root.{ROOT_ID}")) & F.col(f"_child.{ROW_ID}").isNotNull()
    others = _by_root(child_target).alias("_child").join(roots.alias("_root"), of_root, "left_anti")
    if child_batch is None:
        return others
    reloaded = _reloaded_children(child_target, roots, child_batch)
    return others.unionByName(reloaded.filter(F.col(WRITTEN)).drop(WRITTEN))


def insert_children(child_target: DataFrame, child_batch: DataFrame) -> DataFrame:
    """Insert-only for child rows: every stored one stays, and those with new ids are added."""
    _need(child_target, "the child table", ROW_ID, ROOT_ID)
    _need(child_batch, "the child batch", ROW_ID, ROOT_ID)
    both = child_target.withColumn(AGAIN, F.lit(False)).unionByName(
        child_batch.withColumn(AGAIN, F.lit(True)), allowMissingColumns=True
    )
    added = F.min(AGAIN).over(_same_child()) | F.col(ROW_ID).isNull()
    return both.withColumn(WRITTEN, added).filter(~F.col(AGAIN) | F.col(WRITTEN)).drop(AGAIN, WRITTEN)


def replace_children(
    child_target: DataFrame, roots: DataFrame, child_batch: DataFrame | None
) -> DataFrame:
    """Upsert and removal in one pass.

    After both, the children of a reloaded root are exactly the rows of the batch, so one
    anti-join with the root ids does the work of two joins on child ids.
    """
    kept = _by_root(child_target).join(roots, ROOT_ID, "left_anti")
    if child_batch is None:
        return kept
    return kept.unionByName(child_batch, allowMissingColumns=True)


def clean_chain(
    stored: Mapping[str, DataFrame], batch: Mapping[str, DataFrame], root: str
) -> dict[str, DataFrame]:
    """Every child table of a chain after its batch and the removal.

    The tables come from the stored chain, so a list that was emptied everywhere and gives
    no batch is cleaned as well.
    """
    roots = root_ids(batch[root])
    result: dict[str, DataFrame] = {}
    for name in [*stored, *[n for n in batch if n not in stored]]:
        if name == root:
            continue
        if name not in stored:
            result[name] = batch[name]
        else:
            result[name] = replace_children(stored[name], roots, batch.get(name))
    return result
