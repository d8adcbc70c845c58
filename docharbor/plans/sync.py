"""Declared syncs: source table, key, cursor, hints, and the load they become."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.errors import ConfigError
from docharbor.functions.names import column_name
from docharbor.operators.shape import ERROR_TYPE, ERRORS, error
from docharbor.plans.dataset import Dataset, new_load_id
from docharbor.plans.load import LoadResult, may_broadcast, run_load
from docharbor.sources import incremental
from docharbor.spec import Hook, LoadSpec, with_hints

BOUNDARY = "_boundary"


@dataclass(frozen=True)
class SyncSpec:
    """One target table of a sync."""

    target: str
    source: Callable[[], DataFrame]
    primary_key: Sequence[str] | str = ()
    cursor: str | None = None
    initial_value: Any = None
    facet: Sequence[str] | str | None = None
    sort: Sequence[str] | str | None = None
    field_hints: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    hook: Hook | None = None
    disposition: str = "merge"
    buckets: int = 8
    on_reject: str = "fail"

    def load_spec(self, full_refresh: bool = False) -> LoadSpec:
        # A cursor says which of several changes of one key is the newest.
        spec = LoadSpec(
            self.target,
            disposition="replace" if full_refresh else self.disposition,
            primary_key=self.primary_key,
            order_by=(self.cursor,) if self.cursor else (),
            hook=self.hook,
            buckets=self.buckets,
            on_reject=self.on_reject,
        )
        if self.facet or self.sort or self.field_hints:
            spec = with_hints(
                spec, facet=self.facet, sort=self.sort, field_hints=self.field_hints or None
            )
        return spec


def run_sync(
    dataset: Dataset,
    syncs: Sequence[SyncSpec],
    pipeline: str,
    *,
    target: str = "all",
    limit: int | None = None,
    full_refresh: bool = False,
    dev_mode: bool = False,
    load_id: str | None = None,
) -> LoadResult:
    """Load what changed in the chosen targets and store the new cursors with the load."""
    chosen = [s for s in syncs if target in ("all", s.target)]
    if not chosen:
        raise ConfigError(f"no sync has the target '{target}'")
    load_id = load_id or new_load_id()
    if dev_mode:
        name = f"{dataset.name}_{load_id}".replace("-", "_")
        root = dataset.path[: -len(dataset.name)].rstrip("/") if dataset.name else dataset.path
        dataset = Dataset(dataset.spark, root, name, separator=dataset.separator)
    dataset.initialise()
    if dataset.is_completed(load_id):
        return LoadResult(load_id, repeated=True)
    state: dict[str, Any] = dict(dataset.state(pipeline) or {})
    batches = []
    for sync in chosen:
        batch = sync.source()
        if sync.cursor:
            batch, cursors = _changed(dataset, sync, batch, state, load_id, limit, full_refresh)
            state[sync.target] = cursors
        elif limit is not None:
            order = [sync.primary_key] if isinstance(sync.primary_key, str) else sync.primary_key
            batch = batch.orderBy(*(order or [F.to_json(F.struct("*"))])).limit(limit)
        batches.append((sync.load_spec(full_refresh), batch))
    return run_load(dataset, batches, load_id, pipeline=pipeline, state=state)


def _changed(
    dataset: Dataset,
    sync: SyncSpec,
    source: DataFrame,
    state: Mapping[str, Any],
    load_id: str,
    limit: int | None,
    full_refresh: bool,
) -> tuple[DataFrame, dict[str, Any]]:
    cursor = sync.cursor
    key = (sync.primary_key,) if isinstance(sync.primary_key, str) else tuple(sync.primary_key)
    before = {} if full_refresh else state.get(sync.target, {})
    kind = source.schema[cursor].dataType
    last = incremental.of_text(str(before["last"]), kind) if "last" in before else sync.initial_value
    seen = None
    if "boundary" in before:
        seen = dataset.spark.read.parquet(f"{dataset.path}/{before['boundary']}")
    few_seen = seen is not None and may_broadcast(dataset, seen.count())
    batch = incremental.delta(source, cursor, last, key=key, seen=seen, few_seen=few_seen)
    if limit is not None:
        batch = incremental.limited(batch, cursor, limit, key)
    # No delta can ever hold rows without a cursor, so each run reports them as rejects.
    missing = incremental.null_cursors(source, cursor)
    problem = error(cursor, F.lit("the cursor is missing or null"), F.lit(None))
    batch = batch.unionByName(
        missing.withColumn(ERRORS, F.array(problem).cast(ERROR_TYPE)), allowMissingColumns=True
    )
    # The source may change while it is read: the cursor must be that of the rows loaded.
    batch = dataset.stage(batch, f"{column_name(sync.target)}_delta", load_id)
    newest = incremental.newest(batch, cursor)
    if newest is None:
        return batch, dict(before)
    boundary = f"{BOUNDARY}/_load={load_id}/{column_name(sync.target)}"
    keys = incremental.boundary_keys(batch, cursor, incremental.of_text(newest, kind), key)
    if seen is not None and newest == str(before["last"]):
        keys = keys.unionByName(seen.select(incremental.BOUNDARY_KEY))
    keys.distinct().write.mode("overwrite").parquet(f"{dataset.path}/{boundary}")
    # Type and exact text: another machine, in another time zone, goes on from the same value.
    last = int(newest) if isinstance(kind, T.IntegralType) else newest
    return batch, {"last": last, "type": kind.simpleString(), "boundary": boundary}
