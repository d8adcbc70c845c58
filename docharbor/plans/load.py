"""Run a load: shape the batches, apply their dispositions, commit them together."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.errors import ConfigError, LoadError, SchemaError
from docharbor.functions import ids
from docharbor.functions.names import (
    ID,
    LIST_IDX,
    LOAD_ID,
    PARENT_ID,
    ROOT_ID,
    ROW_ID,
    normalise_names,
)
from docharbor.operators import dispositions, orphans, quality
from docharbor.operators.shape import (
    ERRORS,
    checked,
    child_tables,
    flatten,
    list_columns,
    merged_type,
    nest_chain,
    primary_kind,
    reconcile,
    split_variant,
    to_documents,
)
from docharbor.plans.dataset import (
    BUCKET,
    OK,
    UNBUCKETED,
    Dataset,
    Layout,
    Part,
    Written,
    bucket_of,
    document_schema,
    new_load_id,
)
from docharbor.session import SHORT_SHUFFLES, settings
from docharbor.spec import LoadSpec, table_fields

logger = logging.getLogger(__name__)

# Bytes an id takes in a broadcast table, with room for its overhead.
ID_BYTES = 128

# So many hashes of root ids are broadcast at once, some 40 bytes each.
MOST_HASHES = 1 << 22
ROOT_HASH = "_root_hash"


@dataclass
class TableResult:
    """What a load did to one table."""

    total: int = 0
    failed: int = 0
    updated: int = 0
    removed_orphans: int = 0
    ids_of_other_scheme: int = 0


@dataclass
class LoadResult:
    """What a load did; ``repeated`` when the load had been completed before."""

    load_id: str
    tables: dict[str, TableResult] = field(default_factory=dict)
    repeated: bool = False


def run_load(
    dataset: Dataset,
    batches: Sequence[tuple[LoadSpec, DataFrame]],
    load_id: str | None = None,
    *,
    pipeline: str | None = None,
    state: Mapping[str, Any] | None = None,
) -> LoadResult:
    """Apply several resources under one load id and commit them in one step.

    Nothing is visible before the commit. A load that failed can be run again under its
    id; a load that was completed is not run again.
    """
    load_id = load_id or new_load_id()
    if not re.fullmatch(r"[A-Za-z0-9._-]+", load_id):
        raise ConfigError(f"load id {load_id!r} may hold letters, digits, '.', '_' and '-' only")
    names = [spec.name for spec, _ in batches]
    if len(set(names)) != len(names):
        raise ConfigError(f"a load names a table twice: {sorted(names)}")
    for spec, _ in batches:
        if spec.disposition == "merge":
            _ = spec.key
    dataset.initialise()
    result = LoadResult(load_id)
    if dataset.is_completed(load_id):
        result.repeated = True
        return result
    stored = dataset.layouts()
    changed: dict[str, Layout] = {}
    for name in names:
        if name in stored and stored[name].parent is not None:
            raise SchemaError(f"resource '{name}' has the name of a child table of '{stored[name].root}'")
    with settings(dataset.spark, SHORT_SHUFFLES):
        for spec, batch in batches:
            if spec.disposition != "skip":
                _Resource(dataset, spec, load_id, stored, changed, result, names).run(batch)
    known = {**stored, **changed}
    schema_hash = dataset.store_schema(
        {name: {"fields": lay.fields, "columns": lay.schema} for name, lay in known.items()}
    )
    if pipeline is not None and state is not None:
        dataset.store_state(pipeline, state, load_id)
    dataset.commit(load_id, changed, schema_hash, stored)
    dataset.drop_stage(load_id)
    return result


class _Resource:
    """One resource of a load."""

    def __init__(
        self,
        dataset: Dataset,
        spec: LoadSpec,
        load_id: str,
        stored: Mapping[str, Layout],
        changed: dict[str, Layout],
        result: LoadResult,
        resources: Sequence[str],
    ) -> None:
        self.dataset = dataset
        self.spec = spec
        self.load_id = load_id
        self.stored = stored
        self.changed = changed
        self.result = result
        self.resources = resources

    # Shaping

    def run(self, batch: DataFrame) -> None:
        spec = self.spec
        rows = shape_rows(self.dataset, spec, batch, self.load_id, self.stored)
        children = child_tables(rows.schema, spec.name, spec.inline_columns())
        self._refuse_foreign(children)
        rows = self._one_per_key(rows)
        if children:
            # Every table of the chain reads the rows, so shape them once.
            known = self.stored.get(spec.name)
            buckets = known.buckets if known is not None else spec.buckets
            merged = spec.disposition == "merge"
            rows = self.dataset.stage(rows, spec.name, self.load_id, buckets if merged else None)
        chain = nest_chain(rows, spec.name, spec.inline_columns())
        old_children = [n for n, lay in self.stored.items() if lay.root == spec.name]
        roots = self._load_root(chain[spec.name])
        batches = {name: self._write_child(name, chain[name], roots) for name in children}
        # All rows of the batch lie in the tables' own folders before stored ones are written again.
        self.dataset.drop_stage(self.load_id, spec.name, f"{spec.name}_read")
        for name, (layout, written, staged) in batches.items():
            layout.parts = self._parts(name, layout, written, staged, roots)
        for name in old_children:
            if name not in children:
                self._load_without_batch(name, roots)

    def _refuse_foreign(self, children: Sequence[str]) -> None:
        """A child table must not take the name of a resource, or of a child of another one."""
        known = {**self.stored, **self.changed}
        for name in children:
            root = known[name].root if name in known else self.spec.name
            if name in self.resources or root != self.spec.name:
                raise SchemaError(
                    f"the child table '{name}' of '{self.spec.name}' has the name of another table"
                )

    def _fields(self, name: str, schema: T.StructType, is_root: bool) -> dict[str, Any]:
        spec = self.spec
        fresh = table_fields(spec if is_root else LoadSpec(name), schema)
        old = self.stored.get(name)
        if old is None or spec.disposition == "replace":
            return fresh
        if old.fields != fresh and is_root and (spec.field_hints or spec.table_hints):
            logger.info(
                "hints of table '%s' were not re-applied: they take effect when it is created", name
            )
        return old.fields

    def _documents(
        self, name: str, rows: DataFrame, fields: dict[str, Any], is_root: bool
    ) -> DataFrame:
        documents = to_documents(
            rows,
            self.spec,
            collection=self.dataset.qualified(name),
            fields=fields,
            is_root=is_root,
        )
        return self._reconciled(name, documents)

    def _reconciled(self, name: str, documents: DataFrame) -> DataFrame:
        old = self.stored.get(name)
        if old is None or self.spec.disposition == "replace":
            return documents
        return reconcile(documents, old.spark_schema)

    def _one_per_key(self, rows: DataFrame) -> DataFrame:
        """Keep the last row of a key, before its lists become child rows."""
        spec = self.spec
        if spec.disposition != "merge" or not spec.order_by:
            return rows
        missing = [c for c in spec.order_by if c not in rows.columns]
        if missing:
            raise ConfigError(f"table '{spec.name}': order_by columns {missing} are not in the batch")
        # A rejected row must not win over a good one of its key, and each is a reject of its own.
        flat = flatten(rows, spec.inline_columns())
        plain = flat.drop(*list_columns(flat, spec.inline_columns()))
        marked = checked(flat, spec, self._fields(spec.name, plain.drop(ERRORS).schema, True))
        marked = self.dataset.stage(marked, f"{spec.name}_read", self.load_id)
        good = marked.filter(F.col(ERRORS).isNull())
        bad = marked.filter(F.col(ERRORS).isNotNull())
        content = ids.content_json(bad.drop(ROW_ID))
        own = ids.digest_id(F.lit(spec.name), F.lit(self.load_id), content)
        if spec.action == "emplace":
            good = dispositions.last_value_per_column(good, [ROW_ID], spec.order_by)
        else:
            good = dispositions.last_wins(good, [ROW_ID], spec.order_by)
        return good.unionByName(bad.withColumn(ROW_ID, own))

    # Writing

    def _write_batch(
        self, name: str, documents: DataFrame, layout: Layout
    ) -> tuple[Written, DataFrame]:
        bucketed = self.spec.disposition == "merge"
        written = self.dataset.write_part(
            documents,
            name,
            self.load_id,
            "batch",
            layout,
            bucketed=bucketed,
            # Child rows come from files that were dealt out by their buckets.
            rebalance=bucketed and layout.parent is None,
            max_rows_per_file=self.spec.max_rows_per_file,
        )
        outcome = TableResult(written.total, written.failed)
        self.result.tables[name] = outcome
        # Objects are read back with the fields they have in the whole table.
        kinds = {f.name: f.dataType for f in layout.spark_schema.fields}
        schema = T.StructType(
            [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in documents.schema.fields]
        )
        staged = self.dataset.read_part(schema, name, written.part.path, layout)
        if written.failed and self.spec.on_reject == "fail":
            quality.fail_on_rejects(
                name,
                self.load_id,
                staged.filter(~F.col(OK)).drop(OK, BUCKET),
                written.failed,
                written.total,
            )
        return written, staged.filter(F.col(OK)).drop(OK, BUCKET, ERRORS)

    def _layout(
        self, name: str, schema: T.StructType, fields: dict[str, Any], is_root: bool
    ) -> Layout:
        old = self.stored.get(name) if self.spec.disposition != "replace" else None
        merged = document_schema(schema, fields)
        parent = None if is_root else self._parent_of(name)
        aliases = {} if is_root and self.spec.key else {ID: ROW_ID}
        if parent == self.spec.name:
            aliases[PARENT_ID] = ROOT_ID
        layout = Layout(
            schema=merged.jsonValue(),
            fields=fields,
            parent=parent,
            root=None if is_root else self.spec.name,
            buckets=self.spec.buckets,
            aliases=aliases,
            # Every child row is an element of a list.
            row_ids_of=None if is_root else name,
        )
        if old is not None:
            kinds = {f.name: f.dataType for f in old.spark_schema.fields}
            for f in merged.fields:
                kinds[f.name] = merged_type(kinds.get(f.name, f.dataType), f.dataType) or f.dataType
            every = T.StructType([T.StructField(n, k) for n, k in kinds.items()])
            layout.schema = document_schema(every, fields).jsonValue()
            layout.buckets = old.buckets
            layout.row_ids_of = old.row_ids_of
            # A table that was appended to and merged into stores its ids from then on.
            layout.aliases = {n: o for n, o in aliases.items() if old.aliases.get(n) == o}
            layout.fallbacks = {
                n: o
                for n, o in {**old.aliases, **old.fallbacks}.items()
                if n not in layout.aliases
            }
        return layout

    def _parent_of(self, name: str) -> str:
        known = [self.spec.name, *self.stored, *self.changed]
        parents = [n for n in known if name.startswith(f"{n}__")]
        return max(parents, key=len, default=self.spec.name)

    def _load_root(self, rows: DataFrame) -> DataFrame:
        """Load the root table; gives the good rows that were written."""
        name = self.spec.name
        fields = self._fields(name, rows.schema, True)
        documents = self._documents(name, rows, fields, True)
        layout = self._layout(name, documents.schema, fields, True)
        written, staged = self._write_batch(name, documents, layout)
        layout.parts = self._parts(name, layout, written, staged, None)
        self.changed[name] = layout
        return staged

    def _write_child(
        self, name: str, rows: DataFrame, roots: DataFrame
    ) -> tuple[Layout, Written, DataFrame]:
        fields = self._fields(name, rows.schema, False)
        documents = self._of_loaded_roots(self._documents(name, rows, fields, False), roots)
        layout = self._layout(name, documents.schema, fields, False)
        written, staged = self._write_batch(name, documents, layout)
        self.changed[name] = layout
        return layout, written, staged

    def _load_without_batch(self, name: str, roots: DataFrame) -> None:
        """The stored schema knows a child table that this batch has no list for."""
        old = self.stored[name]
        if self.spec.disposition == "replace":
            self.changed[name] = replace(old, parts=[])
        elif self.spec.cleans_orphans:
            layout = replace(old)
            layout.parts = self._parts(name, layout, None, None, roots)
            self.changed[name] = layout

    def _of_loaded_roots(self, documents: DataFrame, roots: DataFrame) -> DataFrame:
        """Reject the children of rejected root rows."""
        if not self.result.tables[self.spec.name].failed:
            return documents
        accepted = roots.select(F.col(ROW_ID).alias(ROOT_ID), F.lit(True).alias("_accepted"))
        marked = documents.join(accepted, ROOT_ID, "left")
        reason = F.when(F.col("_accepted").isNull(), F.lit("the root row was rejected"))
        return quality.add_error(marked, ROOT_ID, reason, F.col(ROOT_ID)).select(
            *[F.col(f"`{c}`") for c in documents.columns]
        )

    # Dispositions over stored parts

    def _parts(
        self,
        name: str,
        layout: Layout,
        written: Written | None,
        staged: DataFrame | None,
        roots: DataFrame | None,
    ) -> list[Part]:
        """Live parts of a table after this load."""
        spec = self.spec
        old = self.stored.get(name)
        batch = [written.part] if written is not None and written.part.buckets else []
        if spec.disposition == "replace" or (old is None and spec.disposition == "append"):
            return batch
        if spec.disposition == "append":
            return [*old.parts, *batch]
        if spec.row_key and staged is not None and not spec.order_by and roots is None:
            self._refuse_repeated_ids(name, staged)
        if old is None:
            return batch
        if spec.strategy == "insert-only":
            if not batch:
                return list(old.parts)
            return self._insert_only(name, layout, old, written, staged)
        self._warn_of_other_ids(name, old, staged, roots)
        return self._upsert(name, layout, old, written, staged, roots, batch)

    def _stored_rows(
        self, name: str, old: Layout, layout: Layout, buckets: set[int]
    ) -> DataFrame:
        """Rows of the stored parts with the columns the table has after this load."""
        return self.dataset.read_layout(name, replace(layout, parts=old.parts), buckets)

    def _refuse_repeated_ids(self, name: str, staged: DataFrame) -> None:
        repeated = dispositions.repeated_keys(staged.select(ID), [ID])
        if repeated:
            raise LoadError(
                f"table '{name}': {repeated} keys occur more than once in load '{self.load_id}' "
                "and no order_by says which row wins"
            )

    def _warn_of_other_ids(
        self, name: str, old: Layout, staged: DataFrame | None, roots: DataFrame | None
    ) -> None:
        """Rows an earlier append stored under row ids stay beside the merged ones."""
        appended = [p for p in old.parts if UNBUCKETED in p.buckets]
        key = self.spec.key
        if roots is not None or staged is None or not appended:
            return
        if not set(key) <= set(old.spark_schema.names):
            return
        target = self.dataset.read_layout(name, replace(old, parts=appended))
        count = dispositions.of_other_scheme(target, staged, key).count()
        self.result.tables[name].ids_of_other_scheme = count
        if count:
            logger.warning("table '%s': %d rows keep ids of an earlier append", name, count)

    def _insert_only(
        self, name: str, layout: Layout, old: Layout, written: Written, staged: DataFrame
    ) -> list[Part]:
        """Add the rows that are new; only buckets with some known ids are written again."""
        target = self._stored_rows(name, old, layout, {*written.part.buckets, UNBUCKETED})
        keys, _ = self._checked_broadcast(staged.select(ID), written.total)
        hits = self._hits(target, keys, ID, layout)
        if not hits:
            return [*old.parts, written.part]
        known = self._stored_rows(name, old, layout, {*hits, UNBUCKETED})
        bucket = bucket_of(F.col(layout.bucket_by), layout.buckets)
        mixed = staged.filter(bucket.isin(sorted(hits)))
        added = self._rewrite(name, layout, dispositions.new_rows(known, mixed), "new", True)
        batch = replace(layout, parts=[written.part]).without_buckets(set(hits))
        return [*old.parts, *batch, *([added.part] if added.part.buckets else [])]

    def _checked_broadcast(self, keys: DataFrame, count: int) -> tuple[DataFrame, bool]:
        """Keys for a broadcast join where their counted size allows it, and whether it does."""
        small = may_broadcast(self.dataset, count)
        return (F.broadcast(keys) if small else keys), small

    def _upsert(
        self,
        name: str,
        layout: Layout,
        old: Layout,
        written: Written | None,
        staged: DataFrame | None,
        roots: DataFrame | None,
        batch: list[Part],
    ) -> list[Part]:
        """Rewrite the buckets that hold rows the batch replaces; all others stay as they are.

        Rows are replaced by document id, or in child tables whose orphans are removed by
        root id: after both steps a reloaded root has the children of the batch and no other.
        """
        spec = self.spec
        cleans = roots is not None and spec.cleans_orphans
        if cleans:
            on, keys = ROOT_ID, orphans.root_ids(roots)
            count = self.result.tables[spec.name].total
        else:
            on, keys, count = ID, staged.select(ID), written.total
        keys, small = self._checked_broadcast(keys, count)
        near = self._buckets_of(keys, on, written, layout)
        target = self._stored_rows(name, old, layout, {*near, UNBUCKETED})
        counted = self._counted_roots(name, target) if cleans else None
        hits = self._hits(target, keys, on, layout, counted)
        outcome = self.result.tables.setdefault(name, TableResult())
        replaced = existing = sum(hits.values())
        if cleans and existing:
            replaced = 0
            if staged is not None:
                replaced = self._written_again(target, staged, old)
            outcome.removed_orphans = existing - replaced
        outcome.updated = replaced
        if not hits:
            return [*old.parts, *batch]
        touched = {*hits, UNBUCKETED}
        target = self._stored_rows(name, old, layout, touched)
        by_id = on == ID == layout.bucket_by
        if spec.action == "emplace" and staged is not None:
            if cleans:
                target = orphans.without_stale(target, keys, staged)
            bucket = bucket_of(F.col(layout.bucket_by), layout.buckets)
            near_rows = staged.filter(bucket.isin(sorted(hits)))
            # Child rows are joined by their own id but stored by that of their root.
            if by_id:
                target, near_rows = self._side_by_side(layout, target, near_rows, ID)
            rows = dispositions.emplace(target, near_rows)
            rewritten = self._rewrite(name, layout, rows, "merged", rebalance=not by_id)
            batch = replace(layout, parts=batch).without_buckets(set(hits))
        else:
            # Few keys are broadcast: stored rows never move, and every task writes the
            # buckets it read. Many keys are joined by a shuffle. A root may own very many
            # children, so these are left to the adaptive join and spread evenly afterwards.
            kept_parts = None
            if cleans and not small:
                kept_parts = self._kept_in_place(name, layout, old, sorted(hits), counted, keys, near)
            if kept_parts is None:
                if by_id and not small:
                    target, keys = self._side_by_side(layout, target, keys, on)
                kept = target.join(keys, on, "left_anti").select(
                    *[F.col(f"`{c}`") for c in target.columns]
                )
                # Joined by the hash that makes the buckets: with a multiple of them as partitions,
                # every task holds rows of one bucket, and no second shuffle is needed.
                tasks = int(self.dataset.spark.conf.get("spark.sql.shuffle.partitions"))
                even = on == layout.bucket_by and tasks % layout.buckets == 0
                rewritten = self._rewrite(name, layout, kept, "kept", not (small or by_id or even))
                kept_parts = [rewritten.part]
            return [*old.without_buckets(touched), *batch, *[p for p in kept_parts if p.buckets]]
        kept_parts = [rewritten.part] if rewritten.part.buckets else []
        return [*old.without_buckets(touched), *batch, *kept_parts]

    def _written_again(self, target: DataFrame, staged: DataFrame, old: Layout) -> int:
        """How many stored child rows have their row id in the batch."""
        if not old.row_ids_of:
            return target.join(staged.select(ROW_ID), ROW_ID, "left_semi").count()
        # A row id is made of the parent and the place in its list. Of every 64 places of a list
        # one row is moved, with a bit for each of them.
        place = [PARENT_ID, LIST_IDX]
        both = target.select(*place, F.lit(True).alias("_stored")).unionByName(
            staged.select(*place, F.lit(False).alias("_stored"))
        )
        bit = F.expr(f"shiftleft(1L, {LIST_IDX} % 64)")
        stretch = F.floor(F.col(LIST_IDX) / 64).alias("_stretch")
        met = both.groupBy(PARENT_ID, stretch).agg(
            F.count_if("_stored").alias("rows"),
            F.coalesce(F.bit_or(F.when(F.col("_stored"), bit)), F.lit(0)).alias("stored"),
            F.coalesce(F.bit_or(F.when(~F.col("_stored"), bit)), F.lit(0)).alias("again"),
        )
        shared = F.bit_count(F.col("stored").bitwiseAND(F.col("again")))
        repeated = F.col("rows") > F.bit_count("stored")
        found = met.agg(F.sum(shared), F.max(repeated & (F.col("again") != 0))).first()
        if not found[1]:
            return found[0] or 0
        # An append may have stored a place several times; each of its rows counts.
        met = both.groupBy(*place).agg(
            F.count_if("_stored").alias("times"), F.min("_stored").alias("least")
        )
        return met.filter(~F.col("least")).agg(F.sum("times")).first()[0] or 0

    def _counted_roots(self, name: str, target: DataFrame) -> DataFrame:
        """Stored child rows counted by root: few rows, which several joins read."""
        counts = target.groupBy(ROOT_ID).count()
        return self.dataset.stage(counts, f"{name}_roots", self.load_id)

    def _kept_in_place(
        self,
        name: str,
        layout: Layout,
        old: Layout,
        hits: list[int],
        counted: DataFrame,
        keys: DataFrame,
        reloaded: Mapping[int, int],
    ) -> list[Part] | None:
        """Write the child rows of roots that are not reloaded again, without moving them.

        The reloaded roots are broadcast as hashes of 8 bytes, of so many buckets at a time as
        ``MOST_HASHES`` allow. None where a single bucket has more of them, or where a root that
        stays has the hash of a reloaded one: these need a join by the ids.
        """
        groups: list[list[int]] = []
        room = -1
        for bucket in hits:
            room -= reloaded[bucket]
            if room < 0:
                groups.append([])
                room = MOST_HASHES - reloaded[bucket]
            groups[-1].append(bucket)
        # Rows without a bucket of their own may belong to any.
        unbucketed = any(UNBUCKETED in p.buckets for p in old.parts)
        if max(reloaded[b] for b in hits) > MOST_HASHES or (unbucketed and len(groups) > 1):
            return None
        # A row without a root has no hash and stays.
        known = keys.filter(F.col(ROOT_ID).isNotNull())
        staying = counted.join(keys, ROOT_ID, "left_anti").select(root_hash())
        if staying.join(known.select(root_hash()), ROOT_HASH, "left_semi").limit(1).collect():
            return None
        bucket_column = bucket_of(F.col(ROOT_ID), layout.buckets)
        parts = []
        for i, group in enumerate(groups):
            target = self._stored_rows(name, old, layout, {*group, UNBUCKETED})
            hashes = known.filter(bucket_column.isin(group)).select(root_hash()).distinct()
            marked = target.select("*", root_hash())
            kept = marked.join(F.broadcast(hashes), ROOT_HASH, "left_anti").select(
                *[F.col(f"`{c}`") for c in target.columns]
            )
            step = f"kept-{i}" if i else "kept"
            parts.append(self._rewrite(name, layout, kept, step, rebalance=False).part)
        return parts

    def _buckets_of(
        self, keys: DataFrame, on: str, written: Written | None, layout: Layout
    ) -> dict[int, int]:
        """Buckets that rows with these keys can be in, with the number of keys where they are read.

        At most one small row per bucket is collected.
        """
        if written is not None and on == ID:
            return dict.fromkeys(written.part.buckets, 0)
        bucket = bucket_of(F.col(on), layout.buckets).alias(BUCKET)
        return {r[BUCKET]: r["count"] for r in keys.groupBy(bucket).count().collect()}

    def _hits(
        self,
        target: DataFrame,
        keys: DataFrame,
        on: str,
        layout: Layout,
        counted: DataFrame | None = None,
    ) -> dict[int, int]:
        """Stored rows with one of the keys, counted per bucket, reading ids alone.

        A batch of new rows hits nothing and then costs no rewrite at all. ``counted`` are the
        rows counted by ``on``, where that is what makes the buckets.
        """
        bucket = bucket_of(F.col(layout.bucket_by), layout.buckets).alias(BUCKET)
        if counted is not None:
            found = counted.join(keys, on, "left_semi").groupBy(bucket).agg(F.sum("count").alias("count"))
        else:
            names = list(dict.fromkeys([on, layout.bucket_by]))
            found = target.select(*names).join(keys, on, "left_semi").groupBy(bucket).count()
        return {r[BUCKET]: r["count"] for r in found.collect()}

    def _side_by_side(
        self, layout: Layout, left: DataFrame, right: DataFrame, on: str
    ) -> tuple[DataFrame, DataFrame]:
        """Both sides laid out by the hash that also makes the buckets.

        Ids are unique, so the tasks are even, and each of them writes to one bucket without
        another shuffle.
        """
        tasks = int(self.dataset.spark.conf.get("spark.sql.shuffle.partitions"))
        parts = layout.buckets * max(1, -(-tasks // layout.buckets))
        return left.repartition(parts, on), right.repartition(parts, on)

    def _rewrite(
        self, name: str, layout: Layout, rows: DataFrame, step: str, rebalance: bool
    ) -> Written:
        return self.dataset.write_part(
            rows, name, self.load_id, step, layout, rebalance=rebalance
        )


def root_hash() -> Column:
    """A number for a root id; null for none."""
    return F.when(F.col(ROOT_ID).isNotNull(), F.xxhash64(ROOT_ID)).alias(ROOT_HASH)


def may_broadcast(dataset: Dataset, ids_count: int) -> bool:
    """Whether so many ids fit the session's limit for broadcast tables."""
    return ids_count * ID_BYTES <= _broadcast_limit(dataset)


def _broadcast_limit(dataset: Dataset) -> int:
    text = str(dataset.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).lower().rstrip("b")
    units = {"k": 1024, "m": 1024**2, "g": 1024**3}
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def shape_rows(
    dataset: Dataset,
    spec: LoadSpec,
    batch: DataFrame,
    load_id: str,
    stored: Mapping[str, Layout] | None = None,
) -> DataFrame:
    """Source rows with cleaned names, resolved variants, row ids and the load id."""
    if spec.hook is not None:
        batch = batch.transform(spec.hook)
    rows = normalise_names(batch, spec.inline_columns())
    rows = _resolve_variants(rows, spec, (stored or {}).get(spec.name))
    collection = dataset.qualified(spec.name)
    rows = with_row_id(rows, spec, collection, load_id)
    others = [c for c in rows.columns if c not in (ROW_ID, LOAD_ID, *spec.origin)]
    kept = [c for c in spec.origin if not c.startswith("_origin")]
    return rows.select(
        ROW_ID,
        F.lit(load_id).alias(LOAD_ID),
        *[F.col(f"`{c}`") for c in others],
        *[F.col(f"`{c}`") for c in kept],
    )


def with_row_id(rows: DataFrame, spec: LoadSpec, collection: str, load_id: str) -> DataFrame:
    """Row ids, by the best name a row has: its own, its key, its origin, its content."""
    if ROW_ID in rows.columns:
        return rows.withColumn(ROW_ID, F.col(ROW_ID).cast("string"))
    if spec.row_key:
        missing = [c for c in spec.row_key if c not in rows.columns]
        if missing:
            raise ConfigError(f"table '{spec.name}': key columns {missing} are not in the batch")
        keyed = ids.keyed_row_id(rows, collection, spec.row_key)
        # A row without a key, or one its source rejects, must not pass for a row of a key.
        content = ids.digest_id(F.lit(collection), F.lit(load_id), ids.content_json(rows))
        no_key = reduce(or_, [F.col(f"`{c}`").isNull() for c in spec.row_key])
        if ERRORS in rows.columns:
            no_key = no_key | F.col(ERRORS).isNotNull()
        return rows.withColumn(ROW_ID, F.when(no_key, content).otherwise(keyed))
    if spec.origin:
        return rows.withColumn(ROW_ID, ids.origin_row_id(collection, load_id, spec.origin))
    return ids.with_content_row_id(rows, collection, load_id)


def _resolve_variants(rows: DataFrame, spec: LoadSpec, stored: Layout | None) -> DataFrame:
    """Give every VARIANT column of mixed types its typed columns."""
    families = {
        T.StringType(): "STRING",
        T.LongType(): "BIGINT",
        T.DoubleType(): "DOUBLE",
        T.BooleanType(): "BOOLEAN",
    }
    inline = spec.inline_columns()
    known = {f.name: f.dataType for f in stored.spark_schema.fields} if stored else {}
    for f in rows.schema.fields:
        if not isinstance(f.dataType, T.VariantType) or f.name in inline:
            continue
        primary = families.get(known.get(f.name))
        if primary is None:
            seq = spec.order_by[0] if spec.order_by else None
            ordered = rows if seq else rows.withColumn("_text", F.to_json(F.col(f"`{f.name}`")))
            primary = primary_kind(ordered, f.name, seq or "_text")
        rows = split_variant(rows, f.name, primary or "STRING")
    return rows
