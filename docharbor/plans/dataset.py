"""A dataset: Parquet tables below one folder, switched by completed loads.

    <root>/<dataset>/<table>/_load=<id>/_part=<step>/_ok=<bool>/_bucket=<n>/*.parquet
    <root>/<dataset>/_loads, _versions, _pipeline_state

A load writes new folders and then one row to ``_loads``, which names the folders that
make up every table it changed. Readers follow the newest row of a table, so they see
either the whole load or nothing of it. There is one writer per dataset.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.errors import ConfigError, LoadError
from docharbor.functions.ids import child_row_id, system_row_id
from docharbor.functions.names import (
    ID,
    LIST_IDX,
    LOAD_ID,
    PARENT_ID,
    ROOT_ID,
    ROW_ID,
    SYSTEM_COLUMNS,
    qualified_name,
)
from docharbor.operators import reads, system
from docharbor.operators.shape import ERROR_TYPE, ERRORS
from docharbor.session import FOOTER_COUNTS, OPEN_FILES_LIMIT, require_utc, settings

ENGINE_VERSION = 1
LOADS, VERSIONS, STATE, STAGE = "_loads", "_versions", "_pipeline_state", "_stage"
LOAD, PART, OK, BUCKET = "_load", "_part", "_ok", "_bucket"
UNBUCKETED = -1
ADDED = "added"
# Staged rows often grow many times when their lists are exploded, so they are cut finely.
STAGE_BLOCK_BYTES = 4 * 1024 * 1024
# Texts are read and written a few times by a load, and their files are most of its disk.
CODEC = "zstd"
# A task keeps so many files open while it writes, and sorts its rows by bucket where there are
# more; of each file it holds a block in memory.
OPEN_FILES = 8
OPEN_BLOCK_BYTES = 16 * 1024 * 1024
# Up to this many buckets of a part are read by their folder names.
FEW_BUCKETS = 64
PLACES = (
    T.StructField(LOAD, T.StringType()),
    T.StructField(PART, T.StringType()),
    T.StructField(OK, T.BooleanType()),
    T.StructField(BUCKET, T.IntegerType()),
)


@dataclass
class Part:
    """One written folder of a table and those of its buckets that are still live."""

    path: str
    buckets: list[int]
    whole: bool = True


@dataclass
class Layout:
    """What makes up a table: its schema, its hints as of creation, its live parts."""

    schema: dict[str, Any]
    fields: dict[str, Any]
    parts: list[Part] = field(default_factory=list)
    parent: str | None = None
    root: str | None = None
    buckets: int = 8
    # Columns that equal another one in every row and are not stored, such as the id of a
    # row that is its row id; and columns that only later parts store.
    aliases: dict[str, str] = field(default_factory=dict)
    fallbacks: dict[str, str] = field(default_factory=dict)
    # The name under which the row ids of list elements were made. They are made again when rows
    # are read: digests do not compress and would be most of a table of short values.
    row_ids_of: str | None = None

    @property
    def not_stored(self) -> set[str]:
        """Columns that follow from others."""
        return {*self.aliases, *([ROW_ID] if self.row_ids_of else [])}

    def column(self, name: str) -> Column:
        """A column of the table, out of those that are stored."""
        name = self.aliases.get(name, name)
        if name == ROW_ID and self.row_ids_of:
            return child_row_id(self.column(PARENT_ID), self.row_ids_of, F.col(LIST_IDX))
        return F.col(f"`{name}`")

    @property
    def spark_schema(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    @property
    def bucket_by(self) -> str:
        return ROOT_ID if self.parent else ID

    def dumps(self, old: Layout | None = None) -> str:
        """The layout as text; only the added parts where nothing else differs from ``old``.

        A table that is appended to many times then costs a few bytes per load.
        """
        if old is not None and self.parts[: len(old.parts)] == old.parts:
            if replace(self, parts=old.parts) == old:
                added = self.parts[len(old.parts) :]
                return json.dumps({ADDED: [asdict(p) for p in added]})
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def of(raw: dict[str, Any]) -> Layout:
        return Layout(**{**raw, "parts": [Part(**p) for p in raw["parts"]]})

    def without_buckets(self, buckets: set[int]) -> list[Part]:
        """The parts less some buckets, which were written anew."""
        left = []
        for part in self.parts:
            live = [b for b in part.buckets if b not in buckets]
            if live:
                left.append(Part(part.path, live, part.whole and live == part.buckets))
        return left


@dataclass(frozen=True)
class Written:
    """Counts of one written part."""

    part: Part
    total: int
    failed: int


def bucket_of(column: Column, buckets: int) -> Column:
    """Hash bucket of an id, the same function Spark shuffles by."""
    return F.pmod(F.hash(column), F.lit(buckets))


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def new_load_id(prefix: str = "load") -> str:
    """A load id that is also a legal folder name."""
    return f"{prefix}-{time.time_ns()}"


class Dataset:
    """Tables and system tables of one dataset."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str = "",
        *,
        separator: str = "_",
        schema_name: str | None = None,
    ) -> None:
        require_utc(spark)
        self.spark = spark
        self.name = name
        self.separator = separator
        self.schema_name = schema_name or name or "default"
        self.path = f"{root.rstrip('/')}/{name}" if name else root.rstrip("/")

    # Storage helpers

    def _folder(self, *parts: str) -> str:
        return "/".join([self.path, *parts])

    def _file_system(self, path: str) -> tuple[Any, Any]:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _exists(self, path: str) -> bool:
        file_system, hadoop_path = self._file_system(path)
        return bool(file_system.exists(hadoop_path))

    def _delete(self, path: str) -> None:
        file_system, hadoop_path = self._file_system(path)
        file_system.delete(hadoop_path, True)

    def _system(self, table: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self._folder(table))
        except AnalysisException as missing:
            raise LoadError(f"dataset '{self.name}' has no table '{table}'") from missing

    def _row(self, schema: T.StructType, row: Mapping[str, Any]) -> DataFrame:
        """One row in one partition, so that writing it makes one file."""
        values = []
        for f in schema.fields:
            value = row[f.name]
            if isinstance(value, dict):
                pairs = [F.lit(x) for pair in value.items() for x in pair]
                value = F.create_map(*pairs) if pairs else F.create_map()
            column = value if isinstance(value, Column) else F.lit(value)
            values.append(column.cast(f.dataType).alias(f.name))
        return self.spark.range(0, 1, 1, 1).select(*values)

    def _no_rows(self, schema: T.StructType) -> DataFrame:
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return self.spark.range(0, 0, 1, 1).select(*nulls)

    # Life cycle

    def qualified(self, table: str) -> str:
        return qualified_name(self.name, table, self.separator)

    def initialise(self, truncate: Iterable[str] = ()) -> None:
        """Make missing system tables and empty the listed tables; other data stays."""
        for table, schema in (
            (VERSIONS, system.VERSION_SCHEMA),
            (LOADS, system.LOADS_SCHEMA),
            (STATE, system.STATE_SCHEMA),
        ):
            if not self._exists(self._folder(table)):
                self._no_rows(schema).write.mode("append").parquet(self._folder(table))
        names = list(truncate)
        if names:
            self.truncate(names)

    def is_initialised(self) -> bool:
        return self._exists(self._folder(VERSIONS))

    def truncate(self, tables: Iterable[str]) -> None:
        """Empty the listed tables; they keep their schema."""
        layouts = self.layouts()
        changed = {}
        for name in tables:
            if name in layouts:
                layouts[name].parts = []
                changed[name] = layouts[name]
        if changed:
            self.commit(new_load_id("truncate"), changed)

    def drop(self, tables: Iterable[str] | None = None) -> None:
        """Delete the dataset's folder; without a dataset name only the listed tables."""
        if self.name:
            self._delete(self.path)
            return
        if tables is None:
            raise LoadError("a dataset without a name is dropped table by table: list them")
        for name in tables:
            self._delete(self._folder(name))
        for table in (LOADS, VERSIONS, STATE, STAGE):
            self._delete(self._folder(table))

    # System tables

    def loads(self) -> DataFrame:
        return self._system(LOADS, system.LOADS_SCHEMA)

    def versions(self) -> DataFrame:
        return self._system(VERSIONS, system.VERSION_SCHEMA)

    def states(self) -> DataFrame:
        return self._system(STATE, system.STATE_SCHEMA)

    def is_completed(self, load_id: str) -> bool:
        return bool(self.loads().filter(F.col("load_id") == load_id).limit(1).collect())

    def store_schema(self, tables: Mapping[str, Any]) -> str:
        """Store a schema version unless its hash is stored already; gives the hash."""
        text = json.dumps({"name": self.schema_name, "tables": tables}, sort_keys=True)
        digest = hashlib.sha256(text.encode("utf-8")).hexdigest()
        stored = self.versions()
        if not system.schema_by_hash(stored, digest).collect():
            newest = stored.filter(F.col("schema_name") == self.schema_name).agg(F.max("version"))
            row = {
                "id": None,
                "version": (newest.first()[0] or 0) + 1,
                "engine_version": ENGINE_VERSION,
                "inserted_at": utc_now(),
                "schema_name": self.schema_name,
                "version_hash": digest,
                "schema": text,
            }
            rows = system.with_version_id(self._row(system.VERSION_SCHEMA, row))
            rows.select(*system.VERSION_SCHEMA.names).write.mode("append").parquet(
                self._folder(VERSIONS)
            )
        return digest

    def schema(self, name: str | None = None) -> dict[str, Any] | None:
        """The newest stored schema; none before the dataset is set up."""
        if not self.is_initialised():
            return None
        row = system.latest_schema(self.versions(), name).first()
        return row.asDict() if row else None

    def schema_by_hash(self, version_hash: str) -> dict[str, Any] | None:
        if not self.is_initialised():
            return None
        row = system.schema_by_hash(self.versions(), version_hash).first()
        return row.asDict() if row else None

    def store_state(self, pipeline: str, state: Mapping[str, Any], load_id: str) -> None:
        """Write a state with its load; it is visible once the load is completed."""
        newest = self.states().filter(F.col("pipeline_name") == pipeline).agg(F.max("version"))
        row = {
            "id": None,
            "version": (newest.first()[0] or 0) + 1,
            "engine_version": ENGINE_VERSION,
            "pipeline_name": pipeline,
            "state": json.dumps(state, sort_keys=True),
            "created_at": utc_now(),
            "_load_id": load_id,
        }
        rows = self._row(system.STATE_SCHEMA, row).withColumn(
            ID, system_row_id(F.lit("state"), F.col("pipeline_name"), F.col(LOAD_ID))
        )
        rows.select(*system.STATE_SCHEMA.names).write.mode("append").parquet(
            self._folder(STATE)
        )

    def state(self, pipeline: str) -> dict[str, Any] | None:
        """The newest committed state of a pipeline."""
        row = system.newest_state(self.states(), self.loads(), pipeline).first()
        return json.loads(row["state"]) if row else None

    def state_row(self, pipeline: str) -> dict[str, Any] | None:
        row = system.newest_state(self.states(), self.loads(), pipeline).first()
        return row.asDict() if row else None

    def commit(
        self,
        load_id: str,
        changed: Mapping[str, Layout],
        schema_hash: str = "",
        stored: Mapping[str, Layout] | None = None,
    ) -> None:
        """Complete a load: one row in one file, written last."""
        loads = self.loads()
        if loads.filter(F.col("load_id") == load_id).limit(1).collect():
            return
        row = {
            "id": load_id,
            "load_id": load_id,
            "schema_name": self.schema_name,
            "status": system.COMPLETED,
            "inserted_at": utc_now(),
            "schema_version_hash": schema_hash,
            "seq": (loads.agg(F.max("seq")).first()[0] or 0) + 1,
            "layout": {n: lay.dumps((stored or {}).get(n)) for n, lay in changed.items()},
        }
        self._row(system.LOADS_SCHEMA, row).write.mode("append").parquet(
            self._folder(LOADS)
        )

    # Tables

    def layouts(self) -> dict[str, Layout]:
        """Newest layout of every table: its last whole layout and the parts added since."""
        entries = self.loads().select("seq", F.explode("layout").alias("table", "layout"))
        whole = ~F.col("layout").startswith(f'{{"{ADDED}"')
        bases = entries.filter(whole).groupBy("table").agg(F.max("seq").alias("base"))
        since = entries.join(bases, "table").filter(F.col("seq") >= F.col("base"))
        found: dict[str, Layout] = {}
        for row in since.orderBy("seq").select("table", "layout").collect():
            raw = json.loads(row["layout"])
            if ADDED in raw:
                found[row["table"]].parts += [Part(**p) for p in raw[ADDED]]
            else:
                found[row["table"]] = Layout.of(raw)
        return found

    def tables(self) -> list[str]:
        return sorted(self.layouts()) if self._exists(self._folder(LOADS)) else []

    def layout(self, table: str) -> Layout:
        layouts = self.layouts()
        if table not in layouts:
            raise LoadError(f"dataset '{self.name}' has no table '{table}'")
        return layouts[table]

    def read(self, table: str) -> DataFrame:
        """All rows of a table as of its newest completed load."""
        return self.read_layout(table, self.layout(table))

    def read_layout(
        self, table: str, layout: Layout, buckets: set[int] | None = None
    ) -> DataFrame:
        """Rows of a table, or of some of its buckets; other buckets are not read.

        A few buckets of a part are named one by one. More of them are left to partition
        pruning, which spares the driver a long list of folders.
        """
        base = self._folder(table)
        paths, condition = [], F.lit(True)
        for part in layout.parts:
            live = [b for b in part.buckets if buckets is None or b in buckets]
            folder = f"{base}/{part.path}/{OK}=true"
            if live and part.whole and live == part.buckets:
                paths.append(folder)
            elif len(live) <= FEW_BUCKETS:
                paths += [f"{folder}/{BUCKET}={b}" for b in live]
            else:
                paths.append(folder)
                load, step = (p.split("=", 1)[1] for p in part.path.split("/"))
                elsewhere = (F.col(LOAD) != load) | (F.col(PART) != step)
                condition = condition & (elsewhere | F.col(BUCKET).isin(live))
        schema = layout.spark_schema
        if not paths:
            return self._no_rows(schema)
        stored = [f for f in schema.fields if f.name not in layout.not_stored]
        rows = self.spark.read.schema(T.StructType([*stored, *PLACES]))
        rows = rows.option("basePath", base).parquet(*paths).filter(condition)
        columns = []
        for name in schema.names:
            column = layout.column(name)
            if name in layout.fallbacks:
                column = F.coalesce(column, F.col(f"`{layout.fallbacks[name]}`"))
            columns.append(column.alias(name))
        return rows.select(*columns)

    def count(self, table: str) -> int:
        """How many rows a table has, added up from the footers of its files; no column is read."""
        with settings(self.spark, FOOTER_COUNTS):
            return reads.found(self.read(table))

    def lookup(self, table: str, document_id: str) -> DataFrame:
        """The document with an id; only the id's bucket is read."""
        layout = self.layout(table)
        buckets = None
        if layout.bucket_by == ID:
            target = self.spark.range(1).select(bucket_of(F.lit(document_id), layout.buckets))
            buckets = {target.first()[0], UNBUCKETED}
        return reads.where_equal(self.read_layout(table, layout, buckets), ID, document_id)

    def browse(
        self, table: str, per_page: int, number: int = 1, *, after: tuple[str | None, str] | None = None
    ) -> DataFrame:
        """A page in the table's default order, or by id where it has none.

        Pages are numbered, or follow the place ``after`` that :meth:`place` gives for the page before; the
        latter skips files instead of counting off rows.
        """
        layout = self.layout(table)
        column = layout.fields.get("default_sorting_field")
        rows = self.read_layout(table, layout)
        if after is not None:
            return reads.page_after(
                rows, column or ID, per_page=per_page, last=after, descending=bool(column)
            )
        return reads.page(
            rows, column or ID, per_page=per_page, number=number, descending=bool(column)
        )

    def place(self, table: str, page: DataFrame) -> tuple[str | None, str] | None:
        """Where a page of :meth:`browse` ends."""
        return reads.place_of(page, self.layout(table).fields.get("default_sorting_field") or ID)

    def delete_where(self, table: str, condition: Column, load_id: str | None = None) -> int:
        """Delete matching rows; gives how many there were.

        Only the buckets that hold such rows are written anew. A load id that was completed is
        refused: its folder may be part of the table.
        """
        load_id = load_id or new_load_id("delete")
        if self.is_completed(load_id):
            raise ConfigError(f"the load '{load_id}' was completed before")
        layout = self.layout(table)
        rows = self.read_layout(table, layout)
        wanted = F.coalesce(condition, F.lit(False))
        bucket = bucket_of(F.col(layout.bucket_by), layout.buckets).alias(BUCKET)
        hits = {r[BUCKET]: r["count"] for r in rows.filter(wanted).groupBy(bucket).count().collect()}
        if hits:
            # Rows without a bucket of their own may belong to any, so they are read as well.
            touched = {*hits, UNBUCKETED}
            left = reads.without(self.read_layout(table, layout, touched), condition)
            written = self.write_part(left, table, load_id, "kept", layout)
            added = [written.part] if written.part.buckets else []
            layout.parts = [*layout.without_buckets(touched), *added]
            self.commit(load_id, {table: layout})
        return sum(hits.values())

    def remove_unreferenced(self, keep_rejects: bool = True) -> int:
        """Delete folders that no table is made of any more; gives how many there were.

        Rejected rows of completed loads stay, unless ``keep_rejects`` is false. Run it when no load and no
        reader of an older state is active.
        """
        removed = 0
        for name, layout in self.layouts().items():
            live = {part.path for part in layout.parts}
            file_system, table = self._file_system(self._folder(name))
            if not file_system.exists(table):
                continue
            for load in file_system.listStatus(table):
                for part in file_system.listStatus(load.getPath()):
                    path = f"{load.getPath().getName()}/{part.getPath().getName()}"
                    if path in live:
                        continue
                    unused = [part.getPath()]
                    if keep_rejects and self._exists(self._folder(name, path, f"{OK}=false")):
                        if self.is_completed(load.getPath().getName().split("=", 1)[1]):
                            inside = file_system.listStatus(part.getPath())
                            unused = [p.getPath() for p in inside if p.getPath().getName() == f"{OK}=true"]
                    for folder in unused:
                        file_system.delete(folder, True)
                    removed += bool(unused)
        return removed

    def write_part(
        self,
        rows: DataFrame,
        table: str,
        load_id: str,
        step: str,
        layout: Layout,
        *,
        bucketed: bool = True,
        rebalance: bool = False,
        max_rows_per_file: int = 0,
    ) -> Written:
        """Write rows, good ones apart from rejected ones, and count both from the files.

        Counting what was written stays exact when tasks are run again. Running a load
        again overwrites its own folders and nothing else. Files are sorted by the default
        sorting field, so that range filters on it skip row groups. Without buckets they are
        also cut by ranges of it, equal values by row id, so that such filters skip files.
        """
        if ERRORS not in rows.columns:
            rows = rows.withColumn(ERRORS, F.lit(None).cast(ERROR_TYPE))
        bucket = F.lit(UNBUCKETED)
        if bucketed:
            bucket = bucket_of(F.col(layout.bucket_by), layout.buckets)
        placed = rows.withColumns(
            {OK: F.col(ERRORS).isNull(), BUCKET: F.coalesce(bucket, F.lit(UNBUCKETED)).cast("int")}
        ).drop(*layout.not_stored)
        if rebalance:
            placed = placed.hint("rebalance", BUCKET)
        sort_by = layout.fields.get("default_sorting_field")
        if sort_by is not None and sort_by in rows.columns:
            place = F.col(f"`{sort_by}`").desc()
            if not bucketed:
                placed = placed.repartitionByRange(place, F.col(ROW_ID))
            placed = placed.sortWithinPartitions(OK, BUCKET, place)
        path = f"{LOAD}={load_id}/{PART}={step}"
        # Static overwrite: a retry must not leave buckets of the first try behind.
        writer = placed.write.mode("overwrite").options(
            maxRecordsPerFile=max_rows_per_file, partitionOverwriteMode="static", compression=CODEC
        )
        if bucketed:
            writer = writer.option("parquet.block.size", OPEN_BLOCK_BYTES)
        with settings(self.spark, {OPEN_FILES_LIMIT: str(OPEN_FILES)}):
            writer.partitionBy(OK, BUCKET).parquet(self._folder(table, path))
        counts = (
            self.read_part(rows.schema, table, path, layout).groupBy(OK, BUCKET).count().collect()
        )
        live = sorted(r[BUCKET] for r in counts if r[OK])
        return Written(
            Part(path, live),
            total=sum(r["count"] for r in counts),
            failed=sum(r["count"] for r in counts if not r[OK]),
        )

    def read_part(
        self, schema: T.StructType, table: str, path: str, layout: Layout
    ) -> DataFrame:
        """Everything a step wrote, good and rejected rows."""
        stored = [f for f in schema.fields if f.name not in layout.not_stored]
        rows = self.spark.read.schema(T.StructType([*stored, *PLACES[2:]])).parquet(
            self._folder(table, path)
        )
        made = [n for n in schema.names if n in layout.not_stored]
        return rows.withColumns({n: layout.column(n) for n in made})

    def stage(
        self, rows: DataFrame, table: str, load_id: str, buckets: int | None = None
    ) -> DataFrame:
        """Write rows that several steps use, and read them back.

        With ``buckets`` a file holds rows of few buckets of child rows, so that what is exploded
        from a file goes to few folders and need not move. So many buckets as a task keeps files
        open are few anyway, and then the rows are written where they are.
        """
        if buckets is not None and buckets > OPEN_FILES:
            bucket = bucket_of(F.col(ROW_ID), buckets).alias(BUCKET)
            rows = rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).drop(BUCKET)
        path = self._folder(STAGE, f"{LOAD}={load_id}", table)
        # A dictionary of a list's values takes as long as all else and saves nothing beside the codec.
        writer = rows.write.mode("overwrite").option("parquet.block.size", STAGE_BLOCK_BYTES)
        writer = writer.option("parquet.enable.dictionary", "false")
        writer.parquet(path, compression=CODEC)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop_stage(self, load_id: str, *tables: str) -> None:
        """Delete the staged rows of a load, or those of some tables."""
        folder = self._folder(STAGE, f"{LOAD}={load_id}")
        for path in [f"{folder}/{t}" for t in tables] or [folder]:
            self._delete(path)

    def rejects(self, table: str, load_id: str) -> DataFrame:
        """Rejected rows of a load with their reasons."""
        path = self._folder(table, f"{LOAD}={load_id}/{PART}=batch/{OK}=false")
        if not self._exists(path):
            schema = self.layout(table).spark_schema
            return self._no_rows(schema).withColumn(ERRORS, F.lit(None).cast(ERROR_TYPE))
        rows = self.spark.read.parquet(path).drop(BUCKET)
        layout = self.layout(table)
        return rows.withColumns({n: layout.column(n) for n in sorted(layout.not_stored)})


def document_schema(schema: T.StructType, fields: Mapping[str, Any]) -> T.StructType:
    """Columns of a document, the system columns first, with the hints as field metadata."""
    hints = {f["name"]: f for f in fields["fields"]}
    columns = [
        T.StructField(
            f.name, f.dataType, True, {"hint": hints[f.name]} if f.name in hints else {}
        )
        for f in schema.fields
        if f.name not in (ERRORS, OK, BUCKET)
    ]
    is_system = [f.name in (ID, *SYSTEM_COLUMNS) for f in columns]
    first = [f for f, own in zip(columns, is_system, strict=True) if own]
    return T.StructType([*first, *[f for f, own in zip(columns, is_system, strict=True) if not own]])
