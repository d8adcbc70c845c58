"""System tables: schema versions, completed loads, pipeline state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.functions import ids
from docharbor.functions.names import ID, LOAD_ID

COMPLETED = 0


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, LONG = T.StringType(), T.LongType()
VERSION_SCHEMA = _schema(
    id=TEXT,
    version=LONG,
    engine_version=LONG,
    inserted_at=TEXT,
    schema_name=TEXT,
    version_hash=TEXT,
    schema=TEXT,
)
LOADS_SCHEMA = _schema(
    id=TEXT,
    load_id=TEXT,
    schema_name=TEXT,
    status=T.IntegerType(),
    inserted_at=TEXT,
    schema_version_hash=TEXT,
    seq=LONG,
    layout=T.MapType(TEXT, TEXT),
)
STATE_SCHEMA = _schema(
    id=TEXT,
    version=LONG,
    engine_version=LONG,
    pipeline_name=TEXT,
    state=TEXT,
    created_at=TEXT,
    _load_id=TEXT,
)


def with_version_id(versions: DataFrame) -> DataFrame:
    return versions.withColumn(ID, ids.system_row_id(F.lit("version"), F.col("version_hash")))


def new_versions(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Schema versions whose hash is not stored yet."""
    return incoming.dropDuplicates(["version_hash"]).join(
        stored.select("version_hash"), "version_hash", "left_anti"
    )


def latest_schema(versions: DataFrame, schema_name: str | None = None) -> DataFrame:
    """The stored schema with the highest version, of one name or of all."""
    rows = versions
    if schema_name:
        rows = rows.filter(F.col("schema_name") == schema_name)
    return rows.orderBy(F.col("version").desc()).limit(1)


def latest_schemas(versions: DataFrame) -> DataFrame:
    """The stored schema with the highest version, for every name."""
    others = [c for c in versions.columns if c != "schema_name"]
    newest = versions.groupBy("schema_name").agg(
        F.max_by(F.struct(*others), "version").alias("row")
    )
    return newest.select("schema_name", *[F.col(f"row.`{c}`").alias(c) for c in others])


def schema_by_hash(versions: DataFrame, version_hash: str) -> DataFrame:
    return versions.filter(F.col("version_hash") == version_hash).limit(1)


def complete_loads(loads: DataFrame, completed: DataFrame) -> DataFrame:
    """One row per load id, however often a load is completed; the first row stays."""
    fresh = completed.dropDuplicates(["load_id"]).join(
        loads.select("load_id"), "load_id", "left_anti"
    )
    return loads.unionByName(fresh, allowMissingColumns=True)


def committed_states(states: DataFrame, loads: DataFrame) -> DataFrame:
    """States whose load was completed; a state without a load is never visible."""
    done = loads.select(F.col("load_id").alias(LOAD_ID))
    return states.join(done, LOAD_ID, "left_semi")


def newest_state(states: DataFrame, loads: DataFrame, pipeline_name: str) -> DataFrame:
    """The newest committed state of one pipeline."""
    mine = states.filter(F.col("pipeline_name") == pipeline_name)
    return committed_states(mine, loads).orderBy(F.col("version").desc()).limit(1)


def newest_states(states: DataFrame, loads: DataFrame) -> DataFrame:
    """The newest committed state of every pipeline."""
    others = [c for c in states.columns if c != "pipeline_name"]
    newest = (
        committed_states(states, loads)
        .groupBy("pipeline_name")
        .agg(F.max_by(F.struct(*others), "version").alias("row"))
    )
    return newest.select("pipeline_name", *[F.col(f"row.`{c}`").alias(c) for c in others])
