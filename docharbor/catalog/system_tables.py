"""System tables, state and incremental loads over histories made of the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.catalog.registry import Tables, query
from docharbor.functions import ids
from docharbor.operators import system
from docharbor.sources import incremental

CURSOR_START = dt.datetime(2024, 1, 15)
SQL_START = "timestamp '2024-01-15 00:00:00'"


def state_history(t: Tables) -> DataFrame:
    """Every event is a state version of its user's pipeline."""
    return t.events.select(
        F.col("user_id").cast("string").alias("pipeline_name"),
        F.col("event_id").alias("version"),
        F.expr("event_id div 4").cast("string").alias("_load_id"),
        F.col("props").alias("state"),
    )


def finished_loads(t: Tables) -> DataFrame:
    """A load is completed when one of its events is a purchase."""
    done = t.events.filter("event_type = 'purchase'")
    return done.select(F.expr("event_id div 4").cast("string").alias("load_id")).distinct()


SQL_STATES = """
  select cast(user_id as varchar) as pipeline_name, event_id as version,
         cast(event_id // 4 as varchar) as _load_id, props as state
  from events
  where event_id // 4 in (select event_id // 4 from events where event_type = 'purchase')
"""


@query(
    f"""
select pipeline_name, max(version) as version, arg_max(_load_id, version) as _load_id,
       arg_max(state, version) as state
from ({SQL_STATES}) group by pipeline_name
"""
)
def state_newest_committed(t: Tables) -> DataFrame:
    return system.newest_states(state_history(t), finished_loads(t))


@query(
    f"""
select * from ({SQL_STATES})
where pipeline_name = (select cast(max(user_id) as varchar) from events)
order by version desc limit 1
"""
)
def state_of_one_pipeline(t: Tables) -> DataFrame:
    last = t.events.agg(F.max("user_id").cast("string").alias("pipeline_name"))
    name = last.first()[0]
    return system.newest_state(state_history(t), finished_loads(t), name).select(
        "pipeline_name", "version", "_load_id", "state"
    )


def schema_history(t: Tables) -> DataFrame:
    """Schema versions: one per event, named by event type, hashed by content."""
    rows = t.events.select(
        F.col("event_type").alias("schema_name"),
        F.col("event_id").alias("version"),
        F.sha2(F.concat_ws("/", "event_type", "event_id"), 256).alias("version_hash"),
        F.col("props").alias("schema"),
    )
    return rows


SQL_SCHEMAS = """
  select event_type as schema_name, event_id as version,
         sha256(event_type || '/' || event_id) as version_hash, props as schema
  from events
"""


@query(
    f"""
select schema_name, max(version) as version, arg_max(version_hash, version) as version_hash,
       arg_max(schema, version) as schema
from ({SQL_SCHEMAS}) group by schema_name
"""
)
def schema_latest(t: Tables) -> DataFrame:
    return system.latest_schemas(schema_history(t))


@query(f"select * from ({SQL_SCHEMAS}) where version_hash = sha256('click/1')")
def schema_by_hash(t: Tables) -> DataFrame:
    wanted = t.spark.range(1).select(F.sha2(F.lit("click/1"), 256)).first()[0]
    return system.schema_by_hash(schema_history(t), wanted)


@query(
    f"""
select schema_name, version, version_hash,
       sha1('version|' || version_hash) as id
from ({SQL_SCHEMAS}) where schema_name <> 'error'
"""
)
def schema_new_versions(t: Tables) -> DataFrame:
    """Versions with a stored hash are not written again."""
    stored = schema_history(t).filter("schema_name = 'error'")
    fresh = system.new_versions(stored, schema_history(t))
    return system.with_version_id(fresh).select("schema_name", "version", "version_hash", "id")


@query("select distinct cast(event_id // 4 as varchar) as load_id, 0 as status from events")
def complete_load_idempotent(t: Tables) -> DataFrame:
    """Completing the loads again, and one of them many times, changes nothing."""
    calls = t.events.select(
        F.expr("event_id div 4").cast("string").alias("load_id"),
        F.lit(system.COMPLETED).alias("status"),
    )
    done = system.complete_loads(calls.limit(0), calls)
    return system.complete_loads(done, calls).select("load_id", "status")


@query(f"select event_id, event_type from events where ts >= {SQL_START}")
def incremental_delta(t: Tables) -> DataFrame:
    return incremental.delta(t.events, "ts", CURSOR_START).select("event_id", "event_type")


@query(
    """
select o_orderkey, o_totalprice from orders
where o_orderdate > timestamp '1997-06-01 00:00:00'
   or (o_orderdate = timestamp '1997-06-01 00:00:00' and o_orderstatus <> 'F')
"""
)
def incremental_boundary(t: Tables) -> DataFrame:
    """Rows at the last cursor value that were loaded before are not loaded again."""
    last = dt.datetime(1997, 6, 1)
    loaded = t.orders.filter("o_orderstatus = 'F'")
    seen = incremental.boundary_keys(loaded, "o_orderdate", last, ["o_orderkey"])
    found = incremental.delta(t.orders, "o_orderdate", last, key=["o_orderkey"], seen=seen)
    return found.select("o_orderkey", "o_totalprice")


@query(
    """
select o_orderkey, o_totalprice from orders
where o_orderdate > timestamp '1997-06-01 00:00:00'
   or (o_orderdate = timestamp '1997-06-01 00:00:00' and o_orderstatus <> 'F')
"""
)
def incremental_boundary_one_scan(t: Tables) -> DataFrame:
    """The same with few keys at the boundary, after their number was checked."""
    last = dt.datetime(1997, 6, 1)
    loaded = t.orders.filter("o_orderstatus = 'F'")
    seen = incremental.boundary_keys(loaded, "o_orderdate", last, ["o_orderkey"])
    few = seen.count() <= 10_000
    found = incremental.delta(
        t.orders, "o_orderdate", last, key=["o_orderkey"], seen=seen, few_seen=few
    )
    return found.select("o_orderkey", "o_totalprice")


@query(
    """
select event_type, max(epoch_us(ts)) as cursor_at,
       max(event_id) as last_seen
from events group by event_type
"""
)
def incremental_advance(t: Tables) -> DataFrame:
    """The cursor each stream of events would start from next time."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return t.events.groupBy("event_type").agg(
        F.max(at).alias("cursor_at"), F.max("event_id").alias("last_seen")
    )


@query("select event_id, user_id from events order by ts, event_id limit 500")
def incremental_limit(t: Tables) -> DataFrame:
    """A row cap takes the first rows by cursor, so none is skipped later."""
    return incremental.limited(t.events, "ts", 500, ["event_id"]).select("event_id", "user_id")


@query(
    """
select cast(d.doc_id as bigint) as doc_id from documents d
left join labels l on d.doc_id = l.doc_id where l.quality is null
"""
)
def incremental_null_cursors(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return incremental.null_cursors(rows, "quality").select("doc_id")


@query("select event_id, sha1('event|' || event_id) as id from events")
def system_row_ids(t: Tables) -> DataFrame:
    name = ids.system_row_id(F.lit("event"), F.col("event_id").cast("string"))
    return t.events.select("event_id", name.alias("id"))
