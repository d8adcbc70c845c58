"""Whole loads into a dataset folder, read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.catalog.merging import (
    CUSTOMER,
    SQL_CHANGES,
    customer_changes,
)
from docharbor.catalog.nesting import (
    DOCS,
    LONG_LINES,
    SECOND_LANG,
    nested_documents,
    sql_lines,
    sql_words,
)
from docharbor.catalog.registry import Tables, query, sql_merge_id
from docharbor.functions.names import ID, LIST_IDX, ROOT_ID, ROW_ID
from docharbor.plans.dataset import Dataset
from docharbor.plans.load import run_load
from docharbor.plans.sync import SyncSpec, run_sync
from docharbor.session import shared_dir
from docharbor.spec import LoadSpec
from docharbor.streaming.micro_batch import load_stream


def fresh_dataset(t: Tables, name: str) -> Dataset:
    """A dataset in a folder of its own below the shared folder."""
    root = f"{shared_dir(t.spark)}/runs/{name}-{uuid.uuid4().hex}"
    return Dataset(t.spark, root, "shop")


def counted(dataset: Dataset) -> DataFrame:
    """Rows per table of a dataset."""
    rows = [dataset.read(n).select(F.lit(n).alias("table")) for n in dataset.tables()]
    return reduce(DataFrame.unionByName, rows).groupBy("table").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    f"""
with batch as ({SQL_CHANGES}),
merged as (
  select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
  where c_custkey not in (select c_custkey from batch)
  union all select * from batch)
select *, {sql_merge_id("shop_customer", "c_custkey")} as id from merged
"""
)
def load_upsert(t: Tables) -> DataFrame:
    """Two loads: all customers, then a batch that changes some and adds others."""
    dataset = fresh_dataset(t, "load_upsert")
    spec = LoadSpec("customer", "merge", primary_key="c_custkey")
    run_load(dataset, [(spec, t.customer)], "load-1")
    run_load(dataset, [(spec, customer_changes(t).drop("id"))], "load-2")
    return dataset.read("customer").select(*CUSTOMER, ID)


@query(
    f"""
with l1 as ({sql_lines()}), l2 as ({sql_lines(LONG_LINES, SECOND_LANG)}),
w1 as ({sql_words("select * from l1")}), w2 as ({sql_words("select * from l2")}),
again as (select doc_id from documents where {SECOND_LANG})
select 'lines' as level, parent as _root_id, place::bigint as _list_idx, line as "value" from (
  select * from l2 union all select * from l1 where doc_id not in (from again))
union all
select 'words', root_id, place::bigint, word from (
  select * from w2 union all select * from w1 where doc_id not in (from again))
"""
)
def load_nested_with_cleanup(t: Tables) -> DataFrame:
    """A chain of three tables; the second load shortens the lists of some documents."""
    dataset = fresh_dataset(t, "load_nested")
    spec = LoadSpec("documents", "merge", primary_key="doc_id", buckets=4)
    whole = nested_documents(t).withColumn(ROW_ID, F.col(ROW_ID))
    run_load(dataset, [(spec, whole)], "load-1")
    shorter = nested_documents(t, LONG_LINES).filter(SECOND_LANG)
    run_load(dataset, [(spec, shorter)], "load-2")
    assert dataset.qualified("documents") != DOCS
    index = F.col(LIST_IDX).cast("bigint").alias(LIST_IDX)
    lines = dataset.read("documents__lines").select(
        F.lit("lines").alias("level"), ROOT_ID, index, F.col("line").alias("value")
    )
    words = dataset.read("documents__lines__words").select(
        F.lit("words").alias("level"), ROOT_ID, index, "value"
    )
    return lines.unionByName(words)


@query(
    """
select 'customer' as "table", count(*) as "rows" from customer
union all select 'events', 2 * count(*) from events
union all select 'nation', count(*) from nation
"""
)
def mixed_dispositions(t: Tables) -> DataFrame:
    """Merge, append, replace and skip under one load id, run twice."""
    dataset = fresh_dataset(t, "mixed")
    batches = [
        (LoadSpec("customer", "merge", primary_key="c_custkey"), t.customer),
        (LoadSpec("events", "append", origin="event_id"), t.events),
        (LoadSpec("nation", "replace"), t.nation),
        (LoadSpec("region", "skip"), t.region),
    ]
    run_load(dataset, batches, "load-1")
    run_load(dataset, batches, "load-2")
    run_load(dataset, batches, "load-2")
    return counted(dataset)


@query("select o_orderkey, o_orderstatus, o_totalprice from orders")
def sync_incremental(t: Tables) -> DataFrame:
    """A first sync of the older orders, then one of what came since, from the stored cursor."""
    dataset = fresh_dataset(t, "sync")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    older = t.orders.filter("o_orderdate <= timestamp '1996-01-01 00:00:00'").select(*columns)
    everything = t.orders.select(*columns)

    def sync(source: DataFrame) -> SyncSpec:
        return SyncSpec(
            "orders",
            lambda: source,
            primary_key="o_orderkey",
            cursor="o_orderdate",
            field_hints={"o_orderdate": {"type": "int64", "sort": True}},
        )

    run_sync(dataset, [sync(older)], "orders_sync", load_id="load-1")
    run_sync(dataset, [sync(everything)], "orders_sync", load_id="load-2")
    return dataset.read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("select user_id, max(event_id) as event_id from events group by user_id")
def stream_micro_batches(t: Tables) -> DataFrame:
    """A stream of events merged by user, one load per micro-batch."""
    dataset = fresh_dataset(t, "stream")
    dataset.initialise()
    schema = t.events.schema
    stream = t.spark.readStream.schema(schema).parquet(f"{t.folder}/event[s].parquet")
    spec = LoadSpec("users", "merge", primary_key="user_id", order_by="event_id")
    writer = load_stream(
        stream.select("user_id", "event_id"),
        dataset,
        spec,
        name="events",
        checkpoint=f"{dataset.path}/_stream",
    )
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return dataset.read("users").select("user_id", "event_id")


@query(
    f"""
with l2 as ({sql_lines(LONG_LINES, SECOND_LANG)}), w2 as ({sql_words("select * from l2")})
select 'lines' as level, parent as _root_id, place::bigint as _list_idx, line as "value" from l2
union all
select 'words', root_id, place::bigint, word from w2
"""
)
def load_replace_chain(t: Tables) -> DataFrame:
    """Replacing a chain leaves no child row of the run before."""
    dataset = fresh_dataset(t, "load_replace")
    spec = LoadSpec("documents", "replace")
    run_load(dataset, [(spec, nested_documents(t))], "load-1")
    run_load(dataset, [(spec, nested_documents(t, LONG_LINES).filter(SECOND_LANG))], "load-2")
    index = F.col(LIST_IDX).cast("bigint").alias(LIST_IDX)
    lines = dataset.read("documents__lines").select(
        F.lit("lines").alias("level"), ROOT_ID, index, F.col("line").alias("value")
    )
    words = dataset.read("documents__lines__words").select(
        F.lit("words").alias("level"), ROOT_ID, index, "value"
    )
    return lines.unionByName(words)


@query(
    f"""
select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice,
       epoch_us(o_orderdate) // 1000000 as o_orderdate
from orders
order by cast(o_totalprice as decimal(18,2)) desc, {sql_merge_id("shop_orders", "o_orderkey")}
limit 50
"""
)
def default_sort_page(t: Tables) -> DataFrame:
    """Hinted columns are stored as numbers; a page comes in the default order of its table."""
    dataset = fresh_dataset(t, "sorted")
    spec = LoadSpec(
        "orders",
        "merge",
        primary_key="o_orderkey",
        field_hints={"o_totalprice": {"type": "float"}, "o_orderdate": {"type": "int64"}},
        table_hints={"default_sorting_field": "o_totalprice"},
    )
    rows = t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    run_load(dataset, [(spec, rows)], "load-1")
    return dataset.browse("orders", per_page=50).select("o_orderkey", "o_totalprice", "o_orderdate")


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'F'")
def load_delete_by_filter(t: Tables) -> DataFrame:
    dataset = fresh_dataset(t, "deleted")
    run_load(dataset, [(LoadSpec("orders", "merge", primary_key="o_orderkey"), t.orders)], "load-1")
    dataset.delete_where("orders", F.col("o_orderstatus") == "F")
    return dataset.read("orders").select("o_orderkey", "o_orderstatus")


@query(
    f"""
with batch as ({SQL_CHANGES})
select coalesce(b.c_custkey, c.c_custkey) as c_custkey, coalesce(b.c_name, c.c_name) as c_name,
       coalesce(b.c_nationkey, c.c_nationkey) as c_nationkey,
       coalesce(b.c_acctbal, c.c_acctbal) as c_acctbal,
       coalesce(b.c_mktsegment, c.c_mktsegment) as c_mktsegment
from customer c full join batch b on c.c_custkey = b.c_custkey
"""
)
def load_emplace(t: Tables) -> DataFrame:
    dataset = fresh_dataset(t, "emplaced")
    spec = LoadSpec("customer", "merge", primary_key="c_custkey", action="emplace")
    run_load(dataset, [(spec, t.customer)], "load-1")
    run_load(dataset, [(spec, customer_changes(t).drop("id"))], "load-2")
    return dataset.read("customer").select(*CUSTOMER)


@query(
    f"""
with batch as ({SQL_CHANGES})
select * from customer
union all
select * from batch b where not exists (select 1 from customer c where c.c_custkey = b.c_custkey)
"""
)
def load_insert_only(t: Tables) -> DataFrame:
    dataset = fresh_dataset(t, "inserted")
    spec = LoadSpec("customer", "merge", primary_key="c_custkey", strategy="insert-only")
    run_load(dataset, [(spec, t.customer)], "load-1")
    run_load(dataset, [(spec, customer_changes(t).drop("id"))], "load-2")
    return dataset.read("customer").select(*CUSTOMER)


@query(
    """
select case when l.quality is null then 'quarantined' else 'loaded' end as outcome,
       count(*) as "rows"
from documents d left join labels l on d.doc_id = l.doc_id group by 1
"""
)
def load_quarantine(t: Tables) -> DataFrame:
    """Rejected rows of a load are kept apart with their reasons."""
    dataset = fresh_dataset(t, "quarantine")
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    spec = LoadSpec(
        "labels",
        "merge",
        primary_key="doc_id",
        field_hints={"quality": {"optional": False}},
        on_reject="quarantine",
    )
    run_load(dataset, [(spec, rows)], "load-1")
    good = dataset.read("labels").select(F.lit("loaded").alias("outcome"))
    bad = dataset.rejects("labels", "load-1").select(F.lit("quarantined").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


@query("select 'customer' as \"table\", count(*) as \"rows\" from customer")
def truncate_tables(t: Tables) -> DataFrame:
    """Only the listed tables are emptied."""
    dataset = fresh_dataset(t, "truncated")
    batches = [(LoadSpec("customer", origin="c_custkey"), t.customer), (LoadSpec("part"), t.part)]
    run_load(dataset, batches, "load-1")
    dataset.truncate(["part"])
    return counted(dataset)


@query("select 'part' as \"table\", count(*) as \"rows\" from part")
def drop_dataset(t: Tables) -> DataFrame:
    """Dropping a dataset leaves others alone, also one whose name starts the same."""
    shop = fresh_dataset(t, "dropped")
    other = Dataset(t.spark, shop.path.rsplit("/", 1)[0], "shop_eu")
    run_load(shop, [(LoadSpec("part", origin="p_partkey"), t.part)], "load-1")
    run_load(other, [(LoadSpec("part", origin="p_partkey"), t.part)], "load-1")
    shop.drop()
    assert not shop.is_initialised()
    return counted(other)


@query(
    """
select event_id, cast(json_extract(props, '$.k') as bigint) as val, cast(null as varchar) as val__v_text
from events where event_type <> 'error'
union all
select event_id, null, props from events where event_type = 'error'
"""
)
def load_variant_column(t: Tables) -> DataFrame:
    """A later load brings text for a number column: the text gets a column of its own."""
    dataset = fresh_dataset(t, "variant")
    spec = LoadSpec("events", "merge", primary_key="event_id")
    number = F.get_json_object("props", "$.k").cast("bigint")
    numbers = t.events.filter("event_type <> 'error'").select("event_id", number.alias("val"))
    texts = t.events.filter("event_type = 'error'").select("event_id", F.col("props").alias("val"))
    run_load(dataset, [(spec, numbers)], "load-1")
    run_load(dataset, [(spec, texts)], "load-2")
    return dataset.read("events").select("event_id", "val", "val__v_text")


@query(
    """
select event_id, event_type, cast(null as double) as "value" from events
union all
select event_id, event_type, "value" from events
"""
)
def load_schema_evolution(t: Tables) -> DataFrame:
    """Rows of an earlier load do not have the column that a later load adds."""
    dataset = fresh_dataset(t, "evolution")
    spec = LoadSpec("events", origin="event_id")
    run_load(dataset, [(spec, t.events.select("event_id", "event_type"))], "load-1")
    run_load(dataset, [(spec, t.events.select("event_id", "event_type", "value"))], "load-2")
    return dataset.read("events").select("event_id", "event_type", "value")


@query("select max(o_orderkey) as last, count(*) as loaded from orders")
def restore_state(t: Tables) -> DataFrame:
    """Another session finds the cursor of the last completed load and loads nothing twice."""
    dataset = fresh_dataset(t, "restored")
    spec = SyncSpec("orders", lambda: t.orders, primary_key="o_orderkey", cursor="o_orderkey")
    run_sync(dataset, [spec], "p", load_id="load-1")
    dataset.store_state("p", {"orders": {"last": -1}}, "never-completed")
    elsewhere = Dataset(t.spark, dataset.path.rsplit("/", 1)[0], "shop")
    again = run_sync(elsewhere, [spec], "p", load_id="load-2")
    assert again.tables["orders"].total == 0
    last = elsewhere.state("p")["orders"]["last"]
    rows = elsewhere.read("orders").agg(F.count(F.lit(1)).alias("loaded"))
    return rows.select(F.lit(last).cast("bigint").alias("last"), "loaded")


@query(
    """
select 'customer' as "table", count(*) as "rows" from customer where c_mktsegment = 'BUILDING'
union all select 'supplier', count(*) from supplier
"""
)
def sync_full_refresh(t: Tables) -> DataFrame:
    """All targets are synced; a full refresh of one of them replaces its table."""
    dataset = fresh_dataset(t, "refresh")

    def syncs(customers: DataFrame) -> list[SyncSpec]:
        return [
            SyncSpec("customer", lambda: customers, primary_key="c_custkey", cursor="c_custkey"),
            SyncSpec("supplier", lambda: t.supplier, primary_key="s_suppkey"),
        ]

    run_sync(dataset, syncs(t.customer), "p", load_id="load-1")
    building = t.customer.filter("c_mktsegment = 'BUILDING'")
    run_sync(
        dataset, syncs(building), "p", target="customer", full_refresh=True, load_id="load-2"
    )
    return counted(dataset)
