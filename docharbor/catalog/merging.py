"""Write dispositions, ids and keys over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.catalog.registry import (
    Tables,
    query,
    sql_merge_id,
    sql_uuid_of_digest,
)
from docharbor.functions import ids
from docharbor.functions.ids import NAMESPACE_HEX
from docharbor.functions.names import normalise_names
from docharbor.operators import dispositions, quality

NEW_KEYS = 1_000_000
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def customers(t: Tables) -> DataFrame:
    rows = t.customer.select(*CUSTOMER)
    return rows.withColumn("id", ids.merge_id(rows, "shop_customer", ["c_custkey"]))


def customer_changes(t: Tables) -> DataFrame:
    """Customers with a finished order get a new balance; suppliers become customers."""
    finished = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    changed = t.customer.join(finished, "c_custkey", "left_semi").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
    )
    added = t.supplier.select(
        (F.col("s_suppkey") + NEW_KEYS).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    rows = changed.unionByName(added)
    return rows.withColumn("id", ids.merge_id(rows, "shop_customer", ["c_custkey"]))


SQL_CHANGES = f"""
  select c_custkey, c_name, c_nationkey, c_acctbal + 1 as c_acctbal,
         cast(null as varchar) as c_mktsegment
  from customer
  where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')
  union all
  select s_suppkey + {NEW_KEYS}, s_name, s_nationkey, s_acctbal, 'SUPPLIER' from supplier
"""
SQL_CUSTOMER_ID = sql_merge_id("shop_customer", "c_custkey")


@query(
    f"""
with batch as ({SQL_CHANGES}),
merged as (
  select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
  where c_custkey not in (select c_custkey from batch)
  union all select * from batch)
select *, {SQL_CUSTOMER_ID} as id from merged
"""
)
def merge_upsert(t: Tables) -> DataFrame:
    return dispositions.upsert(customers(t), customer_changes(t))


@query(
    f"""
with batch as ({SQL_CHANGES}),
merged as (
  select coalesce(b.c_custkey, c.c_custkey) as c_custkey,
         coalesce(b.c_name, c.c_name) as c_name,
         coalesce(b.c_nationkey, c.c_nationkey) as c_nationkey,
         coalesce(b.c_acctbal, c.c_acctbal) as c_acctbal,
         coalesce(b.c_mktsegment, c.c_mktsegment) as c_mktsegment
  from customer c full join batch b on c.c_custkey = b.c_custkey)
select *, {SQL_CUSTOMER_ID} as id from merged
"""
)
def merge_emplace(t: Tables) -> DataFrame:
    return dispositions.emplace(customers(t), customer_changes(t))


@query(
    f"""
with batch as ({SQL_CHANGES}),
merged as (
  select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
  union all
  select * from batch b
  where not exists (select 1 from customer c where c.c_custkey = b.c_custkey))
select *, {SQL_CUSTOMER_ID} as id from merged
"""
)
def merge_insert_only(t: Tables) -> DataFrame:
    return dispositions.insert_only(customers(t), customer_changes(t))


@query(
    f"""
with batch as ({SQL_CHANGES})
select case when c.c_custkey is null then 'inserted'
            when b.c_custkey is null then 'kept' else 'updated' end as outcome,
       count(*) as "rows"
from customer c full join batch b on c.c_custkey = b.c_custkey group by 1
"""
)
def merge_mixed_batch(t: Tables) -> DataFrame:
    old = customers(t).select("id", F.lit(True).alias("was"))
    new = customer_changes(t).select("id", F.lit(True).alias("given"))
    outcome = (
        F.when(F.col("was").isNull(), "inserted")
        .when(F.col("given").isNull(), "kept")
        .otherwise("updated")
    )
    joined = old.join(new, "id", "full_outer").select(outcome.alias("outcome"))
    return joined.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


@query(
    """
select event_id, user_id, event_type, cast(null as double) as "value", 'load-1' as _load_id
from events
union all
select event_id, user_id, event_type, "value", 'load-2' from events
"""
)
def append_two_loads(t: Tables) -> DataFrame:
    first = t.events.select("event_id", "user_id", "event_type", F.lit("load-1").alias("_load_id"))
    second = t.events.select(
        "event_id", "user_id", "event_type", "value", F.lit("load-2").alias("_load_id")
    )
    return dispositions.append(first, second)


@query(
    """
select count(*) as total, count(*) as distinct_ids
from (select * from lineitem union all select * from lineitem)
"""
)
def append_row_ids(t: Tables) -> DataFrame:
    """Identical rows and repeated loads keep ids of their own."""
    first = ids.with_content_row_id(t.lineitem, "shop_lineitem", "load-1")
    second = ids.with_content_row_id(t.lineitem, "shop_lineitem", "load-2")
    both = dispositions.append(first, second)
    copies = both.groupBy("_row_id").agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_ids"))


@query("select s_suppkey, s_name from supplier")
def replace_snapshot(t: Tables) -> DataFrame:
    return dispositions.replace(t.supplier.select("s_suppkey", "s_name"))


@query("select s_suppkey, s_name from supplier where false")
def replace_empty(t: Tables) -> DataFrame:
    return dispositions.empty_like(t.supplier.select("s_suppkey", "s_name"))


LINE = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
SQL_LINE_PLACE = """row_number() over (
  partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc,
           l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
           l_linestatus desc)"""


@query(
    f"""
select l_orderkey, l_linenumber, {LINE}, strftime(l_shipdate, '%Y-%m-%d') as shipped
from (select *, {SQL_LINE_PLACE} as place from lineitem) where place = 1
"""
)
def dedup_last_wins(t: Tables) -> DataFrame:
    kept = dispositions.last_wins(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return kept.withColumn("shipped", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@query(
    """
select event_type, user_id, event_id, "value" from (
  select *, row_number() over (partition by event_type order by ts desc, event_id desc) as place
  from events) where place = 1
"""
)
def dedup_hot_keys(t: Tables) -> DataFrame:
    """A handful of keys hold all rows; every task passes on one row per key."""
    rows = t.events.select("event_type", "ts", "event_id", "user_id", "value")
    return dispositions.last_wins(rows, ["event_type"], ["ts", "event_id"]).drop("ts")


@query(
    """
select user_id,
  arg_max(event_type, (ts, event_type)) as event_type,
  arg_max(amount, (ts, amount)) filter (amount is not null) as amount,
  arg_max(failure, (ts, failure)) filter (failure is not null) as failure,
  max(epoch_us(ts)) as at
from (select user_id, ts, event_type,
             case when event_type = 'purchase' then "value" end as amount,
             case when event_type = 'error' then props end as failure from events)
group by user_id
"""
)
def dedup_last_value_per_column(t: Tables) -> DataFrame:
    """Partial updates of one key: every field has its last given value."""
    updates = t.events.select(
        "user_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("failure"),
    )
    return dispositions.last_value_per_column(updates, ["user_id"], ["at"])


@query(f"select c_custkey, {SQL_CUSTOMER_ID} as id from customer")
def merge_id_single(t: Tables) -> DataFrame:
    return customers(t).select("c_custkey", "id")


@query(
    "select conv_id, turn, "
    + sql_merge_id("chat_turns", "conv_id", "turn")
    + " as id from conversations"
)
def merge_id_compound(t: Tables) -> DataFrame:
    rows = t.conversations
    return rows.select("conv_id", "turn", ids.merge_id(rows, "chat_turns", ["conv_id", "turn"]).alias("id"))


@query(
    "select l_orderkey, l_linenumber, l_partkey, "
    + sql_merge_id("shop_lines", "l_orderkey", "l_linenumber", "l_partkey")
    + " as id from lineitem"
)
def merge_id_lines(t: Tables) -> DataFrame:
    """Ids of the largest table."""
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    return t.lineitem.select(*key, ids.merge_id(t.lineitem, "shop_lines", key).alias("id"))


SQL_JSON_TEXT = r"""'"' || array_to_string(list_transform(regexp_extract_all(text, '(?s).'), lambda ch:
  case when ch = '"' then '\"' when ch = '\' then '\\'
       when ch = chr(10) then '\n' when ch = chr(13) then '\r' when ch = chr(9) then '\t'
       when ch = chr(8) then '\b' when ch = chr(12) then '\f'
       when unicode(ch) between 32 and 126 then ch
       when unicode(ch) < 65536 then printf('\u%04x', unicode(ch))
       else printf('\u%04x\u%04x', 55296 + ((unicode(ch) - 65536) // 1024),
                   56320 + ((unicode(ch) - 65536) % 1024)) end), '') || '"'"""


@query(
    f"""
select doc_id, {sql_uuid_of_digest("h")} as id from (
  select doc_id,
         sha1(from_hex('{NAMESPACE_HEX}') ||
              encode('lib_documents:["' || lang || '", ' || {SQL_JSON_TEXT} || ']')) as h
  from documents)
"""
)
def merge_id_text(t: Tables) -> DataFrame:
    """Text keys with accents, quotes and line breaks, over whole documents."""
    rows = t.documents
    return rows.select("doc_id", ids.merge_id(rows, "lib_documents", ["lang", "text"]).alias("id"))


@query(
    """
select count(*) as total_count, count(*) filter (l.quality is null) as failed_count
from documents d left join labels l on d.doc_id = l.doc_id
"""
)
def null_key_rejects(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return quality.summary(quality.require_keys(rows, "doc_id", "quality"))


@query(
    """
select p_partkey as __id, p_name as part_name, p_retailprice as retail_price_usd,
       p_size as size_2 from part
"""
)
def reserved_id_rename(t: Tables) -> DataFrame:
    rows = t.part.select(
        F.col("p_partkey").alias("ID"),
        F.col("p_name").alias("partName"),
        F.col("p_retailprice").alias("RetailPriceUSD"),
        F.col("p_size").alias("size-2"),
    )
    return normalise_names(rows)


@query(
    """
select 'after merge' as measure, 2 * count(distinct o_custkey) as "rows" from orders
union all
select 'left over', count(distinct o_custkey) from orders
"""
)
def append_then_merge(t: Tables) -> DataFrame:
    """Rows that an append stored under row ids stay beside merged ones, and are counted."""
    rows = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    appended = rows.withColumn(
        "id", ids.origin_row_id("shop_customer", "load-1", ["custkey"])
    )
    batch = rows.withColumn("id", ids.merge_id(rows, "shop_customer", ["custkey"]))
    merged = dispositions.upsert(appended, batch)
    left_over = dispositions.of_other_scheme(appended, batch, ["custkey"])
    return merged.select(F.lit("after merge").alias("measure")).unionByName(
        left_over.select(F.lit("left over").alias("measure"))
    ).groupBy("measure").agg(F.count(F.lit(1)).alias("rows"))


@query("select o_custkey, o_orderkey from orders")
def keyed_rows_converge(t: Tables) -> DataFrame:
    """Two pipelines that load one key get one document; other collections do not."""
    rows = t.orders.select("o_custkey", "o_orderkey")
    here = rows.withColumn("id", ids.merge_id(rows, "a_orders", ["o_orderkey"]))
    elsewhere = rows.select(ids.merge_id(rows, "b_orders", ["o_orderkey"]).alias("id"))
    merged = dispositions.upsert(here, here)
    return merged.join(elsewhere, "id", "left_anti").select("o_custkey", "o_orderkey")
