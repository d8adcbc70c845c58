"""Conversions, JSON, variants and reject accounting over the given tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.catalog.registry import Tables, query
from docharbor.functions import convert, ids
from docharbor.operators import quality, shape
from docharbor.spec import LoadSpec, table_fields


def documents_of(rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """Rows with row ids of their key, as checked documents."""
    rows = rows.withColumn(ids.ROW_ID, ids.keyed_row_id(rows, spec.name, spec.primary_key))
    return shape.to_documents(
        rows, spec, collection=spec.name, fields=table_fields(spec, rows.schema)
    )


def hinted(name: str, key: str, hints: Mapping[str, Any], **other: Any) -> LoadSpec:
    return LoadSpec(name, "merge", primary_key=key, field_hints=hints, **other)


@query(
    """
select event_id, epoch_us(ts) // 1000000 as ts from events where epoch_us(ts) // 1000000 > 1705000000
"""
)
def epoch_int64(t: Tables) -> DataFrame:
    spec = hinted("events", "event_id", {"ts": {"type": "int64"}})
    rows = quality.valid_rows(documents_of(t.events.select("event_id", "ts"), spec))
    return rows.filter(F.col("ts") > 1705000000).select("event_id", "ts")


@query(
    """
select o_orderkey, epoch_us(o_orderdate) // 1000000 - 3600 as placed from orders
"""
)
def epoch_from_text(t: Tables) -> DataFrame:
    """Wire text with an offset keeps its instant."""
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00"))
    spec = hinted(
        "orders", "o_orderkey", {"placed": {"type": "int64"}}, data_types={"placed": "timestamp"}
    )
    rows = documents_of(t.orders.select("o_orderkey", text.alias("placed")), spec)
    return quality.valid_rows(rows).select("o_orderkey", "placed")


@query(
    """
select count(*) as total_count,
       count(*) filter (epoch_us(o_orderdate + interval 40 year) // 1000000 > 2147483647) as failed_count
from orders
"""
)
def epoch_int32_overflow(t: Tables) -> DataFrame:
    spec = hinted("orders", "o_orderkey", {"due": {"type": "int32"}})
    due = (F.col("o_orderdate") + F.expr("interval 40 years")).alias("due")
    return quality.summary(documents_of(t.orders.select("o_orderkey", due), spec))


@query("select o_orderkey, epoch_us(o_orderdate) // 1000000 as day from orders")
def date_epoch(t: Tables) -> DataFrame:
    spec = hinted("orders", "o_orderkey", {"day": {"type": "int64"}})
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return quality.valid_rows(documents_of(rows, spec)).select("o_orderkey", "day")


@query(
    """
select count(*) as total_count,
       count(*) filter (p <> floor(p)) as failed_count
from (select cast(o_totalprice as decimal(18,2)) as p from orders)
"""
)
def decimal_to_int_rejects(t: Tables) -> DataFrame:
    """Amounts with a fraction are rejected, never cut."""
    spec = hinted("orders", "o_orderkey", {"amount": {"type": "int64"}})
    amount = F.col("o_totalprice").cast("decimal(18,2)").alias("amount")
    return quality.summary(documents_of(t.orders.select("o_orderkey", amount), spec))


@query(
    """
select o_orderkey, cast(round(cast(o_totalprice as decimal(18,2)) * 100) as bigint) as cents
from orders
"""
)
def decimal_text_to_int(t: Tables) -> DataFrame:
    """Scientific text is read exactly: 12.34E+2 is 1234."""
    text = F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("E+2"))
    spec = hinted(
        "orders", "o_orderkey", {"cents": {"type": "int64"}}, data_types={"cents": "decimal"}
    )
    rows = documents_of(t.orders.select("o_orderkey", text.alias("cents")), spec)
    return quality.valid_rows(rows).select("o_orderkey", "cents")


@query(
    """
select l_orderkey, l_linenumber, l_partkey, cast(cast(l_extendedprice as decimal(18,2)) as double) as price
from lineitem where l_returnflag <> 'R'
"""
)
def decimal_to_float(t: Tables) -> DataFrame:
    """Decimal text becomes a float; NaN and infinities are rejected."""
    text = F.when(F.col("l_returnflag") == "R", F.lit("NaN")).otherwise(
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    )
    spec = LoadSpec(
        "lines",
        "merge",
        primary_key=("l_orderkey", "l_linenumber", "l_partkey"),
        field_hints={"price": {"type": "float"}},
        data_types={"price": "decimal"},
    )
    rows = t.lineitem.select(*spec.primary_key, text.alias("price"))
    return quality.valid_rows(documents_of(rows, spec)).select(*spec.primary_key, "price")


@query(
    """
select l_orderkey, l_linenumber, l_partkey,
       cast(l_partkey as varchar) || repeat('0', 18) as big,
       l_partkey <= 9 as fits
from lineitem
"""
)
def big_integers(t: Tables) -> DataFrame:
    """Integers of any size keep their digits; only those of 64 bits become int64."""
    text = F.concat(F.col("l_partkey").cast("string"), F.lit("0" * 18))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("big"))
    number = convert.to_number(F.col("big"), rows.schema["big"].dataType, "int64")
    return rows.withColumn("fits", number.value.isNotNull())


@query(
    r"""
select e.event_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
         case when epoch_us(ts) % 1000000 = 0 then ''
              else '.' || lpad((epoch_us(ts) % 1000000)::varchar, 6, '0') end || 'Z' as at,
       strftime(ts, '%Y-%m-%d') as day,
       cast(cast("value" as decimal(18,2)) as varchar) as amount,
       base64(encode(event_type)) as raw
from events e
"""
)
def iso_and_base64(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id",
        F.col("ts").alias("at"),
        F.col("ts").cast("date").alias("day"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.encode("event_type", "UTF-8").alias("raw"),
    )
    found = documents_of(rows, LoadSpec("events", "merge", primary_key="event_id"))
    return found.select(*rows.columns)


@query(
    """
select c_custkey, case when "text" is null then k end as val, "text" as val__v_text
from (select event_id as c_custkey, cast(json_extract(props, '$.k') as bigint) as k,
             case when event_type = 'error' then event_type || ' ' || event_id end as "text"
      from events)
"""
)
def variant_split(t: Tables) -> DataFrame:
    """A field that is a number in some rows and text in others gets two columns."""
    number = F.get_json_object("props", "$.k")
    words = F.to_json(F.struct(F.concat_ws(" ", "event_type", "event_id").alias("v")))
    wire = F.when(
        F.col("event_type") == "error", F.get_json_object(F.lit('{"v":0}'), "$.none")
    ).otherwise(number)
    rows = t.events.select(
        F.col("event_id").alias("c_custkey"),
        F.coalesce(
            F.parse_json(wire), F.try_variant_get(F.parse_json(words), "$.v", "variant")
        ).alias("val"),
    )
    return shape.split_variant(rows, "val", "BIGINT").select("c_custkey", "val", "val__v_text")


@query(
    """
select event_id, cast(json_extract(props, '$.k') as bigint) as k, false as opted_in
from events
"""
)
def decode_json_hook(t: Tables) -> DataFrame:
    """A row hook that decodes JSON text and fills a field that is missing."""

    def clean(df: DataFrame) -> DataFrame:
        decoded = df.withColumn("k", F.from_json("props", "k bigint")["k"])
        return shape.with_default(decoded, "opted_in", False)

    rows = t.events.transform(clean)
    return rows.select("event_id", "k", "opted_in")


@query(
    """
select doc_id, case when lang = 'en' then len(string_split(text, ' '))::bigint else 0 end as words
from documents
"""
)
def decode_json_list(t: Tables) -> DataFrame:
    """A JSON list held as text is decoded; text that is no list becomes an empty list."""
    wire = F.when(F.col("lang") == "en", F.to_json(F.split("text", " "))).otherwise(F.col("text"))
    rows = shape.decode_json_list(t.documents.select("doc_id", wire.alias("words")), "words")
    return rows.select("doc_id", F.size("words").cast("bigint").alias("words"))


@query(
    """
select event_id, props::json->>'$.k' as k, '{"k":' || (props::json->>'$.k') || '}' as props
from events
"""
)
def stringify_json(t: Tables) -> DataFrame:
    """A parsed JSON column is written back as text, unless it is pinned to stay native."""
    rows = t.events.select("event_id", F.parse_json("props").alias("props"))
    found = documents_of(rows, LoadSpec("events", "merge", primary_key="event_id"))
    return found.select("event_id", F.get_json_object("props", "$.k").alias("k"), "props")


@query(
    """
select '{"doc_id":' || d.doc_id || ',"lang":"' || lang || '"' ||
       case when quality is null then '' else ',"quality":' || quality end ||
       case when toxic is null then '' else ',"toxic":' || toxic end ||
       ',"empty":""}' as document
from documents d left join labels l on d.doc_id = l.doc_id
"""
)
def null_strip(t: Tables) -> DataFrame:
    """Absent fields are left out of the document; empty text is a value."""
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    rows = rows.withColumn("empty", F.lit(""))
    return rows.select(shape.json_document(rows).alias("document"))


@query(
    """
select count(*) as total_count, count(*) filter (label = 3) as failed_count from embeddings
"""
)
def vector_dim_check(t: Tables) -> DataFrame:
    vector = F.when(F.col("label") == 3, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    spec = hinted("vectors", "vec_id", {"embedding": {"type": "float[]", "num_dim": 64}})
    return quality.summary(documents_of(t.embeddings.select("vec_id", vector.alias("embedding")), spec))


@query(
    """
select count(*) as total_count, count(*) filter (quality is null) as failed_count
from documents d left join labels l on d.doc_id = l.doc_id
"""
)
def required_field_check(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    spec = hinted("documents", "doc_id", {"quality": {"optional": False}})
    return quality.summary(documents_of(rows, spec))


@query(
    """
select count(*) as total_count, count(*) filter (event_type = 'error') as failed_count from events
"""
)
def pinned_type_mismatch(t: Tables) -> DataFrame:
    wire = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.get_json_object("props", "$.k")
    )
    spec = hinted("events", "event_id", {"k": {"type": "int64"}})
    return quality.summary(documents_of(t.events.select("event_id", wire.alias("k")), spec))


def amounts(t: Tables) -> DataFrame:
    """Orders with a whole-number amount and a 32-bit due date, each with its rejects."""
    spec = hinted("orders", "o_orderkey", {"amount": {"type": "int64"}, "due": {"type": "int32"}})
    rows = t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        (F.col("o_orderdate") + F.expr("interval 40 years")).alias("due"),
    )
    return documents_of(rows, spec)


@query(
    """
select 'amount' as "column", 'not a whole number, use float' as reason, count(*) as "rows"
from orders where cast(o_totalprice as decimal(18,2)) <> floor(cast(o_totalprice as decimal(18,2)))
union all
select 'due', 'epoch seconds do not fit int32, use int64', count(*)
from orders where epoch_us(o_orderdate + interval 40 year) // 1000000 > 2147483647
"""
)
def reject_reasons(t: Tables) -> DataFrame:
    return quality.reasons(amounts(t))


@query(
    """
select 'orders' as "table", count(*) as total_count,
       count(*) filter (
         p <> floor(p) or epoch_us(o_orderdate + interval 40 year) // 1000000 > 2147483647
       ) as failed_count
from (select o_orderdate, cast(o_totalprice as decimal(18,2)) as p from orders)
union all
select 'labels', count(*), count(*) filter (l.quality is null)
from documents d left join labels l on d.doc_id = l.doc_id
"""
)
def partial_import_summary(t: Tables) -> DataFrame:
    """Counts per table of a load; good rows are told apart from rejected ones."""
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    labels = documents_of(rows, hinted("labels", "doc_id", {"quality": {"optional": False}}))
    found = [
        quality.summary(df).select(F.lit(name).alias("table"), "total_count", "failed_count")
        for name, df in (("orders", amounts(t)), ("labels", labels))
    ]
    return found[0].unionByName(found[1])


@query(
    """
select substr('key: key column is missing or null | document: {"doc_id":' || doc_id ||
              ',"id":"' || right('000000000' || doc_id, 9) || '"}', 1, 500) as sample
from documents where doc_id not in (select doc_id from labels)
order by right('000000000' || doc_id, 9) limit 5
"""
)
def reject_samples(t: Tables) -> DataFrame:
    """At most five samples, by id, with their document."""
    rows = t.documents.select("doc_id").join(
        t.labels.select("doc_id", F.col("quality").alias("key")), "doc_id", "left"
    )
    rows = rows.withColumn("id", F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    return quality.samples(quality.rejected_rows(quality.require_keys(rows, "key")))
