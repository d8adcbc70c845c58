"""Nested lists, child tables and orphan cleanup over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.catalog.registry import Tables, query, sql_digest, sql_row_id
from docharbor.functions import ids
from docharbor.functions.names import ROOT_ID, ROW_ID
from docharbor.operators import orphans, shape
from docharbor.spec import LoadSpec

DOCS = "lib_documents"
LINES = f"{DOCS}__lines"
WORDS = f"{LINES}__words"


def nested_documents(t: Tables, line_filter: str = "true", by_root: bool = False) -> DataFrame:
    """Documents as rows with nested lists: lines, and the words of every line.

    With ``by_root`` they are dealt out by their row id before their lists are taken apart, so
    that joins of the child rows by root id move none of them.
    """
    lines = F.expr(
        f"transform(filter(split(text, '\\n'), line -> {line_filter}),"
        " line -> named_struct('line', line, 'words', split(line, ' ')))"
    )
    rows = t.documents.select("doc_id", "lang", "text")
    rows = rows.withColumn(ROW_ID, ids.keyed_row_id(rows, DOCS, ["doc_id"]))
    if by_root:
        rows = rows.repartition(ROW_ID)
    return rows.select("doc_id", "lang", lines.alias("lines"), ROW_ID)


def sql_lines(line_filter: str = "true", row_filter: str = "true") -> str:
    """Child rows of the documents as SQL: parent id, list place, row id."""
    return f"""
select doc_id, parent, place, line, {sql_digest("parent", f"'{LINES}'", "place::varchar")} as row_id
from (
  select doc_id, parent, unnest(ls) as line, generate_subscripts(ls, 1) - 1 as place
  from (
    select doc_id, {sql_row_id(DOCS, "doc_id")} as parent,
           list_filter(string_split(text, chr(10)), lambda line: {line_filter}) as ls
    from documents where {row_filter}))"""


def sql_words(lines: str) -> str:
    return f"""
select doc_id, root_id, parent, place, word,
       {sql_digest("parent", f"'{WORDS}'", "place::varchar")} as row_id
from (
  select doc_id, parent as root_id, row_id as parent, unnest(string_split(line, ' ')) as word,
         generate_subscripts(string_split(line, ' '), 1) - 1 as place
  from ({lines}))"""


@query(
    f"""
select row_id as _row_id, parent as _parent_id, parent as _root_id, place::bigint as _list_idx,
       line
from ({sql_lines()})
"""
)
def nested_children(t: Tables) -> DataFrame:
    child = shape.nest_chain(nested_documents(t), DOCS)[LINES]
    return child.select(
        ROW_ID, "_parent_id", ROOT_ID, F.col("_list_idx").cast("bigint").alias("_list_idx"), "line"
    )


@query(
    f"""
select row_id as _row_id, parent as _parent_id, root_id as _root_id, place::bigint as _list_idx,
       word as "value"
from ({sql_words(sql_lines())})
"""
)
def nested_grandchildren(t: Tables) -> DataFrame:
    """Two levels under one root: the root id is carried down."""
    words = shape.nest_chain(nested_documents(t), DOCS)[WORDS]
    return words.select(
        ROW_ID, "_parent_id", ROOT_ID, F.col("_list_idx").cast("bigint").alias("_list_idx"), "value"
    )


@query(
    f"""
select parent as _parent_id, (place - 1)::bigint as _list_idx, "value" from (
  select {sql_row_id(DOCS, "doc_id")} as parent,
         unnest(string_split(text, chr(10))) as "value",
         generate_subscripts(string_split(text, chr(10)), 1) as place
  from documents)
"""
)
def nested_scalar_lists(t: Tables) -> DataFrame:
    """A list of plain values becomes a child table with one value column."""
    rows = t.documents.select("doc_id", F.split("text", "\n").alias("lines"))
    rows = rows.withColumn(ROW_ID, ids.keyed_row_id(rows, DOCS, ["doc_id"]))
    child = shape.nest_chain(rows, DOCS)[LINES]
    return child.select("_parent_id", F.col("_list_idx").cast("bigint").alias("_list_idx"), "value")


# The second load holds the English documents, with their longer lines only.
SECOND_LANG = "lang = 'en'"
LONG_LINES = "length(line) > 200"


@query(
    f"""
with l1 as ({sql_lines()}), l2 as ({sql_lines(LONG_LINES, SECOND_LANG)}),
w1 as ({sql_words("select * from l1")}), w2 as ({sql_words("select * from l2")}),
again as (select doc_id from documents where {SECOND_LANG})
select 'lines' as level, row_id as _row_id from l1
where doc_id in (from again) and row_id not in (select row_id from l2)
union all
select 'words', row_id from w1
where doc_id in (from again) and row_id not in (select row_id from w2)
"""
)
def orphan_all_levels(t: Tables) -> DataFrame:
    """Stale rows of every level of the chain, found by root id."""
    first = shape.nest_chain(nested_documents(t, by_root=True), DOCS)
    again = nested_documents(t, LONG_LINES, by_root=True).filter(SECOND_LANG)
    second = shape.nest_chain(again, DOCS)
    roots = orphans.root_ids(second[DOCS])
    found = [
        orphans.stale_children(first[table].select(ROOT_ID, ROW_ID), roots, second[table]).select(
            F.lit(level).alias("level"), ROW_ID
        )
        for table, level in ((LINES, "lines"), (WORDS, "words"))
    ]
    return found[0].unionByName(found[1])


@query(
    """
select o_orderkey, o_custkey as customer__key, c_name as customer__name,
       n_name as customer__nation__name, r_name as customer__nation__region
from orders join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""
)
def flatten_structs(t: Tables) -> DataFrame:
    joined = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    nation = F.struct(F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    customer = F.struct(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), nation.alias("nation")
    )
    return shape.flatten(joined.select("o_orderkey", customer.alias("customer")))


@query(
    """
select vec_id, label, len(embedding)::bigint as dims, embedding[1]::double as first_value
from embeddings
"""
)
def keep_inline(t: Tables) -> DataFrame:
    """A hinted list stays in the document and makes no child table."""
    spec = LoadSpec("vectors", field_hints={"embedding": {"type": "float[]"}})
    rows = t.embeddings.withColumn(ROW_ID, ids.keyed_row_id(t.embeddings, "vectors", ["vec_id"]))
    chain = shape.nest_chain(rows, "vectors", spec.inline_columns())
    return chain["vectors"].select(
        "vec_id",
        "label",
        F.size("embedding").cast("bigint").alias("dims"),
        F.col("embedding")[0].cast("double").alias("first_value"),
    )


ORDERS = "shop_orders"
LINE_FIELDS = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"
]
LINE_PLACE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def order_roots(t: Tables, condition: str = "true") -> DataFrame:
    rows = t.orders.filter(condition).select("o_orderkey", "o_custkey")
    return rows.withColumn(ROW_ID, ids.keyed_row_id(rows, ORDERS, ["o_orderkey"]))


def child_rows(t: Tables, condition: str = "true") -> DataFrame:
    """Line items as a stored child table of the orders, one row id per distinct line.

    Lines meet their orders by root id, so they lie where the joins of a cleanup need them, and
    the row ids are made afterwards: they do not move.
    """
    rows = t.lineitem.filter(condition).filter("l_orderkey is not null")
    rows = rows.withColumn("o_orderkey", F.col("l_orderkey"))
    rows = rows.withColumn(ROOT_ID, ids.keyed_row_id(rows, ORDERS, ["o_orderkey"]))
    rows = orphans.of_roots(rows, orphans.root_ids(order_roots(t, "o_orderkey is not null")))
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd")
    place = F.concat_ws("/", *[F.col(c).cast("string") for c in LINE_PLACE], shipped)
    row_id = ids.child_row_id(F.col(ROOT_ID), "shop_orders__lines", place)
    return rows.select(row_id.alias(ROW_ID), ROOT_ID, "l_orderkey", *LINE_FIELDS)


def sql_children(condition: str = "true") -> str:
    place = " , ".join(f"{c}::varchar" for c in LINE_PLACE)
    place = f"concat_ws('/', {place}, strftime(l_shipdate, '%Y-%m-%d'))"
    return f"""
select *, {sql_digest("parent", "'shop_orders__lines'", place)} as row_id from (
  select *, {sql_row_id(ORDERS, "l_orderkey")} as parent from lineitem
  where {condition} and l_orderkey in (select o_orderkey from orders))"""


# The second load holds the orders that are not open, with their large lines only.
RELOADED = "o_orderstatus <> 'O'"
KEPT_LINES = "l_quantity > 25"


def reloaded_roots(t: Tables) -> DataFrame:
    return order_roots(t, RELOADED)


def reloaded_children(t: Tables) -> DataFrame:
    roots = orphans.root_ids(reloaded_roots(t))
    return orphans.of_roots(child_rows(t, KEPT_LINES), roots)


SQL_SECOND = f"""
with first_load as ({sql_children()}),
second_load as (
  select * from ({sql_children(KEPT_LINES)})
  where l_orderkey in (select o_orderkey from orders where {RELOADED})),
stale as (
  select * from first_load
  where l_orderkey in (select o_orderkey from orders where {RELOADED})
    and row_id not in (select row_id from second_load))
"""


@query(f"{SQL_SECOND} select row_id as _row_id, parent as _root_id from stale")
def orphan_stale_rows(t: Tables) -> DataFrame:
    roots = orphans.root_ids(reloaded_roots(t))
    first = child_rows(t).select(ROOT_ID, ROW_ID)
    return orphans.stale_children(first, roots, reloaded_children(t)).select(ROW_ID, ROOT_ID)


@query(
    f"""{SQL_SECOND}
select row_id as _row_id, l_partkey, l_quantity from second_load
union all
select row_id, l_partkey, l_quantity from first_load
where row_id not in (select row_id from stale)
  and row_id not in (select row_id from second_load)
"""
)
def orphan_cleanup_result(t: Tables) -> DataFrame:
    chain = orphans.clean_chain(
        {ORDERS: order_roots(t), "lines": child_rows(t)},
        {ORDERS: reloaded_roots(t), "lines": reloaded_children(t)},
        ORDERS,
    )
    return chain["lines"].select(ROW_ID, "l_partkey", "l_quantity")


@query(
    f"""{SQL_SECOND}
select row_id as _row_id from first_load
where l_orderkey not in (select o_orderkey from orders where {RELOADED})
"""
)
def orphan_emptied_lists(t: Tables) -> DataFrame:
    """Reloaded orders with empty lists lose all their lines; others keep theirs."""
    chain = orphans.clean_chain(
        {ORDERS: order_roots(t), "lines": child_rows(t)}, {ORDERS: reloaded_roots(t)}, ORDERS
    )
    return chain["lines"].select(ROW_ID)


@query(
    f"""{SQL_SECOND}
select 'removed' as measure, count(*) as "rows" from stale
union all
select 'kept', count(*) from first_load where row_id not in (select row_id from stale)
"""
)
def orphan_counts(t: Tables) -> DataFrame:
    """Stored children less the stale ones, as two joins on child ids see them."""
    roots = orphans.root_ids(reloaded_roots(t))
    batch = reloaded_children(t)
    first = child_rows(t).select(ROOT_ID, ROW_ID)
    removed = orphans.stale_children(first, roots, batch)
    kept = orphans.without_stale(first, roots, batch)
    both = removed.select(F.lit("removed").alias("measure")).unionByName(
        kept.select(F.lit("kept").alias("measure"))
    )
    return both.groupBy("measure").agg(F.count(F.lit(1)).alias("rows"))


@query("select count(*) as children from lineitem where l_orderkey in (select o_orderkey from orders)")
def insert_only_keeps_children(t: Tables) -> DataFrame:
    """With cleanup off every stored child stays, and the shorter lists add none."""
    spec = LoadSpec("orders", "merge", primary_key="o_orderkey", strategy="insert-only")
    first, batch = child_rows(t), reloaded_children(t)
    if spec.cleans_orphans:
        first = orphans.without_stale(first, orphans.root_ids(reloaded_roots(t)), batch)
    return orphans.insert_children(first, batch).agg(F.count(F.lit(1)).alias("children"))
