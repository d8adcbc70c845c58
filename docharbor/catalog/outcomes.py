"""What becomes of loads: schemas found or changed, failures, rejects, files; and pages and caps by place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docharbor.catalog.loading import fresh_dataset
from docharbor.catalog.reading import written
from docharbor.catalog.registry import Tables, query, sql_merge_id
from docharbor.errors import RejectedRows, SchemaError
from docharbor.functions.convert import data_type_of, stored_type
from docharbor.functions.names import ROOT_ID, ROW_ID
from docharbor.operators import reads
from docharbor.plans.load import run_load
from docharbor.sources import files, incremental
from docharbor.spec import LoadSpec


@query(
    """
select 'orders' as "table", o_orderkey, null::bigint as l_linenumber, o_totalprice as amount, null as flag
from orders where o_orderkey % 50 <> 0
union all
select 'orders__lines', l_orderkey, l_linenumber, l_quantity, case when l_returnflag = 'R' then 'back' end
from lineitem where l_orderkey in (select o_orderkey from orders) and l_orderkey % 50 <> 0
"""
)
def undeclared_lines(t: Tables) -> DataFrame:
    """Nested JSON lines that nobody declared land as a root table and its child table.

    Some fields stand in some lines only, and every fiftieth line breaks off and is a reject.
    """
    flag = F.when(F.col("l_returnflag") == "R", "back").alias("flag")
    line = F.struct("l_linenumber", "l_quantity", flag)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("lines"))
    text = F.to_json(F.struct("o_orderkey", "o_totalprice", "lines"))
    broken = F.when(F.col("o_orderkey") % 50 == 0, F.substring(text, 1, 20)).otherwise(text)
    path = written(t, "undeclared_lines")
    t.orders.join(lines, "o_orderkey", "left").select(broken).write.mode("overwrite").text(path)
    dataset = fresh_dataset(t, "undeclared")
    spec = LoadSpec("orders", "append", origin=["o_orderkey"], on_reject="quarantine")
    run_load(dataset, [(spec, files.read_undeclared_files(t.spark, path))], "load-1")
    root = dataset.read("orders")
    child = dataset.read("orders__lines")
    key = root.select(F.col(ROW_ID).alias(ROOT_ID), "o_orderkey")
    return root.select(
        F.lit("orders").alias("table"), "o_orderkey", F.lit(None).cast("bigint").alias("l_linenumber"),
        F.col("o_totalprice").alias("amount"), F.lit(None).cast("string").alias("flag"),
    ).unionByName(
        child.join(key, ROOT_ID).select(
            F.lit("orders__lines").alias("table"), "o_orderkey", "l_linenumber",
            F.col("l_quantity").alias("amount"), "flag",
        )
    )


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 60 offset 60")
def page_by_place(t: Tables) -> DataFrame:
    """The second page by the place where the first one ends: a filter, no offset."""
    first = reads.page_after(t.orders, "o_totalprice", per_page=60, tie="o_orderkey")
    at = reads.place_of(first, "o_totalprice", "o_orderkey")
    second = reads.page_after(t.orders, "o_totalprice", per_page=60, last=at, tie="o_orderkey")
    return second.select("o_orderkey", "o_totalprice")


@query(
    """
select d.doc_id, l.quality from documents d left join labels l on d.doc_id = l.doc_id
order by l.quality nulls last, d.doc_id limit 90 offset (select count(*) from labels where quality is not null)
"""
)
def page_without_values(t: Tables) -> DataFrame:
    """Pages go on among the rows that have no value, which come last."""
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", "quality")
    valued = rows.filter("quality is not null").agg(F.max(F.struct("quality", "doc_id")).alias("m")).first()[0]
    at = (str(valued["quality"]), str(valued["doc_id"]))
    first = reads.page_after(rows, "quality", per_page=40, last=at, descending=False, tie="doc_id")
    at = reads.place_of(first, "quality", "doc_id")
    second = reads.page_after(rows, "quality", per_page=50, last=at, descending=False, tie="doc_id")
    return first.unionByName(second)


@query("select event_id, user_id from events order by ts, event_id limit (select count(*) // 2 from events)")
def incremental_limit_half(t: Tables) -> DataFrame:
    """A cap of half the table is found in the cursor's histogram; no task orders all rows."""
    half = t.events.count() // 2
    found = incremental.limited(t.events, "ts", half, ["event_id"], ordered=1_000)
    return found.select("event_id", "user_id")


@query("select event_id, event_type from events order by event_type, event_id limit (select count(*) // 2 from events)")
def incremental_limit_ties(t: Tables) -> DataFrame:
    """Very many rows of one cursor value are cut by the next column."""
    half = t.events.count() // 2
    found = incremental.limited(t.events, "event_type", half, ["event_id"], ordered=1_000)
    return found.select("event_id", "event_type")


@query("select doc_id, 'required field is missing' as reason from documents")
def quarantine_survives_cleanup(t: Tables) -> DataFrame:
    """A load of which every row was rejected; folders no table is made of are then removed."""
    dataset = fresh_dataset(t, "cleanup")
    hints = {"quality": {"optional": False}}
    spec = LoadSpec("docs", "merge", primary_key="doc_id", field_hints=hints, on_reject="quarantine")
    rows = t.documents.select("doc_id", F.lit(None).cast("int").alias("quality"))
    run_load(dataset, [(spec, rows)], "load-1")
    dataset.remove_unreferenced()
    return dataset.rejects("docs", "load-1").select("doc_id", F.col("_errors")[0]["reason"].alias("reason"))


@query("select p_name, p_size::varchar as p_size, 'p_name,p_size' as columns from part")
def replace_new_schema(t: Tables) -> DataFrame:
    """A replace takes the schema of its batch: a column goes, another changes its type."""
    dataset = fresh_dataset(t, "replaced")
    spec = LoadSpec("part", "replace")
    run_load(dataset, [(spec, t.part.select("p_name", "p_size", "p_brand"))], "load-1")
    run_load(dataset, [(spec, t.part.select("p_name", F.col("p_size").cast("string").alias("p_size")))], "load-2")
    found = dataset.read("part")
    names = ",".join(sorted(c for c in found.columns if c.startswith("p_")))
    return found.select("p_name", "p_size", F.lit(names).alias("columns"))


@query(
    f"""
select event_id as code, {sql_merge_id("shop_events", "lpad(event_id::varchar, 9, '0')")} as id from events
"""
)
def key_before_conversion(t: Tables) -> DataFrame:
    """The id is made of the key as it came, with its zeros; the stored column is a number."""
    dataset = fresh_dataset(t, "raw_keys")
    code = F.lpad(F.col("event_id").cast("string"), 9, "0").alias("code")
    spec = LoadSpec(
        "events", "merge", primary_key="code", data_types={"code": "decimal"}, field_hints={"code": {"type": "int64"}}
    )
    run_load(dataset, [(spec, t.events.select(code))], "load-1")
    return dataset.read("events").select("code", "id")


@query(
    """
select (select count(*) from documents) as total,
       (select count(*) from documents d left join labels l on d.doc_id = l.doc_id where l.quality is null) as failed,
       'load-1' as load_id, 5 as samples, 0 as tables, true as no_state, (select count(*) from labels) as loaded_again
"""
)
def failed_load(t: Tables) -> DataFrame:
    """A load with rejects says how many and which; nothing of it shows, and it can run again under its id."""
    dataset = fresh_dataset(t, "failed")
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    spec = LoadSpec("labels", "merge", primary_key="doc_id", field_hints={"quality": {"optional": False}})
    try:
        run_load(dataset, [(spec, rows)], "load-1", pipeline="p", state={"at": 1})
        raise AssertionError("the load has rejects")
    except RejectedRows as failure:
        said = failure
    tables, state = len(dataset.tables()), dataset.state("p")
    run_load(dataset, [(spec, t.labels.select("doc_id", "quality"))], "load-1", pipeline="p", state={"at": 1})
    return dataset.read("labels").agg(
        F.lit(said.total_count).cast("long").alias("total"), F.lit(said.failed_count).cast("long").alias("failed"),
        F.lit(said.load_id).alias("load_id"), F.lit(len(said.samples)).alias("samples"),
        F.lit(tables).alias("tables"), F.lit(state is None).alias("no_state"),
        F.count(F.lit(1)).alias("loaded_again"),
    )


@query("select c_custkey, c_name, 0 as written, true as state_kept from customer")
def empty_load(t: Tables) -> DataFrame:
    """A batch without rows is a success that changes nothing but the state."""
    dataset = fresh_dataset(t, "empty")
    spec = LoadSpec("customer", "merge", primary_key="c_custkey")
    rows = t.customer.select("c_custkey", "c_name")
    run_load(dataset, [(spec, rows)], "load-1")
    done = run_load(dataset, [(spec, rows.filter("false"))], "load-2", pipeline="p", state={"at": 2})
    kept = dataset.state("p") == {"at": 2}
    total = done.tables["customer"].total
    return dataset.read("customer").select(
        "c_custkey", "c_name", F.lit(total).cast("int").alias("written"), F.lit(kept).alias("state_kept")
    )


@query(
    """
select p_partkey, p_size, 'p_size int32,p_retailprice float' as pinned, 'p_size' as sorted_by
from (select * from part union all select * from part)
"""
)
def hints_at_creation(t: Tables) -> DataFrame:
    """Pinned columns and settings are those of the load that made the table; later hints change nothing."""
    dataset = fresh_dataset(t, "hints")
    rows = t.part.select("p_partkey", "p_size", "p_retailprice")
    first = {"p_size": {"type": "int32"}, "p_retailprice": {"type": "float", "facet": True}}
    spec = LoadSpec("part", field_hints=first, table_hints={"default_sorting_field": "p_size"}, origin=["p_partkey"])
    run_load(dataset, [(spec, rows)], "load-1")
    later = LoadSpec("part", field_hints={"p_size": {"type": "string"}}, origin=["p_partkey"])
    run_load(dataset, [(later, rows)], "load-2")
    fields = dataset.layout("part").fields
    pinned = ",".join(f"{f['name']} {f['type']}" for f in fields["fields"])
    return dataset.read("part").select(
        "p_partkey", "p_size", F.lit(pinned).alias("pinned"), F.lit(fields["default_sorting_field"]).alias("sorted_by")
    )


def _with_turns(t: Tables) -> DataFrame:
    """Conversations with the list of their turns."""
    turns = F.collect_list(F.struct("turn", "role")).alias("turns")
    return t.conversations.groupBy("conv_id").agg(turns)


def _loaded_turns(dataset) -> DataFrame:
    conv = dataset.read("conv").select(F.col(ROW_ID).alias(ROOT_ID), "conv_id")
    return dataset.read("conv__turns").join(conv, ROOT_ID).select("conv_id", "turn", "role")


@query("select conv_id, turn, role from conversations where not (conv_id % 2 = 0 and turn >= 2)")
def orphans_in_batches(t: Tables) -> DataFrame:
    """Stale child rows go in the same way whether their roots come in one load or in several."""
    dataset = fresh_dataset(t, "batches")
    spec = LoadSpec("conv", "merge", primary_key="conv_id")
    run_load(dataset, [(spec, _with_turns(t))], "load-1")
    kept = F.filter("turns", lambda x: x["turn"] < 2)
    shorter = _with_turns(t).filter("conv_id % 2 = 0").withColumn("turns", kept)
    for n in (0, 1):
        run_load(dataset, [(spec, shorter.filter(F.col("conv_id") % 4 == 2 * n))], f"load-{n + 2}")
    return _loaded_turns(dataset)


@query("select conv_id, turn, role from conversations")
def no_children_to_clean(t: Tables) -> DataFrame:
    """Roots that had no child table so far: there is nothing to clean, and their children are added."""
    dataset = fresh_dataset(t, "no_children")
    spec = LoadSpec("conv", "merge", primary_key="conv_id")
    run_load(dataset, [(spec, _with_turns(t).select("conv_id"))], "load-1")
    done = run_load(dataset, [(spec, _with_turns(t))], "load-2")
    assert done.tables["conv__turns"].removed_orphans == 0
    return _loaded_turns(dataset)


@query("select event_type, count(*) as events, true as refused, 0 as tables from events group by event_type")
def times_as_floats(t: Tables) -> DataFrame:
    """A float hint for a point in time is refused before anything is written."""
    dataset = fresh_dataset(t, "floats")
    spec = LoadSpec("events", field_hints={"ts": {"type": "float"}})
    try:
        run_load(dataset, [(spec, t.events.select("event_type", "ts"))], "load-1")
        refused = False
    except SchemaError:
        refused = True
    made = len(dataset.tables())
    return t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.lit(refused).alias("refused"), F.lit(made).alias("tables")
    )


@query(
    """
select 'orders' as "table", column_name as "column", stored, (select count(*) from orders) as "rows" from (
  select column_name, case when data_type in ('BIGINT', 'INTEGER') then 'int64' when data_type = 'DOUBLE' then 'float'
         else 'string' end as stored from information_schema.columns where table_name = 'orders')
union all
select 'embeddings', column_name, case when data_type in ('BIGINT', 'INTEGER') then 'int64' else 'string' end,
       (select count(*) from embeddings) from information_schema.columns where table_name = 'embeddings'
"""
)
def stored_types(t: Tables) -> DataFrame:
    """The stored type of every column where no hint names another."""
    found = None
    for name in ("orders", "embeddings"):
        rows = getattr(t, name)
        kinds = [F.struct(F.lit(f.name).alias("column"), F.lit(stored_type(data_type_of(f.dataType))).alias("stored")) for f in rows.schema.fields]
        each = rows.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.explode(F.array(*kinds)).alias("k"))
        each = each.select(F.lit(name).alias("table"), "k.column", "k.stored", "rows")
        found = each if found is None else found.unionByName(each)
    return found


@query("select count(*) as total, true as bounded, true as several from lineitem")
def bounded_files(t: Tables) -> DataFrame:
    """A load whose files hold at most 5,000 rows keeps every row."""
    dataset = fresh_dataset(t, "bounded")
    spec = LoadSpec("lineitem", max_rows_per_file=5_000, origin=["l_orderkey", "l_linenumber"])
    run_load(dataset, [(spec, t.lineitem)], "load-1")
    rows = files.read_parquet(t.spark, f"{dataset.path}/lineitem", with_origin=True)
    sizes = rows.groupBy(files.ORIGIN[0]).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("total"), (F.max("n") <= 5_000).alias("bounded"),
        ((F.count(F.lit(1)) > 1) | (F.sum("n") <= 5_000)).alias("several"),
    )


@query(
    """
select 'orders' as "table", 2 * count(*) as "rows" from orders
union all select 'customer', count(*) from customer
union all select 'region', 0
"""
)
def footer_counts(t: Tables) -> DataFrame:
    """Rows of whole tables, of partly replaced buckets and of an emptied table, from file footers."""
    dataset = fresh_dataset(t, "footers")
    orders = LoadSpec("orders", origin=["o_orderkey"])
    customer = LoadSpec("customer", "merge", primary_key="c_custkey")
    run_load(dataset, [(orders, t.orders), (customer, t.customer), (LoadSpec("region"), t.region)], "load-1")
    some = t.customer.filter("c_custkey % 1000 = 1")
    run_load(dataset, [(orders, t.orders), (customer, some)], "load-2")
    dataset.truncate(["region"])
    counts = [F.struct(F.lit(n).alias("table"), F.lit(dataset.count(n)).cast("long").alias("rows")) for n in dataset.tables()]
    return t.spark.range(1).select(F.inline(F.array(*counts)))


@query(
    """
select o_orderkey, o_totalprice from orders where o_totalprice > 100000 and o_totalprice <= 120000
union all
select o_orderkey, o_totalprice from orders where o_totalprice > 100000 and o_totalprice <= 120000
"""
)
def load_range_filter(t: Tables) -> DataFrame:
    """A range of the sorting field, read from appended files that are cut by ranges of it."""
    dataset = fresh_dataset(t, "ranges")
    spec = LoadSpec("orders", table_hints={"default_sorting_field": "o_totalprice"}, origin=["o_orderkey"])
    for load in ("load-1", "load-2"):
        run_load(dataset, [(spec, t.orders)], load)
    found = reads.where_range(dataset.read("orders"), "o_totalprice", above=100_000.0, at_most=120_000.0)
    return found.select("o_orderkey", "o_totalprice")
