"""Pure operators on small frames, some against a plain Python model."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from docharbor.errors import MAX_SAMPLE_CHARS, ConfigError, LoadError, RejectedRows, SchemaError
from docharbor.operators import dispositions, orphans, quality, reads, shape, system
from docharbor.spec import LoadSpec, table_fields, with_hints


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_dispositions_agree_with_a_dictionary(spark, seed):
    rng = random.Random(seed)
    schema = "id string, a long, b long"

    def table(n):
        return {
            f"k{rng.randrange(40)}": (rng.choice([None, rng.randrange(9)]), rng.choice([None, 1]))
            for _ in range(n)
        }

    old, new = table(30), table(20)
    target = spark.createDataFrame([(k, *v) for k, v in old.items()], schema)
    batch = spark.createDataFrame([(k, *v) for k, v in new.items()], schema)

    def found(df):
        result = {r["id"]: (r["a"], r["b"]) for r in df.collect()}
        assert len(result) == df.count()
        return result

    assert found(dispositions.upsert(target, batch)) == {**old, **new}
    assert found(dispositions.insert_only(target, batch)) == {**new, **old}
    patched = dict(old)
    for key, (a, b) in new.items():
        was = old.get(key, (None, None))
        patched[key] = (was[0] if a is None else a, was[1] if b is None else b)
    assert found(dispositions.emplace(target, batch)) == patched
    assert dispositions.append(target, batch).count() == len(old) + len(new)


@pytest.mark.parametrize("seed", range(3))
def test_orphans_agree_with_sets(spark, seed):
    rng = random.Random(seed)
    stored = [(f"r{i}", f"c{i}-{j}") for i in range(10) for j in range(rng.randrange(5))]
    roots = [f"r{i}" for i in range(12) if rng.random() < 0.5]
    loaded = [(r, f"c{r[1:]}-{j}") for r in roots for j in range(rng.randrange(4))]
    schema = "_root_id string, _row_id string"
    target = spark.createDataFrame(stored, schema)
    batch = spark.createDataFrame(loaded, schema)
    root_batch = spark.createDataFrame([(r,) for r in roots], "_row_id string")
    ids = orphans.root_ids(root_batch)
    stale = {c for r, c in stored if r in roots} - {c for _, c in loaded}
    assert {r["_row_id"] for r in orphans.stale_children(target, ids, batch).collect()} == stale
    left = orphans.without_stale(target, ids, batch)
    assert {r["_row_id"] for r in left.collect()} == {c for _, c in stored} - stale
    after = {c for r, c in stored if r not in roots} | {c for _, c in loaded}
    both_steps = dispositions.upsert(left, batch, on="_row_id")
    one_step = orphans.replace_children(target, ids, batch)
    for df in (both_steps, one_step):
        assert sorted(r["_row_id"] for r in df.collect()) == sorted(after)
    emptied = orphans.clean_chain({"t": root_batch, "c": target}, {"t": root_batch}, "t")["c"]
    assert {r["_root_id"] for r in emptied.collect()}.isdisjoint(roots)


def by_root_tables(spark):
    """Stored children, batch and roots; rows come twice, ids and roots are null."""
    stored = [("r1", "a"), ("r1", "a"), ("r1", "b"), ("r1", None), (None, "n"), ("r2", "c"), ("r2", "c"), ("r3", "d")]
    batch = [("r1", "a"), ("r1", "a"), ("r1", "e"), ("r1", None), ("r4", "f")]
    schema = "_root_id string, _row_id string"
    roots = spark.createDataFrame([("r1",), ("r1",), ("r3",), (None,)], "_row_id string")
    return spark.createDataFrame(stored, schema), spark.createDataFrame(batch, schema), orphans.root_ids(roots)


def test_children_with_repeated_and_null_ids(spark):
    target, batch, roots = by_root_tables(spark)
    stale = rows_of(orphans.stale_children(target, roots, batch), "_root_id", "_row_id")
    assert stale == sorted([("r1", "b"), ("r1", None), ("r3", "d")], key=str)
    kept = rows_of(orphans.without_stale(target, roots, batch), "_root_id", "_row_id")
    left = [("r1", "a"), ("r1", "a"), ("r1", None), (None, "n"), ("r2", "c"), ("r2", "c")]
    assert kept == sorted(left, key=str)
    emptied = rows_of(orphans.without_stale(target, roots, None), "_root_id", "_row_id")
    assert emptied == sorted([("r1", None), (None, "n"), ("r2", "c"), ("r2", "c")], key=str)
    added = rows_of(orphans.insert_children(target, batch), "_root_id", "_row_id")
    assert added == sorted([*map(tuple, target.collect()), ("r1", "e"), ("r1", None), ("r4", "f")], key=str)


@pytest.mark.parametrize("name", ["orphan_stale_rows", "orphan_counts", "orphan_cleanup_result",
                                  "orphan_emptied_lists", "insert_only_keeps_children", "orphan_all_levels"])
def test_cleanup_deals_rows_out_by_root_alone(spark, tmp_path, name):
    """No join of a cleanup moves rows by another key, however small or large its tables are."""
    from docharbor.catalog import run

    kinds = "l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"
    lines = [(k % 7, k, k, k, 1.0 * k, "A", "F", dt.datetime(2020, 1, 1)) for k in range(60)]
    orders = [(k, k, "OF"[k % 2]) for k in range(5)]
    for table, rows, schema in (
        ("lineitem", lines, f"l_orderkey long, {kinds}, l_shipdate timestamp"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string"),
        ("documents", [(1, "a b\nc", "en"), (2, "d", "de")], "doc_id long, text string, lang string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    plan = run(name, spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    moved = [x.split("hashpartitioning(")[1].split(",")[0] for x in plan.splitlines() if "hashpartitioning(" in x]
    assert "BroadcastHashJoin" not in plan
    assert {x.split("#")[0] for x in moved} <= {"_root_id", "_row_id", "measure"}
    assert all("_row_id#" not in x or "_root_id#" not in x for x in plan.splitlines() if "Exchange hash" in x)


def test_orphans_need_their_link_columns(spark):
    plain = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(LoadError, match="_row_id"):
        orphans.root_ids(plain)
    ids = spark.createDataFrame([("a",)], "_root_id string")
    with pytest.raises(LoadError, match="vanished"):
        orphans.stale_children(plain, ids, None)


def test_last_wins_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", i, None) for i in range(100)], "k string, n long, m long")
    kept = dispositions.last_wins(df, ["k"], ["n"])
    assert [tuple(r) for r in kept.collect()] == [("k", 99, None)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_last_value_per_column(spark):
    df = spark.createDataFrame(
        [("k", 1, "x", None), ("k", 3, None, None), ("k", 2, "y", 7)],
        "k string, n long, a string, b long",
    )
    assert rows_of(dispositions.last_value_per_column(df, ["k"], ["n"]), "k", "n", "a", "b") == [
        ("k", 3, "y", 7)
    ]


def test_chain_of_lists(spark):
    df = spark.createDataFrame(
        [
            ("r1", {"a": 1, "deep": {"b": 2}}, [{"x": 1, "tags": ["p", "q"]}, {"x": 2, "tags": []}]),
            ("r2", None, []),
            ("r3", None, None),
        ],
        "_row_id string, obj struct<a:long, deep:struct<b:long>>,"
        " items array<struct<x:long, tags:array<string>>>",
    )
    chain = shape.nest_chain(df, "t")
    assert list(chain) == ["t", "t__items", "t__items__tags"] == [
        "t", *shape.child_tables(df.schema, "t")
    ]
    assert chain["t"].columns == ["_row_id", "obj__a", "obj__deep__b"]
    assert rows_of(chain["t__items"], "_root_id", "_list_idx", "x") == [("r1", 0, 1), ("r1", 1, 2)]
    assert rows_of(chain["t__items__tags"], "_root_id", "_list_idx", "value") == [
        ("r1", 0, "p"), ("r1", 1, "q")
    ]
    parents = {r["_row_id"] for r in chain["t__items"].collect()}
    assert {r["_parent_id"] for r in chain["t__items__tags"].collect()} <= parents
    inline = shape.nest_chain(df, "t", frozenset({"items", "obj"}))
    assert list(inline) == ["t"] and inline["t"].columns == df.columns


def test_lists_of_lists(spark):
    df = spark.createDataFrame([("r1", [[1, 2], [3]])], "_row_id string, m array<array<long>>")
    chain = shape.nest_chain(df, "t")
    assert list(chain) == ["t", *shape.child_tables(df.schema, "t")]
    assert rows_of(chain["t__m__value"], "value") == [(1,), (2,), (3,)]


def test_variants_of_one_field(spark):
    texts = ["10", '"ten"', "1.5", "true", '{"a":null}', "null", None, '"10"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "rid long, t string")
    df = df.select("rid", F.parse_json("t").alias("val"))
    assert shape.primary_kind(df, "val", "rid") == "BIGINT"
    found = shape.split_variant(df, "val", "BIGINT").orderBy("rid").collect()
    assert [r["val"] for r in found] == [10] + [None] * 7
    assert [r["val__v_text"] for r in found] == [None, "ten"] + [None] * 5 + ["10"]
    assert [r["val__v_double"] for r in found][2] == 1.5
    assert [r["val__v_bool"] for r in found][3] is True
    assert [r["val__v_json"] for r in found][4] == '{"a":null}'
    wide = shape.split_variant(df, "val", "DOUBLE").orderBy("rid").collect()
    assert [r["val"] for r in wide][:3] == [10.0, None, 1.5]


def test_hooks(spark):
    df = spark.createDataFrame(
        [('["a","b"]',), ("{}",), ("nope",), (None,)], "tags string"
    )
    found = shape.decode_json_list(df, "tags").collect()
    assert [r[0] for r in found] == [["a", "b"], [], [], []]
    filled = shape.with_default(df, "opted_in", False)
    assert {r["opted_in"] for r in filled.collect()} == {False}


def documents(spec, df, key="id_of"):
    df = df.withColumn("_row_id", F.lit("r"))
    return shape.to_documents(df, spec, collection="c", fields=table_fields(spec, df.schema))


def test_json_columns_are_text_unless_pinned(spark):
    df = spark.createDataFrame([('{"nested":{"a":null},"arr":[1,2,3]}',)], "t string").select(
        F.parse_json("t").alias("payload")
    )
    assert documents(LoadSpec("t"), df).first()["payload"] == '{"arr":[1,2,3],"nested":{"a":null}}'
    native = LoadSpec("t", field_hints={"payload": {"type": "object"}})
    assert documents(native, df).schema["payload"].dataType.typeName() == "variant"
    pinned = LoadSpec("t", field_hints={"payload": {"type": "string"}})
    assert documents(pinned, df).schema["payload"].dataType.typeName() == "string"


def test_ids_come_from_source_values(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), "x")], "ts timestamp, v string")
    spec = LoadSpec("t", "merge", primary_key="ts", field_hints={"ts": {"type": "int64"}})
    row = documents(spec, df).first()
    text = spark.createDataFrame([("2020-01-01T00:00:00Z",)], "ts string")
    from docharbor.functions import ids

    assert row["id"] == text.select(ids.merge_id(text, "c", ["ts"])).first()[0]
    assert row["ts"] == 1577836800


def test_rejects_carry_reason_and_sample(spark):
    df = spark.createDataFrame(
        [("a", "x" * 3000, 1), (None, "2020-01-01T00:00:00Z", 2), ("", "2021-01-01", 3)],
        "k string, at string, n long",
    )
    spec = LoadSpec(
        "t", "merge", primary_key="k", data_types={"at": "timestamp"},
        field_hints={"at": {"type": "int64"}},
    )
    found = documents(spec, df)
    errors = {r["n"]: r["_errors"] for r in found.collect()}
    assert errors[3] is None
    assert [(e["column"], len(e["sample"])) for e in errors[1]] == [("at", MAX_SAMPLE_CHARS)]
    assert [(e["column"], e["reason"]) for e in errors[2]] == [("k", "key column is missing or null")]
    assert tuple(quality.summary(found).first()) == (3, 2)
    with pytest.raises(RejectedRows) as failure:
        quality.fail_on_rejects("t", "l", quality.rejected_rows(found), 2, 3)
    assert failure.value.failed_count == 2 and len(failure.value.samples) == 2


def test_geopoints_and_missing_required_fields(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "at array<double>")
    spec = LoadSpec("t", field_hints={"at": {"type": "geopoint"}})
    assert [r["_errors"] is None for r in documents(spec, df).collect()] == [True, False]
    spec = LoadSpec("t", field_hints={"gone": {"type": "string", "optional": False}})
    assert quality.rejected_rows(documents(spec, df)).count() == 2


def test_reads(spark):
    df = spark.createDataFrame(
        [(f"d{i}", i % 3, 100 - i) for i in range(9)] + [("none", None, None)],
        "id string, kind long, rank long",
    )
    assert reads.found(reads.where_equal(df, "kind", 1)) == 3
    keys = spark.createDataFrame([("d1",), ("d1",), ("zz",)], "wanted string")
    assert rows_of(reads.where_in(df, "id", keys), "id") == [("d1",)]
    assert reads.found(reads.where_in(df, "id", ["d1", "d`2", "d2"])) == 2
    assert reads.found(reads.where_range(df, "rank", above=95, at_most=98)) == 3
    pages = [
        [r["id"] for r in reads.page(df, "kind", per_page=4, number=n).collect()] for n in (1, 2, 3)
    ]
    assert [len(p) for p in pages] == [4, 4, 2] and len({i for p in pages for i in p}) == 10
    assert pages[0] == ["d2", "d5", "d8", "d1"] and pages[2][-1] == "none"
    assert reads.export(df, ["id"], F.col("kind") == 0).columns == ["id"]
    assert reads.found(reads.without(df, F.col("kind") == 0)) == 7
    with pytest.raises(ValueError, match="at least 1"):
        reads.page(df, "kind", per_page=0)


def test_state_is_visible_with_its_load_only(spark):
    schema = "pipeline_name string, version long, state string, _load_id string"
    committed = [("p", 1, "old", "l1"), ("p", 2, "good", "l2"), ("q", 9, "other", "l1")]
    forged = [("p", 3 + i, "never", f"x{i}") for i in range(60)] + [("p", 99, "null", None)]
    states = spark.createDataFrame(committed + forged, schema)
    loads = spark.createDataFrame([("l1",), ("l2",)], "load_id string")
    assert system.newest_state(states, loads, "p").first()["state"] == "good"
    assert system.newest_state(states, loads, "q").first()["state"] == "other"
    assert system.newest_state(states, loads, "z").first() is None
    newest = {r["pipeline_name"]: r["state"] for r in system.newest_states(states, loads).collect()}
    assert newest == {"p": "good", "q": "other"}


@pytest.mark.parametrize(
    "wrong",
    [
        {"disposition": "upsert"}, {"strategy": "delete-insert"}, {"strategy": "scd2"},
        {"action": "create"}, {"replace_strategy": "insert-from-staging"}, {"on_reject": "drop"},
    ],
)
def test_unsafe_choices_are_refused(wrong):
    with pytest.raises(ConfigError, match="not supported"):
        LoadSpec("t", **wrong)


def test_keys_of_a_spec():
    assert LoadSpec("t", "merge", primary_key=["b", "a"]).key == ("b", "a")
    assert LoadSpec("t", "merge", unique="code").key == ("code",)
    assert LoadSpec("t", "merge", primary_key="Id").key == ("__id",)
    assert LoadSpec("t", "merge", primary_key="a", strategy="insert-only").key == ()
    assert LoadSpec("t", "append", primary_key="a").key == ()
    with pytest.raises(ConfigError, match="primary_key"):
        _ = LoadSpec("t", "merge", unique="_row_id").key


def test_hints_are_merged():
    spec = LoadSpec("t")
    assert with_hints(spec, facet="category").field_hints == {"category": {"facet": True}}
    both = with_hints(spec, facet=["c"], sort=["c", "p"], index="s")
    assert both.field_hints == {"c": {"facet": True, "sort": True}, "p": {"sort": True}, "s": {"index": True}}
    assert with_hints(spec, facet="c", field_hints={"c": {"facet": False}}).field_hints["c"] == {"facet": False}
    again = with_hints(both, field_hints={"c": {"type": "string"}}, table_hints={"metadata": {"x": 1}})
    assert again.field_hints["c"] == {"type": "string"} and again.field_hints["p"] == {"sort": True}
    kept = with_hints(again, remove_orphans=False)
    assert kept.table_hints == {"metadata": {"x": 1}} and not kept.remove_orphans
    assert with_hints(spec, field_hints={"v": {"type": "float[]"}}).inline_columns() == {"v"}
    assert with_hints(spec, field_hints={"v": {"type": "int64"}}).inline_columns() == frozenset()


@pytest.mark.parametrize(
    ("given", "message"),
    [
        ({}, "no hint"),
        ({"facet": [""]}, "facet: '' names no column"),
        ({"field_hints": {"c": True}}, "expected a mapping"),
        ({"field_hints": {"c": {"num_dim": 0}}}, "whole number above zero"),
        ({"field_hints": {"c": {"num_dim": True}}}, "whole number above zero"),
        ({"field_hints": {"c": {"optional": "yes"}}}, "true or false"),
        ({"field_hints": {"c": {"type": 1}}}, "type wants text"),
        ({"table_hints": {"default_sorting_field": 1}}, "default_sorting_field"),
        ({"remove_orphans": "yes"}, "neither true nor false"),
    ],
)
def test_wrong_hints_are_refused(given, message):
    with pytest.raises(ValueError, match=message):
        with_hints(LoadSpec("t"), **given)


def test_table_fields(spark):
    schema = spark.createDataFrame([], "title string, price double, id_ long, amount decimal(9,2), ts timestamp").schema
    assert table_fields(LoadSpec("t"), schema)["fields"] == []
    fields = table_fields(LoadSpec("t", field_hints={"title": {"facet": True}}), schema)["fields"]
    assert fields == [{"name": "title", "type": "string", "optional": True, "facet": True}]
    sorting = table_fields(LoadSpec("t", table_hints={"default_sorting_field": "price"}), schema)
    assert sorting["default_sorting_field"] == "price"
    assert sorting["fields"][0] == {"name": "price", "type": "float", "optional": False}
    explicit = LoadSpec(
        "t", field_hints={"price": {"optional": True}}, table_hints={"default_sorting_field": "price"}
    )
    assert table_fields(explicit, schema)["fields"][0]["optional"] is True
    pinned = LoadSpec(
        "t", field_hints={"amount": {"type": "float"}}, table_hints={"default_sorting_field": "amount"}
    )
    assert table_fields(pinned, schema)["fields"][0]["type"] == "float"
    unknown = LoadSpec("t", field_hints={"vec": {"facet": True}})
    assert table_fields(unknown, schema)["fields"][0]["type"] == "auto"
    for field, message in (("nope", "has no column"), ("title", "cannot sort"), ("amount", "cannot sort")):
        with pytest.raises(SchemaError, match=message):
            table_fields(LoadSpec("t", table_hints={"default_sorting_field": field}), schema)
    with pytest.raises(SchemaError, match="float"):
        table_fields(LoadSpec("t", field_hints={"ts": {"type": "float"}}), schema)
    renamed = LoadSpec("t", table_hints={"default_sorting_field": "id"})
    ids = spark.createDataFrame([], "__id long").schema
    assert table_fields(renamed, ids)["default_sorting_field"] == "__id"


def test_pages_of_a_larger_table_are_more_and_not_longer(spark, tmp_path, monkeypatch):
    from docharbor.catalog import reading
    from docharbor.catalog.registry import Tables

    rows = spark.range(700).selectExpr("id as conv_id", "0 as turn", "'user' as role", "string(id) as text")
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    seen, unnest = [], reading.pages.unnest
    monkeypatch.setattr(reading.pages, "unnest", lambda df, *a: seen.append(df) or unnest(df, *a))
    out = reading.json_pages_unnest(Tables(spark, str(tmp_path)))
    assert sorted(r.conv_id for r in out.collect()) == list(range(700))
    sizes = [r.page.count('"conv_id"') for r in seen[0].collect()]
    assert (len(sizes), set(sizes)) == (100, {7})
