"""Names that clash, rejects that last, schemas found in lines, pages by place, caps by histogram."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from docharbor.errors import SchemaError
from docharbor.operators import reads
from docharbor.operators.shape import child_tables, flatten
from docharbor.plans.load import run_load
from docharbor.sources import files, incremental
from docharbor.spec import LoadSpec

LISTS = "k long, items array<struct<sku:string>>"


def put(dataset, *loads, load_id=None):
    batches = [(spec, dataset.spark.createDataFrame(rows, schema)) for spec, rows, schema in loads]
    return run_load(dataset, batches, load_id)


def test_a_resource_does_not_overwrite_a_child_table(dataset):
    orders = LoadSpec("orders")
    put(dataset, (orders, [(1, [("a",), ("b",)])], LISTS))
    with pytest.raises(SchemaError, match="child table of 'orders'"):
        put(dataset, (LoadSpec("orders__items"), [(9,)], "k long"))
    assert dataset.read("orders__items").count() == 2
    with pytest.raises(SchemaError, match="another table"):
        put(dataset, (LoadSpec("a"), [(1, [("x",)])], LISTS), (LoadSpec("a__items"), [(9,)], "k long"))
    put(dataset, (LoadSpec("b__items"), [(9,)], "k long"))
    with pytest.raises(SchemaError, match="another table"):
        put(dataset, (LoadSpec("b"), [(1, [("x",)])], LISTS))
    with pytest.raises(SchemaError, match="another table"):
        put(
            dataset,
            (LoadSpec("c"), [(1, [(1,)])], "k long, d__e array<struct<v:long>>"),
            (LoadSpec("c__d"), [(1, [(1,)])], "k long, e array<struct<v:long>>"),
        )
    assert sorted(dataset.tables()) == ["b__items", "orders", "orders__items"]


def test_columns_and_children_that_would_share_a_name(spark):
    rows = spark.createDataFrame([(1, (2,))], "a__b long, a struct<b:long>")
    with pytest.raises(SchemaError, match="a__b"):
        flatten(rows)
    deep = spark.createDataFrame([], "b__c array<long>, b array<struct<c:array<long>>>")
    with pytest.raises(SchemaError, match="t__b__c"):
        child_tables(deep.schema, "t")


def test_rejects_outlive_the_cleanup(dataset):
    spec = LoadSpec("t", "merge", primary_key="k", on_reject="quarantine")
    put(dataset, (spec, [(None, "x")], "k long, v string"), load_id="l1")
    put(dataset, (spec, [(1, "a"), (None, "y")], "k long, v string"), load_id="l2")
    put(dataset, (spec, [(1, "b")], "k long, v string"), load_id="l3")
    dataset.remove_unreferenced()
    assert [r["v"] for r in dataset.rejects("t", "l1").collect()] == ["x"]
    assert [r["v"] for r in dataset.rejects("t", "l2").collect()] == ["y"]
    assert [r["v"] for r in dataset.read("t").collect()] == ["b"]
    assert dataset.remove_unreferenced() == 0 and dataset.remove_unreferenced(keep_rejects=False) == 2
    assert dataset.rejects("t", "l1").count() == 0 and dataset.read("t").count() == 1


def test_fields_are_found_in_all_lines(spark, dataset, tmp_path):
    lines = [
        {"id": 1, "price": 2, "tags": ["x"], "items": [{"sku": "s", "deep": [{"q": 1}]}], "odd": 1, "none": None},
        {"id": 2, "price": 2.5, "items": [{"sku": 7, "more": True}], "odd": "two", "empty": [], "at": {"x": 1}},
        {"id": 3, "items": [], "odd": {"k": [1]}, "big": 12345678901234567890, "at": {"y": "z"}},
    ]
    text = "\n".join([*map(json.dumps, lines), "", "broken {", "[1]", "7"])
    (tmp_path / "lines.json").write_text(text)
    rows = files.read_undeclared_files(spark, str(tmp_path / "lines.json"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name != "_errors"}
    assert kinds == {
        "id": "bigint", "price": "double", "tags": "array<string>", "odd": "variant", "big": "decimal(38,0)",
        "items": "array<struct<deep:array<struct<q:bigint>>,more:boolean,sku:string>>", "at": "struct<x:bigint,y:string>",
    }
    done = run_load(dataset, [(LoadSpec("t", on_reject="quarantine"), rows)], "l1")
    assert (done.tables["t"].total, done.tables["t"].failed) == (6, 3)
    assert sorted(dataset.tables()) == ["t", "t__items", "t__items__deep", "t__tags"]
    assert {(r["sku"], r["more"]) for r in dataset.read("t__items").collect()} == {("s", None), ("7", True)}
    assert dataset.read("t__items__deep").first()["q"] == 1
    odd = {r["id__"] if "id__" in r else r["__id"]: r.asDict() for r in dataset.read("t").collect()}
    assert odd[1]["price"] == 2.0 and odd[2]["at__x"] == 1 and odd[3]["at__y"] == "z"


@pytest.mark.parametrize("text", ["", "broken {\n[1]", '{"a": null, "b": [], "c": {}}'])
def test_lines_without_a_field(spark, tmp_path, text):
    (tmp_path / "lines.json").write_text(text)
    rows = files.read_undeclared_files(spark, str(tmp_path / "lines.json"))
    assert rows.columns == ["_errors"]
    assert rows.filter("_errors is not null").count() == (2 if text.startswith("broken") else 0)


VALUES = {
    "double": [0.5, 1.0, -0.0, 3.25, math.nan, math.inf, None],
    "timestamp": [dt.datetime(2020, 1, d, 5, 6, 7, 89) for d in (1, 2, 3)] + [None],
    "string": ["", "a", "b", "ä", "'", None],
    "decimal(9,2)": [None, *map(__import__("decimal").Decimal, ("1.50", "1.51", "-3.00"))],
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("descending", [True, False])
def test_pages_follow_one_another(spark, kind, descending):
    rng = random.Random(kind)
    rows = spark.createDataFrame([(f"i{i:03}", rng.choice(VALUES[kind])) for i in range(57)], f"id string, v {kind}")
    wanted = [r["id"] for r in reads.sorted_by(rows, "v", descending).collect()]
    found, last = [], None
    while True:
        page = reads.page_after(rows, "v", per_page=10, last=last, descending=descending)
        found += [r["id"] for r in page.collect()]
        last = reads.place_of(page, "v")
        if last is None:
            break
    assert found == wanted


def test_a_deep_page_is_a_filter_of_the_scan(spark, dataset, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) id", "id % 10 as v").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    page = reads.page_after(rows, "v", per_page=5, last=("3", "77"))
    plan = page._jdf.queryExecution().toString()
    assert "Offset" not in plan and "TakeOrderedAndProject" in plan and "LessThan(v,3)" in plan
    spec = LoadSpec("s", table_hints={"default_sorting_field": "rank"}, field_hints={"rank": {"type": "int64"}})
    put(dataset, (spec, [(f"n{i}", i) for i in range(7)], "name string, rank long"))
    first = dataset.browse("s", per_page=3)
    second = dataset.browse("s", per_page=3, after=dataset.place("s", first))
    assert [r["name"] for r in second.collect()] == ["n3", "n2", "n1"]
    last = dataset.browse("s", per_page=3, after=dataset.place("s", second))
    assert [r["name"] for r in last.collect()] == ["n0"]
    assert dataset.place("s", dataset.browse("s", per_page=3, after=dataset.place("s", last))) is None


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("count", [0, 60, 200, 390, 400, 500])
def test_a_cap_takes_the_first_rows(spark, kind, count):
    rng = random.Random(f"{kind}{count}")
    rows = [(rng.choice(VALUES[kind]), i // 3, "x") for i in range(400)]
    df = spark.createDataFrame(rows, f"v {kind}, n int, w string").repartition(5)
    wanted = [(r["v"], r["n"]) for r in df.orderBy("v", "n").limit(count).collect()]
    found = incremental.limited(df, "v", count, ["n"], ordered=50)
    assert found.columns == df.columns
    assert sorted(map(repr, [(r["v"], r["n"]) for r in found.collect()])) == sorted(map(repr, wanted))


def test_a_cap_among_identical_rows_and_many_values(spark):
    same = spark.range(1000).select(F.lit(1).alias("v"), F.lit("x").alias("w"))
    assert incremental.limited(same, "v", 700, ordered=10).count() == 700
    many = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    found = incremental.limited(many, "v", 3210, ordered=10)
    assert sorted(r["v"] for r in found.collect()) == list(range(3210))
    assert "rangepartitioning" not in found._jdf.queryExecution().toString().lower()
