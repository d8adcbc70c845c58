"""End-to-end loads into a dataset folder."""

from __future__ import annotations

import hashlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from docharbor import ConfigError, LoadError, LoadSpec, RejectedRows, run_load
from docharbor.functions.names import ID, LIST_IDX, PARENT_ID, ROOT_ID, ROW_ID
from docharbor.operators import dispositions
from docharbor.plans.dataset import Dataset, Layout
from docharbor.plans.load import _Resource

ITEMS = "order_id string, items array<struct<sku:string>>"
PARTS = "order_id string, items array<struct<sku:string, parts:array<struct<pn:string>>>>"


def put(dataset, spec, rows, schema, load_id=None, **kwargs):
    return run_load(
        dataset, [(spec, dataset.spark.createDataFrame(rows, schema))], load_id, **kwargs
    )


def values(dataset, table, *columns):
    return sorted(tuple(r) for r in dataset.read(table).select(*columns).collect())


PRODUCTS = LoadSpec("products", "merge", primary_key="sku", buckets=4)


def test_upsert_updates_in_place_and_adds(dataset):
    put(dataset, PRODUCTS, [("A1", 1), ("B2", 2)], "sku string, price long")
    before = dict(values(dataset, "products", "sku", ID))
    put(dataset, PRODUCTS, [("B2", 20), ("C3", 3)], "sku string, price long")
    assert values(dataset, "products", "sku", "price") == [("A1", 1), ("B2", 20), ("C3", 3)]
    after = dict(values(dataset, "products", "sku", ID))
    assert before["A1"] == "d93899e3-6e93-57c0-94a1-d6905be62c70"
    assert {k: after[k] for k in before} == before


def test_upsert_replaces_the_document_and_emplace_does_not(dataset):
    put(dataset, PRODUCTS, [("A1", 1, 2)], "sku string, a long, b long")
    put(dataset, PRODUCTS, [("A1", 10)], "sku string, a long")
    assert values(dataset, "products", "sku", "a", "b") == [("A1", 10, None)]
    emplace = LoadSpec("other", "merge", primary_key="sku", action="emplace")
    put(dataset, emplace, [("A1", 1, 2)], "sku string, a long, b long")
    put(dataset, emplace, [("A1", 10)], "sku string, a long")
    put(dataset, emplace, [("A1", None), ("B2", 5)], "sku string, a long")
    assert values(dataset, "other", "sku", "a", "b") == [("A1", 10, 2), ("B2", 5, None)]
    put(dataset, emplace, [(f"N{i}", i) for i in range(20)], "sku string, a long")
    done = put(dataset, emplace, [("N3", 33), ("M1", 1)], "sku string, a long")
    assert done.tables["other"].updated == 1
    found = dict(values(dataset, "other", "sku", "a"))
    assert len(found) == 23 and (found["N3"], found["N4"], found["M1"]) == (33, 4, 1)


def test_compound_and_unique_keys(dataset):
    stock = LoadSpec("stock", "merge", primary_key=("tenant", "sku"))
    put(dataset, stock, [("t1", "A1", 1), ("t2", "A1", 2)], "tenant string, sku string, qty long")
    put(dataset, stock, [("t1", "A1", 99)], "tenant string, sku string, qty long")
    assert values(dataset, "stock", "tenant", "qty") == [("t1", 99), ("t2", 2)]
    codes = LoadSpec("codes", "merge", unique="code")
    put(dataset, codes, [("X", 1)], "code string, price long")
    put(dataset, codes, [("X", 2)], "code string, price long")
    assert values(dataset, "codes", "code", "price") == [("X", 2)]


def test_merge_without_a_key_writes_nothing(dataset):
    with pytest.raises(ConfigError, match="primary_key"):
        put(dataset, LoadSpec("titles", "merge"), [("x",)], "title string")
    assert dataset.tables() == []


def test_append_accumulates_identical_rows(dataset):
    spec = LoadSpec("events")
    rows = [("e1", "a"), ("e2", "b"), ("e2", "b")]
    put(dataset, spec, rows, "event_id string, name string")
    put(dataset, spec, rows, "event_id string, name string")
    found = values(dataset, "events", ID, ROW_ID)
    assert len(found) == 6 and len({i for i, _ in found}) == 6
    assert all(i == r for i, r in found)


def test_append_evolution_keeps_old_rows(dataset):
    spec = LoadSpec("events")
    put(dataset, spec, [("e1", "a")], "event_id string, name string")
    put(dataset, spec, [("e2", "b", "x")], "event_id string, name string, extra string")
    assert dict(values(dataset, "events", "event_id", "extra")) == {"e1": None, "e2": "x"}


def test_type_conflict_goes_to_a_variant_column(dataset):
    spec = LoadSpec("rows", "merge", primary_key="rid")
    put(dataset, spec, [(1, 10)], "rid long, val long")
    put(dataset, spec, [(2, "ten")], "rid long, val string")
    found = {r["rid"]: (r["val"], r["val__v_text"]) for r in dataset.read("rows").collect()}
    assert found == {1: (10, None), 2: (None, "ten")}


def test_replace_and_replace_with_no_rows(dataset):
    spec = LoadSpec("snap", "replace")
    put(dataset, spec, [(k,) for k in range(5)], "k long")
    put(dataset, spec, [(100,), (101,)], "k long")
    assert values(dataset, "snap", "k") == [(100,), (101,)]
    put(dataset, spec, [], "k long")
    assert dataset.tables() == ["snap"] and dataset.read("snap").count() == 0


def test_replace_takes_the_new_schema(dataset):
    spec = LoadSpec("snap", "replace")
    put(dataset, spec, [("a", 1, 1)], "keep string, drop_me long, changes long")
    put(dataset, spec, [("b", "x")], "keep string, changes string")
    assert "drop_me" not in dataset.read("snap").columns
    assert values(dataset, "snap", "keep", "changes") == [("b", "x")]


def test_replace_covers_child_tables(dataset):
    spec = LoadSpec("orders", "replace")
    put(dataset, spec, [("o1", [("a",), ("b",), ("c",)])], ITEMS)
    put(dataset, spec, [("o1", [("z",)])], ITEMS)
    assert values(dataset, "orders__items", "sku") == [("z",)]
    put(dataset, spec, [("o2",)], "order_id string")
    assert dataset.read("orders__items").count() == 0


def test_child_rows_are_linked(dataset):
    spec = LoadSpec("orders", "merge", primary_key="order_id")
    put(dataset, spec, [("o1", [("a",), ("b",)])], ITEMS)
    root = dataset.read("orders").first()
    children = dataset.read("orders__items").orderBy(LIST_IDX).collect()
    assert [(c["sku"], c[LIST_IDX]) for c in children] == [("a", 0), ("b", 1)]
    assert {c[PARENT_ID] for c in children} == {c[ROOT_ID] for c in children} == {root[ROW_ID]}
    assert all(c[ID] == c[ROW_ID] for c in children)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_orphans_are_removed_from_reloaded_roots_only(spark, dataset, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        spec = LoadSpec("orders", "merge", primary_key="order_id", buckets=3)
        put(dataset, spec, [("o1", [("a",), ("b",)]), ("o2", [("c",)])], ITEMS)
        done = put(dataset, spec, [("o1", [("a",)])], ITEMS)
        assert done.tables["orders__items"].removed_orphans == 1
        assert values(dataset, "orders__items", "sku") == [("a",), ("c",)]
        put(dataset, spec, [("o1", [])], ITEMS)
        assert values(dataset, "orders__items", "sku") == [("c",)]
        assert dataset.read("orders").count() == 2
        done = put(dataset, spec, [("o2",)], "order_id string")
        assert done.tables["orders__items"].removed_orphans == 1
        assert dataset.read("orders__items").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_are_removed_at_every_level(dataset):
    spec = LoadSpec("orders", "merge", primary_key="order_id")
    full = [("o1", [("a", [("p1",), ("p2",)]), ("b", [("p3",)])])]
    put(dataset, spec, full, PARTS)
    assert values(dataset, "orders__items__parts", "pn") == [("p1",), ("p2",), ("p3",)]
    layout = dataset.layout("orders__items__parts")
    assert (layout.parent, layout.root) == ("orders__items", "orders")
    put(dataset, spec, [("o1", [("a", [("p1",)])])], PARTS)
    assert values(dataset, "orders__items", "sku") == [("a",)]
    assert values(dataset, "orders__items__parts", "pn") == [("p1",)]


@pytest.mark.parametrize("disposition", ["merge", "replace"])
def test_row_ids_of_list_elements_are_made_when_read(spark, dataset, disposition):
    key = {"primary_key": "order_id"} if disposition == "merge" else {}
    spec = LoadSpec("orders", disposition, buckets=2, **key)
    full = [("o1", [("a", [("p1",), ("p2",)]), ("b", [("p3",)])]), ("o2", [("c", [("p4",)])])]
    put(dataset, spec, full, PARTS, "l1")
    for table in ("orders__items", "orders__items__parts"):
        (part,) = dataset.layout(table).parts
        stored = spark.read.parquet(f"{dataset.path}/{table}/{part.path}")
        assert not {ID, ROW_ID} & set(stored.columns)
        for r in dataset.read(table).select(ID, ROW_ID, PARENT_ID, LIST_IDX).collect():
            text = "\u0001".join([r[PARENT_ID], table, str(r[LIST_IDX])])
            assert r[ID] == r[ROW_ID] == hashlib.sha256(text.encode()).hexdigest()[:32]
    items, parts = dataset.read("orders__items"), dataset.read("orders__items__parts")
    assert {r[PARENT_ID] for r in parts.collect()} == {r[ROW_ID] for r in items.collect()}
    done = put(dataset, spec, [("o1", [("a", [("p1",), ("p5",)])])], PARTS, "l2")
    if disposition == "merge":
        assert values(dataset, "orders__items__parts", "pn") == [("p1",), ("p4",), ("p5",)]
        changes = done.tables["orders__items__parts"]
        assert (changes.updated, changes.removed_orphans) == (2, 1)


def test_child_tables_that_store_row_ids_go_on_doing_so(spark, dataset, monkeypatch):
    """Tables of an earlier version of the library have no name to make the ids of."""
    spec = LoadSpec("orders", "merge", primary_key="order_id", buckets=2)
    made = _Resource._layout
    monkeypatch.setattr(_Resource, "_layout", lambda *a: replace(made(*a), row_ids_of=None))
    put(dataset, spec, [("o1", [("a",), ("b",)]), ("o2", [("c",)])], ITEMS, "l1")
    monkeypatch.undo()
    before = dict(values(dataset, "orders__items", "sku", ROW_ID))
    done = put(dataset, spec, [("o1", [("a",)])], ITEMS, "l2")
    changes = done.tables["orders__items"]
    assert (changes.updated, changes.removed_orphans) == (1, 1)
    after = dict(values(dataset, "orders__items", "sku", ROW_ID))
    assert after == {k: before[k] for k in ("a", "c")}


def test_staged_rows_are_gone_before_stored_rows_are_written_again(dataset, tmp_path, monkeypatch):
    """The stage and the rewritten tables are never on disk at once; stages of other resources stay."""
    spec = LoadSpec("orders", "merge", primary_key="order_id", buckets=2)
    put(dataset, spec, [("o1", [("a", [("p1",)])]), ("o2", [("b", [("p2",)])])], PARTS, "l1")
    dataset.stage(dataset.spark.range(1), "other_delta", "l2")
    staged, write = {}, Dataset.write_part

    def watching(self, rows, table, load_id, step, *args, **kwargs):
        staged[table, step] = sorted(p.name for p in tmp_path.glob("catalog/_stage/_load=l2/*"))
        return write(self, rows, table, load_id, step, *args, **kwargs)

    monkeypatch.setattr(Dataset, "write_part", watching)
    put(dataset, spec, [("o1", [("c", [("p3",)])])], PARTS, "l2")
    for table in ("orders__items", "orders__items__parts"):
        assert "orders" in staged[table, "batch"]
        assert "orders" not in staged[table, "kept"] and "other_delta" in staged[table, "kept"]
    assert values(dataset, "orders__items__parts", "pn") == [("p2",), ("p3",)]


@pytest.mark.parametrize("way", ["hashes", "groups", "clash", "many"])
def test_child_rows_of_other_roots_do_not_move(spark, dataset, monkeypatch, way):
    """They stay where hashes of the reloaded roots say so, which roots that share a hash prevent."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    if way == "clash":
        monkeypatch.setattr("docharbor.plans.load.root_hash", lambda: F.lit(1).alias("_root_hash"))
    if way in ("groups", "many"):
        monkeypatch.setattr("docharbor.plans.load.MOST_HASHES", 6 if way == "groups" else 0)
    in_place, made, plans = [], _Resource._kept_in_place, []
    monkeypatch.setattr(_Resource, "_kept_in_place", lambda *a: in_place.append(made(*a)) or in_place[-1])
    rewrite = _Resource._rewrite

    def watching(self, name, layout, rows, *args, **kwargs):
        if name == "orders__items":
            plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return rewrite(self, name, layout, rows, *args, **kwargs)

    monkeypatch.setattr(_Resource, "_rewrite", watching)
    try:
        spec = LoadSpec("orders", "merge", primary_key="order_id", buckets=2)
        put(dataset, spec, [(f"o{i}", [(f"a{i}",), (f"b{i}",)]) for i in range(40)], ITEMS)
        done = put(dataset, spec, [(f"o{i}", [(f"c{i}",)]) for i in range(8)], ITEMS, "l2")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kept = [(f"{x}{i}",) for x in "ab" for i in range(8, 40)]
    assert values(dataset, "orders__items", "sku") == sorted(kept + [(f"c{i}",) for i in range(8)])
    changes = done.tables["orders__items"]
    assert (changes.updated, changes.removed_orphans) == (8, 8)
    (parts,) = in_place
    steps = {"hashes": ["kept"], "groups": ["kept", "kept-1"]}.get(way)
    assert (parts and [p.path for p in parts]) == (steps and [f"_load=l2/_part={s}" for s in steps])
    assert all(("SortMergeJoin" in plan) == (steps is None) for plan in plans) and plans


def test_places_that_are_stored_several_times_are_counted_so(spark):
    """Appends may leave a place of a list twice; others are counted by a bit for each place."""
    schema = f"{PARENT_ID} string, {LIST_IDX} int"
    stored = [("p", 0), ("p", 63), ("p", 64), ("p", 130), ("q", 1), ("r", 0)]
    again = spark.createDataFrame([("p", 0), ("p", 64), ("p", 65), ("q", 0), ("r", 0), ("s", 0)], schema)
    old = Layout({}, {}, row_ids_of="orders__items")
    for rows, count in ((stored, 3), (stored + [("p", 64), ("q", 1)], 4), ([], 0)):
        target = spark.createDataFrame(rows, schema)
        assert _Resource._written_again(None, target, again, old) == count


@pytest.mark.parametrize("change", [{"remove_orphans": False}, {"strategy": "insert-only"}])
def test_orphans_stay_when_cleanup_is_off(dataset, change):
    spec = LoadSpec("orders", "merge", primary_key="order_id", **change)
    put(dataset, spec, [("o1", [("a",), ("b",)])], ITEMS)
    put(dataset, spec, [("o1", [("a",)])], ITEMS)
    assert values(dataset, "orders__items", "sku") == [("a",), ("b",)]


def test_emplace_cleans_and_keeps_fields(dataset):
    spec = LoadSpec("orders", "merge", primary_key="order_id", action="emplace")
    wide = "order_id string, items array<struct<sku:string, n:long>>"
    put(dataset, spec, [("o1", [("a", 1), ("b", 2)])], wide)
    put(dataset, spec, [("o1", [("z", None)])], wide)
    assert values(dataset, "orders__items", "sku", "n") == [("z", 1)]


def test_insert_only_never_changes_a_row(dataset):
    spec = LoadSpec("products", "merge", primary_key="sku", strategy="insert-only")
    put(dataset, spec, [("A1", 1), ("B2", 2)], "sku string, n long")
    before = values(dataset, "products", ID, "sku", "n")
    more = [("A1", 1), ("B2", 99), *[(f"C{i}", i) for i in range(30)]]
    put(dataset, spec, more, "sku string, n long")
    put(dataset, spec, [], "sku string, n long")
    assert dict(values(dataset, "products", "sku", "n")) == {**dict(more), "B2": 2}
    assert dataset.read("products").count() == 32
    put(dataset, spec, [("D4", 4)], "sku string, n long", "fresh")
    assert "_load=fresh/_part=batch" in [p.path for p in dataset.layout("products").parts]
    assert set(before) <= set(values(dataset, "products", ID, "sku", "n"))
    assert all(i == r for i, r in values(dataset, "products", ID, ROW_ID))


def test_append_then_merge_leaves_both_and_counts_them(dataset):
    put(dataset, LoadSpec("products"), [("A1", 1)], "sku string, price long")
    done = put(dataset, PRODUCTS, [("A1", 2)], "sku string, price long")
    assert values(dataset, "products", "price") == [(1,), (2,)]
    assert done.tables["products"].ids_of_other_scheme == 1
    put(dataset, PRODUCTS, [("A1", 3)], "sku string, price long")
    assert values(dataset, "products", "price") == [(1,), (3,)]


def test_last_row_of_a_key_wins_or_the_load_is_refused(dataset):
    rows = [("A1", 1, "x"), ("A1", 2, None), ("B2", 1, "y")]
    schema = "sku string, seq long, note string"
    with pytest.raises(LoadError, match="1 keys occur more than once"):
        put(dataset, PRODUCTS, rows, schema)
    assert dataset.tables() == []
    ordered = LoadSpec("products", "merge", primary_key="sku", order_by="seq")
    put(dataset, ordered, rows, schema)
    assert values(dataset, "products", "sku", "seq", "note")[0] == ("A1", 2, None)
    patch = LoadSpec("patched", "merge", primary_key="sku", order_by="seq", action="emplace")
    put(dataset, patch, rows, schema)
    assert values(dataset, "patched", "sku", "seq", "note")[0] == ("A1", 2, "x")


def test_the_winner_of_a_key_brings_its_children_alone(dataset):
    spec = LoadSpec("orders", "merge", primary_key="order_id", order_by="seq")
    schema = "order_id string, seq long, items array<struct<sku:string>>"
    put(dataset, spec, [("o1", 1, [("a",), ("b",)]), ("o1", 2, [("c",)])], schema)
    assert values(dataset, "orders__items", "sku") == [("c",)]


def test_rejects_fail_the_load_and_nothing_is_visible(dataset):
    spec = LoadSpec("vecs", field_hints={"embedding": {"type": "float[]", "num_dim": 3}})
    schema = "doc string, embedding array<float>"
    with pytest.raises(RejectedRows) as failure:
        put(dataset, spec, [("a", [0.1, 0.2]), ("b", [0.1, 0.2, 0.3])], schema, "l1",
            pipeline="p", state={"x": 1})
    caught = failure.value
    assert (caught.failed_count, caught.total_count, caught.table, caught.load_id) == (1, 2, "vecs", "l1")
    assert "vector must have 3 values" in caught.samples[0] and '"doc":"a"' in caught.samples[0]
    assert dataset.tables() == [] and dataset.state("p") is None
    put(dataset, spec, [("b", [0.1, 0.2, 0.3])], schema, "l1")
    assert dataset.read("vecs").count() == 1


def test_quarantine_keeps_good_rows_and_saves_the_rest(dataset):
    spec = LoadSpec("orders", "merge", primary_key="order_id", on_reject="quarantine")
    done = put(dataset, spec, [("o1", [("a",)]), (None, [("b",)])], ITEMS, "l1")
    assert (done.tables["orders"].failed, done.tables["orders"].total) == (1, 2)
    assert values(dataset, "orders__items", "sku") == [("a",)]
    reasons = [r["_errors"][0]["reason"] for r in dataset.rejects("orders", "l1").collect()]
    assert reasons == ["key column is missing or null"]
    assert dataset.rejects("orders__items", "l1").first()["sku"] == "b"
    put(dataset, spec, [("o2", [("c",)])], ITEMS, "l2")
    assert dataset.rejects("orders", "l2").count() == 0


def test_a_retry_leaves_no_bucket_of_the_first_try(spark, dataset, monkeypatch):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        with monkeypatch.context() as patched:
            patched.setattr(Dataset, "commit", lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                put(dataset, PRODUCTS, [(f"s{i}", i) for i in range(50)], "sku string, price long", "l1")
        put(dataset, PRODUCTS, [("s1", 7)], "sku string, price long", "l1")
        assert values(dataset, "products", "sku", "price") == [("s1", 7)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_eight_failures_give_five_short_samples(dataset):
    spec = LoadSpec("rows", field_hints={"v": {"type": "int64", "optional": False}})
    rows = [(f"{i}-" + "x" * 2000, None) for i in range(8)]
    with pytest.raises(RejectedRows) as failure:
        put(dataset, spec, rows, "text string, v long")
    assert failure.value.failed_count == 8
    assert len(failure.value.samples) == 5
    assert all(len(s) <= 500 for s in failure.value.samples)


def test_a_load_that_failed_between_write_and_commit_can_run_again(dataset, monkeypatch):
    for disposition in ("append", "replace", "merge"):
        spec = LoadSpec(f"t_{disposition}", disposition, primary_key="n")
        rows = [(i,) for i in range(25)]
        with monkeypatch.context() as patched:
            patched.setattr(Dataset, "commit", lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                put(dataset, spec, rows, "n long", f"load-{disposition}")
        assert spec.name not in dataset.tables()
        for _ in range(2):
            done = put(dataset, spec, rows, "n long", f"load-{disposition}")
        assert done.repeated
        assert dataset.read(spec.name).count() == 25


def test_several_resources_under_one_load(dataset):
    spark = dataset.spark
    products = spark.createDataFrame([("A1", 1)], "sku string, price long")
    events = spark.createDataFrame([(1, "x"), (2, "y")], "event_id long, name string")
    skipped = LoadSpec("nothing", "skip")
    for _ in range(2):
        run_load(dataset, [(PRODUCTS, products), (LoadSpec("events"), events), (skipped, events)])
    assert dataset.read("products").count() == 1
    assert dataset.read("events").count() == 4
    assert dataset.tables() == ["events", "products"]


def test_the_source_id_column_is_kept_under_another_name(dataset):
    put(dataset, LoadSpec("rows"), [("user-supplied", "x")], "id string, userName string")
    row = dataset.read("rows").first()
    assert row["__id"] == "user-supplied" and row["id"] == row[ROW_ID] != "user-supplied"
    assert row["user_name"] == "x"


def test_hints_take_effect_when_the_table_is_created(dataset, caplog):
    schema = "name string, last_update timestamp"
    import datetime as dt

    rows = [("a", dt.datetime(2020, 1, 1))]
    hinted = LoadSpec("logs", field_hints={"last_update": {"type": "int64"}})
    put(dataset, hinted, rows, schema)
    changed = LoadSpec("logs", field_hints={"last_update": {"type": "string"}})
    with caplog.at_level("INFO"):
        put(dataset, changed, rows, schema)
    assert "were not re-applied" in caplog.text
    assert values(dataset, "logs", "last_update") == [(1577836800,), (1577836800,)]
    put(dataset, LoadSpec("logs", "replace", field_hints=changed.field_hints), rows, schema)
    assert values(dataset, "logs", "last_update") == [("2020-01-01T00:00:00Z",)]


def test_empty_batches_are_a_success(dataset):
    done = put(dataset, LoadSpec("empty"), [], "a long")
    assert done.tables["empty"].total == 0 and dataset.read("empty").count() == 0
    put(dataset, LoadSpec("em", "merge", primary_key="a"), [], "a long")
    put(dataset, LoadSpec("em", "merge", primary_key="a"), [], "a long")
    assert dataset.read("em").count() == 0


@pytest.mark.parametrize("few", [64, 2])
def test_merge_reads_and_writes_touched_buckets_only(dataset, monkeypatch, few):
    monkeypatch.setattr("docharbor.plans.dataset.FEW_BUCKETS", few)
    spec = LoadSpec("many", "merge", primary_key="n", buckets=16)
    put(dataset, spec, [(i, 0) for i in range(200)], "n long, v long", "first")
    put(dataset, spec, [(7, 1)], "n long, v long", "second")
    parts = {p.path: p.buckets for p in dataset.layout("many").parts}
    assert len(parts["_load=first/_part=batch"]) == 15
    assert parts["_load=second/_part=batch"] == parts["_load=second/_part=kept"]
    assert dict(values(dataset, "many", "n", "v"))[7] == 1
    assert dataset.read("many").count() == 200
    document = dataset.read("many").filter("n = 7").first()[ID]
    assert dataset.lookup("many", document).first()["v"] == 1


@pytest.fixture(params=["10m", "-1"], ids=["broadcast", "shuffle"])
def broadcast_limit(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("action", ["upsert", "emplace"])
def test_a_task_of_a_rewrite_writes_to_one_bucket(dataset, tmp_path, broadcast_limit, action):
    spec = LoadSpec("many", "merge", primary_key="n", buckets=3, action=action)
    spark = dataset.spark
    run_load(dataset, [(spec, spark.range(500).selectExpr("id n", "0 v", "id w"))], "l1")
    run_load(dataset, [(spec, spark.range(250, 600).selectExpr("id n", "1 v"))], "l2")
    found = {r["n"]: (r["v"], r["w"]) for r in dataset.read("many").collect()}
    kept = {n: n for n in range(500)} if action == "emplace" else {n: n for n in range(250)}
    assert found == {n: (int(n >= 250), kept.get(n)) for n in range(600)}
    assert dataset.read("many").count() == 600
    step = "merged" if action == "emplace" else "kept"
    if broadcast_limit == "-1":
        files = list(tmp_path.glob(f"catalog/many/_load=l2/_part={step}/*/*/*.parquet"))
        assert 3 <= len(files) <= 9


def test_new_rows_rewrite_nothing(dataset, broadcast_limit):
    spec = LoadSpec("orders", "merge", primary_key="order_id", buckets=2)
    put(dataset, spec, [("o1", [("a",)])], ITEMS, "l1")
    done = put(dataset, spec, [("o2", [("b",)]), ("o3", [])], ITEMS, "l2")
    assert (done.tables["orders"].updated, done.tables["orders"].total) == (0, 2)
    for table in ("orders", "orders__items"):
        steps = {p.path for p in dataset.layout(table).parts}
        assert steps == {"_load=l1/_part=batch", "_load=l2/_part=batch"}
    assert values(dataset, "orders__items", "sku") == [("a",), ("b",)]
    done = put(dataset, spec, [("o2", [("c",), ("d",)]), ("o4", [("e",)])], ITEMS, "l3")
    assert (done.tables["orders"].updated, done.tables["orders__items"].updated) == (1, 1)
    assert values(dataset, "orders__items", "sku") == [("a",), ("c",), ("d",), ("e",)]


def test_one_root_may_own_most_children(dataset, broadcast_limit):
    spec = LoadSpec("orders", "merge", primary_key="order_id", buckets=2)
    hot = [(f"s{i}",) for i in range(3000)]
    put(dataset, spec, [("hot", hot), ("cold", [("x",)])], ITEMS)
    done = put(dataset, spec, [("hot", hot[:10])], ITEMS)
    assert done.tables["orders__items"].removed_orphans == 2990
    assert dataset.read("orders__items").count() == 11


def test_a_key_may_hold_most_rows_of_a_batch(dataset):
    spec = LoadSpec("orders", "merge", primary_key="k", order_by="n", buckets=2)
    batch = dataset.spark.range(20000).selectExpr("if(id % 3 > 0, 0, id) k", "id n")
    run_load(dataset, [(spec, batch)])
    found = dict(values(dataset, "orders", "k", "n"))
    assert len(found) == 6667 and found[0] == 19999


@pytest.mark.parametrize("seed", range(2))
def test_random_loads_agree_with_a_dictionary(dataset, broadcast_limit, seed):
    import random

    rng = random.Random(seed)
    spec = LoadSpec("t", "merge", primary_key="k", buckets=2)
    model: dict[int, list[int]] = {}
    for _ in range(4):
        batch = {rng.randrange(12): [rng.randrange(5) for _ in range(rng.randrange(4))] for _ in range(5)}
        model.update(batch)
        rows = [(k, [(x,) for x in items]) for k, items in batch.items()]
        put(dataset, spec, rows, "k long, items array<struct<x:long>>")
        roots = dict(values(dataset, "t", ROW_ID, "k"))
        found: dict[int, list[tuple[int, int]]] = {k: [] for k in roots.values()}
        for root, place, x in values(dataset, "t__items", ROOT_ID, LIST_IDX, "x"):
            found[roots[root]].append((place, x))
        assert {k: [x for _, x in sorted(v)] for k, v in found.items()} == model


def test_a_rejected_row_does_not_win_over_a_good_one(spark, dataset):
    spec = LoadSpec(
        "t", "merge", primary_key="k", order_by="at", on_reject="quarantine",
        field_hints={"v": {"type": "int32"}},
    )
    rows = [("a", 1, 5), ("a", 2, 1 << 40), ("b", 1, 7), ("b", 2, 8), (None, 1, 1), (None, 1, 1), ("c", 1, 1 << 40)]
    batch = spark.createDataFrame(rows, "k string, at int, v long")
    done = run_load(dataset, [(spec, batch)], "l1")
    assert {r["k"]: r["v"] for r in dataset.read("t").collect()} == {"a": 5, "b": 8}
    assert (done.tables["t"].total, done.tables["t"].failed) == (6, 4)
    assert sorted(str(r["k"]) for r in dataset.rejects("t", "l1").collect()) == ["None", "None", "a", "c"]


def test_last_values_of_types_without_an_order(spark):
    rows = spark.sql(
        "select * from values (1, 1, map('a', 1), parse_json('1'), named_struct('m', map('x', 1))),"
        " (1, 2, map('b', 2), null, null) as t(k, at, m, v, s)"
    )
    found = dispositions.last_value_per_column(rows, ["k"], ["at"]).first()
    assert found["m"] == {"b": 2} and str(found["v"].toJson()) == "1" and found["s"]["m"] == {"x": 1}
    assert dispositions.last_wins(rows, ["k"], ["at"]).first()["m"] == {"b": 2}
