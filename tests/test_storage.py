"""System tables, state, incremental syncs, streams, sources and files."""

from __future__ import annotations

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from docharbor import LoadError, LoadSpec, RejectedRows, SyncSpec, run_load, run_sync
from docharbor.errors import ConfigError
from docharbor.operators import quality
from docharbor.plans.dataset import Dataset
from docharbor.session import FOOTER_COUNTS, settings
from docharbor.sources import files, incremental, jdbc, pages
from docharbor.streaming.micro_batch import load_stream


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_initialise_keeps_data_and_truncates_listed_tables(spark, dataset):
    assert dataset.is_initialised()
    df = frame(spark, [(1,), (2,)], "n long")
    run_load(dataset, [(LoadSpec("a"), df), (LoadSpec("b"), df)])
    dataset.initialise()
    assert dataset.read("a").count() == 2
    dataset.initialise(truncate=["a"])
    assert dataset.read("a").count() == 0 and dataset.read("b").count() == 2
    assert dataset.tables() == ["a", "b"]
    run_load(dataset, [(LoadSpec("a"), df)])
    assert dataset.read("a").count() == 2


def test_datasets_are_isolated_and_can_be_dropped(spark, tmp_path):
    root = str(tmp_path)
    shop, shop_eu = Dataset(spark, root, "shop"), Dataset(spark, root, "shop_eu")
    df = frame(spark, [(1,)], "n long")
    for each in (shop, shop_eu):
        run_load(each, [(LoadSpec("a"), df)])
    shop.drop()
    assert not shop.is_initialised() and shop.tables() == []
    assert shop_eu.read("a").count() == 1
    run_load(shop, [(LoadSpec("a"), df)])
    assert shop.read("a").count() == 1


def test_a_dataset_without_a_name_drops_listed_tables(spark, tmp_path):
    bare = Dataset(spark, str(tmp_path))
    (tmp_path / "unrelated").mkdir()
    run_load(bare, [(LoadSpec("a"), frame(spark, [(1,)], "n long"))])
    assert bare.qualified("a") == "a"
    with pytest.raises(LoadError, match="list them"):
        bare.drop()
    bare.drop(["a"])
    assert (tmp_path / "unrelated").exists() and not (tmp_path / "a").exists()


def test_missing_tables_are_errors(spark, tmp_path):
    nothing = Dataset(spark, str(tmp_path), "nothing")
    assert nothing.schema() is None and nothing.schema_by_hash("x") is None
    assert not nothing.is_initialised() and nothing.tables() == []
    with pytest.raises(LoadError, match="_pipeline_state"):
        nothing.state("p")
    nothing.initialise()
    assert nothing.state("p") is None
    with pytest.raises(LoadError, match="no table 'x'"):
        nothing.read("x")


def test_schema_versions(spark, dataset):
    run_load(dataset, [(LoadSpec("a"), frame(spark, [(1,)], "a long"))])
    first = dataset.schema()
    run_load(dataset, [(LoadSpec("a"), frame(spark, [(2,)], "a long"))])
    assert dataset.versions().count() == 1
    run_load(dataset, [(LoadSpec("a"), frame(spark, [(3, "x")], "a long, b string"))])
    newest = dataset.schema("catalog")
    assert newest["version"] > first["version"] and newest["version_hash"] != first["version_hash"]
    assert dataset.schema_by_hash(first["version_hash"])["version"] == first["version"]
    assert dataset.schema("other") is None
    assert "b" in json.dumps(json.loads(newest["schema"])["tables"]["a"]["columns"])
    import hashlib

    assert first["id"] == hashlib.sha1(f"version|{first['version_hash']}".encode()).hexdigest()


def test_completing_a_load_again_changes_nothing(spark, dataset):
    for _ in range(3):
        dataset.commit("l1", {})
    loads = dataset.loads().collect()
    assert [(r["id"], r["load_id"], r["status"], r["schema_name"]) for r in loads] == [
        ("l1", "l1", 0, "catalog")
    ]


def test_uncommitted_state_stays_invisible(spark, dataset):
    df = frame(spark, [(1,)], "n long")
    run_load(dataset, [(LoadSpec("a"), df)], "l1", pipeline="p", state={"at": 1})
    committed = dataset.state_row("p")
    for i in range(3):
        dataset.store_state("p", {"at": 100 + i}, f"never-{i}")
    assert dataset.state("p") == {"at": 1} and dataset.state_row("p") == committed
    run_load(dataset, [(LoadSpec("a"), df)], "l2", pipeline="p", state={"at": 2})
    assert dataset.state("p") == {"at": 2}
    assert dataset.state_row("p")["version"] > committed["version"]
    assert dataset.state("q") is None


def test_readers_see_the_old_table_until_the_commit(spark, dataset, monkeypatch):
    spec = LoadSpec("snap", "replace")
    run_load(dataset, [(spec, frame(spark, [(1,)], "n long"))], "l1")
    seen = []
    original = Dataset.commit

    def watching(self, *args, **kwargs):
        seen.append([r["n"] for r in self.read("snap").collect()])
        return original(self, *args, **kwargs)

    monkeypatch.setattr(Dataset, "commit", watching)
    run_load(dataset, [(spec, frame(spark, [(2,)], "n long"))], "l2")
    assert seen == [[1]]
    assert [r["n"] for r in dataset.read("snap").collect()] == [2]


def test_a_load_that_only_adds_commits_only_what_it_adds(spark, dataset):
    def sizes():
        rows = dataset.loads().orderBy("seq").collect()
        return [len(r["layout"]["a"]) for r in rows]

    spec = LoadSpec("a", origin="n")
    for i in range(4):
        run_load(dataset, [(spec, frame(spark, [(i,)], "n long"))])
    assert max(sizes()[1:]) < 150 < sizes()[0]
    assert sorted(r["n"] for r in dataset.read("a").collect()) == [0, 1, 2, 3]
    run_load(dataset, [(spec, frame(spark, [(4, "x")], "n long, s string"))])
    run_load(dataset, [(spec, frame(spark, [(5, "y")], "n long, s string"))])
    assert sizes()[4] > 150 > sizes()[5]
    assert dict(dataset.read("a").select("n", "s").collect())[5] == "y"
    assert dataset.read("a").count() == 6 and len(dataset.layout("a").parts) == 6
    dataset.truncate(["a"])
    run_load(dataset, [(spec, frame(spark, [(6, "z")], "n long, s string"))])
    assert [r["n"] for r in dataset.read("a").collect()] == [6]


def test_unreferenced_folders_can_be_removed(spark, dataset):
    spec = LoadSpec("a", "merge", primary_key="n", buckets=2)
    for i in range(3):
        rows = [(k, i) for k in range(20)]
        run_load(dataset, [(spec, frame(spark, rows, "n long, v long"))], f"l{i}")
    assert dataset.remove_unreferenced() > 0
    assert {r["v"] for r in dataset.read("a").collect()} == {2}
    assert dataset.read("a").count() == 20 and dataset.remove_unreferenced() == 0


def test_deletes(spark, dataset):
    rows = [(1, "x"), (2, None), (3, "y")]
    run_load(dataset, [(LoadSpec("a", "merge", primary_key="n"), frame(spark, rows, "n long, s string"))])
    assert dataset.delete_where("a", F.col("s") == "x") == 1
    assert sorted(r["n"] for r in dataset.read("a").collect()) == [2, 3]
    assert dataset.delete_where("a", F.col("s") == "zzz") == 0
    assert dataset.delete_where("a", F.lit(True)) == 2
    assert dataset.read("a").count() == 0 and dataset.tables() == ["a"]


def test_default_order(spark, dataset):
    rows = [(f"n{i}", i) for i in range(3)]
    spec = LoadSpec("a", table_hints={"default_sorting_field": "rank"})
    run_load(dataset, [(spec, frame(spark, rows, "name string, rank long"))])
    assert [r["name"] for r in dataset.browse("a", per_page=2).collect()] == ["n2", "n1"]
    assert [r["name"] for r in dataset.browse("a", per_page=2, number=2).collect()] == ["n0"]


def test_counts_come_from_footers(spark, dataset):
    merged = LoadSpec("m", "merge", primary_key="n")
    run_load(dataset, [(LoadSpec("a"), spark.range(50).toDF("n")), (merged, spark.range(40).toDF("n"))])
    run_load(dataset, [(LoadSpec("a"), spark.range(7).toDF("n")), (merged, spark.range(38, 41).toDF("n"))])
    kept = dict(FOOTER_COUNTS) | {k: spark.conf.get(k) for k in FOOTER_COUNTS}
    assert (dataset.count("a"), dataset.count("m")) == (57, 41)
    assert {k: spark.conf.get(k) for k in FOOTER_COUNTS} == kept
    for table in "am":
        with settings(spark, FOOTER_COUNTS):
            plan = dataset.read(table).groupBy().count()._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan
    dataset.truncate(["a"])
    assert dataset.count("a") == 0
    with pytest.raises(LoadError, match="no table"):
        dataset.count("nothing")


def test_a_range_lies_in_few_files(spark, dataset):
    """Values in any order, one of them in a third of the rows, which doesn't end in one file."""
    rank = F.when(F.col("n") % 3 == 0, 500).otherwise(F.xxhash64("n") % 1000).cast("long").alias("rank")
    rows = spark.range(0, 6_000, 1, 8).toDF("n").select("n", rank)
    spec = LoadSpec("a", table_hints={"default_sorting_field": "rank"}, origin=["n"])
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}):
        for load in ("one", "two"):
            run_load(dataset, [(spec, rows)], load)
    stored = dataset.read("a").withColumn("file", F.input_file_name())
    files = {r["file"]: (r["n"], r["least"], r["most"]) for r in stored.groupBy("file").agg(F.count("*").alias("n"), F.min("rank").alias("least"), F.max("rank").alias("most")).collect()}
    assert len(files) == 24 and max(n for n, _, _ in files.values()) < 1_000
    assert sum(least <= 900 <= most for _, least, most in files.values()) <= 4
    assert sum(least <= 500 <= most for _, least, most in files.values()) >= 8
    got = sorted((r["n"], r["rank"]) for r in stored.filter("rank > 900").collect())
    assert got == sorted(2 * [(r["n"], r["rank"]) for r in rows.filter("rank > 900").collect()])


def test_files_hold_at_most_the_given_rows(spark, dataset, tmp_path):
    spec = LoadSpec("a", max_rows_per_file=10)
    run_load(dataset, [(spec, spark.range(25).coalesce(1).toDF("n"))])
    assert dataset.read("a").count() == 25
    sizes = [spark.read.parquet(str(p)).count() for p in tmp_path.rglob("catalog/a/**/*.parquet")]
    assert sorted(sizes) == [5, 10, 10]


SEQ = "seq long, payload string"


def sequence(spark, *numbers):
    return frame(spark, [(i, f"row-{i}") for i in numbers], SEQ)


def test_second_sync_loads_the_delta_also_elsewhere(spark, dataset, tmp_path):
    def sync(where, *numbers, **kwargs):
        spec = SyncSpec(
            "events", lambda: sequence(spark, *numbers), cursor="seq", initial_value=0,
            disposition="append",
        )
        return run_sync(where, [spec], "p", **kwargs)

    assert sync(dataset, 1, 2, 3).tables["events"].total == 3
    assert sync(dataset, 1, 2, 3, 4, 5).tables["events"].total == 2
    assert dataset.read("events").count() == 5
    elsewhere = Dataset(spark, str(tmp_path), "catalog")
    assert elsewhere.state("p")["events"]["last"] == 5
    assert sync(elsewhere, 4, 5, 6).tables["events"].total == 1
    assert sync(elsewhere, 4, 5, 6).tables["events"].total == 0
    assert elsewhere.state("p")["events"]["last"] == 6
    sync(elsewhere, 7, 8, full_refresh=True)
    assert sorted(r["seq"] for r in elsewhere.read("events").collect()) == [7, 8]


def test_rows_at_the_boundary_are_loaded_once(spark, dataset):
    moment = dt.datetime(2024, 1, 1)
    schema = "k string, at timestamp_ntz"

    def sync(rows):
        spec = SyncSpec("t", lambda: frame(spark, rows, schema), primary_key="k", cursor="at")
        return run_sync(dataset, [spec], "p").tables["t"].total

    assert sync([("a", moment), ("b", moment)]) == 2
    assert sync([("a", moment), ("b", moment), ("c", moment)]) == 1
    assert sync([("a", moment), ("b", moment), ("c", moment)]) == 0
    later = moment + dt.timedelta(seconds=1)
    assert sync([("a", later), ("b", moment), ("c", moment)]) == 1
    assert dataset.read("t").count() == 3


def test_a_row_cap_goes_on_where_it_stopped(spark, dataset):
    spec = SyncSpec("t", lambda: sequence(spark, 5, 3, 1, 4, 2), primary_key="seq", cursor="seq")
    found = []
    for _ in range(4):
        run_sync(dataset, [spec], "p", limit=2)
        found.append(dataset.read("t").count())
    assert found == [2, 4, 5, 5]


def test_null_cursors_are_rejected(spark, dataset):
    rows = frame(spark, [(1, "a"), (None, "b")], SEQ)
    spec = SyncSpec("t", lambda: rows, cursor="seq", disposition="append")
    with pytest.raises(RejectedRows) as failure:
        run_sync(dataset, [spec], "p")
    assert (failure.value.failed_count, failure.value.total_count) == (1, 2)
    assert "the cursor is missing or null" in failure.value.samples[0]


def test_a_row_without_a_cursor_does_not_pass_for_its_key(spark, dataset):
    schema = "k string, seq long, items array<struct<x:long>>"
    rows = frame(spark, [("a", 1, [(1,), (2,)]), ("a", None, [(9,)]), ("b", 2, [])], schema)
    sync = SyncSpec("t", lambda: rows, primary_key="k", cursor="seq", on_reject="quarantine")
    done = run_sync(dataset, [sync], "p", load_id="l1")
    assert (done.tables["t"].total, done.tables["t"].failed) == (3, 1)
    assert sorted(r["x"] for r in dataset.read("t__items").collect()) == [1, 2]
    assert dataset.rejects("t", "l1").first()["k"] == "a"
    assert dataset.rejects("t__items", "l1").first()["x"] == 9
    assert dataset.state("p")["t"]["last"] == 2


def test_targets_and_dev_mode(spark, dataset, tmp_path):
    syncs = [
        SyncSpec(name, lambda: sequence(spark, 1, 2), primary_key="seq", cursor="seq")
        for name in ("a", "b")
    ]
    run_sync(dataset, syncs, "p", target="a")
    assert dataset.tables() == ["a"]
    run_sync(dataset, syncs, "p", dev_mode=True, load_id="dev-1")
    assert dataset.tables() == ["a"]
    assert Dataset(spark, str(tmp_path), "catalog_dev_1").tables() == ["a", "b"]
    with pytest.raises(LoadError, match="no sync"):
        run_sync(dataset, syncs, "p", target="zzz")


def test_a_sync_with_hook_and_hints(spark, dataset):
    rows = [
        ("n-7", "sea", 40, dt.datetime(2023, 3, 4, 5, 6, 7), '["harbour", "tide"]'),
        ("n-8", "land", 2, dt.datetime(2023, 3, 5), "not a list"),
        ("n-9", "sea", 0, dt.datetime(2023, 3, 6), None),
    ]
    schema = "station string, kind string, reports int, seen timestamp_ntz, tags string"
    from docharbor.operators.shape import decode_json_list

    spec = SyncSpec(
        "stations", lambda: frame(spark, rows, schema), primary_key="station", cursor="seen",
        initial_value=dt.datetime(2000, 1, 1), facet=["kind"], sort=["reports"],
        field_hints={"seen": {"type": "int64", "sort": True}, "tags": {"type": "string[]"}},
        hook=lambda df: decode_json_list(df, "tags"),
    )
    run_sync(dataset, [spec], "p")
    found = {r["station"]: (r["seen"], r["tags"]) for r in dataset.read("stations").collect()}
    assert found == {
        "n-7": (1677906367, ["harbour", "tide"]), "n-8": (1677974400, []), "n-9": (1678060800, [])
    }
    assert dataset.tables() == ["stations"]
    pinned = [f["name"] for f in dataset.layout("stations").fields["fields"]]
    assert sorted(pinned) == ["kind", "reports", "seen", "tags"]


def test_a_replayed_micro_batch_changes_nothing(spark, dataset, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    sequence(spark, 1, 2, 3).write.parquet(str(source))
    spec = LoadSpec("events")

    def drain(folder):
        stream = spark.readStream.schema(SEQ).parquet(str(source))
        writer = load_stream(stream, dataset, spec, name="s", checkpoint=folder)
        writer.trigger(availableNow=True).start().awaitTermination()

    drain(checkpoint)
    sequence(spark, 4, 5).write.mode("append").parquet(str(source))
    drain(checkpoint)
    assert dataset.read("events").count() == 5
    # Another checkpoint is another stream: its batch 0 is no repeat, and no row of it is lost.
    drain(str(tmp_path / "other"))
    assert dataset.read("events").count() == 10
    drain(str(tmp_path / "other"))
    assert dataset.read("events").count() == 10


def test_file_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,label\n1,x\n2,y\n3,z\n")
    found = files.read_csv(spark, str(tmp_path / "a.csv"), "id string, label string")
    assert found.count() == 3
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"id":"1","label":"x"}\n\n   \n{"id":"2"}\n{"broken\n[1]\n', encoding="utf-8")
    rows = files.read_load_files(spark, str(lines), "id string, label string")
    good = quality.valid_rows(rows).collect()
    assert sorted(tuple(r) for r in good) == [("1", "x"), ("2", None)]
    bad = quality.rejected_rows(rows).collect()
    assert {r["_errors"][0]["sample"] for r in bad} == {'{"broken', "[1]"}
    assert files.read_json(spark, str(lines), "id string").filter("id is not null").count() == 2


def test_bad_lines_are_rejects_of_their_load(spark, dataset, tmp_path):
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"k":"1","items":[{"x":1}]}\nnot json\n{"k":2}\n{"items":[]}\n')
    rows = files.read_load_files(spark, str(lines), "k string, items array<struct<x:long>>")
    for disposition in ("append", "merge"):
        spec = LoadSpec(f"t_{disposition}", disposition, primary_key="k")
        with pytest.raises(RejectedRows) as failure:
            run_load(dataset, [(spec, rows)])
        expected = 2 if disposition == "merge" else 1
        assert (failure.value.failed_count, failure.value.total_count) == (expected, 4)
        assert any("not json" in s for s in failure.value.samples)
    spec = LoadSpec("t", "merge", primary_key="k", on_reject="quarantine")
    run_load(dataset, [(spec, rows)])
    assert sorted(r["k"] for r in dataset.read("t").collect()) == ["1", "2"]
    assert dataset.read("t__items").count() == 1 and dataset.tables() == ["t", "t__items"]


@pytest.mark.parametrize("action", ["upsert", "emplace"])
def test_objects_may_gain_and_lose_fields(spark, dataset, action):
    spec = LoadSpec(
        "t", "merge", primary_key="k", action=action, field_hints={"o": {"type": "object"}}
    )
    batches = [
        ([("a", (1, "x")), ("b", (2, "y"))], "k string, o struct<n:long,s:string>"),
        ([("b", (3, True)), ("c", (4, False))], "k string, o struct<n:long,f:boolean>"),
        ([("c", ("z",))], "k string, o struct<s:string>"),
    ]
    for rows, schema in batches:
        run_load(dataset, [(spec, frame(spark, rows, schema))])
    found = {r["k"]: (r["o"]["n"], r["o"]["s"], r["o"]["f"]) for r in dataset.read("t").collect()}
    assert found == {"a": (1, "x", None), "b": (3, None, True), "c": (None, "z", None)}


def test_parquet_types_reach_the_table(spark, dataset, tmp_path):
    path = str(tmp_path / "p")
    spark.sql(
        "select cast(1 as bigint) n, 0.5d ratio, timestamp'2024-05-06 07:08:09' ts,"
        " cast(10.25 as decimal(18,2)) amount"
    ).write.parquet(path)
    batch = files.read_parquet(spark, path, with_origin=True)
    run_load(dataset, [(LoadSpec("t", origin=files.ORIGIN), batch)])
    row = dataset.read("t").first()
    assert (row["n"], row["ratio"], row["ts"], row["amount"]) == (1, 0.5, "2024-05-06T07:08:09Z", "10.25")
    assert not [c for c in dataset.read("t").columns if c.startswith("_origin")]


def test_pages(spark, tmp_path):
    first = {"items": [{"id": i, "updated_at": i, "name": f"n{i}"} for i in range(3)], "paging": {"next": "/2"}}
    last = {"items": [{"id": 3, "updated_at": 3, "name": "n3"}], "paging": {}}
    for i, page in enumerate([first, last, {"items": []}, {}]):
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    found = pages.read_pages(spark, str(tmp_path), "struct<id:bigint,updated_at:bigint,name:string>")
    assert sorted(r["id"] for r in quality.valid_rows(found).collect()) == [0, 1, 2, 3]
    # A page without the list is no empty page.
    assert [r["_errors"][0]["sample"] for r in quality.rejected_rows(found).collect()] == ["{}"]


def test_jdbc_options():
    split = jdbc.SplitRange("id", 0, 1000, 16)
    options = jdbc.jdbc_options("jdbc:x", "t", split, user="u")
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "1000", "user": "u", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "16",
    }
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "t")


@pytest.mark.parametrize("few_seen", [True, False])
@pytest.mark.parametrize("key", [("payload",), ()])
def test_delta_filters_reach_the_scan(spark, tmp_path, few_seen, key):
    path = str(tmp_path / "s")
    rows = [(i // 3, f"row-{i}") for i in range(30)] + [(None, "none")]
    frame(spark, rows, SEQ).write.parquet(path)
    df = spark.read.parquet(path)
    seen = incremental.boundary_keys(df.filter("payload <> 'row-16'"), "seq", 5, key)
    found = incremental.delta(df, "seq", 5, key=key, seen=seen, few_seen=few_seen)
    assert sorted(int(r["payload"][4:]) for r in found.collect()) == [16, *range(18, 30)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    wanted = ["GreaterThanOrEqual(seq,5)"] if few_seen else ["GreaterThan(seq,5)", "EqualTo(seq,5)"]
    assert all(w in plan for w in wanted)


def test_variant_fields_from_load_files(spark, dataset, tmp_path):
    lines = tmp_path / "v.jsonl"
    lines.write_text('{"rid":1,"val":10}\n{"rid":2,"val":"ten"}\n{"rid":3}\n')
    rows = files.read_variant_files(spark, str(lines), ["rid", "val"])
    rows = rows.withColumn("rid", F.try_variant_get("rid", "$", "bigint"))
    spec = LoadSpec("rows", "merge", primary_key="rid", order_by="rid")
    for _ in range(2):
        run_load(dataset, [(spec, rows)])
    found = {r["rid"]: (r["val"], r["val__v_text"]) for r in dataset.read("rows").collect()}
    assert found == {1: (10, None), 2: (None, "ten"), 3: (None, None)}


def test_values_round_trip(spark, dataset):
    tricky = "Zażółć 'gęślą' \\ \"jaźń\"\r\n\tκόσμε 🚢 海港\u2028"
    rows = [
        ("r1", tricky, "x" * 20000, 2**63 - 1, 9.99, True, None, ""),
        ("r2", "", "y", -(2**63 - 1), -0.5, False, "value", ""),
    ]
    schema = "rid string, text string, long string, big long, ratio double, flag boolean, maybe string, empty string"
    for spec in (LoadSpec("appended"), LoadSpec("merged", "merge", primary_key="rid")):
        run_load(dataset, [(spec, frame(spark, rows, schema))])
        names = [n.split()[0] for n in schema.split(", ")]
        assert sorted(tuple(r) for r in dataset.read(spec.name).select(*names).collect()) == rows


def test_numbers_of_any_size_keep_their_text(spark, dataset):
    df = spark.sql(
        "select 'a' k, cast('123456789.123456789' as decimal(38,9)) d, cast(1208925819614629174706176 as decimal(38,0)) wei,"
        " cast('00:01:02' as string) t, cast('abc' as binary) b"
    )
    run_load(dataset, [(LoadSpec("n", "merge", primary_key="k"), df)])
    row = dataset.read("n").first()
    assert (row["d"], row["wei"], row["t"], row["b"]) == (
        "123456789.123456789", str(2**80), "00:01:02", "YWJj"
    )


def test_typed_hints_reach_the_table(spark, dataset):
    rows = [
        ("a", dt.datetime(2001, 9, 9, 1, 46, 40), "7.25"), ("b", dt.datetime(2033, 5, 18), "1E+3"),
    ]
    spec = LoadSpec(
        "typed", "merge", primary_key="k", data_types={"amount": "decimal"},
        field_hints={"at": {"type": "int64"}, "amount": {"type": "float"}},
    )
    run_load(dataset, [(spec, frame(spark, rows, "k string, at timestamp_ntz, amount string"))])
    table = dataset.read("typed")
    assert {r["k"]: (r["at"], r["amount"]) for r in table.collect()} == {
        "a": (1000000000, 7.25), "b": (1999987200, 1000.0)
    }
    from docharbor.operators import reads

    assert [r["k"] for r in reads.where_range(table, "at", above=10**9).collect()] == ["b"]
    assert [r["k"] for r in reads.sorted_by(table, "at").collect()] == ["b", "a"]


def test_objects_stay_nested_when_hinted(spark, dataset):
    df = frame(spark, [("A1", ("red", "M"))], "sku string, attrs struct<color:string,size:string>")
    run_load(dataset, [(LoadSpec("kept", field_hints={"attrs": {"type": "object"}}), df)])
    assert dataset.read("kept").first()["attrs"]["color"] == "red"
    run_load(dataset, [(LoadSpec("flat"), df)])
    assert dataset.read("flat").first()["attrs__color"] == "red"


def test_variants_stay_native_and_hints_are_metadata(spark, dataset):
    df = spark.createDataFrame([("a", '{"x":null,"y":[1]}')], "k string, t string").select(
        "k", F.parse_json("t").alias("attrs")
    )
    spec = LoadSpec(
        "t", "merge", primary_key="k",
        field_hints={"attrs": {"type": "object"}, "k": {"facet": True, "locale": "el"}},
    )
    for _ in range(2):
        run_load(dataset, [(spec, df)])
    table = dataset.read("t")
    assert table.select(F.to_json("attrs")).first()[0] == '{"x":null,"y":[1]}'
    assert table.schema["k"].metadata["hint"] == {
        "name": "k", "type": "string", "optional": True, "facet": True, "locale": "el"
    }


def test_a_used_load_id_deletes_nothing(spark, dataset):
    spec = LoadSpec("rows", "merge", primary_key="n", buckets=8)
    run_load(dataset, [(spec, spark.range(200).toDF("n"))], "first")
    assert dataset.delete_where("rows", F.col("n") == 7, load_id="second") == 1
    with pytest.raises(ConfigError):
        dataset.delete_where("rows", F.col("n") == 9, load_id="second")
    with pytest.raises(ConfigError):
        dataset.delete_where("rows", F.col("n") == 9, load_id="first")
    assert dataset.read("rows").count() == 199
    # One bucket was written anew, the others keep their files.
    parts = dataset.layout("rows").parts
    assert sorted(len(p.buckets) for p in parts) == [1, 7]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "decimal(20,6)", "date"])
def test_cursors_hold_in_any_time_zone(spark, dataset, tmp_path, monkeypatch, zone, kind):
    made = {"timestamp": "timestamp_micros(1700000000000000 + id * 1000000)", "date": "date_add(date'2024-01-01', int(id))"}
    value = made.get(kind, f"cast(cast(id as decimal(20,6)) + 0.000001 as {kind})" if "dec" in kind else "timestamp_ntz'2024-03-10 01:59:59' + make_interval(0, 0, 0, 0, 0, 0, id)")
    sync = lambda n: SyncSpec("t", lambda: spark.range(n).selectExpr("id", f"{value} c"), primary_key="id", cursor="c")
    run_sync(dataset, [sync(8)], "p", load_id="a")
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        second = run_sync(dataset, [sync(12)], "p", load_id="b")
    finally:
        monkeypatch.undo()
        time.tzset()
    assert dataset.read("t").count() == 12
    assert second.tables["t"].total == 4
