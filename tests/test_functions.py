"""Names, ids and conversions against values worked out in plain Python."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docharbor.errors import ConfigError, SchemaError
from docharbor.functions import convert, ids
from docharbor.functions.names import column_name, name_map, normalise_names, qualified_name


def python_id(collection, *key):
    name = f"{collection}:{json.dumps([str(k) for k in key])}"
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


@pytest.mark.parametrize(
    ("source", "stored"),
    [
        ("id", "__id"), ("Id", "__id"), ("ID", "__id"), ("userName", "user_name"),
        ("HTTPStatus", "http_status"), ("a b", "a_b"), ("already_snake", "already_snake"),
        ("2nd", "_2nd"), ("_row_id", "_row_id"), ("a__b", "a__b"),
    ],
)
def test_column_names(source, stored):
    assert column_name(source) == stored
    assert column_name(stored) == stored


def test_colliding_names_are_refused(spark):
    with pytest.raises(SchemaError, match="collide"):
        name_map(["id", "__id"])
    nested = spark.createDataFrame([((1,), [(2,)])], "Outer struct<Id:long>, L array<struct<userName:long>>")
    assert normalise_names(nested).schema.simpleString() == (
        "struct<outer:struct<__id:bigint>,l:array<struct<user_name:bigint>>>"
    )
    inline = normalise_names(nested, ["outer"])
    assert inline.schema["outer"].dataType.names == ["Id"]


def test_qualified_names():
    assert qualified_name("catalog", "products") == "catalog_products"
    assert qualified_name("catalog", "products", "__") == "catalog__products"
    assert qualified_name("", "products") == "products"
    long_name = qualified_name("d" * 200, "t" * 200)
    assert len(long_name) == 255 and long_name == qualified_name("d" * 200, "t" * 200)
    assert long_name[:238] == ("d" * 200 + "_" + "t" * 200)[:238] and long_name[238] == "_"


def test_golden_merge_ids(spark):
    one = spark.createDataFrame([("A1",)], "sku string")
    assert one.select(ids.merge_id(one, "catalog_products", ["sku"])).first()[0] == (
        "d93899e3-6e93-57c0-94a1-d6905be62c70"
    )
    two = spark.createDataFrame([("a_b", "c"), ("a", "b_c")], "x string, y string")
    found = [r[0] for r in two.select(ids.merge_id(two, "c", ["x", "y"])).collect()]
    assert found[0] == "7d62c874-ddc4-5b1a-b523-ec3f2bef90fb" and found[0] != found[1]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=1, max_size=40))
def test_text_keys_are_encoded_as_json(spark, texts):
    tricky = ["", 'q"uote', "back\\slash", "\n\r\t\b\f", "\x00\x1f\x7f", "é日本😀", " "]
    rows = spark.createDataFrame([(t,) for t in [*texts, *tricky]], "k string")
    found = rows.select("k", ids.merge_id(rows, "c", ["k"]).alias("id")).collect()
    assert [r["id"] for r in found] == [python_id("c", r["k"]) for r in found]


def test_keys_of_other_types(spark):
    rows = spark.createDataFrame(
        [(True, 7, decimal.Decimal("10.50")), (False, -1, decimal.Decimal("0.00"))],
        "b boolean, n long, d decimal(10,2)",
    )
    found = rows.select("*", ids.merge_id(rows, "c", ["b", "n", "d"]).alias("id")).collect()
    assert [r["id"] for r in found] == [python_id("c", r["b"], r["n"], r["d"]) for r in found]
    with pytest.raises(ConfigError, match="floating point"):
        ids.merge_id(spark.createDataFrame([(1.0,)], "x double"), "c", ["x"])
    null = spark.createDataFrame([(None, "a")], "x string, y string")
    assert null.select(ids.merge_id(null, "c", ["x", "y"])).first()[0] is None


def test_content_ids_keep_identical_rows_apart(spark):
    rows = spark.createDataFrame([("a",)] * 500 + [("b",)], "v string").repartition(4)
    found = ids.with_content_row_id(rows, "c", "l1")
    assert found.select(ids.ROW_ID).distinct().count() == 501
    parted = ids.with_content_row_id(rows.repartition(7), "c", "l1")
    assert parted.join(found, [ids.ROW_ID, "v"], "left_semi").count() == 501
    other = ids.with_content_row_id(rows, "c", "l2")
    assert other.join(found, ids.ROW_ID, "left_semi").count() == 0


def test_a_row_that_is_repeated_very_often_is_spread(spark, monkeypatch):
    monkeypatch.setattr(ids, "COPIES", 100)
    rows = spark.createDataFrame([("a", 1)] * 3000 + [("b", 2)] * 7 + [("c", 3)], "v string, n int").repartition(4)
    found = ids.with_content_row_id(rows, "c", "l1")
    assert found.columns == ["v", "n", ids.ROW_ID]
    tasks = {r[0]: r[1] for r in found.where("v = 'a'").groupBy(F.spark_partition_id()).count().collect()}
    assert sum(tasks.values()) == 3000 and len(tasks) == 3 and max(tasks.values()) < 1700
    digest = hashlib.sha256(b'{"v":"a","n":1}').hexdigest()
    wanted = {hashlib.sha256("\u0001".join(["c", "l1", digest, str(i)]).encode()).hexdigest()[:32] for i in range(1, 3001)}
    assert {r[0] for r in found.where("v = 'a'").select(ids.ROW_ID).collect()} == wanted


def test_content_ids_of_every_type(spark):
    """Signs of zeros, nulls, maps, variants and floats in lists tell rows apart and stay as they are."""
    rows = spark.sql(
        """select * from values
           (0.0D, array(1.5D), map('k', 1), parse_json('{"a": 1}'), 'x'),
           (-0.0D, array(1.5D), map('k', 1), parse_json('{"a": 1}'), 'x'),
           (0.0D, array(-0.0D), map('k', 2), parse_json('[1]'), 'x'),
           (0.0D, array(0.0D), map('k', 2), parse_json('[1]'), 'x'),
           (double('NaN'), null, null, null, null),
           (null, null, null, null, null) as t(d, l, m, v, `s.t`)"""
    )
    found = ids.with_content_row_id(rows.unionByName(rows), "c", "l1")
    text = F.to_json(F.struct("d", "l", "m", F.to_json("v").alias("v"), "`s.t`"))
    assert found.select(ids.ROW_ID).distinct().count() == 12
    kept = sorted(r[0] for r in found.select(text).collect())
    assert kept == sorted(r[0] for r in rows.unionByName(rows).select(text).collect())
    assert sum('"d":-0.0' in k for k in kept) == 2


def converted(spark, values, schema, function, *args):
    rows = spark.createDataFrame([(v,) for v in values], f"v {schema}")
    result = function(F.col("v"), rows.schema["v"].dataType, *args)
    return [tuple(r) for r in rows.select(result.value, result.reason).collect()]


def test_epochs(spark):
    texts = {
        "2020-01-01T00:00:00Z": 1577836800,
        "2020-01-01T01:00:00+01:00": 1577836800,
        "2020-01-01": 1577836800,
        "2020-01-01T12:00:00": 1577880000,
        "2020-01-01T00:00:00.999999Z": 1577836800,
        "20200101": 1577836800,
        "20200101T120000Z": 1577880000,
        "not-a-date": None,
        "12:30": None,
        "": None,
    }
    found = converted(spark, list(texts), "string", convert.to_epoch, "int64")
    assert [v for v, _ in found] == list(texts.values())
    assert [r is None for _, r in found] == [v is not None for v in texts.values()]
    assert converted(spark, [None], "string", convert.to_epoch, "int64") == [(None, None)]
    moments = [dt.datetime(2020, 1, 1, 12), dt.datetime(1969, 12, 31, 23, 59, 59)]
    assert converted(spark, moments, "timestamp_ntz", convert.to_epoch, "int64") == [
        (1577880000, None), (-1, None)
    ]
    assert converted(spark, [dt.date(2020, 1, 1)], "date", convert.to_epoch, "int64") == [
        (1577836800, None)
    ]
    assert converted(spark, [5.9], "double", convert.to_epoch, "int64") == [(5, None)]
    assert converted(spark, [True], "boolean", convert.to_epoch, "int64")[0][1]


def test_epochs_in_32_bits(spark):
    texts = ["2038-01-19T03:14:07Z", "2038-01-19T03:14:08Z", "2040-01-01T00:00:00Z"]
    found = converted(spark, texts, "string", convert.to_epoch, "int32")
    assert found[0] == (2147483647, None)
    assert all(v is None and "int32" in r for v, r in found[1:])


def test_temporal_as_float_is_refused_at_plan_time():
    with pytest.raises(SchemaError, match="float"):
        convert.converter_kind("timestamp", "float", "ts")
    assert convert.converter_kind("text", "int64", "t") is None
    assert convert.converter_kind("bigint", "int64", "n") is None


WHOLE = {
    "42": 42, "1E+2": 100, "-0": 0, "0e5": 0, "100E-2": 1, "1.50e1": 15, " 7 ": 7, "1_000": 1000,
    "9223372036854775807": 2**63 - 1, "-9223372036854775808": -(2**63), "00012": 12, ".0": 0,
    "19.50": None, "1.0000000001": None, "1e-20": None, "NaN": None, "Infinity": None,
    "-Infinity": None, "9223372036854775808": None, "1E+999999999": None, "x": None, "": None,
    "1e": None, ".": None,
}


def test_exact_integers(spark):
    found = converted(spark, list(WHOLE), "string", convert.to_number, "int64")
    assert dict(zip(WHOLE, [v for v, _ in found], strict=True)) == WHOLE
    assert [r is None for _, r in found] == [v is not None for v in WHOLE.values()]
    small = converted(spark, ["2147483647", "2147483648"], "string", convert.to_number, "int32")
    assert small[0] == (2147483647, None) and "int32" in small[1][1]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(allow_nan=False, allow_infinity=False), min_size=1, max_size=60))
def test_exact_integers_agree_with_python(spark, numbers):
    texts = [str(n) for n in numbers]
    found = converted(spark, texts, "string", convert.to_number, "int64")
    for text, (value, _) in zip(texts, found, strict=True):
        number = decimal.Decimal(text)
        whole = number.is_zero() or (number.adjusted() <= 18 and number == number.to_integral_value())
        fits = whole and -(2**63) <= int(number) < 2**63
        assert value == (int(number) if fits else None), text


def test_decimal_columns(spark):
    rows = [decimal.Decimal("19.50"), decimal.Decimal("42.00"), None]
    found = converted(spark, rows, "decimal(18,2)", convert.to_number, "int64")
    assert [v for v, _ in found] == [None, 42, None]
    assert [r is None for _, r in found] == [False, True, True]
    assert converted(spark, rows, "decimal(18,2)", convert.to_number, "float")[0] == (19.5, None)


def test_finite_floats(spark):
    texts = ["19.50", "1e3", "NaN", "Infinity", "-Infinity", "1e999", "1.0d", "x", None]
    found = converted(spark, texts, "string", convert.to_number, "float")
    assert [v for v, _ in found] == [19.5, 1000.0] + [None] * 7
    assert [r is None for _, r in found] == [True, True] + [False] * 6 + [True]


def test_wire_values(spark):
    row = spark.sql(
        "select timestamp_ntz'2024-05-06 07:08:09.000120' t, date'2024-05-06' d,"
        " cast('123456789.123456789' as decimal(38,9)) n, cast('abc' as binary) b,"
        " cast(3 as int) i, named_struct('a', 1) s, map('k', 2) m"
    )
    found = row.select(
        *[convert.wire_value(F.col(f.name), f.dataType).alias(f.name) for f in row.schema.fields]
    ).first()
    assert tuple(found) == (
        "2024-05-06T07:08:09.000120Z", "2024-05-06", "123456789.123456789", "YWJj", 3,
        '{"a":1}', '{"k":2}',
    )


def test_pinned_types(spark):
    assert converted(spark, ["5", "x", None], "string", convert.to_pinned, "int64") == [
        (5, None), (None, "does not fit the pinned type int64"), (None, None)
    ]
    assert converted(spark, [5.0, 5.5], "double", convert.to_pinned, "int64")[1][1]
    assert converted(spark, [["1", "x"]], "array<string>", convert.to_pinned, "int64[]")[0][1]
    assert converted(spark, [[1.5, None]], "array<float>", convert.to_pinned, "float[]") == [
        ([1.5, None], None)
    ]


def test_values_of_another_shape_are_reasons_not_plan_errors(spark):
    unfit = "does not fit the pinned type "
    assert converted(spark, ['["a"]', None], "string", convert.to_pinned, "string[]") == [
        (None, unfit + "string[]"), (None, None)
    ]
    assert converted(spark, [[1]], "array<long>", convert.to_pinned, "int64") == [
        (None, unfit + "int64")
    ]
    assert converted(spark, [b"1"], "binary", convert.to_pinned, "int32")[0][1]
    assert converted(spark, [dt.date(2020, 1, 1)], "date", convert.to_pinned, "bool")[0][1]


def test_every_type_is_mapped():
    assert len(convert.STORED_TYPES) == 11
    assert convert.stored_type("wei") == "string"
    assert convert.stored_type(None) == convert.stored_type("other") == "auto"
