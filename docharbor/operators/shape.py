"""Row shaping: nested lists to child tables, documents, variants, hooks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.errors import SchemaError
from docharbor.functions import ids
from docharbor.functions.convert import (
    KEEP_NULLS,
    converter_kind,
    sample_text,
    to_epoch,
    to_number,
    to_pinned,
    wire_value,
)
from docharbor.functions.names import (
    ID,
    LIST_IDX,
    LOAD_ID,
    NEST,
    PARENT_ID,
    ROOT_ID,
    ROW_ID,
    SYSTEM_COLUMNS,
)
from docharbor.spec import LoadSpec

ERRORS = "_errors"
ERROR_TYPE = "array<struct<column:string,reason:string,sample:string>>"

# Name suffix of the column that takes values of another type.
VARIANT_SUFFIX = {
    "STRING": "text",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "bool",
    "JSON": "json",
}
VARIANT_TYPES = {"STRING": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


def flatten(df: DataFrame, inline: frozenset[str] = frozenset()) -> DataFrame:
    """Turn struct columns that are not kept inline into ``a__b`` columns, at any depth."""
    while True:
        nested = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.StructType) and f.name not in inline
        ]
        if not nested:
            return df
        columns: list[Column] = []
        for f in df.schema.fields:
            if f.name in nested:
                columns += [
                    F.col(f"`{f.name}`.`{c}`").alias(f"{f.name}{NEST}{c}")
                    for c in f.dataType.names
                ]
            else:
                columns.append(F.col(f"`{f.name}`"))
        _refuse_repeated("columns", df.select(*columns).columns)
        df = df.select(*columns)


def _refuse_repeated(label: str, names: list[str]) -> None:
    repeated = sorted(n for n, count in Counter(names).items() if count > 1)
    if repeated:
        raise SchemaError(f"several {label} would be named {repeated} once nested fields are taken apart")


def list_columns(df: DataFrame, inline: frozenset[str] = frozenset()) -> list[str]:
    """Array columns that become child tables."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and f.name not in inline and f.name != ERRORS
    ]


def explode_child(rows: DataFrame, column: str, table: str, is_root: bool) -> DataFrame:
    """Child rows of one list column, linked to parent and root by row ids."""
    root = F.col(ROW_ID) if is_root else F.col(ROOT_ID)
    items = rows.select(
        F.col(ROW_ID).alias(PARENT_ID),
        root.alias(ROOT_ID),
        *([F.col(LOAD_ID)] if LOAD_ID in rows.columns else []),
        F.posexplode(F.col(f"`{column}`")).alias(LIST_IDX, "_item"),
    )
    element = rows.schema[column].dataType.elementType
    kept = [c for c in items.columns if c != "_item"]
    if isinstance(element, T.StructType):
        # A null element is an empty object, so it still makes a row.
        values = [F.col(f"_item.`{f}`").alias(f) for f in element.names]
    else:
        values = [F.col("_item").alias("value")]
    return items.select(
        ids.child_row_id(F.col(PARENT_ID), table, F.col(LIST_IDX)).alias(ROW_ID),
        *[F.col(c) for c in kept],
        *values,
    )


def nest_chain(
    rows: DataFrame, table: str, inline: frozenset[str] = frozenset()
) -> dict[str, DataFrame]:
    """Split rows with nested lists into a chain of flat tables, the root table first.

    ``rows`` needs row ids. A list gives one child table per level; an empty or missing
    list gives no rows.
    """
    chain: dict[str, DataFrame] = {}

    def add(level: DataFrame, name: str, is_root: bool, keep: frozenset[str]) -> None:
        flat = flatten(level, keep)
        lists = list_columns(flat, keep)
        chain[name] = flat.drop(*lists)
        for column in lists:
            child = f"{name}{NEST}{column}"
            add(explode_child(flat, column, child, is_root), child, False, frozenset())

    add(rows, table, True, inline)
    return chain


def child_tables(schema: T.StructType, table: str, inline: frozenset[str] = frozenset()) -> list[str]:
    """Names of the child tables a schema gives, from the schema alone."""
    names: list[str] = []

    def walk(fields: T.StructType, name: str, prefix: str, keep: frozenset[str]) -> None:
        for f in fields.fields:
            column = f"{prefix}{f.name}"
            if column in keep or column == ERRORS:
                continue
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, name, f"{column}{NEST}", keep)
            elif isinstance(f.dataType, T.ArrayType):
                child = f"{name}{NEST}{column}"
                names.append(child)
                element = f.dataType.elementType
                if isinstance(element, T.StructType):
                    walk(element, child, "", frozenset())
                elif isinstance(element, T.ArrayType):
                    walk(T.StructType([T.StructField("value", element)]), child, "", frozenset())

    walk(schema, table, "", inline)
    _refuse_repeated("child tables", names)
    return names


def error(column: str, reason: Column, sample: Column) -> Column:
    """One reject reason, or null where there is none."""
    return F.when(
        reason.isNotNull(),
        F.struct(
            F.lit(column).alias("column"),
            reason.alias("reason"),
            sample.cast("string").alias("sample"),
        ),
    )


def to_documents(
    rows: DataFrame,
    spec: LoadSpec,
    *,
    collection: str,
    fields: Mapping[str, Any],
    is_root: bool = True,
) -> DataFrame:
    """Rows to documents: the managed id, converted values and the reject reasons.

    The id is made of the source values, before any conversion. A child table takes no
    hints, which belong to the columns of the root table. Rows that a source marked as
    rejects stay so, with the reason the source gave.
    """
    key = spec.key if is_root else ()
    pinned = _pinned(fields) if is_root else {}
    staged = _converted(rows, spec, pinned)
    doc_id = ids.merge_id(rows, collection, key) if key else F.col(ROW_ID)
    columns: list[Column] = [doc_id.alias(ID)]
    for f in rows.schema.fields:
        column = F.col(f"`{f.name}`")
        if f.name == ERRORS:
            continue
        if f.name in SYSTEM_COLUMNS:
            columns.append(column)
        elif f.name in pinned:
            columns.append(F.col(f"`_pair_{f.name}`")["value"].alias(f.name))
        else:
            declared = spec.data_types.get(f.name) if is_root else None
            stored = column if declared not in (None, "json") else wire_value(column, f.dataType)
            columns.append(stored.alias(f.name))
    return staged.select(*columns, _reasons(rows, pinned, key))


def checked(rows: DataFrame, spec: LoadSpec, fields: Mapping[str, Any]) -> DataFrame:
    """Root rows as they are, those that :func:`to_documents` will reject marked with the reasons."""
    pinned = _pinned(fields)
    kept = [F.col(f"`{c}`") for c in rows.columns if c != ERRORS]
    return _converted(rows, spec, pinned).select(*kept, _reasons(rows, pinned, spec.key))


def _pinned(fields: Mapping[str, Any]) -> dict[str, Any]:
    return {f["name"]: f for f in fields["fields"]}


def _converted(rows: DataFrame, spec: LoadSpec, pinned: Mapping[str, Any]) -> DataFrame:
    """The rows and each conversion as one struct, so that no later use works it out again."""
    pairs = {
        f"_pair_{f.name}": _convert(F.col(f"`{f.name}`"), f.dataType, spec, f.name, pinned[f.name])
        for f in rows.schema.fields
        if f.name in pinned and f.name not in SYSTEM_COLUMNS
    }
    return rows.select("*", *[pair.alias(name) for name, pair in pairs.items()])


def _reasons(rows: DataFrame, pinned: Mapping[str, Any], key: tuple[str, ...]) -> Column:
    """Why a row of :func:`_converted` is rejected, null if it isn't."""
    missing = F.lit("key column is missing or null")
    problems = [(k, F.when(F.col(f"`{k}`").isNull(), missing), F.lit(None)) for k in key]
    for f in rows.schema.fields:
        if f.name in pinned and f.name not in SYSTEM_COLUMNS and f.name != ERRORS:
            reason = F.col(f"`_pair_{f.name}`")["reason"]
            problems += _problems(F.col(f"`{f.name}`"), f.dataType, f.name, pinned[f.name], reason)
    problems += [
        (name, F.lit("required field is missing"), F.lit(None))
        for name, hint in pinned.items()
        if name not in rows.columns and hint["optional"] is False
    ]
    errors = F.lit(None)
    if problems:
        found = F.array_compact(F.array(*[error(*p) for p in problems]))
        errors = F.when(F.coalesce(*[reason for _, reason, _ in problems]).isNotNull(), found)
    if ERRORS in rows.columns:
        errors = F.coalesce(F.col(ERRORS), errors)
    return errors.cast(ERROR_TYPE).alias(ERRORS)


def _convert(
    column: Column, spark_type: T.DataType, spec: LoadSpec, name: str, hint: Mapping[str, Any]
) -> Column:
    kind = converter_kind(spec.data_type(name, spark_type), hint["type"], name)
    if kind == "epoch":
        return to_epoch(column, spark_type, hint["type"]).pair()
    if kind == "number":
        return to_number(column, spark_type, hint["type"]).pair()
    return to_pinned(column, spark_type, hint["type"]).pair()


def _problems(
    column: Column, spark_type: T.DataType, name: str, hint: Mapping[str, Any], reason: Column
) -> list[tuple[str, Column, Column]]:
    """Reasons to reject a pinned value, each with a sample of it."""
    sample = sample_text(column, spark_type)
    problems = [(name, reason, sample)]
    if "num_dim" in hint and isinstance(spark_type, T.ArrayType):
        length = F.lit(f"vector must have {hint['num_dim']} values")
        problems.append((name, F.when(F.size(column) != hint["num_dim"], length), sample))
    if hint["type"] == "geopoint" and isinstance(spark_type, T.ArrayType):
        pair = F.lit("a geopoint has two coordinates")
        problems.append((name, F.when(F.size(column) != 2, pair), sample))
    if hint["optional"] is False:
        absent = F.lit("required field is missing")
        problems.append((name, F.when(column.isNull(), absent), F.lit(None)))
    return problems


def stringify(df: DataFrame, *columns: str) -> DataFrame:
    """Nested values as JSON text."""
    return df.withColumns({c: F.to_json(F.col(f"`{c}`"), KEEP_NULLS) for c in columns})


def json_document(df: DataFrame) -> Column:
    """The whole row as a JSON document; absent top-level fields are left out."""
    # Nulls within a field are part of its value; only fields that are null themselves are left out.
    fields = [
        F.when(
            F.col(f"`{c}`").isNotNull(),
            F.regexp_replace(
                F.to_json(F.struct(F.col(f"`{c}`").alias(c)), KEEP_NULLS), r"(?s)^\{(.*)\}$", "$1"
            ),
        )
        for c in df.columns
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def variant_kind(value: Column) -> Column:
    """Type family of a VARIANT value; null for an absent or JSON null value."""
    name = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (name == "VOID"), F.lit(None).cast("string"))
        .when(name.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.lit("DOUBLE"))
        .when(name.rlike("^(OBJECT|ARRAY)"), F.lit("JSON"))
        .otherwise(name)
    )


def primary_kind(df: DataFrame, column: str, seq: str) -> str | None:
    """Type family of the first non-null value by sequence; one small row is collected."""
    kinds = df.select(variant_kind(F.col(f"`{column}`")).alias("kind"), F.col(f"`{seq}`"))
    found = kinds.filter("kind IS NOT NULL").agg(F.min_by("kind", seq)).first()
    return found[0] if found else None


def split_variant(df: DataFrame, column: str, primary: str) -> DataFrame:
    """Values of the primary type stay; those of other types go to ``column__v_type``.

    An integer fits a floating point column and stays there.
    """
    value = F.col(f"`{column}`")
    kind = variant_kind(value)

    def typed(family: str) -> Column:
        if family == "JSON":
            return F.to_json(value)
        return F.try_variant_get(value, "$", VARIANT_TYPES[family])

    holds = kind.isin("DOUBLE", "BIGINT") if primary == "DOUBLE" else kind == primary
    others = {
        f"{column}{NEST}v_{suffix}": F.when(kind == family, typed(family))
        for family, suffix in VARIANT_SUFFIX.items()
        if family != primary and not (primary == "DOUBLE" and family == "BIGINT")
    }
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    split = {column: F.when(holds, typed(primary)), **others}
    return df.select(*kept, *[c.alias(n) for n, c in split.items()])


def _widens(source: T.DataType, target: T.DataType) -> bool:
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if type(source) in order and type(target) in order:
        return order.index(type(source)) <= order.index(type(target))
    if isinstance(target, T.DoubleType):
        return isinstance(source, T.FloatType) or type(source) in order
    return isinstance(source, T.NullType)


def merged_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """A type that holds objects of both, where one has fields the other lacks."""
    if old == new:
        return old
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        element = merged_type(old.elementType, new.elementType)
        return T.ArrayType(element) if element is not None else None
    if not (isinstance(old, T.StructType) and isinstance(new, T.StructType)):
        return None
    fields = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        merged = merged_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
        if merged is None:
            return None
        fields[f.name] = merged
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def reconcile(batch: DataFrame, stored: T.StructType) -> DataFrame:
    """Fit a batch to a stored schema: widen losslessly, else use a variant column."""
    known = {f.name: f.dataType for f in stored.fields}
    columns: list[Column] = []
    for f in batch.schema.fields:
        column = F.col(f"`{f.name}`")
        target = known.get(f.name)
        if target is None or target == f.dataType or f.name in (*SYSTEM_COLUMNS, ID, ERRORS):
            columns.append(column)
        elif merged_type(target, f.dataType) is not None:
            columns.append(column)
        elif _widens(f.dataType, target):
            columns.append(column.cast(target).alias(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            columns.append(F.to_json(column, KEEP_NULLS).alias(f"{f.name}{NEST}v_json"))
        else:
            suffix = VARIANT_SUFFIX.get(_family(f.dataType), "text")
            columns.append(column.alias(f"{f.name}{NEST}v_{suffix}"))
    return batch.select(*columns)


def _family(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "BIGINT"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "DOUBLE"
    return "BOOLEAN" if isinstance(data_type, T.BooleanType) else "STRING"


def decode_json_list(df: DataFrame, column: str, element: str = "string") -> DataFrame:
    """A JSON list held as text; anything else becomes an empty list."""
    decoded = F.from_json(F.col(f"`{column}`"), f"array<{element}>")
    return df.withColumn(column, F.coalesce(decoded, F.array().cast(f"array<{element}>")))


def with_default(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Fill a missing field, whether the column is absent or the value is null."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(value))
    return df.withColumn(column, F.coalesce(F.col(f"`{column}`"), F.lit(value)))
