"""Document and row ids as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.errors import ConfigError
from docharbor.functions.convert import iso_text
from docharbor.functions.names import ROW_ID

# Fixed value: the DNS namespace of RFC 4122, under which merge ids are made.
NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"

# Row ids keep 128 bits of the digest.
ROW_ID_CHARS = 32
SEPARATOR = "\u0001"


def key_text(column: Column, data_type: T.DataType, name: str = "key") -> Column:
    """A key value as the text it has on the wire."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        raise ConfigError(f"key column '{name}' is floating point; use a decimal, integer or text")
    if isinstance(data_type, T.BooleanType):
        return F.when(column, F.lit("True")).when(~column, F.lit("False"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return iso_text(column, data_type)
    if isinstance(data_type, T.BinaryType):
        return F.base64(column)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        raise ConfigError(f"key column '{name}' is nested; a key must be a scalar")
    return column.cast("string")


# The escapes that JSON has a letter for.
SHORT_ESCAPES = {
    '"': '\\"',
    "\\": "\\\\",
    "\n": "\\n",
    "\r": "\\r",
    "\t": "\\t",
    "\b": "\\b",
    "\f": "\\f",
}

# A run that needs no escape, a run that has none but numeric escapes, or one character.
RUNS = r"[ !#-\[\]-~]+|[^\x00-\x7e]+|(?s:.)"


def _escaped_run(run: Column) -> Column:
    """JSON escape of a run, with everything outside printable ASCII as \\uXXXX."""
    units = F.lower(F.hex(F.encode(run, "UTF-16BE")))
    numeric = F.regexp_replace(units, "(.{4})", r"\\u$1")
    escaped = F.when(run.rlike(r"^[ !#-\[\]-~]"), run)
    for char, escape in SHORT_ESCAPES.items():
        escaped = escaped.when(run == char, F.lit(escape))
    return escaped.otherwise(numeric)


def json_string(text: Column, plain: bool = False) -> Column:
    """The text as an ASCII JSON string literal; ``plain`` when it cannot need escapes."""
    quoted = F.concat(F.lit('"'), text, F.lit('"'))
    if plain:
        return quoted
    runs = F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))
    escaped = F.concat(F.lit('"'), F.array_join(F.transform(runs, _escaped_run), ""), F.lit('"'))
    # Most keys need no escape and skip the walk.
    return F.when(text.rlike(r'^[ !#-\[\]-~]*\z'), quoted).otherwise(escaped)


def key_json(df: DataFrame, key: Sequence[str]) -> Column:
    """The key as a JSON list of strings; null when any part is null."""
    parts: list[Column] = [F.lit("[")]
    for position, name in enumerate(key):
        data_type = df.schema[name].dataType
        plain = not isinstance(data_type, (T.StringType, T.VarcharType, T.CharType))
        if position:
            parts.append(F.lit(", "))
        parts.append(json_string(key_text(F.col(f"`{name}`"), data_type, name), plain))
    return F.concat(*parts, F.lit("]"))


def uuid5(name: Column) -> Column:
    """Version 5 UUID of the text under the fixed namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_HEX)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def merge_id(df: DataFrame, collection: str, key: Sequence[str]) -> Column:
    """Deterministic document id of a keyed row; null when a key part is null."""
    return uuid5(F.concat(F.lit(f"{collection}:"), key_json(df, key)))


def digest_id(*parts: Column) -> Column:
    """Short row id over text parts."""
    return F.substring(F.sha2(F.concat_ws(SEPARATOR, *parts), 256), 1, ROW_ID_CHARS)


def keyed_row_id(df: DataFrame, collection: str, key: Sequence[str]) -> Column:
    """Row id that depends on the key alone, so a reloaded row keeps it."""
    return digest_id(F.lit(collection), F.lit("key"), key_json(df, key))


def child_row_id(parent: Column, table: str, position: Column) -> Column:
    """Row id of a list element: its parent, its table and its place."""
    return digest_id(parent, F.lit(table), position.cast("string"))


def system_row_id(*parts: Column) -> Column:
    """Id of a system table row."""
    return F.sha1(F.concat_ws("|", *parts))


def origin_row_id(collection: str, load_id: str, origin: Sequence[str]) -> Column:
    """Row id from columns that name the row's place at its source; needs no shuffle."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0002")) for c in origin]
    return digest_id(F.lit(collection), F.lit(load_id), *texts)


def content_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The whole row as text, for rows that have no better name than their content."""
    names = list(columns or df.columns)
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]))


# Copies of one row that are written out together.
COPIES = 10_000


def _groups(kind: T.DataType) -> bool:
    """Whether grouping by the type keeps its values as they are, the sign of a zero included."""
    if isinstance(kind, T.ArrayType):
        return _groups(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_groups(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.FloatType, T.DoubleType, T.MapType, T.VariantType))


def _group_keys(column: Column, kind: T.DataType) -> list[Column]:
    """What two values share if they have one content."""
    if _groups(kind):
        return [column]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        below = F.when(column == 0, column.cast("string").startswith("-"))
        return [column, F.coalesce(below, F.lit(False))]
    return [F.to_json(F.struct(column))]


def with_content_row_id(df: DataFrame, collection: str, load_id: str) -> DataFrame:
    """Row ids from content plus a number among identical rows, the same for any partitioning.

    Identical rows are made one and counted by partial aggregates, so every content moves once and is
    digested once. A row that was counted very often is cut into ranges of ``COPIES`` numbers, and the
    ranges are dealt to all tasks before their rows are written out: no task holds all copies of a row.
    """
    columns = {f.name: F.col(f"`{f.name}`") for f in df.schema.fields}
    keys, others, values = [], [], []
    for i, f in enumerate(df.schema.fields):
        keys += [k.alias(f"_key_{i}_{j}") for j, k in enumerate(_group_keys(columns[f.name], f.dataType))]
        if _groups(f.dataType):
            values.append(F.col(f"_key_{i}_0").alias(f.name))
        else:
            others.append(F.first(columns[f.name]).alias(f.name))
            values.append(columns[f.name])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"), *others)
    counted = counted.select(*values, "_times")
    digest = F.sha2(content_json(counted, df.columns), 256).alias("_digest")
    counted = counted.select("*", digest)
    few = counted.filter(F.col("_times") <= COPIES)
    few = few.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
    many = counted.filter(F.col("_times") > COPIES)
    many = many.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), "_times", F.lit(COPIES).cast("long"))))
    # A fixed number of tasks: ranges are small, and would else be put together again.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("_times"), F.col("_from") + (COPIES - 1))
    many = many.repartition(tasks, "_digest", "_from").withColumn("_copy", F.explode(F.sequence("_from", last)))
    rows = few.unionByName(many.drop("_from"))
    row_id = digest_id(
        F.lit(collection), F.lit(load_id), F.col("_digest"), F.col("_copy").cast("string")
    )
    return rows.select(*columns.values(), row_id.alias(ROW_ID))
