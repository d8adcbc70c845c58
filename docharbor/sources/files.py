"""File sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.functions.names import name_map
from docharbor.operators.shape import ERROR_TYPE, ERRORS, error

# Columns that name a row's place in its file; see ``LoadSpec.origin``.
ORIGIN = ("_origin_file", "_origin_row")
CORRUPT = "_corrupt_record"


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header; the schema is given, so the files are read once.

    A line with a cell that does not fit its column, or with too few or too many cells, becomes a
    row without values that is marked as a reject with its text.
    """
    schema = _struct(schema)
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(marked).option("header", True).option("columnPruning", False)
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    bad = F.col(CORRUPT).isNotNull()
    problem = error("", F.when(bad, F.lit("the line does not fit the schema")), F.col(CORRUPT))
    return rows.select(
        *[F.when(~bad, F.col(f"`{n}`")).alias(n) for n in schema.names],
        F.when(bad, F.array(problem)).cast(ERROR_TYPE).alias(ERRORS),
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line; see :func:`read_load_files` for lines that are none."""
    return read_load_files(spark, path, schema)


def read_parquet(spark: SparkSession, path: str, with_origin: bool = False) -> DataFrame:
    """Parquet; ``with_origin`` adds the columns named in ``ORIGIN``."""
    rows = spark.read.parquet(path)
    if not with_origin:
        return rows
    return rows.select(
        *rows.columns,
        F.col("_metadata.file_path").alias(ORIGIN[0]),
        F.col("_metadata.row_index").alias(ORIGIN[1]),
    )


def read_load_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines files of a load, plain or compressed, without their blank lines.

    A line that is no object of the schema becomes a row without values that is marked as a
    reject with its text, so that a load counts it with the other rejects.
    """
    schema = _struct(schema)
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", marked, options).alias("row"))
    bad = F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()
    problem = error("", F.when(bad, F.lit("the line is no object of the schema")), F.col("value"))
    return parsed.select(
        *[F.when(~bad, F.col(f"row.`{n}`")).alias(n) for n in schema.names],
        F.when(bad, F.array(problem)).cast(ERROR_TYPE).alias(ERRORS),
    )


def read_variant_files(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """JSON lines with fields of mixed types: every field as VARIANT, told apart later.

    A line that is no JSON object is a reject with its text.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    row = F.try_parse_json("value")
    bad = ~F.coalesce(F.schema_of_variant(row).startswith("OBJECT"), F.lit(False))
    problem = error("", F.when(bad, F.lit("the line is no JSON object")), F.col("value"))
    return lines.select(
        *[F.when(~bad, F.try_variant_get(row, f"$.{c}", "variant")).alias(c) for c in columns],
        F.when(bad, F.array(problem)).cast(ERROR_TYPE).alias(ERRORS),
    )


def discovered_schema(lines: DataFrame, column: str = "value") -> T.StructType:
    """The fields of all JSON objects in a text column, found by one aggregate over every line.

    Fields that only some objects have are found as well. A field whose values are of several types is a
    VARIANT, or JSON text within a list or an object; numbers with a fraction are doubles. A field that
    never holds anything but nulls, empty lists or empty objects has no type and is left out.
    """
    row = F.try_parse_json(column)
    objects = lines.select(row.alias("row")).filter(F.schema_of_variant("row").startswith("OBJECT"))
    found = objects.agg(F.schema_of_variant_agg("row")).first()[0]
    # Object is the name of a struct here; names of fields in quotes may say anything.
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    kind = T.DataType.fromDDL(ddl) if found.startswith("OBJECT<") else T.StructType()
    fields = [(f.name, _read_type(f.dataType, False)) for f in kind.fields]
    schema = T.StructType([T.StructField(n, k) for n, k in fields if k is not None])
    name_map(schema.names)
    return schema


def _read_type(kind: T.DataType, nested: bool) -> T.DataType | None:
    if isinstance(kind, T.StructType):
        fields = [(f.name, _read_type(f.dataType, True)) for f in kind.fields]
        kept = [T.StructField(n, k) for n, k in fields if k is not None]
        return T.StructType(kept) if kept else None
    if isinstance(kind, T.ArrayType):
        element = _read_type(kind.elementType, True)
        return T.ArrayType(element) if element is not None else None
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.VariantType):
        return T.StringType() if nested else kind
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.DecimalType(38, 0)
    return kind


def read_undeclared_files(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines whose fields nobody has declared, nested as they are; see :func:`discovered_schema`.

    The lines are read once for their fields and once for their values. Lines that are no JSON objects are
    rejects with their text, as in :func:`read_load_files`.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return read_load_files(spark, path, discovered_schema(lines))
