"""Column and table names."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docharbor.errors import SchemaError

# Document id column, its replacement, and the name length limit
# with the parts a longer name is cut into.
ID = "id"
RESERVED_NAMES = {"id": "__id"}
MAX_NAME = 255
KEPT_CHARS = 238
DIGEST_CHARS = 16

# System columns.
ROW_ID = "_row_id"
LOAD_ID = "_load_id"
PARENT_ID = "_parent_id"
ROOT_ID = "_root_id"
LIST_IDX = "_list_idx"
SYSTEM_COLUMNS = (ROW_ID, LOAD_ID, PARENT_ID, ROOT_ID, LIST_IDX)

NEST = "__"


def snake_case(name: str) -> str:
    """Lower snake case: split camel humps, turn other symbols into underscores."""
    text = re.sub(r"\W", "_", name.strip(), flags=re.ASCII)
    text = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", text).lower()
    if not text:
        raise SchemaError(f"the name {name!r} has no usable character")
    return f"_{text}" if text[0].isdigit() else text


def column_name(name: str) -> str:
    """A stored column name; the managed document id keeps its name to itself."""
    cleaned = snake_case(name)
    return RESERVED_NAMES.get(cleaned, cleaned)


def name_map(names: Iterable[str]) -> dict[str, str]:
    """Source name to stored name, refusing two sources that end up as one column."""
    mapped = {name: column_name(name) for name in names}
    clashes = sorted(n for n, count in Counter(mapped.values()).items() if count > 1)
    if clashes:
        sources = sorted(s for s, n in mapped.items() if n in clashes)
        raise SchemaError(f"columns {sources} collide as {clashes} after renaming")
    too_long = [n for n in mapped.values() if len(n) > MAX_NAME]
    if too_long:
        raise SchemaError(f"column names longer than {MAX_NAME} characters: {too_long}")
    return mapped


def renamed_type(data_type: T.DataType) -> T.DataType:
    """The same type with every nested field renamed."""
    if isinstance(data_type, T.StructType):
        mapped = name_map(data_type.names)
        return T.StructType(
            [
                T.StructField(mapped[f.name], renamed_type(f.dataType), f.nullable, f.metadata)
                for f in data_type.fields
            ]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(renamed_type(data_type.elementType), data_type.containsNull)
    return data_type


def normalise_names(df: DataFrame, inline: Iterable[str] = ()) -> DataFrame:
    """Rename all columns; nested fields too, save in columns kept inline as they came."""
    mapped = name_map(df.columns)
    keep = set(inline)
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        target = field.dataType if mapped[field.name] in keep else renamed_type(field.dataType)
        if target != field.dataType:
            column = column.cast(target)
        columns.append(column.alias(mapped[field.name]))
    return df.select(*columns)


def qualified_name(dataset: str, table: str, separator: str = "_") -> str:
    """Dataset-qualified table name, cut with a digest when it is too long."""
    name = f"{dataset}{separator}{table}" if dataset else table
    if len(name) <= MAX_NAME:
        return name
    digest = hashlib.sha1(name.encode("utf-8")).hexdigest()[:DIGEST_CHARS]
    return f"{name[:KEPT_CHARS]}_{digest}"
