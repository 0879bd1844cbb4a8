"""Helpers to name, cast and key columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal_sql(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def col(name: str) -> Column:
    """Column by its exact name, whatever dots or blanks it holds."""
    return F.col(quoted(name))


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def key_struct(names: Sequence[str]) -> Column:
    """All key parts as one struct.

    Struct equality treats null parts as equal, so grouping, windows and plain
    equi-joins on it are null-safe and share one hash partitioning.
    """
    return F.struct(*[col(n).alias(n) for n in names])


#: Field of a value struct without columns.
NO_VALUES = "_none"


def value_struct(names: Sequence[str]) -> Column:
    """The non-key columns of a row as one struct; compares field by field, nulls first."""
    return F.struct(*[col(n).alias(n) for n in names] or [F.lit(None).cast("string").alias(NO_VALUES)])


def holds_map(data_type: T.DataType) -> bool:
    """Whether a map lies anywhere in a type."""
    if isinstance(data_type, T.ArrayType):
        return holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(holds_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, T.MapType)


def _canonical(column: Column, data_type: T.DataType) -> Column:
    """The value with every map, at any depth, as its entries in key order."""
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda x: _canonical(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [_canonical(column.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else column
    if isinstance(data_type, T.MapType):
        return F.array_sort(F.transform(F.map_entries(column), lambda e: F.struct(
            _canonical(e.getField("key"), data_type.keyType).alias("key"),
            _canonical(e.getField("value"), data_type.valueType).alias("value"),
        )))
    return column


#: How values inside arrays, structs and maps are written: nulls kept, times to the microsecond.
JSON_OPTIONS = {
    "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def as_text(column: Column, data_type: T.DataType) -> Column:
    """The string form values are compared in.

    Arrays, structs and maps become JSON with nulls kept and strings quoted, so unequal values never share a text;
    maps are lists of entries in key order.
    """
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(_canonical(column, data_type), JSON_OPTIONS)
    return column.cast("string")


def texts(df: DataFrame, names: Iterable[str] | None = None) -> list[Column]:
    names = df.columns if names is None else names
    return [as_text(col(n), df.schema[n].dataType).alias(n) for n in names]


def trimmed_list(values: str, sep: str = ",") -> list[str]:
    """Split a parameter such as ``"id, name"`` and trim each item."""
    return [part.strip() for part in values.split(sep)]
