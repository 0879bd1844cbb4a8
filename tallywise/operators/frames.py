"""Column-set operators on whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import as_text, col, cols, holds_map


def cast_all_string(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column but those in ``keep`` as a string, in one projection."""
    held = set(keep)
    return df.select(*[
        col(f.name) if f.name in held else as_text(col(f.name), f.dataType).alias(f.name) for f in df.schema.fields
    ])


def maps_as_text(df: DataFrame) -> DataFrame:
    """Columns that hold a map at any depth as text in key order, all others as they are."""
    return df.select(*[
        as_text(col(f.name), f.dataType).alias(f.name) if holds_map(f.dataType) else col(f.name)
        for f in df.schema.fields
    ])


def drop_columns(df: DataFrame, exclude: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Drop columns; absent and empty names are ignored, keys may not be dropped."""
    held = [k for k in keys if k in exclude]
    if held:
        raise ValueError(f"key columns cannot be excluded: {held}")
    gone = set(exclude)
    return df.select(*cols(c for c in df.columns if c not in gone))


def common_columns(base: DataFrame, actual: DataFrame) -> list[str]:
    """Names found on both sides, in base order; names compare case-sensitively."""
    there = set(actual.columns)
    return [c for c in base.columns if c in there]


def schema_diff(base: DataFrame, actual: DataFrame, count_values: bool = False) -> DataFrame:
    """Columns found on one side only, with their type.

    ``count_values`` adds how many non-null values each of them holds, in one
    aggregation per side that reads just those columns.
    """
    spark = base.sparkSession
    shared = set(common_columns(base, actual))
    parts = []
    for side, df in (("base", base), ("actual", actual)):
        alone = [f for f in df.schema.fields if f.name not in shared]
        if not alone:
            continue
        if count_values:
            counts = df.agg(*[F.count(col(f.name)).alias(f"n{i}") for i, f in enumerate(alone)])
            rows = [
                F.struct(F.lit(f.name).alias("column_name"), F.lit(side).alias("side"),
                         F.lit(f.dataType.simpleString()).alias("data_type"),
                         F.col(f"n{i}").alias("n_values"))
                for i, f in enumerate(alone)
            ]
            parts.append(counts.select(F.inline(F.array(*rows))))
        else:
            rows = [(f.name, side, f.dataType.simpleString()) for f in alone]
            parts.append(spark.createDataFrame(rows, "column_name string, side string, data_type string"))
    if not parts:
        schema = "column_name string, side string, data_type string"
        return spark.createDataFrame([], schema + (", n_values bigint" if count_values else ""))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def select_keys(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    return df.select(*cols(pk))


def normalise_column_names(df: DataFrame) -> DataFrame:
    """Trim names and replace blanks by ``_``; clashing results are an error."""
    names = [c.strip().replace(" ", "_") for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after normalising: {clashes}")
    return df.toDF(*names)


def suffix_columns(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Append ``suffix`` to every name but those in ``keep``."""
    held = set(keep)
    return df.select(*[col(c).alias(c if c in held else c + suffix) for c in df.columns])


def fill_nulls(df: DataFrame, sentinel: str = "NULL_VALUE") -> DataFrame:
    """Replace nulls of string columns by a sentinel; it may collide with real data."""
    return df.na.fill(sentinel)


def require_columns(df: DataFrame, names: Sequence[str], side: str) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise KeyError(f"Missing key columns in {side}: {absent}")


def input_status(base: DataFrame, actual: DataFrame) -> str:
    """``OK`` or which side holds no row. Reads at most one row per side."""
    no_base, no_actual = base.isEmpty(), actual.isEmpty()
    if no_base and no_actual:
        return "EMPTY_BOTH"
    if no_base:
        return "EMPTY_BASE"
    return "EMPTY_ACTUAL" if no_actual else "OK"


def exists(df: DataFrame) -> bool:
    return not df.isEmpty()


def at_point(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one point in time; prunes partitions when ``column`` partitions the table."""
    return df.where(col(column) == _as_column_type(df, column, value))


def _as_column_type(df: DataFrame, column: str, value) -> Column:
    """The literal in the column's type: casting the column instead would stop pushdown."""
    return F.lit(value).cast(df.schema[column].dataType)


def filter_range(df: DataFrame, date_col: str, start, end, members: Mapping[str, Sequence] | None = None,
                 archived_col: str | None = None, include_archived: bool = False) -> DataFrame:
    """Closed date range plus membership lists.

    ``members`` maps a column to its allowed values; an empty list does not
    restrict. Archived rows are left out unless asked for.
    """
    keep = col(date_col).between(_as_column_type(df, date_col, start), _as_column_type(df, date_col, end))
    for name, values in (members or {}).items():
        if values:
            keep = keep & col(name).isin(list(values))
    if archived_col is not None and not include_archived:
        keep = keep & ~F.coalesce(col(archived_col), F.lit(False))
    return df.where(keep)


def names_containing(df: DataFrame, column: str, find: str, put: str, out: str) -> DataFrame:
    """Rows whose name holds ``find``, with the replaced name beside it."""
    return df.where(col(column).contains(find)).withColumn(out, F.replace(col(column), F.lit(find), F.lit(put)))


def head(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Last rows by ascending ``order``; a top-k in reverse order, not a full sort."""
    return df.orderBy(*[col(c).desc_nulls_last() for c in order]).limit(n)


def append_rows(df: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        df = df.unionByName(other, allowMissingColumns=True)
    return df
