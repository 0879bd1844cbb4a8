"""Expressions that decide whether two cells or rows differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywise.functions.columns import JSON_OPTIONS, col


def differs(base: Column, actual: Column) -> Column:
    """Null equals null; null differs from every value."""
    return ~base.eqNullSafe(actual)


def differs_plain(base: Column, actual: Column, sentinel: str = "NULL_VALUE") -> Column:
    """Plain inequality on strings whose nulls were replaced by a sentinel.

    Prefer :func:`differs`: a cell that really holds the sentinel equals null here.
    """
    return F.coalesce(base, F.lit(sentinel)) != F.coalesce(actual, F.lit(sentinel))


def differs_rounded(base: Column, actual: Column, digits: int) -> Column:
    """Compare numbers rounded half-up to ``digits``; other text is compared exactly."""
    b, a = base.try_cast("double"), actual.try_cast("double")
    both = b.isNotNull() & a.isNotNull()
    return F.when(both, F.round(b, digits) != F.round(a, digits)).otherwise(differs(base, actual))


def differs_sql(base: str, actual: str, digits: int | None = None) -> str:
    """The same two conditions as SQL text, for expressions over many columns."""
    unequal = f"NOT ({base} <=> {actual})"
    if digits is None:
        return unequal
    b, a = f"try_cast({base} AS DOUBLE)", f"try_cast({actual} AS DOUBLE)"
    return (
        f"({unequal} AND CASE WHEN {b} IS NOT NULL AND {a} IS NOT NULL "
        f"THEN round({b}, {digits}) <> round({a}, {digits}) ELSE true END)"
    )


def fingerprint(names: Sequence[str]) -> Column:
    """SHA-256 of the JSON form of some columns.

    Nulls keep their place and values are escaped, so unlike a delimiter-joined
    string two different rows never share the hashed text.
    """
    row = F.struct(*[col(n).alias(n) for n in names])
    return F.sha2(F.to_json(row, JSON_OPTIONS), 256)


def change_carrier(base: Column, actual: Column, tag: Column) -> Column:
    """``array(base, actual, tag)`` where the cell differs, else null."""
    return F.when(differs(base, actual), F.array(base.cast("string"), actual.cast("string"), tag))


def same_map(left: Column, right: Column) -> Column:
    """Whether two maps hold the same entries, whatever their order."""
    return F.array_sort(F.map_entries(left)).eqNullSafe(F.array_sort(F.map_entries(right)))
