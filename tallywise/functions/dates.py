"""Date and time texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def iso_stamp(column: Column) -> Column:
    """ISO text with milliseconds and a literal ``Z``, e.g. ``2025-05-09T10:00:00.000Z``."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def to_stamp(text: Column, fmt: str | None = None) -> Column:
    """Timestamp, or null for text that is none."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


#: Formats tried in turn, after the text was tidied.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "MMMM d, yyyy", "MMM d, yyyy")


def tidy_date_text(text: Column, pivot: int = 70) -> Column:
    """Repeated commas become one and ``'94`` becomes a four-digit year."""
    tidy = F.trim(F.regexp_replace(F.regexp_replace(text, ",+", ","), " +", " "))
    short = F.regexp_extract(tidy, "'([0-9]{2})$", 1)
    century = F.when(short.try_cast("int") >= pivot, "19").otherwise("20")
    full = F.concat(F.regexp_replace(tidy, "'[0-9]{2}$", ""), century, short)
    return F.when(short != "", full).otherwise(tidy)


def parse_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    tidy = tidy_date_text(text)
    return F.coalesce(*[F.try_to_date(tidy, fmt) for fmt in formats])
