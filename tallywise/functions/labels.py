"""Labels built from names, numbers and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_letters(number: Column) -> Column:
    """Spreadsheet letters of a 1-based column number: A..Z, AA..ZZ, AAA..XFD."""
    n = number.cast("int") - 1
    units = F.char((n % 26 + 65).cast("int"))
    tens = F.char((F.floor((n - 26) / 26) % 26 + 65).cast("int"))
    hundreds = F.char((F.floor((n - 702) / 676) + 65).cast("int"))
    return (
        F.when(n < 26, units)
        .when(n < 702, F.concat(tens, units))
        .otherwise(F.concat(hundreds, tens, units))
    )


def cell_name(row_no: Column, col_no: Column) -> Column:
    return F.concat(column_letters(col_no), row_no.cast("string"))


def day_month(date_text: Column) -> Column:
    """``2025-05-09`` to ``9 May``."""
    return F.date_format(F.try_to_date(date_text, "yyyy-MM-dd"), "d MMM")


def duration_label(seconds: Column) -> Column:
    """Seconds only, minutes only, or both."""
    minutes = F.floor(seconds / 60).cast("bigint")
    rest = (seconds % 60).cast("bigint")
    minutes_text = F.concat(minutes.cast("string"), F.lit(" MINUTES"))
    rest_text = F.concat(rest.cast("string"), F.lit(" SECONDS"))
    return (
        F.when(minutes == 0, rest_text)
        .when(rest == 0, minutes_text)
        .otherwise(F.concat(minutes_text, F.lit(" & "), rest_text))
    )


def product_label(table: Column) -> Column:
    """Table name without database, first and last token, in upper case.

    One table has a label of its own.
    """
    name = F.element_at(F.split(table, r"\."), -1)
    tokens = F.split(F.upper(name), "_")
    kept = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0)))
    return F.when(name == "ipv_position_consumption", "IPV").otherwise(F.array_join(kept, "_"))


def run_label(product: Column) -> Column:
    return F.concat(F.lit("TC_"), F.replace(product, F.lit(" "), F.lit("_")), F.lit("_REGRESSION"))


def report_name(product: Column, stamp: Column, run_id: Column | None = None) -> Column:
    """Report name with the stamp ``yyyy_MM_dd_mm``; the run id keeps names apart.

    The stamp holds the minute but no hour, as the report's users know it.
    """
    parts = [product, F.lit("_REPORT_"), F.date_format(stamp, "yyyy_MM_dd_mm")]
    if run_id is not None:
        parts += [F.lit("_"), run_id.cast("string")]
    return F.concat(*parts)


def replaced_name(name: Column, find: str, put: str) -> Column:
    return F.replace(name, F.lit(find), F.lit(put))


def split_trimmed(column: Column, sep: str = ",") -> Column:
    """Trimmed items of a delimited string."""
    return F.transform(F.split(column, "\\Q" + sep + "\\E"), lambda part: F.trim(part))
