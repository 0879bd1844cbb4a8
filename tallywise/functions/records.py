"""JSON records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_json_value(text: Column) -> Column:
    """The first value of a JSON object, as text."""
    return F.try_element_at(F.map_values(F.from_json(text, "map<string,string>")), F.lit(1))


def parse_json(text: Column, schema: str) -> Column:
    """Typed struct; fields of malformed text are null."""
    return F.from_json(text, schema)


def missing_as_null(column: Column, data_type: str) -> Column:
    """NaN counts as missing in float columns."""
    if data_type in ("double", "float"):
        return F.nanvl(column, F.lit(None).cast(data_type))
    return column


def fill_missing(column: Column, fill: Column, data_type: str) -> Column:
    return F.coalesce(missing_as_null(column, data_type), fill)


def event_payload(action: Column, stamp: Column, user: Column, day: Column, label: Column,
                  filename: Column, kind: Column) -> Column:
    """The nested adjustment record as a struct."""
    blank = F.lit("")
    return F.struct(
        F.array(F.struct(action.alias("action"), stamp.alias("dateTimestamp"), user.alias("user"))).alias("actionLog"),
        blank.alias("approver"),
        user.alias("author"),
        F.struct(day.alias("from"), blank.alias("to")).alias("dateRange"),
        stamp.alias("dateTimeStamp"),
        filename.alias("description"),
        filename.alias("filename"),
        F.lit("Pending").alias("state"),
        F.array(label).alias("timeSlices"),
        kind.alias("type"),
    )
