"""JSON records in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.functions.columns import JSON_OPTIONS, col, cols
from tallywise.functions.records import first_json_value
from tallywise.operators.numbering import number_in_order


def explode_json_records(df: DataFrame, column: str, record: str) -> DataFrame:
    """Rows of the record list that the first value of a JSON object holds.

    ``record`` is the DDL of one record, e.g. ``"id int, price decimal(10,2)"``. Documents without such a list are in
    ``explode_or_reject``'s second frame.
    """
    return explode_or_reject(df, column, record)[0]


def explode_or_reject(df: DataFrame, column: str, record: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the record lists, and the rows of ``df`` whose document holds no list that parses."""
    rest = [c for c in df.columns if c != column]
    records = F.from_json(first_json_value(col(column)), T.ArrayType(T.StructType.fromDDL(record)))
    rejects = df.where(col(column).isNotNull() & records.isNull())
    return df.select(*cols(rest), F.inline(records)), rejects


def malformed_records(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Rows whose JSON cannot be parsed, to be looked at apart."""
    bad = "_bad"
    parsed = F.from_json(col(column), f"{schema}, {bad} string", {"columnNameOfCorruptRecord": bad})
    return df.where(col(column).isNotNull() & parsed.getField(bad).isNotNull())


def record_json(names: Sequence[str]) -> Column:
    """One record as JSON with ISO dates; nulls are kept."""
    return F.to_json(F.struct(*[col(n).alias(n) for n in names]), JSON_OPTIONS)


def to_json_records(df: DataFrame, names: Sequence[str] | None = None, out: str = "record") -> DataFrame:
    """One JSON record per row; a table is never gathered into one string."""
    names = df.columns if names is None else names
    return df.select("*", record_json(names).alias(out))


def batch_json_records(df: DataFrame, row_id: str, names: Sequence[str], size: int) -> DataFrame:
    """``batch_no, records``: JSON lists of at most ``size`` records each.

    What a prompt over several rows takes. Rows are numbered by ``row_id``, and
    no list outgrows its bound, however many rows there are.
    """
    numbered = number_in_order(df, [], [col(row_id)], "_n")
    record = F.struct("_n", record_json(names).alias("json"))
    lists = numbered.groupBy(F.floor((F.col("_n") - 1) / size).alias("batch_no")).agg(
        F.array_sort(F.collect_list(record)).alias("_records")
    )
    texts = F.transform("_records", lambda r: r["json"])
    return lists.select("batch_no", F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("records"))
