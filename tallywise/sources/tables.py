"""Frames from queries, tables and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallywise.functions.columns import col, trimmed_list


def from_query(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def from_batch(spark: SparkSession, table: str, batch_col: str, ids: str | Sequence) -> DataFrame:
    """Rows of some batches; ``ids`` may be a comma list. The filter reaches the scan."""
    values = trimmed_list(ids) if isinstance(ids, str) else list(ids)
    return spark.table(table).where(col(batch_col).isin(values))


def literal_rows(spark: SparkSession, rows: Sequence, schema: str) -> DataFrame:
    """A small frame from rows written in code."""
    return spark.createDataFrame(rows, schema)
