"""Delimited files in, CSV reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywise.operators.frames import normalise_column_names


def read_delimited(spark: SparkSession, path: str, sep: str = ",", quote: str = "'") -> DataFrame:
    """A file with a header row; every column is a string, nothing is inferred."""
    reader = spark.read.options(header=True, sep=sep, quote=quote, inferSchema=False)
    return normalise_column_names(reader.csv(path))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a report back. CSV cannot tell an empty string from null: both become null."""
    return spark.read.option("header", True).csv(path)


def write_report(df: DataFrame, path: str, single: bool = True, compression: str = "none") -> None:
    """Write CSV with a header to any URI Spark can reach.

    ``single`` makes one file and is meant for capped frames only.
    """
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", "true").option(
        "compression", compression
    ).csv(path)
