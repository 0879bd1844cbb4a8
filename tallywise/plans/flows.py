"""Whole comparison runs: two queries, two batches of a table, two files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions.columns import trimmed_list
from tallywise.functions.labels import product_label
from tallywise.operators.frames import common_columns, exists
from tallywise.operators.sets import smallest_value
from tallywise.plans import reports
from tallywise.plans.comparison import Comparison, compare
from tallywise.session import stored
from tallywise.sources.delimited import read_delimited, write_report
from tallywise.sources.tables import from_batch, from_query

# Folder names of the reports.
REPORT_FOLDERS = {
    "duplicates_base": "BaseDuplicates",
    "duplicates_actual": "ActualDuplicates",
    "extra_base": "BaseExtra",
    "extra_actual": "ActualExtra",
    "cells": "Diffs",
    "pairs": "MismatchCount",
    "columns": "ColumnDiffSum",
    "samples": "MismatchFiltered1000",
}


# Folder names of what a run over two files, and one over two batches, writes.
FILE_REPORTS = {
    "changed_base": "base_except_actual", "changed_actual": "actual_except_base", "columns": "column_diff_counts",
    "pairs": "pivot_table", "samples": "top_5_differences",
}
BATCH_REPORTS = {
    "summary": "Summary Report", "columns": "Mismatched Column Names", "counts": "Mismatched Records Count", "wide": "Mismatched Data",
    "extra_base": "Extra Records in Baseline", "extra_actual": "Extra Records in Regression",
    "duplicates_base": "Baseline Duplicate Records", "duplicates_actual": "Regression Duplicate Records",
    "unmatched": "UnMatched Column Names",
}


@dataclass(frozen=True)
class Run:
    """What a run leaves behind: stored findings and cells, counts and, for batches, the summary.

    ``passed`` are the compared columns without a difference, ``unmatched`` those that one side lacks.
    """

    comparison: Comparison
    cells: DataFrame
    verdict: dict
    summary: DataFrame | None = None
    passed: tuple[str, ...] = ()
    unmatched: tuple[str, ...] = ()


def exists_at(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _put(df: DataFrame, target: str, single: bool) -> None:
    """Write a stored frame, unless it is empty and no report of an earlier run is there to be replaced."""
    if exists(df) or exists_at(df.sparkSession, target):
        write_report(df, target, single)


def _run(cmp: Comparison, cells: DataFrame) -> Run:
    differing = {r["col_name"] for r in cells.select("col_name").distinct().collect()}  # at most one row per column
    shared = {*cmp.columns, *cmp.pk}
    unmatched = sorted({*cmp.base.columns, *cmp.actual.columns} - {*common_columns(cmp.base, cmp.actual)} - shared)
    passed = tuple(c for c in cmp.columns if c not in differing)
    return Run(cmp, cells, reports.verdict(cmp).first().asDict(), None, passed, tuple(unmatched))


def write_reports(cmp: Comparison, out: str, full_diff: bool = False) -> Run:
    """Write the capped reports under ``out`` and return the verdict.

    The findings and the changed cells are stored once; every report reads
    those. Empty reports are not written, but over one of an earlier run, which becomes a header
    without rows. Only capped reports become one file.
    """
    cmp = cmp.stored()
    cells = stored(cmp.changed_cells(), "cells")
    out = out.rstrip("/")

    def put(name: str, df: DataFrame, single: bool = True) -> None:
        _put(df if df is cells else stored(df, name), f"{out}/{REPORT_FOLDERS[name]}", single)

    duplicates, extras = reports.top_duplicates(cmp), reports.top_extras(cmp)
    for side in ("base", "actual"):
        put(f"duplicates_{side}", duplicates.where(duplicates["side"] == side).drop("side"))
        put(f"extra_{side}", extras.where(extras["side"] == side).drop("side"))
    if full_diff:
        put("cells", cells, single=False)
    counts = reports.value_pair_counts(cells)
    put("pairs", reports.top_value_pairs(counts))
    put("columns", reports.column_diff_counts(counts))
    # One small group per value pair: many groups, so this one stays partitioned.
    put("samples", reports.sample_diffs(cells, cmp.pk), single=False)
    return _run(cmp, cells)


def write_file_reports(cmp: Comparison, out: str) -> Run:
    """Write what a comparison of two files leaves: the differing rows of each side, counts, value pairs and samples.

    Rows and pairs are all of them, the pairs most frequent first and in one file; of each pair five samples are kept.
    """
    cmp = cmp.stored()
    cells = stored(cmp.changed_cells(), "cells")
    counts = stored(reports.value_pair_counts(cells), "pair-counts")
    changed = stored(cmp.changed_rows(), "changed-rows")
    found = {
        "changed_base": (changed.where("side = 'base'").drop("side"), False), "changed_actual": (changed.where("side = 'actual'").drop("side"), False),
        "columns": (reports.column_diff_counts(counts), True), "pairs": (reports.ordered_value_pairs(counts), False),
        "samples": (reports.sample_diffs(cells, cmp.pk, reports.SHORT_SAMPLES_PER_PAIR).drop("rn"), False),
    }
    for name, (df, single) in found.items():
        _put(df, f"{out.rstrip('/')}/{FILE_REPORTS[name]}", single)
    return _run(cmp, cells)


def write_batch_reports(cmp: Comparison, out: str, facts: Mapping[str, Column | str | None]) -> Run:
    """Write what a comparison of two batches leaves: the summary block, the mismatched and unmatched columns, counts of
    cells that are not null, mismatched keys side by side, and whole extra and duplicate rows."""
    cmp = cmp.stored()
    cells = stored(cmp.changed_cells(), "cells")
    run = _run(cmp, cells)
    spark = cells.sparkSession
    block = stored(reports.summary(cmp, facts), "summary")
    counts = stored(reports.nonnull_diff_cells(cells), "cell-counts")
    differing = [c for c in cmp.columns if c not in run.passed]
    duplicates = stored(cmp.duplicate_rows(common_only=False), "duplicate-rows")
    found = {
        "summary": (block, True), "columns": (counts.select("col_name").orderBy("col_name"), True), "counts": (counts.orderBy("col_name"), True),
        "wide": (stored(cmp.wide_diff(differing), "wide") if differing else counts.limit(0), False),
        "unmatched": (spark.createDataFrame([(c,) for c in run.unmatched], "col_name string"), True),
    }
    for side in ("base", "actual"):
        found[f"extra_{side}"] = stored(cmp.extra_rows(side).drop("side"), f"extra-{side}"), False
        found[f"duplicates_{side}"] = duplicates.where(F.col("side") == side).drop("side"), False
    for name, (df, single) in found.items():
        _put(df, f"{out.rstrip('/')}/{BATCH_REPORTS[name]}", single)
    return replace(run, summary=block)


def compare_queries(spark: SparkSession, base_query: str, actual_query: str, keys: str, out: str,
                    exclude: str = "", full_diff: bool = False) -> Run:
    """Compare the results of two queries; ``keys`` and ``exclude`` are comma lists."""
    cmp = compare(from_query(spark, base_query), from_query(spark, actual_query),
                  trimmed_list(keys), trimmed_list(exclude))
    return write_reports(cmp, out, full_diff)


def compare_batches(spark: SparkSession, base_table: str, base_ids: str, actual_table: str, actual_ids: str,
                    keys: str, out: str, batch_col: str = "pcm_batch_id", exclude: Sequence[str] = (),
                    core_batch_col: str = "core_batch_id", date_col: str = "business_date") -> Run:
    """Compare batches of two tables and add the summary block.

    The batch column itself is left out of the comparison. The core batch id and
    the business date of a side are its smallest ones.
    """
    base = from_batch(spark, base_table, batch_col, base_ids)
    actual = from_batch(spark, actual_table, batch_col, actual_ids)
    cmp = compare(base, actual, trimmed_list(keys), [batch_col, *exclude])

    def least(df: DataFrame, name: str) -> Column | None:
        return smallest_value(df, [name]).scalar().cast("string") if name in df.columns else None

    facts = {
        "product": product_label(F.lit(base_table)),
        "business_date": least(base, date_col),
        "baseline_batch": base_ids,
        "regression_batch": actual_ids,
        "baseline_core_batch": least(base, core_batch_col),
        "regression_core_batch": least(actual, core_batch_col),
    }
    return write_batch_reports(cmp, out, facts)


def compare_files(spark: SparkSession, base_file: str, actual_file: str, keys: str, out: str, exclude: str = "",
                  base_sep: str = ",", actual_sep: str = ",") -> Run:
    """Compare two delimited files; ``keys`` and ``exclude`` are pipe lists."""
    cmp = compare(read_delimited(spark, base_file, base_sep), read_delimited(spark, actual_file, actual_sep),
                  trimmed_list(keys, "|"), trimmed_list(exclude, "|"))
    return write_file_reports(cmp, out)
