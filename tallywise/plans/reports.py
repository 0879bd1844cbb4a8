"""Capped reports, summary and verdict of a comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import cols
from tallywise.operators import sets
from tallywise.operators.frames import common_columns
from tallywise.plans.comparison import Comparison

# Rows kept per report.
KEYS_PER_REPORT = 499
PAIRS_PER_COLUMN = 99
SAMPLES_PER_PAIR = 24
SHORT_SAMPLES_PER_PAIR = 5
SAMPLES_PER_COLUMN = 999

_PAIR = ["col_name", "base_value", "actual_value"]


def value_pair_counts(cells: DataFrame) -> DataFrame:
    """How often each (column, base value, actual value) occurs."""
    return cells.groupBy(*_PAIR).agg(F.count(F.lit(1)).alias("n"))


def column_diff_counts(pair_counts: DataFrame) -> DataFrame:
    """Differing cells per column, summed from the value pairs."""
    return pair_counts.groupBy("col_name").agg(F.sum("n").alias("diff_count"))


def top_value_pairs(pair_counts: DataFrame, n: int = PAIRS_PER_COLUMN) -> DataFrame:
    order = [F.desc("n"), F.asc_nulls_first("base_value"), F.asc_nulls_first("actual_value")]
    return sets.top_per_group(pair_counts, ["col_name"], order, n).drop("rn")


def ordered_value_pairs(pair_counts: DataFrame) -> DataFrame:
    """All value pairs, most frequent first."""
    return pair_counts.orderBy(F.desc("n"), *_PAIR)


def sample_diffs(cells: DataFrame, pk: Sequence[str], n: int = SAMPLES_PER_PAIR, by: str = "pair") -> DataFrame:
    """First cells by key per value pair, or per column with ``by='column'``."""
    group = _PAIR if by == "pair" else ["col_name"]
    tie = [] if by == "pair" else [F.asc_nulls_first(c) for c in _PAIR[1:]]
    return sets.top_per_group(cells, group, [*[c.asc_nulls_first() for c in cols(pk)], *tie], n)


def nonnull_diff_cells(cells: DataFrame) -> DataFrame:
    """Non-null differing cells per column and side."""
    return cells.groupBy("col_name").agg(
        F.count("base_value").alias("base_count"), F.count("actual_value").alias("actual_count")
    )


def mismatch_totals(cells: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Distinct keys and columns among the differing cells."""
    return cells.agg(
        F.count_distinct(F.struct(*cols(pk))).alias("mismatched_keys"),
        F.count_distinct("col_name").alias("mismatched_columns"),
    )


def top_duplicates(cmp: Comparison, n: int = KEYS_PER_REPORT) -> DataFrame:
    """Most repeated keys per side; a top-k per side, no full sort."""
    keys = cmp.duplicate_keys()
    return _top_per_side(keys, [F.desc("n"), *[c.asc_nulls_first() for c in cols(cmp.pk)]], n)


def top_extras(cmp: Comparison, n: int = KEYS_PER_REPORT) -> DataFrame:
    """First keys by key order that one side lacks, per side."""
    return _top_per_side(cmp.extra_keys(), [c.asc_nulls_first() for c in cols(cmp.pk)], n)


def _top_per_side(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    sides = [df.where(F.col("side") == side).orderBy(*order).limit(n) for side in ("base", "actual")]
    return sides[0].unionByName(sides[1])


def _totals(cmp: Comparison) -> DataFrame:
    """Every count of a comparison in one aggregation over its findings."""
    both = (F.col("_nb") > 0) & (F.col("_na") > 0)
    zero = F.lit(0).cast("bigint")
    clean = F.lit(cmp.clean_keys).cast("bigint")
    return cmp.findings.agg(
        (F.coalesce(F.sum("_nb"), zero) + clean).alias("rows_base"),
        (F.coalesce(F.sum("_na"), zero) + clean).alias("rows_actual"),
        F.count_if(F.col("_na") == 0).alias("extra_base"),
        F.count_if(F.col("_nb") == 0).alias("extra_actual"),
        F.count_if(F.col("_nb") > 1).alias("duplicate_keys_base"),
        F.count_if(F.col("_na") > 1).alias("duplicate_keys_actual"),
        F.coalesce(F.sum(F.when(both, F.col("_nb") - 1)), zero).alias("duplicate_rows_base"),
        F.coalesce(F.sum(F.when(both, F.col("_na") - 1)), zero).alias("duplicate_rows_actual"),
        F.count_if(cmp.row_differs).alias("mismatched_keys"),
        *cmp.column_counts(),
    ).withColumns({
        "mismatched_cells": F.aggregate(_per_column(cmp), zero, lambda total, n: total + n),
        "mismatched_columns": F.size(F.filter(_per_column(cmp), lambda n: n > 0)).cast("bigint"),
    })


def _per_column(cmp: Comparison) -> Column:
    names = ", ".join(f"c{i}" for i in range(len(cmp.columns)))
    return F.expr(f"CAST(array({names}) AS array<bigint>)")


def _unmapped(cmp: Comparison) -> int:
    shared = len(common_columns(cmp.base, cmp.actual))
    return len(cmp.base.columns) + len(cmp.actual.columns) - 2 * shared


def _status(cmp: Comparison, ignore_extras: bool, strict: bool) -> Column:
    fails = F.col("mismatched_cells") > 0
    if not ignore_extras:
        fails = fails | (F.col("extra_base") > 0) | (F.col("extra_actual") > 0)
    if strict:
        fails = fails | (F.col("duplicate_keys_base") > 0) | (F.col("duplicate_keys_actual") > 0)
        fails = fails | F.lit(_unmapped(cmp) > 0)
    no_base, no_actual = F.col("rows_base") == 0, F.col("rows_actual") == 0
    return (
        F.when(no_base & no_actual, "EMPTY_BOTH")
        .when(no_base, "EMPTY_BASE")
        .when(no_actual, "EMPTY_ACTUAL")
        .when(fails, "FAIL")
        .otherwise("PASS")
    )


def verdict(cmp: Comparison, ignore_extras: bool = False, strict: bool = False) -> DataFrame:
    """One row: status and the counts it rests on."""
    return _totals(cmp).select(
        _status(cmp, ignore_extras, strict).alias("status"),
        "mismatched_cells", "mismatched_keys", "extra_base", "extra_actual",
    )


def summary(cmp: Comparison, facts: Mapping[str, Column | str | None] | None = None) -> DataFrame:
    """The summary block as ``metric, value`` rows.

    ``facts`` carries what the comparison does not know: ``product``,
    ``business_date``, ``baseline_batch``, ``regression_batch``,
    ``baseline_core_batch`` and ``regression_core_batch``. The status here looks
    at changed cells only; extra keys have metrics of their own.
    """
    facts = dict(facts or {})

    def fact(name: str) -> Column:
        value = facts.get(name)
        return value if isinstance(value, Column) else F.lit(value)

    unmapped = _unmapped(cmp)
    # The labels of the summary block, in report order.
    metrics = [
        ("Test Status", _status(cmp, ignore_extras=True, strict=False)),
        ("Product Name", fact("product")),
        ("Business Date", fact("business_date")),
        ("Baseline PCM Batch ID", fact("baseline_batch")),
        ("Regression PCM Batch ID", fact("regression_batch")),
        ("Baseline CORE Batch ID", fact("baseline_core_batch")),
        ("Regression CORE Batch ID", fact("regression_core_batch")),
        ("Columns present in Baseline", F.lit(len(cmp.base.columns))),
        ("Columns present in Regression", F.lit(len(cmp.actual.columns))),
        ("Records present in Baseline", F.col("rows_base")),
        ("Records present in Regression", F.col("rows_actual")),
        ("Primary Key Column Count", F.lit(len(cmp.pk))),
        ("Extra Records present in Baseline", F.col("extra_base")),
        ("Extra Records present in Regression", F.col("extra_actual")),
        ("Baseline Duplicate Records Count", F.col("duplicate_keys_base")),
        ("Regression Duplicate Records Count", F.col("duplicate_keys_actual")),
        ("Mismatched Records Count", F.col("mismatched_keys")),
        ("Mismatched Columns Count", F.col("mismatched_columns")),
        ("All Columns Mapped", F.lit("PASS" if unmapped == 0 else "FAIL")),
        ("Unmapped Columns Count", F.lit(unmapped)),
        # Ours: excess rows among keys of both sides, beside the key counts above.
        ("Baseline Excess Rows of Common Keys", F.col("duplicate_rows_base")),
        ("Regression Excess Rows of Common Keys", F.col("duplicate_rows_actual")),
    ]
    rows = [F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value")) for m, v in metrics]
    return _totals(cmp).select(F.inline(F.array(*rows)))


def any_difference(diff: DataFrame) -> DataFrame:
    """One row ``status, differences`` for a grid or tree comparison."""
    n = F.count(F.lit(1))
    return diff.agg(F.when(n == 0, "PASS").otherwise("FAIL").alias("status"), n.alias("differences"))
