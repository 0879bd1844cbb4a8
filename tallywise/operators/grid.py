"""Positional comparison of cell grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.compare import differs, differs_rounded
from tallywise.functions.labels import cell_name
from tallywise.session import stored


def sheet_presence(base: DataFrame, actual: DataFrame) -> DataFrame:
    """Each sheet name and the sides that hold it: ``base``, ``actual`` or ``both``."""
    tagged = base.select("sheet", F.lit(1).alias("side")).unionAll(actual.select("sheet", F.lit(2).alias("side")))
    sides = tagged.groupBy("sheet").agg(F.bit_or("side").alias("sides"))
    name = F.when(F.col("sides") == 1, "base").when(F.col("sides") == 2, "actual").otherwise("both")
    return sides.select("sheet", name.alias("side"))


def grid_diff(base: DataFrame, actual: DataFrame, round_off: int | None = None) -> DataFrame:
    """Differing cells of the sheets both sides hold.

    Cells pair by position; an absent cell equals an empty one, so a position
    held by one side only differs exactly when its value is not null. Filtering
    nulls first keeps them out of the shuffle. The shared sheet names are stored
    first, so that restricting the cells to them does not shuffle cells by sheet.
    """
    common = stored(sheet_presence(base, actual).where(F.col("side") == "both").select("sheet"), "sheets")
    place = ["sheet", "row_no", "col_no"]

    def side(df: DataFrame, name: str) -> DataFrame:
        held = df.where(F.col("value").isNotNull()).join(common, "sheet", "left_semi")
        return held.select(*place, F.col("value").alias(name))

    joined = side(base, "base_value").join(side(actual, "actual_value"), place, "full")
    return joined.where(_cell_differs(round_off)).select(
        "sheet", "row_no", "col_no", cell_name(F.col("row_no"), F.col("col_no")).alias("cell_name"),
        "base_value", "actual_value",
    )


def _cell_differs(round_off: int | None) -> Column:
    base, actual = F.col("base_value"), F.col("actual_value")
    return differs(base, actual) if round_off is None else differs_rounded(base, actual, round_off)


def sheet_diff_counts(diff: DataFrame) -> DataFrame:
    """Differing cells per sheet; sheets without any are absent."""
    return diff.groupBy("sheet").agg(F.count(F.lit(1)).alias("n"))


def grid_status(base: DataFrame, actual: DataFrame, round_off: int | None = None) -> DataFrame:
    """One row ``diff_count, message``; the count is -1 when no sheet is shared."""
    sheets = sheet_presence(base, actual).agg(F.count_if(F.col("side") == "both").alias("n"))
    diffs = grid_diff(base, actual, round_off).agg(F.count(F.lit(1)).alias("diff_count"))
    shared = sheets.scalar() > 0
    return diffs.select(
        F.when(shared, F.col("diff_count")).otherwise(F.lit(-1)).alias("diff_count"),
        F.when(shared, "compare complete").otherwise("No Common sheets found").alias("message"),
    )


def grid_report(diff: DataFrame) -> DataFrame:
    """Report rows: sheet, cell name and both values."""
    return diff.select("sheet", "cell_name", "base_value", "actual_value")
