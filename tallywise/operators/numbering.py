"""Row numbers and row copies for groups of any size, in the order of given values.

``row_number()`` puts a whole group through one task. Here only groups up to ``HEAVY`` rows go that way, all of them in
one window. A larger one is split into ranges of its order, numbered inside each range, and moved by the sizes of the
ranges before. Numbers follow from the values alone: which way a group went makes no difference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallywise.functions.columns import cols, key_struct
from tallywise.session import stored

#: Rows of a group that one task orders; a group of more is split.
HEAVY = 1 << 20

#: Copies one task makes of a row before the next task takes over.
COPIES_PER_TASK = 65536


def group_key(group: Sequence[str]) -> Column:
    """The group as one struct, so that null parts are equal; a group of all rows without columns."""
    return key_struct(group) if group else F.struct(F.lit(1).alias("all"))


def heavy_groups(df: DataFrame, group: Sequence[str], heavy: int) -> DataFrame | None:
    """``_g`` of the groups with more than ``heavy`` rows; None if there are none. Runs a job over the group columns."""
    sizes = df.groupBy(group_key(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy)
    found = stored(sizes.select("_g"), "heavy-groups")
    return None if found.isEmpty() else found


def _in_one_window(keyed: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    before = W.partitionBy("_g").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return keyed.withColumn(out, F.coalesce(F.sum("_w").over(before), F.lit(0)))


def _in_ranges(keyed: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """The same for groups that one task should not order.

    The rows are written once in the order of group and values, with their place; what is summed over ranges is one
    row per group and range. A task that runs again reads the places that were written.
    """
    sort = [F.col("_g"), *order]
    placed = keyed.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed, "ordered").withColumn("_range", F.shiftright("_place", 33))
    sizes = placed.groupBy("_g", "_range").agg(F.sum("_w").alias("_n"))
    before = W.partitionBy("_g").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored(sizes.select("_g", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "offsets")
    inside = W.partitionBy("_g", "_range").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
    local = placed.withColumn("_local", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    return local.join(offsets, ["_g", "_range"]).withColumn(out, F.col("_offset") + F.col("_local"))


def start_in_order(df: DataFrame, group: Sequence[str], order: Sequence[Column], weight: Column, out: str,
                   heavy: int = HEAVY) -> DataFrame:
    """Add the total ``weight`` of the rows before each row of its group, in the given order.

    Rows that ``order`` does not tell apart come in any order among themselves. Runs a job that counts the groups.
    """
    keyed = df.select("*", group_key(group).alias("_g"), weight.cast("bigint").alias("_w"))
    large = heavy_groups(df, group, heavy)
    if large is None:
        placed = _in_one_window(keyed, order, out)
    else:
        parts = [_in_ranges(keyed.join(large, "_g", "left_semi"), order, out), _in_one_window(keyed.join(large, "_g", "left_anti"), order, out)]
        placed = parts[0].select(*cols([*df.columns, out])).unionByName(parts[1].select(*cols([*df.columns, out])))
    return placed.select(*cols([*df.columns, out]))


def number_in_order(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str, heavy: int = HEAVY) -> DataFrame:
    """Number rows 1..n per group in the given order, whatever the group's size."""
    numbered = start_in_order(df, group, order, F.lit(1), "_start", heavy)
    return numbered.select(*cols(df.columns), (F.col("_start") + 1).alias(out))


def repeat_rows(df: DataFrame, times: str, out: str, per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Repeat each row ``times`` times, numbering the copies from 0 in ``out``.

    Copies are made in blocks that are spread over the cluster first, so one row
    with billions of copies does not keep one task busy. Rows with ``times`` 0
    vanish.
    """
    held = [c for c in df.columns if c != times]
    blocks = df.where(F.col(times) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(times) - 1) / per_task)))
    )
    first = F.col("_block") * per_task
    last = F.least(first + per_task, F.col(times)) - 1
    spread = blocks.repartition(F.xxhash64(*cols(held)), F.col("_block"))
    return spread.select(*cols(held), F.explode(F.sequence(first, last)).alias(out))
