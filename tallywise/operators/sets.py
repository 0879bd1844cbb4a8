"""Set and multiset operators on keys and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallywise.functions.columns import col, cols, key_struct, value_struct
from tallywise.operators.frames import common_columns
from tallywise.operators.numbering import HEAVY, heavy_groups, repeat_rows, start_in_order
from tallywise.functions.hashing import spread_key


def row_counts(base: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per side with its number of rows."""
    tagged = base.select(F.lit("base").alias("side")).unionAll(actual.select(F.lit("actual").alias("side")))
    return tagged.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedupe_by_key(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the other columns, nulls first."""
    rest = [c for c in df.columns if c not in set(pk)]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*cols(pk)).agg(F.min(F.struct(*[col(c).alias(c) for c in rest])).alias("_row"))
    return kept.select(*[
        F.col("_row").getField(c).alias(c) if c in set(rest) else col(c) for c in df.columns
    ])


def duplicate_keys(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*cols(pk)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_rows(df: DataFrame, pk: Sequence[str], rest: Sequence[str] | None = None, keys: DataFrame | None = None,
                   heavy: int = HEAVY) -> DataFrame:
    """All rows of a key but its survivor, numbered from 2 in ``rn`` by their values, nulls first.

    ``keys`` restricts the rows to keys of that frame, each once. The rows meet by key once: join, folding of identical
    rows and numbering use the same partitions. Keys of more than ``heavy`` rows are folded first and then numbered in
    ranges. Runs a job that counts the keys.
    """
    rest = [c for c in df.columns if c not in set(pk)] if rest is None else list(rest)
    order = [c.asc_nulls_first() for c in cols(rest)] or [F.lit(1)]
    keyed = df.select(*cols(rest), key_struct(pk).alias("_key"))
    large = heavy_groups(df, pk, heavy)
    large = None if large is None else large.withColumnRenamed("_g", "_key")

    def restricted(rows: DataFrame) -> DataFrame:
        return rows if keys is None else rows.join(keys.select(key_struct(pk).alias("_key")), "_key", "left_semi")

    def folded(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_key", *cols(rest)).agg(F.count(F.lit(1)).alias("_n"))

    light = folded(restricted(keyed if large is None else keyed.join(large, "_key", "left_anti")))
    before = W.partitionBy("_key").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = light.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if large is not None:
        split = start_in_order(folded(restricted(keyed.join(large, "_key", "left_semi"))), ["_key"], order, F.col("_n"), "_start", heavy=0)
        placed = placed.unionByName(split)
    first = F.when(F.col("_start") == 0, 1).otherwise(0)  # the survivor itself
    excess = placed.where("_start + _n > 1").select("_key", *cols(rest), (F.col("_start") + first).alias("_start"), (F.col("_n") - first).alias("_n"))
    copies = repeat_rows(excess, "_n", "_copy")
    rn = F.col("_start") + F.col("_copy") + 1
    return copies.select(*[F.col("_key").getField(k).alias(k) for k in pk], *cols(rest), rn.alias("rn"))


def _tagged(base: DataFrame, actual: DataFrame, names: Sequence[str]) -> DataFrame:
    b = base.select(*cols(names), F.lit(1).alias("_in_base"), F.lit(0).alias("_in_actual"))
    a = actual.select(*cols(names), F.lit(0).alias("_in_base"), F.lit(1).alias("_in_actual"))
    return b.unionAll(a)


def presence(base: DataFrame, actual: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each distinct ``names`` tuple with its row count per side, in one exchange."""
    return _tagged(base, actual, names).groupBy(*cols(names)).agg(
        F.sum("_in_base").alias("_nb"), F.sum("_in_actual").alias("_na")
    )


def side_of_counts() -> Column:
    return F.when(F.col("_na") == 0, "base").when(F.col("_nb") == 0, "actual").otherwise("both")


def extra_keys(base: DataFrame, actual: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Distinct keys found on one side only."""
    counts = presence(base, actual, pk).where((F.col("_nb") == 0) | (F.col("_na") == 0))
    return counts.select(side_of_counts().alias("side"), *cols(pk))


def common_keys(base: DataFrame, actual: DataFrame, pk: Sequence[str]) -> DataFrame:
    counts = presence(base, actual, pk)
    return counts.where((F.col("_nb") > 0) & (F.col("_na") > 0)).select(*cols(pk))


def multiset_diff(base: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between the sides."""
    names = common_columns(base, actual)
    counts = presence(base, actual, names).where(F.col("_nb") != F.col("_na"))
    return counts.select(*cols(names), F.col("_nb").alias("n_base"), F.col("_na").alias("n_actual"))


def row_except(base: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of one side with no identical row on the other, every copy kept."""
    names = common_columns(base, actual)
    counts = presence(base, actual, names).where((F.col("_nb") == 0) | (F.col("_na") == 0))
    alone = counts.select(side_of_counts().alias("side"), *cols(names), (F.col("_nb") + F.col("_na")).alias("_n"))
    return repeat_rows(alone, "_n", "_copy").drop("_copy")


def rows_with_keys(df: DataFrame, keys: DataFrame, pk: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) in ``keys``.

    ``keys`` must hold each key once. The adaptive planner broadcasts it when it
    turns out small and splits skewed row partitions otherwise.
    """
    left = df.withColumn("_k", key_struct(pk))
    right = keys.select(key_struct(pk).alias("_k"))
    return left.join(right, "_k", how).drop("_k")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, out: str = "rn") -> DataFrame:
    """First ``n`` rows of each group.

    The planner cuts each group to ``n`` rows on the map side as long as ``n`` is
    under its limit. Beyond it the cut is made here, by hash buckets.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    ranked = df
    if n >= limit:
        salted = df.withColumn("_salt", F.substring(spread_key(cols(df.columns)), 1, 3))
        inner = W.partitionBy(*cols(group), F.col("_salt")).orderBy(*order)
        ranked = salted.withColumn(out, F.row_number().over(inner)).where(F.col(out) <= n).drop(out, "_salt")
    outer = W.partitionBy(*cols(group)).orderBy(*order)
    kept = ranked.withColumn(out, F.row_number().over(outer)).where(F.col(out) <= n)
    return kept.withColumn(out, F.col(out).cast("bigint"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col(label))


def range_profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Smallest and largest value per column, in one pass; negative zero counts as zero."""
    ends = df.agg(*[
        agg(col(c)).alias(f"{tag}{i}") for i, c in enumerate(names) for tag, agg in (("lo", F.min), ("hi", F.max))
    ])
    rows = [
        F.struct(F.lit(c).alias("col_name"), (F.col(f"lo{i}").cast("double") + 0.0).alias("min_value"),
                 (F.col(f"hi{i}").cast("double") + 0.0).alias("max_value"))
        for i, c in enumerate(names)
    ]
    return ends.select(F.inline(F.array(*rows)))


def smallest_value(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A representative value per column: the smallest, so that it is the same each run."""
    return df.agg(*[F.min(col(c)).alias(c) for c in names])


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(col(name)).distinct()
