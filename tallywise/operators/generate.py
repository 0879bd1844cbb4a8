"""Generated, augmented and rebalanced rows; the same for every run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions.columns import col, cols, key_struct
from tallywise.functions.hashing import hash_uniform, pick
from tallywise.operators.frames import append_rows
from tallywise.operators.numbering import number_in_order, repeat_rows
from tallywise.session import stored

#: Builds a column from a uniform number and the row's id.
Maker = Callable[[Column, Column], Column]


def date_between(start: str, days: int) -> Maker:
    return lambda u, _: F.date_add(F.lit(start).cast("date"), F.floor(u * days).cast("int"))


def numbered_label(prefix: str, width: int = 3) -> Maker:
    """``Customer 007`` from the row's id; longer ids are kept whole."""
    def make(_: Column, ident: Column) -> Column:
        digits = ident.cast("string")
        return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))
    return make


def amount_between(low: float, high: float, negative_share: float = 0.0) -> Maker:
    """An amount with two decimals; a share of them turns negative."""
    def make(u: Column, ident: Column) -> Column:
        value = F.round(F.lit(low) + u * (high - low), 2)
        sign = F.when(hash_uniform(ident, "sign") < negative_share, -1.0).otherwise(1.0)
        return value * sign
    return make


def integer_between(low: int, high: int) -> Maker:
    return lambda u, _: (F.floor(u * (high - low + 1)) + low).cast("int")


def one_of(values: Sequence) -> Maker:
    return lambda u, _: pick(u, list(values))


def id_range(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def synthesise(ids: DataFrame, id_col: str, spec: Mapping[str, Maker], seed: int = 0) -> DataFrame:
    """One made-up row per id; no shuffle, each row depends on its id alone."""
    ident = col(id_col)
    return ids.select(ident, *[
        make(hash_uniform(ident, name, seed), ident).alias(name) for name, make in spec.items()
    ])


def synthesise_series(ids: DataFrame, id_col: str, start: str, days: int, base: float, spread: float,
                      weekend_factor: float, seed: int = 0) -> DataFrame:
    """A daily series per id with weekend peaks: ``id, date, total_sales``."""
    first = F.lit(start).cast("date")
    daily = ids.select(col(id_col), F.explode(F.sequence(first, F.date_add(first, days - 1))).alias("date"))
    ident = F.concat_ws("/", col(id_col).cast("string"), F.date_format("date", "yyyy-MM-dd"))
    noise = F.lit(base) + hash_uniform(ident, "sales", seed) * spread
    factor = F.when(F.dayofweek("date").isin(1, 7), weekend_factor).otherwise(1.0)
    return daily.select(col(id_col), "date", F.round(noise * factor, 2).alias("total_sales"))


def replicate(df: DataFrame, row_id: str, group: Sequence[str], needed: DataFrame, out: str) -> DataFrame:
    """Copy rows round-robin until each group got as many copies as ``needed``.

    ``needed`` holds ``group…, n_rows, n_needed``. The rows of a group are
    numbered by ``row_id``; each is copied ``n_needed div n_rows`` times and the
    first ``n_needed mod n_rows`` once more. Copies are numbered from 0.
    """
    names = df.columns
    if group:  # on the struct of all parts, so that a null class is one of them
        needed = needed.select(key_struct(group).alias("_gk"), "n_rows", "n_needed")
        df = df.withColumn("_gk", key_struct(group)).join(needed, "_gk", "left_semi").drop("_gk")
    numbered = number_in_order(df, group, [col(row_id)], "_idx")
    if group:
        sized = numbered.withColumn("_gk", key_struct(group)).join(needed, "_gk")
        rows, wanted = F.col("n_rows"), F.col("n_needed")
    else:
        sized = numbered
        rows, wanted = needed.select("n_rows").scalar(), needed.select("n_needed").scalar()
    whole = F.floor(wanted / rows)
    times = whole + F.when(F.col("_idx") <= wanted - whole * rows, 1).otherwise(0)
    counted = sized.select(*cols(names), times.cast("bigint").alias("_times"))
    return repeat_rows(counted, "_times", out)


def rebalance(df: DataFrame, label: str, row_id: str) -> DataFrame:
    """Raise every class to the size of the largest by copying its rows.

    Adds ``is_copy``. The copies are spread evenly over the rows of the class.
    """
    sizes = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n_rows"))
    largest = sizes.agg(F.max("n_rows").alias("n")).scalar()
    needed = stored(sizes.withColumn("n_needed", largest - F.col("n_rows")).where(F.col("n_needed") > 0), "deficits")
    copies = replicate(df, row_id, [label], needed, "_copy").drop("_copy")
    return append_rows(df.withColumn("is_copy", F.lit(0)), copies.withColumn("is_copy", F.lit(1)))


def augment(df: DataFrame, row_id: str, n: int | Column, jitter: Mapping[str, float],
            relation: tuple[str, str] | None = None, seed: int = 0) -> DataFrame:
    """``n`` new rows like the given ones: source rows in turn, numbers shifted.

    ``jitter`` maps numeric columns to the largest relative shift. With
    ``relation=(x, y)`` the value of ``y`` follows the shift of ``x`` along the
    least-squares line, which keeps their relation. Adds ``copy_no``.
    """
    wanted = n if isinstance(n, Column) else F.lit(n)
    needed = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_needed", wanted)
    copies = replicate(df, row_id, [], needed, "copy_no")
    ident = F.concat_ws("/", col(row_id).cast("string"), F.col("copy_no").cast("string"))
    shifted = {}
    for name, share in jitter.items():
        factor = 1 + F.lit(share) * (2 * hash_uniform(ident, name, seed) - 1)
        shifted[name] = F.round(col(name) * factor, 2)
    if relation is not None:
        x, y = relation
        slope = df.agg(F.regr_slope(col(y).cast("double"), col(x).cast("double")).alias("s")).scalar()
        shifted[y] = F.round(col(y) + slope * (shifted[x] - col(x)), 2)
    return copies.withColumns({c: v.cast(df.schema[c].dataType) for c, v in shifted.items()})


def inject_edge_cases(df: DataFrame, cases: DataFrame, fills: Mapping[str, Column]) -> DataFrame:
    """Append edge-case rows; columns the cases lack are filled by ``fills``."""
    absent = {c: v for c, v in fills.items() if c not in cases.columns}
    return append_rows(df, cases.withColumns(absent) if absent else cases)
