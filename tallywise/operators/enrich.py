"""Filling missing values and the seam for a caller's own model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from string import Formatter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tallywise.functions.columns import JSON_OPTIONS, col, cols, key_struct
from tallywise.functions.records import fill_missing, missing_as_null
from tallywise.session import stored


# -- model seam ---------------------------------------------------------------

def render_prompt(df: DataFrame, template: str, out: str = "prompt") -> DataFrame:
    """Fill ``{column}`` places of a template; ``{*}`` stands for the row as JSON."""
    parts = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field == "*":
            parts.append(F.to_json(F.struct(*cols(df.columns)), JSON_OPTIONS))
        elif field:
            parts.append(F.coalesce(col(field).cast("string"), F.lit("None")))
    return df.withColumn(out, F.concat(*parts))


def map_distinct(df: DataFrame, column: str, fn: Callable[[pd.Series], pd.DataFrame], schema: str,
                 parallelism: int | None = None) -> DataFrame:
    """Apply ``fn`` to each distinct value once and join the results back.

    ``fn`` takes a series of values and returns a frame with the columns of
    ``schema``, in the same order. ``parallelism`` sets how many tasks call it.
    Results are stored before the join, so no retry pays for the calls again.
    """
    values = df.select(col(column).alias("_value")).where(F.col("_value").isNotNull()).distinct()
    if parallelism:
        values = values.repartition(parallelism, "_value")
    kind = df.schema[column].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = fn(batch["_value"]).reset_index(drop=True)
            if len(found) != len(batch):
                raise ValueError(f"the model gave {len(found)} answers for {len(batch)} values")
            found.insert(0, "_value", batch["_value"].reset_index(drop=True))
            yield found

    results = stored(values.mapInPandas(score, f"_value {kind}, {schema}"), "responses")
    joined = df.join(results, col(column) == F.col("_value"), "left")
    return joined.drop("_value")


def merge_response(df: DataFrame, response: str, schema: str, names: Mapping[str, str]) -> DataFrame:
    """Fill missing columns from a JSON response; values that are there stay.

    ``names`` maps a column to the response field it is filled from.
    """
    parsed = F.from_json(col(response), schema)
    fills = {
        c: fill_missing(col(c), parsed.getField(field).try_cast(df.schema[c].dataType), df.schema[c].dataType.simpleString())
        for c, field in names.items()
    }
    return df.withColumns(fills).drop(response)


# -- imputation ---------------------------------------------------------------

def impute_lookup(df: DataFrame, target: str, key: str, ref: DataFrame) -> DataFrame:
    """Fill ``target`` from ``ref(key, target)``; of several matches the smallest."""
    known = ref.groupBy(col(key)).agg(F.min(col(target)).alias("_found"))
    joined = df.join(known, [key], "left")
    kind = df.schema[target].dataType.simpleString()
    return joined.withColumn(target, fill_missing(col(target), F.col("_found"), kind)).select(*cols(df.columns))


def group_mode(df: DataFrame, group: Sequence[str], column: str, out: str) -> DataFrame:
    """The most frequent value per group; ties go to the smallest value.

    Two map-side combined aggregations, so no group is gathered in one place.
    """
    counts = (
        df.where(col(column).isNotNull())
        .groupBy(*cols(group), col(column).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    best = F.min(F.struct((-F.col("_n")).alias("rank"), F.col("_v").alias("v")))
    return counts.groupBy(*cols(group)).agg(best.alias("_best")).select(
        *cols(group), F.col("_best").getField("v").alias(out)
    )


def impute_any(df: DataFrame, targets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fill each target by the most frequent value among rows that share its columns.

    Every target looks at the rows as they came, not at values filled before. A
    row that lacks one of the shared columns itself is not filled.
    """
    out = df
    for i, (target, by) in enumerate(targets.items()):
        known = df.dropna(subset=list(by))
        modes = group_mode(known, by, target, f"_m{i}").select(key_struct(by).alias("_k"), f"_m{i}")
        modes = stored(modes, "modes")
        out = out.withColumn("_k", key_struct(by)).join(modes, "_k", "left").drop("_k")
    place = {target: i for i, target in enumerate(targets)}
    return out.select(*[
        F.coalesce(col(c), F.col(f"_m{place[c]}")).alias(c) if c in place else col(c) for c in df.columns
    ])


#: Ranks, as a share of a group, that an approximate quantile may be off by.
RANK_ERROR = 1e-4


def exact_median(df: DataFrame, by: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """``_k`` (the group) and ``_f0``, ``_f1``, … (the lower median of each target), exact for groups of any size.

    A bounded-memory quantile brackets the median on both sides by more than its error. The values below the bracket
    are only counted; those inside, about ``4 * RANK_ERROR`` of a group, are counted per value, and the one that holds
    the middle rank is the median. So no group is sorted or held. Missing values (null, NaN) do not count. Runs jobs.
    """
    group = key_struct(by) if by else F.struct(F.lit(1).alias("all"))
    values = {i: missing_as_null(col(c), df.schema[c].dataType.simpleString()).cast("double") for i, c in enumerate(targets)}
    brackets = [
        F.percentile_approx(v, [0.5 - 2 * RANK_ERROR, 0.5 + 2 * RANK_ERROR], int(1 / RANK_ERROR)).alias(f"_b{i}") for i, v in values.items()
    ]
    bounds = stored(df.groupBy(group.alias("_k")).agg(*brackets, *[F.count(v).alias(f"_n{i}") for i, v in values.items()]), "median-brackets")
    rows = df.select(group.alias("_k"), *[v.alias(f"_v{i}") for i, v in values.items()]).join(bounds, "_k")

    def place(i: int) -> Column:
        """A value of the bracket stands for itself, one below it for all such, one above for none."""
        value, bracket = F.col(f"_v{i}"), F.col(f"_b{i}")
        inside = (value >= bracket[0]) & (value <= bracket[1])
        return F.struct(F.lit(i).alias("i"), F.when(inside, value).alias("v"), (inside | (value < bracket[0])).alias("low"), F.col(f"_n{i}").alias("n"))

    placed = rows.select("_k", F.inline(F.array(*[place(i) for i in values]))).where("low")
    counts = placed.groupBy("_k", "i", "n", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(W.partitionBy("_k", "i").orderBy(F.col("v").asc_nulls_first()))
    middle = counts.select("_k", "i", "v", (upto > F.floor((F.col("n") - 1) / 2)).alias("reached")).where("reached and v is not null")
    medians = stored(middle.groupBy("_k", "i").agg(F.min("v").alias("m")), "medians")
    out = bounds.select("_k")
    for i in values:
        out = out.join(medians.where(F.col("i") == i).select("_k", F.col("m").alias(f"_f{i}")), "_k", "left")
    return out


def impute_numeric(df: DataFrame, targets: Mapping[str, str], by: Sequence[str] = (), how: str = "mean") -> DataFrame:
    """Fill numeric columns by the mean or median of their group.

    ``targets`` maps a column to the type of the result. The median is exact (see ``exact_median``); of an even number
    of values it is the lower one in the middle.
    """
    def mean(name: str) -> Column:
        own = df.schema[name].dataType
        # Sums of integers and decimals are exact and so do not depend on the order rows arrive in.
        if isinstance(own, T.IntegralType):
            return (F.sum(col(name).cast("decimal(20,0)")) / F.count(col(name))).cast("double")
        if isinstance(own, T.DecimalType):
            return F.avg(col(name)).cast("double")
        return F.avg(missing_as_null(col(name), own.simpleString()).cast("double"))

    group = key_struct(by) if by else F.struct(F.lit(1).alias("all"))
    if how == "mean":
        stats = df.groupBy(group.alias("_k")).agg(*[mean(c).alias(f"_f{i}") for i, c in enumerate(targets)])
    elif how == "median":
        stats = exact_median(df, by, list(targets))
    else:
        raise ValueError(f"unknown method {how!r}")
    if by:
        joined = df.withColumn("_k", group).join(stored(stats, "group-stats"), "_k", "left")
        filled = {c: F.col(f"_f{i}") for i, c in enumerate(targets)}
    else:
        joined = df
        stats = stored(stats, "group-stats") if how == "median" else df.agg(*[mean(c).alias(f"_f{i}") for i, c in enumerate(targets)])
        filled = {c: stats.select(f"_f{i}").scalar() for i, c in enumerate(targets)}
    return joined.select(*[
        _typed_fill(df, c, filled[c], targets[c]) if c in targets else col(c) for c in df.columns
    ])


def _typed_fill(df: DataFrame, name: str, fill: Column, kind: str) -> Column:
    """Values that are there keep their own type until the cast to ``kind``; only the fill goes through double."""
    own = df.schema[name].dataType
    there = missing_as_null(col(name), own.simpleString())
    if kind in ("int", "bigint"):
        fill = F.round(fill)
        there = F.round(there) if isinstance(own, T.FractionalType) else there
    return F.coalesce(there.cast(kind), fill.cast(kind)).alias(name)


def impute_regression(df: DataFrame, target: str, predictor: str, kind: str = "double") -> DataFrame:
    """Fill ``target`` on the least-squares line over ``predictor``."""
    y, x = col(target).cast("double"), col(predictor).cast("double")
    line = df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    guess = line.select("slope").scalar() * x + line.select("intercept").scalar()
    return df.select(*[_typed_fill(df, c, guess, kind) if c == target else col(c) for c in df.columns])


# -- time series --------------------------------------------------------------

def fill_series(df: DataFrame, ts: str, value: str, keys: Sequence[str] = (), how: str = "locf",
                chunk_days: int = 366) -> DataFrame:
    """A gapless daily series per key with missing values filled.

    ``locf`` carries the last value forward, ``linear`` interpolates between the
    neighbours; gaps at the end carry forward and gaps at the start backward.
    ``df`` holds at most one row per key and day; further ones come back as they are.

    Series are cut into chunks of days. Windows over the rows run inside chunks;
    what a chunk must know of the others comes from one row per chunk, so a long
    series is not one task's work. Each row then makes the days up to the next.
    """
    if how not in ("locf", "linear"):
        raise ValueError(f"unknown method {how!r}")
    kind = df.schema[value].dataType.simpleString()
    known = df.select(
        (key_struct(keys) if keys else F.struct(F.lit(1).alias("all"))).alias("_k"),
        F.to_date(col(ts)).alias("_day"), missing_as_null(col(value), kind).cast("double").alias("_v"),
        missing_as_null(col(value), kind).alias("_as_is"),
    ).where(F.col("_day").isNotNull())
    chunk = F.floor(F.unix_date("_day") / chunk_days).cast("int")
    point = F.when(F.col("_v").isNotNull(), F.struct(F.col("_day").alias("d"), F.col("_v").alias("v")))
    known = known.select("_k", "_day", "_v", "_as_is", chunk.alias("_c"), point.alias("_p"))

    chunks = known.groupBy("_k", "_c").agg(
        F.min("_day").alias("_first_day"), F.min("_p").alias("_first"), F.max("_p").alias("_last")
    )
    up = W.partitionBy("_k").orderBy("_c").rowsBetween(W.unboundedPreceding, -1)
    down = W.partitionBy("_k").orderBy(F.desc("_c"))
    around = chunks.select(
        "_k", "_c",
        F.last("_last", ignorenulls=True).over(up).alias("_before"),
        F.last("_first", ignorenulls=True).over(down.rowsBetween(W.unboundedPreceding, -1)).alias("_after"),
        F.lag("_first_day").over(down).alias("_next_chunk"),
    )
    inside = W.partitionBy("_k", "_c")
    later = inside.orderBy(F.desc("_day"))
    near = known.select(
        "_k", "_c", "_day", "_v", "_as_is",
        F.last("_p", ignorenulls=True).over(inside.orderBy("_day").rowsBetween(W.unboundedPreceding, 0)).alias("_up"),
        F.last("_p", ignorenulls=True).over(later.rowsBetween(W.unboundedPreceding, -1)).alias("_down"),
        F.lag("_day").over(later).alias("_next_day"),
    ).join(around, ["_k", "_c"])
    until = F.greatest(F.date_sub(F.coalesce("_next_day", "_next_chunk", F.date_add("_day", 1)), 1), "_day")
    days = near.select(
        "_k", "_v", "_as_is", F.coalesce("_up", "_before").alias("_prev"), F.coalesce("_down", "_after").alias("_following"),
        F.col("_day").alias("_own"), F.explode(F.sequence("_day", until)).alias("_day"),
    )
    prev, following = F.col("_prev"), F.col("_following")
    guess = F.coalesce(prev.getField("v"), following.getField("v"))
    if how == "linear":
        span = F.date_diff(following.getField("d"), prev.getField("d"))
        share = F.date_diff(F.col("_day"), prev.getField("d")) / span
        between = prev.getField("v") + (following.getField("v") - prev.getField("v")) * share
        guess = F.when(prev.isNotNull() & following.isNotNull(), between).otherwise(guess)
    measured = F.when(F.col("_day") == F.col("_own"), F.col("_as_is"))
    if isinstance(df.schema[value].dataType, (T.IntegralType, T.DecimalType)):  # values that are there stay as they are
        guess = (F.round(guess) if isinstance(df.schema[value].dataType, T.IntegralType) else guess).cast(df.schema[value].dataType)
    parts = [F.col("_k").getField(k).alias(k) for k in keys]
    return days.select(*parts, F.col("_day").alias(ts), F.coalesce(measured, guess).alias(value),
                       measured.isNull().alias("filled"))
