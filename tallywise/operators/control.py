"""Control totals of two sides, exact whatever the size, sign and order of the values."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.functions.columns import col

#: Decimal digits of the lower part of a value; the parts are summed apart, so no sum can overflow.
LOW = 18
_SUMMED = "decimal(28,0)"
#: Totals without a decimal text.
NAN, POSITIVE, NEGATIVE = "NaN", "Infinity", "-Infinity"


def _parts(value: Column, data_type: T.DataType) -> Column:
    """Struct ``power, high, low, special``: a number is ``(high * 10**LOW + low) * 10**power``, or it is special.

    A floating-point value counts as the decimal that its text shows, so 0.1 and 0.2 make 0.3.
    """
    if isinstance(data_type, T.IntegralType):
        return F.struct(
            F.lit(0).alias("power"), F.lit(0).cast(_SUMMED).alias("high"), value.cast(_SUMMED).alias("low"),
            F.lit(None).cast("string").alias("special"),
        )
    text = value.cast("string")
    special = F.when(text.isin(NAN, POSITIVE, NEGATIVE), text)
    mantissa = F.substring_index(text, "E", 1)
    power = F.when(text.contains("E"), F.substring_index(text, "E", -1).try_cast("int")).otherwise(0)
    power = power - F.when(mantissa.contains("."), F.length(F.substring_index(mantissa, ".", -1))).otherwise(0)
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):  # 17 digits at most
        high, low = F.lit(0).cast(_SUMMED), digits.try_cast(_SUMMED)
    else:
        sign = F.when(digits.startswith("-"), F.lit("-")).otherwise("")
        plain = F.replace(digits, F.lit("-"), F.lit(""))
        begin = F.greatest(F.length(plain) - LOW, F.lit(0))
        low = F.concat(sign, F.substring(plain, begin + 1, F.lit(LOW))).cast(_SUMMED)
        high = F.when(begin > 0, F.concat(sign, F.substring(plain, F.lit(1), begin)).cast(_SUMMED)).otherwise(F.lit(0).cast(_SUMMED))
    return F.struct(power.alias("power"), high.alias("high"), low.alias("low"), special.alias("special"))


def plain_text(number: int, power: int) -> str:
    """``number * 10**power`` in plain decimals, without trailing zeros behind the point."""
    if power >= 0:
        return str(number * 10**power)
    sign, digits = "-" if number < 0 else "", str(abs(number)).rjust(1 - power, "0")
    return (sign + digits[:power] + "." + digits[power:]).rstrip("0").rstrip(".")


def _total(parts: list[dict]) -> tuple[str | None, tuple[int, int] | None]:
    """The text of one side's total, and as number and power of ten where it is finite; None of no values."""
    specials = {p["special"] for p in parts} - {None}
    if specials:
        return (specials.pop() if len(specials) == 1 else NAN), None
    if not parts:
        return None, None
    least = min(p["power"] for p in parts)
    number = sum((int(p["high"]) * 10**LOW + int(p["low"])) * 10 ** (p["power"] - least) for p in parts)
    return plain_text(number, least), (number, least)


def _combined(metrics: list[str]):
    kind = pa.list_(pa.struct([(x, pa.string()) for x in ("metric", "base_exact", "actual_exact", "delta_exact")]))

    def combine(found: pa.Array) -> pa.Array:
        rows = []
        for bins in found.to_pylist():
            out = []
            for i, metric in enumerate(metrics):
                (b, x), (a, y) = (_total([p for p in bins if p["i"] == i and p["side"] == side]) for side in ("b", "a"))
                delta = None
                if x and y:
                    least = min(x[1], y[1])
                    delta = plain_text(y[0] * 10 ** (y[1] - least) - x[0] * 10 ** (x[1] - least), least)
                elif a is not None and b is not None:
                    delta = NAN if a == b or NAN in (a, b) else a if y is None else NEGATIVE if b == POSITIVE else POSITIVE
                out.append({"metric": metric, "base_exact": b, "actual_exact": a, "delta_exact": delta})
            rows.append(out)
        return pa.array(rows, kind)

    return combine


def exact_totals(base: DataFrame, actual: DataFrame, sum_cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """``metric, base_exact, actual_exact, delta_exact``: the sums of both sides as decimal texts of any length.

    Values are split into digits and a power of ten. Digits are summed as integers per power, which partial sums and
    any order of rows leave the same, and a side's few powers are put together once. A side with a NaN, or with both
    infinities, totals NaN; one with an infinity totals that. Nulls do not count; a side without values totals null.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        df = df if where is None else df.where(where)
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(tag).alias("side"), F.lit(i).alias("i"), col(c).isNotNull().alias("there"), _parts(col(c), df.schema[c].dataType).alias("p"))
            for i, c in enumerate(sum_cols)
        ]))).where("there").select("side", "i", "p.*")

    bins = side(base, "b").unionByName(side(actual, "a")).groupBy("side", "i", "power", "special").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")
    )
    text = [F.col(c).cast("string").alias(c) for c in ("high", "low")]
    # At most two rows per column for each power of ten that doubles have.
    packed = bins.select("side", "i", "power", "special", *text).agg(
        F.collect_list(F.struct("side", "i", "power", "special", "high", "low")).alias("bins")
    )
    combine = F.arrow_udf(
        _combined(list(sum_cols)), "array<struct<metric:string,base_exact:string,actual_exact:string,delta_exact:string>>"
    )
    return packed.select(F.inline(combine("bins")))


def control_total(base: DataFrame, actual: DataFrame, sum_cols: Sequence[str], where: Column | None = None,
                  scale: int | None = 2) -> DataFrame:
    """Sums of both sides and their difference, one row per column.

    ``ok`` compares the exact totals of :func:`exact_totals`, so 1e-13 counts beside 1e30; two NaN totals are equal, as
    are equal infinities. ``scale`` rounds only what is shown, as decimal(38, scale), where a total that does not fit,
    NaN or infinite, shows as null. With None the exact texts are shown.
    """
    def shown(text: str) -> Column:
        return F.col(text) if scale is None else F.col(text).try_cast(f"decimal(38,{scale})")

    totals = exact_totals(base, actual, sum_cols, where)
    return totals.select(
        "metric", shown("base_exact").alias("base_value"), shown("actual_exact").alias("actual_value"),
        shown("delta_exact").alias("delta"), F.col("base_exact").eqNullSafe(F.col("actual_exact")).alias("ok"),
    )
