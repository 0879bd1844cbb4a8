"""Key-based comparison of two frames.

Both sides are tagged, put under each other and grouped by key once. The grouped
frame, ``pairs``, holds per key the surviving row and the row count of each side;
nearly every result is a projection or aggregation of it. Grouping folds the rows
of a heavy key on the map side and treats null key parts as equal, which a join
of the two sides would not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.functions.columns import (
    JSON_OPTIONS, NO_VALUES, as_text, col, cols, literal_sql, quoted, texts, value_struct,
)
from tallywise.functions.compare import differs, differs_sql
from tallywise.operators import sets
from tallywise.operators.frames import cast_all_string, common_columns, drop_columns, maps_as_text, require_columns
from tallywise.session import scratch_path, stored


@dataclass(frozen=True)
class Comparison:
    """Lazy results of comparing ``actual`` with ``base`` by ``pk``."""

    base: DataFrame
    actual: DataFrame
    pk: tuple[str, ...]
    columns: tuple[str, ...]
    value_mode: str = "string"
    tolerance: int | None = None
    co_located: bool = False
    stored_findings: DataFrame | None = None
    clean_keys: int = 0

    # -- the keyed frame ---------------------------------------------------

    def _tagged(self, df: DataFrame, is_base: bool) -> DataFrame:
        return df.select(*cols(self.pk), F.lit(is_base).alias("_base"), value_struct(self.columns).alias("_row"))

    @cached_property
    def pairs(self) -> DataFrame:
        """``pk…, _b, _a, _nb, _na``: survivors and row counts per key.

        The survivor is the smallest row by the compared columns, nulls first.
        Presence is told by the counts, never by the structs.
        """
        if not self.co_located:
            return self._grouped_pairs(self.base, self.actual)
        keyed = reduce(and_, (col(k).isNotNull() for k in self.pk))
        known = self._joined_pairs(self.base.where(keyed), self.actual.where(keyed))
        return known.unionByName(self._grouped_pairs(self.base.where(~keyed), self.actual.where(~keyed)))

    def _grouped_pairs(self, base: DataFrame, actual: DataFrame) -> DataFrame:
        both = self._tagged(base, True).unionAll(self._tagged(actual, False))
        on_base = F.col("_base")
        return both.groupBy(*cols(self.pk)).agg(
            F.min(F.when(on_base, F.col("_row"))).alias("_b"),
            F.min(F.when(~on_base, F.col("_row"))).alias("_a"),
            F.count(F.when(on_base, True)).alias("_nb"),
            F.count(F.when(~on_base, True)).alias("_na"),
        )

    def _joined_pairs(self, base: DataFrame, actual: DataFrame) -> DataFrame:
        """Pairs of keys without nulls, grouping each side and joining on the bare key columns.

        Keeps the partitioning of tables bucketed by the key, which a union loses.
        """
        def side(df: DataFrame, row: str, count: str) -> DataFrame:
            return df.groupBy(*cols(self.pk)).agg(
                F.min(value_struct(self.columns)).alias(row), F.count(F.lit(1)).alias(count)
            )

        joined = side(base, "_b", "_nb").join(side(actual, "_a", "_na"), list(self.pk), "full")
        zero = F.lit(0).cast("bigint")
        return joined.select(*cols(self.pk), "_b", "_a", *[F.coalesce(n, zero).alias(n) for n in ("_nb", "_na")])

    @property
    def findings(self) -> DataFrame:
        """``pairs``, or what was stored of it: every key there is something to say about."""
        return self.pairs if self.stored_findings is None else self.stored_findings

    def stored(self, path: str | None = None) -> Comparison:
        """Write the findings to the shared folder and go on from there.

        Keys with one equal row on each side are left out and only counted, so
        what is written grows with the differences, not with the data. Worth it
        before taking several results: they share one shuffle, and a lost
        executor costs no recomputation.
        """
        spark = self.base.sparkSession
        path = path or scratch_path(spark, "findings")
        clean = (F.col("_nb") == 1) & (F.col("_na") == 1) & F.col("_b").eqNullSafe(F.col("_a"))
        self.pairs.where(~clean).write.parquet(path)
        findings = spark.read.parquet(path)
        found = findings.agg(F.coalesce(F.sum("_nb"), F.lit(0))).first()[0]
        return replace(self, stored_findings=findings, clean_keys=self.base.count() - found)

    def suspect_keys(self) -> DataFrame:
        """Keys on both sides that may hold a change, found without moving rows.

        Rows travel as two 64-bit hashes that also tell which cells are null.
        Keys with several rows on a side are always kept. A changed key escapes
        only if both hashes collide.
        """
        def hashed(df: DataFrame, is_base: bool) -> DataFrame:
            marks = [part for c in self.columns for part in (as_text(col(c), df.schema[c].dataType), col(c).isNull())]
            return df.select(*cols(self.pk), F.lit(is_base).alias("_base"),
                             F.xxhash64(F.lit(0), *marks).alias("_h"), F.xxhash64(F.lit(1), *marks).alias("_i"))

        both = hashed(self.base, True).unionAll(hashed(self.actual, False))
        on_base = F.col("_base")
        keys = both.groupBy(*cols(self.pk)).agg(
            F.count(F.when(on_base, True)).alias("_nb"),
            F.count(F.when(~on_base, True)).alias("_na"),
            *[F.min(F.when(on_base if side == "_b" else ~on_base, F.col(h))).alias(h + side)
              for h in ("_h", "_i") for side in ("_b", "_a")],
        )
        several = (F.col("_nb") > 1) | (F.col("_na") > 1)
        unequal = (F.col("_h_b") != F.col("_h_a")) | (F.col("_i_b") != F.col("_i_a"))
        return keys.where(self._on_both & (several | unequal)).select(*cols(self.pk))

    def narrowed(self) -> Comparison:
        """The comparison of the suspect keys' rows only.

        For wide tables that hardly differ: the inputs are read twice, but only
        hashes and the rows of suspect keys are shuffled. Changed cells, rows and
        their counts are those of the whole; results on extra or duplicate keys
        are not.
        """
        keys = stored(self.suspect_keys(), "suspect-keys")
        return replace(
            self, base=sets.rows_with_keys(self.base, keys, self.pk), actual=sets.rows_with_keys(self.actual, keys, self.pk)
        )

    # -- output columns ----------------------------------------------------

    def _shown(self, column: Column, name: str) -> Column:
        """A column as results show it: text in string mode."""
        if self.value_mode != "string":
            return column.alias(name)
        return as_text(column, self.base.schema[name].dataType).alias(name)

    def _keys(self) -> list[Column]:
        return [self._shown(col(k), k) for k in self.pk]

    def _rows(self, df: DataFrame, first: Sequence[str] = (), last: Sequence[str] = ()) -> DataFrame:
        """Key and compared columns as results show them, between plain ones."""
        return df.select(*first, *self._keys(), *[self._shown(col(c), c) for c in self.columns], *last)

    # -- cells -------------------------------------------------------------
    # Built as SQL text: with hundreds of columns, composing Column objects one
    # by one takes longer than planning.

    def cell_differs_sql(self, name: str) -> str:
        return differs_sql(f"_b.{quoted(name)}", f"_a.{quoted(name)}", self.tolerance)

    def cell_text_sql(self, side: str, name: str) -> str:
        """A cell as text; unequal arrays, structs and maps never share one."""
        if isinstance(self.base.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType)) and self.value_mode == "typed":
            options = ", ".join(literal_sql(x) for pair in JSON_OPTIONS.items() for x in pair)
            return f"to_json({side}.{quoted(name)}, map({options}))"
        return f"CAST({side}.{quoted(name)} AS STRING)"

    @property
    def _on_both(self) -> Column:
        return (F.col("_nb") > 0) & (F.col("_na") > 0)

    @property
    def row_differs(self) -> Column:
        """Whether a key on both sides has any differing cell."""
        if not self.columns:
            return F.lit(False)
        unequal = differs(F.col("_b"), F.col("_a"))
        if self.tolerance is not None:
            cells = ", ".join(self.cell_differs_sql(name) for name in self.columns)
            unequal = unequal & F.expr(f"exists(array({cells}), differing -> differing)")
        return self._on_both & unequal

    def changed_cells(self) -> DataFrame:
        """One row per differing cell: ``pk…, col_name, base_value, actual_value``."""
        cell = (
            "struct({text} AS col_name, {base} AS base_value, {actual} AS actual_value, {differs} AS differs)"
        )
        cells = ", ".join(
            cell.format(text=literal_sql(name), base=self.cell_text_sql("_b", name), actual=self.cell_text_sql("_a", name),
                        differs=self.cell_differs_sql(name))
            for name in self.columns
        ) or cell.format(text="''", base=f"_b.{quoted(NO_VALUES)}", actual=f"_a.{quoted(NO_VALUES)}", differs="false")
        changed = self.findings.where(self.row_differs)
        return changed.select(
            *self._keys(), F.expr(f"inline(filter(array({cells}), cell -> cell.differs))")
        ).drop("differs")

    def changed_rows(self) -> DataFrame:
        """Surviving rows of both sides whose key has a differing cell."""
        changed = self.findings.where(self.row_differs)
        sides = F.array(
            F.struct(F.lit("base").alias("side"), F.col("_b").alias("row")),
            F.struct(F.lit("actual").alias("side"), F.col("_a").alias("row")),
        )
        return self._sided_rows(changed.select(*cols(self.pk), F.inline(sides)))

    def _sided_rows(self, long: DataFrame) -> DataFrame:
        """``side, pk…, columns…`` from ``pk…, side, row``."""
        fields = [self._shown(F.col("row").getField(c), c) for c in self.columns]
        return long.select("side", *self._keys(), *fields)

    def column_counts(self) -> list[Column]:
        """One counter of differing cells per column, named ``c0, c1, …``."""
        return [
            F.expr(f"count_if(_nb > 0 AND _na > 0 AND {self.cell_differs_sql(name)})").alias(f"c{i}")
            for i, name in enumerate(self.columns)
        ]

    def _counted_columns(self) -> DataFrame:
        """``col_name, diff_count`` of every compared column.

        All counters run in a single aggregation, no cell is exploded.
        """
        if not self.columns:
            return self.base.sparkSession.createDataFrame([], "col_name string, diff_count bigint")
        rows = ", ".join(
            f"struct({literal_sql(name)} AS col_name, c{i} AS diff_count)" for i, name in enumerate(self.columns)
        )
        return self.findings.agg(*self.column_counts()).select(F.expr(f"inline(array({rows}))"))

    def column_diff_counts(self) -> DataFrame:
        """Differing cells per column; columns without any are absent."""
        return self._counted_columns().where(F.col("diff_count") > 0)

    def passed_columns(self) -> DataFrame:
        """Compared columns without a differing cell."""
        return self._counted_columns().where(F.col("diff_count") == 0).select("col_name")

    def wide_diff(self, names: Sequence[str] | None = None) -> DataFrame:
        """One row per changed key with ``<col>_baseline`` and ``<col>_actual``.

        Equal cells are null. Only columns that differ somewhere appear; unless
        given, their names are looked up first (one row per column).
        """
        if names is None:
            found = {row["col_name"] for row in self.column_diff_counts().select("col_name").collect()}
            names = [c for c in self.columns if c in found]
        shown = [
            F.expr(f"CASE WHEN {self.cell_differs_sql(name)} THEN {self.cell_text_sql(side, name)} END").alias(
                f"{name}_{label}"
            )
            for name in names for side, label in (("_b", "baseline"), ("_a", "actual"))
        ]
        return self.findings.where(self.row_differs).select(*self._keys(), *shown)

    # -- keys --------------------------------------------------------------

    def extra_keys(self) -> DataFrame:
        """Distinct keys of one side only."""
        alone = self.findings.where((F.col("_nb") == 0) | (F.col("_na") == 0))
        return alone.select(sets.side_of_counts().alias("side"), *self._keys())

    def common_keys(self) -> DataFrame:
        return self.pairs.where(self._on_both).select(*self._keys())

    def duplicate_keys(self) -> DataFrame:
        """Keys with several rows on a side, with their row count there."""
        per_side = F.array(
            F.struct(F.lit("base").alias("side"), F.col("_nb").alias("n")),
            F.struct(F.lit("actual").alias("side"), F.col("_na").alias("n")),
        )
        several = F.filter(per_side, lambda s: s["n"] > 1)
        held = self.findings.where((F.col("_nb") > 1) | (F.col("_na") > 1))
        return held.select(F.inline(several), *self._keys()).select("side", *cols(self.pk), "n")

    # -- rows of the un-deduplicated sides ----------------------------------

    def _shared(self, df: DataFrame) -> DataFrame:
        return df.select(*cols([*self.pk, *self.columns]))

    def duplicate_rows(self, common_only: bool = True) -> DataFrame:
        """Second and later rows per key and side, numbered from 2.

        The repeated keys are stored first. When they are few, as they should be,
        only their rows leave the scan.
        """
        repeated = self._repeated_keys.where(self._on_both) if common_only else self._repeated_keys
        parts = []
        for side, df, count in (("base", self.base, "_nb"), ("actual", self.actual, "_na")):
            keys = repeated.where(F.col(count) > 1)
            part = sets.duplicate_rows(self._shared(df), self.pk, self.columns, keys)
            parts.append(self._rows(part, [F.lit(side).alias("side")], ["rn"]))
        return parts[0].unionByName(parts[1])

    @cached_property
    def _repeated_keys(self) -> DataFrame:
        keys = self.findings.where((F.col("_nb") > 1) | (F.col("_na") > 1))
        return stored(keys.select(*cols(self.pk), "_nb", "_na"), "repeated-keys")

    @cached_property
    def _lonely_keys(self) -> DataFrame:
        keys = self.findings.where((F.col("_nb") == 0) | (F.col("_na") == 0))
        return stored(keys.select(*cols(self.pk), "_nb", "_na"), "extra-keys")

    def extra_rows(self, side: str) -> DataFrame:
        """All rows, with all their columns, whose key the other side lacks.

        The keys are stored first, as in ``duplicate_rows``.
        """
        df, other = (self.base, "_na") if side == "base" else (self.actual, "_nb")
        rows = sets.rows_with_keys(df, self._lonely_keys.where(F.col(other) == 0), self.pk)
        shown = texts(rows) if self.value_mode == "string" else cols(rows.columns)
        return rows.select(F.lit(side).alias("side"), *shown)

    def row_except(self, dedupe: bool = True) -> DataFrame:
        """Rows of one side with no identical row on the other.

        By default each side is first reduced to one row per key.
        """
        if not dedupe:
            return self._rows(sets.row_except(self._shared(self.base), self._shared(self.actual)), ["side"])
        sides = F.filter(
            F.array(
                F.struct(F.lit("base").alias("side"), F.col("_b").alias("row"), F.col("_nb").alias("n")),
                F.struct(F.lit("actual").alias("side"), F.col("_a").alias("row"), F.col("_na").alias("n")),
            ),
            lambda s: s["n"] > 0,
        )
        unequal = (F.col("_nb") == 0) | (F.col("_na") == 0) | differs(F.col("_b"), F.col("_a"))
        return self._sided_rows(self.findings.where(unequal).select(*cols(self.pk), F.inline(sides)))

    def multiset_diff(self) -> DataFrame:
        found = sets.multiset_diff(self._shared(self.base), self._shared(self.actual))
        return self._rows(found, last=["n_base", "n_actual"])


#: Types whose text is equal, and ordered, exactly when the values are.
_TEXT_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
#: Types whose text is equal exactly when the values are; enough for keys.
_KEY_LIKE = (*_TEXT_LIKE, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _late_columns(base: DataFrame, actual: DataFrame, pk: Sequence[str]) -> list[str]:
    """Columns to shuffle and compare as they are and to show as text at the end.

    Numbers that are not keys are not among them: which row survives among
    duplicates goes by the order of their texts.
    """
    late = []
    for name in common_columns(base, actual):
        kind = base.schema[name].dataType
        if kind == actual.schema[name].dataType and isinstance(kind, _KEY_LIKE if name in pk else _TEXT_LIKE):
            late.append(name)
    return late


def compare(base: DataFrame, actual: DataFrame, pk: Sequence[str], exclude: Sequence[str] = (),
            value_mode: str = "string", tolerance: int | None = None, co_located: bool = False) -> Comparison:
    """Prepare a comparison; runs no job.

    ``co_located`` is for sides bucketed alike by ``pk``: they are joined bucket
    by bucket instead of being put under each other and shuffled.

    ``value_mode='string'`` compares the text of the values, ``'typed'`` the
    values themselves; maps, which Spark does not order, are compared as text in
    key order either way. ``tolerance`` compares numbers rounded to that many
    digits.
    """
    if value_mode not in ("string", "typed"):
        raise ValueError(f"unknown value mode {value_mode!r}")
    pk = list(pk)
    require_columns(base, pk, "base")
    require_columns(actual, pk, "actual")
    base, actual = drop_columns(base, exclude, pk), drop_columns(actual, exclude, pk)
    if value_mode == "string":
        late = _late_columns(base, actual, pk)
        base, actual = cast_all_string(base, late), cast_all_string(actual, late)
    else:
        base, actual = maps_as_text(base), maps_as_text(actual)
    shared = [c for c in common_columns(base, actual) if c not in set(pk)]
    return Comparison(base, actual, tuple(pk), tuple(shared), value_mode, tolerance, co_located)
