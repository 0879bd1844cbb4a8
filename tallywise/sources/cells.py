"""Tables as positional cells: ``sheet, row_no, col_no, value``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import as_text, col
from tallywise.operators.numbering import number_in_order


def to_cells(df: DataFrame, sheet: str, columns: Sequence[str], row_no: str | None = None,
             order_by: Sequence[Column] = ()) -> DataFrame:
    """Unpivot ``columns`` into cells; rows and columns count from 1.

    Rows already numbered by ``row_no`` need no shuffle. Otherwise they are
    numbered per sheet by ``order_by``.
    """
    if row_no is None:
        if not order_by:
            raise ValueError("give row_no or order_by")
        df = number_in_order(df, [sheet], order_by, "_row_no")
        row_no = "_row_no"
    cells = F.array(*[
        F.struct(F.lit(i + 1).alias("col_no"), as_text(col(c), df.schema[c].dataType).alias("value"))
        for i, c in enumerate(columns)
    ])
    return df.select(
        col(sheet).cast("string").alias("sheet"), col(row_no).cast("bigint").alias("row_no"), F.inline(cells)
    )
