"""Whole runs as queries: files and reports are written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.catalog.pairs import ORDERS_CELLS, ORDERS_SIDES, orders_pair
from tallywise.catalog.registry import query, table
from tallywise.functions.columns import cols
from tallywise.operators.frames import input_status, require_columns
from tallywise.plans import flows
from tallywise.session import scratch_path
from tallywise.sources.delimited import read_report
from tallywise.sources.tables import literal_rows


def _lines(spark, folder: str, reports: dict[str, str]) -> DataFrame:
    """``report, line``: every row of every report that was written, its values in column order."""
    out = None
    for name, place in reports.items():
        if not flows.exists_at(spark, f"{folder}/{place}"):
            continue
        found = read_report(spark, f"{folder}/{place}")
        line = F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in cols(found.columns)])
        rows = found.select(F.lit(name).alias("report"), line.alias("line"))
        out = rows if out is None else out.unionAll(rows)
    return out


def _line(*names: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({n} AS VARCHAR), '~')" for n in names) + ")"


_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("file_run", f"""
WITH {ORDERS_CELLS}, k AS (SELECT DISTINCT o_orderkey FROM cells),
pairs AS (SELECT col_name, base_value, actual_value, count(*) AS n FROM cells GROUP BY ALL)
SELECT 'changed_base' AS report, {_line(*_ORDER)} AS line FROM base JOIN k USING (o_orderkey)
UNION ALL SELECT 'changed_actual', {_line(*_ORDER)} FROM actual JOIN k USING (o_orderkey)
UNION ALL SELECT 'columns', {_line("col_name", "count(*)")} FROM cells GROUP BY col_name
UNION ALL SELECT 'pairs', {_line("col_name", "base_value", "actual_value", "n")} FROM pairs
UNION ALL SELECT 'samples', {_line("o_orderkey", "col_name", "base_value", "actual_value")} FROM (
  SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY col_name, base_value, actual_value ORDER BY o_orderkey) <= 5)
""")
def file_run(spark, folder):
    """Both sides of the orders as delimited files, compared, and every report read back."""
    place = scratch_path(spark, "files")
    for side, df in zip(("base", "actual"), orders_pair(spark, folder)):
        df.select(*[F.col(c).cast("string").alias(c) for c in _ORDER]).write.options(header=True, sep=";", quote="'", nullValue="").csv(f"{place}/{side}")
    out = scratch_path(spark, "file-run")
    flows.compare_files(spark, f"{place}/base", f"{place}/actual", "o_orderkey", out, base_sep=";", actual_sep=";")
    return _lines(spark, out, flows.FILE_REPORTS)


_COPIES = "SELECT * FROM base UNION ALL SELECT * FROM base WHERE CAST(o_orderkey AS BIGINT) % 500 = 1"


@query("batch_run", f"""
WITH {ORDERS_CELLS}, twice AS ({_COPIES})
SELECT 'columns' AS report, col_name AS line FROM cells GROUP BY col_name
UNION ALL SELECT 'counts', {_line("col_name", "count(base_value)", "count(actual_value)")} FROM cells GROUP BY col_name
UNION ALL SELECT 'wide', {_line("o_orderkey", "max(base_value) FILTER (WHERE col_name = 'o_orderstatus')", "max(actual_value) FILTER (WHERE col_name = 'o_orderstatus')",
  "max(base_value) FILTER (WHERE col_name = 'o_totalprice')", "max(actual_value) FILTER (WHERE col_name = 'o_totalprice')")} FROM cells GROUP BY o_orderkey
UNION ALL SELECT 'extra_base', {_line(*_ORDER)} FROM twice ANTI JOIN actual USING (o_orderkey)
UNION ALL SELECT 'extra_actual', {_line(*_ORDER, "'n'")} FROM actual ANTI JOIN base USING (o_orderkey)
UNION ALL SELECT 'duplicates_base', {_line(*_ORDER, "2")} FROM base WHERE CAST(o_orderkey AS BIGINT) % 500 = 1
UNION ALL SELECT 'unmatched', 'note'
""")
def batch_run(spark, folder):
    """Two batches of one table, the first with copied rows, the second with a column of its own; every report read back."""
    base, actual = (df.select(*[F.col(c).cast("string").alias(c) for c in _ORDER]) for df in orders_pair(spark, folder))
    base = base.unionAll(base.where("cast(o_orderkey as bigint) % 500 = 1"))
    base.withColumn("pcm_batch_id", F.lit("1")).createOrReplaceTempView("tallywise_base_batches")
    actual.withColumns({"pcm_batch_id": F.lit("2"), "note": F.lit("n")}).createOrReplaceTempView("tallywise_actual_batches")
    out = scratch_path(spark, "batch-run")
    flows.compare_batches(spark, "tallywise_base_batches", "1", "tallywise_actual_batches", "2, 3", "o_orderkey", out)
    return _lines(spark, out, {k: v for k, v in flows.BATCH_REPORTS.items() if k != "summary"})


@query("input_checks", """
SELECT 'orders' AS name, CASE WHEN (SELECT count(*) FROM orders) > 0 THEN 'EMPTY_ACTUAL' ELSE 'EMPTY_BOTH' END AS status, 'o_nokey' AS absent
UNION ALL SELECT 'customer', CASE WHEN (SELECT count(*) FROM customer) > 0 THEN 'OK' ELSE 'EMPTY_BOTH' END, ''
UNION ALL SELECT 'nation', CASE WHEN (SELECT count(*) FROM nation) > 0 THEN 'EMPTY_BASE' ELSE 'EMPTY_BOTH' END, 'n_name2'
""")
def input_checks(spark, folder):
    """Which side of a comparison holds no row, and which key columns are missing."""
    orders, customers, nations = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    cases = [
        ("orders", orders, orders.where("o_orderkey < 0"), ["o_orderkey", "o_nokey"]), ("customer", customers, customers, ["c_custkey"]),
        ("nation", nations.where("n_nationkey < 0"), nations, ["n_name", "n_name2"]),
    ]
    found = []
    for name, base, actual, keys in cases:
        absent = ""
        try:
            require_columns(base, keys, "base")
        except KeyError as problem:
            absent = ",".join(k for k in keys if f"'{k}'" in str(problem))
        found.append((name, input_status(base, actual), absent))
    return literal_rows(spark, found, "name string, status string, absent string")
