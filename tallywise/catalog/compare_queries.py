"""Queries of the key-based comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywise.catalog.pairs import (
    LINES_CELLS, LINES_KEY, LINES_SIDES, LINES_SURVIVORS, ORDERS_CELLS, ORDERS_KEY, ORDERS_SIDES,
    customers_comparison, customers_pair, lines_comparison, lines_pair, orders_comparison, orders_pair,
)
from tallywise.catalog.registry import query, table
from tallywise.functions.compare import change_carrier, differs, differs_plain, fingerprint
from tallywise.operators import frames, sets
from tallywise.operators.control import control_total
from tallywise.plans import reports
from tallywise.plans.comparison import compare

_CELL = "o_orderkey, col_name, base_value, actual_value"


@query("changed_cells", f"WITH {ORDERS_CELLS} SELECT {_CELL} FROM cells")
def changed_cells(spark, folder):
    return orders_comparison(spark, folder).changed_cells()


@query("changed_cells_with_duplicates", f"WITH {LINES_CELLS} SELECT * FROM cells")
def changed_cells_with_duplicates(spark, folder):
    return lines_comparison(spark, folder).changed_cells()


@query("changed_cells_co_located", f"WITH {LINES_CELLS} SELECT * FROM cells")
def changed_cells_co_located(spark, folder):
    """The same cells by a join of the two grouped sides."""
    return compare(*lines_pair(spark, folder), LINES_KEY, co_located=True).changed_cells()


@query("changed_cells_narrowed", f"WITH {LINES_CELLS} SELECT * FROM cells")
def changed_cells_narrowed(spark, folder):
    """The same cells, shuffling hashes and the rows of suspect keys only."""
    return lines_comparison(spark, folder).narrowed().changed_cells()


@query("wide_diff", f"""
WITH {ORDERS_SIDES}
SELECT b.o_orderkey,
  CASE WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN b.o_orderstatus END AS o_orderstatus_baseline,
  CASE WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN a.o_orderstatus END AS o_orderstatus_actual,
  CASE WHEN b.o_totalprice IS DISTINCT FROM a.o_totalprice THEN b.o_totalprice END AS o_totalprice_baseline,
  CASE WHEN b.o_totalprice IS DISTINCT FROM a.o_totalprice THEN a.o_totalprice END AS o_totalprice_actual
FROM base b JOIN actual a USING (o_orderkey)
WHERE b.o_orderstatus IS DISTINCT FROM a.o_orderstatus OR b.o_totalprice IS DISTINCT FROM a.o_totalprice
""")
def wide_diff(spark, folder):
    return orders_comparison(spark, folder).wide_diff()


@query("column_diff_counts", f"WITH {ORDERS_CELLS} SELECT col_name, count(*) AS diff_count FROM cells GROUP BY 1")
def column_diff_counts(spark, folder):
    return orders_comparison(spark, folder).column_diff_counts()


@query("column_diff_sums", f"WITH {LINES_CELLS} SELECT col_name, count(*) AS diff_count FROM cells GROUP BY 1")
def column_diff_sums(spark, folder):
    return reports.column_diff_counts(reports.value_pair_counts(lines_comparison(spark, folder).changed_cells()))


_PAIRS = f"{ORDERS_CELLS}, pairs AS (SELECT col_name, base_value, actual_value, count(*) AS n FROM cells GROUP BY ALL)"


@query("value_pair_counts", f"WITH {_PAIRS} SELECT * FROM pairs")
def value_pair_counts(spark, folder):
    counts = reports.value_pair_counts(orders_comparison(spark, folder).changed_cells())
    return reports.ordered_value_pairs(counts)


@query("top_value_pairs", f"""
WITH {_PAIRS} SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY col_name
  ORDER BY n DESC, base_value NULLS FIRST, actual_value NULLS FIRST) <= 99
""")
def top_value_pairs(spark, folder):
    return reports.top_value_pairs(reports.value_pair_counts(orders_comparison(spark, folder).changed_cells()))


_SAMPLES = """
WITH {cells} SELECT {cell}, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY o_orderkey NULLS FIRST{tie}) AS rn FROM cells)
WHERE rn <= {n}
"""
_BY_PAIR = "col_name, base_value, actual_value"
_TIE = ", base_value NULLS FIRST, actual_value NULLS FIRST"


@query("sample_diffs", _SAMPLES.format(cells=ORDERS_CELLS, cell=_CELL, group=_BY_PAIR, tie="", n=24))
def sample_diffs(spark, folder):
    return reports.sample_diffs(orders_comparison(spark, folder).changed_cells(), ORDERS_KEY)


@query("sample_diffs_top5", _SAMPLES.format(cells=ORDERS_CELLS, cell=_CELL, group=_BY_PAIR, tie="", n=5))
def sample_diffs_top5(spark, folder):
    cells = orders_comparison(spark, folder).changed_cells()
    return reports.sample_diffs(cells, ORDERS_KEY, reports.SHORT_SAMPLES_PER_PAIR)


@query("sample_by_column", _SAMPLES.format(cells=ORDERS_CELLS, cell=_CELL, group="col_name", tie=_TIE, n=999))
def sample_by_column(spark, folder):
    cells = orders_comparison(spark, folder).changed_cells()
    return reports.sample_diffs(cells, ORDERS_KEY, reports.SAMPLES_PER_COLUMN, by="column")


@query("sample_by_column_large", _SAMPLES.format(cells=ORDERS_CELLS, cell=_CELL, group="col_name", tie=_TIE, n=1500))
def sample_by_column_large(spark, folder):
    """Above the planner's own limit for group cuts."""
    return reports.sample_diffs(orders_comparison(spark, folder).changed_cells(), ORDERS_KEY, 1500, by="column")


_DUPLICATE_KEYS = f"""{LINES_SIDES}, dup AS (
  SELECT 'base' AS side, l_orderkey, l_linenumber, count(*) AS n FROM base GROUP BY ALL HAVING count(*) > 1
  UNION ALL
  SELECT 'actual' AS side, l_orderkey, l_linenumber, count(*) AS n FROM actual GROUP BY ALL HAVING count(*) > 1)
"""


@query("duplicate_keys", f"WITH {_DUPLICATE_KEYS} SELECT * FROM dup")
def duplicate_keys(spark, folder):
    return lines_comparison(spark, folder).duplicate_keys()


@query("top_duplicates", f"""
WITH {_DUPLICATE_KEYS} SELECT * FROM dup
QUALIFY row_number() OVER (PARTITION BY side ORDER BY n DESC, l_orderkey, l_linenumber) <= 499
""")
def top_duplicates(spark, folder):
    return reports.top_duplicates(lines_comparison(spark, folder))


def _duplicate_rows_sql(common_only: bool) -> str:
    def side(name: str, other: str) -> str:
        restrict = f"WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM {other})"
        return f"""
          SELECT '{name}' AS side, l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate, rn FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
              l_quantity NULLS FIRST, l_returnflag NULLS FIRST, l_shipdate NULLS FIRST) AS rn
            FROM {name} {restrict if common_only else ''})
          WHERE rn > 1"""
    return f"WITH {LINES_SIDES} {side('base', 'actual')} UNION ALL {side('actual', 'base')}"


@query("duplicate_rows", _duplicate_rows_sql(common_only=True))
def duplicate_rows(spark, folder):
    return lines_comparison(spark, folder).duplicate_rows()


@query("duplicate_rows_all_keys", _duplicate_rows_sql(common_only=False))
def duplicate_rows_all_keys(spark, folder):
    return lines_comparison(spark, folder).duplicate_rows(common_only=False)


def _extra_sql(sides: str, key: list[str]) -> str:
    names = ", ".join(key)
    return f"""{sides}, extra AS (
      SELECT 'base' AS side, * FROM (SELECT {names} FROM base EXCEPT SELECT {names} FROM actual)
      UNION ALL
      SELECT 'actual' AS side, * FROM (SELECT {names} FROM actual EXCEPT SELECT {names} FROM base))"""


@query("extra_keys", f"WITH {_extra_sql(ORDERS_SIDES, ORDERS_KEY)} SELECT * FROM extra")
def extra_keys(spark, folder):
    return orders_comparison(spark, folder).extra_keys()


@query("key_symmetric_difference", f"WITH {_extra_sql(LINES_SIDES, LINES_KEY)} SELECT * FROM extra")
def key_symmetric_difference(spark, folder):
    base, actual = lines_pair(spark, folder)
    return sets.extra_keys(frames.cast_all_string(base), frames.cast_all_string(actual), LINES_KEY)


@query("top_extras", f"""
WITH {_extra_sql(LINES_SIDES, LINES_KEY)} SELECT * FROM extra
QUALIFY row_number() OVER (PARTITION BY side ORDER BY l_orderkey, l_linenumber) <= 499
""")
def top_extras(spark, folder):
    return reports.top_extras(lines_comparison(spark, folder))


@query("common_keys", f"""
WITH {LINES_SIDES} SELECT l_orderkey, l_linenumber FROM base INTERSECT SELECT l_orderkey, l_linenumber FROM actual
""")
def common_keys(spark, folder):
    return lines_comparison(spark, folder).common_keys()


@query("extra_rows", f"""
WITH {LINES_SIDES}
SELECT 'base' AS side, b.* FROM base b ANTI JOIN actual a USING (l_orderkey, l_linenumber)
UNION ALL
SELECT 'actual' AS side, a.* FROM actual a ANTI JOIN base b USING (l_orderkey, l_linenumber)
""")
def extra_rows(spark, folder):
    cmp = lines_comparison(spark, folder)
    return cmp.extra_rows("base").unionByName(cmp.extra_rows("actual"))


_CHANGED_KEYS = "SELECT DISTINCT l_orderkey, l_linenumber FROM cells"


@query("changed_rows", f"""
WITH {LINES_CELLS}
SELECT 'base' AS side, b.* FROM base1 b SEMI JOIN ({_CHANGED_KEYS}) k USING (l_orderkey, l_linenumber)
UNION ALL
SELECT 'actual' AS side, a.* FROM actual1 a SEMI JOIN ({_CHANGED_KEYS}) k USING (l_orderkey, l_linenumber)
""")
def changed_rows(spark, folder):
    return lines_comparison(spark, folder).changed_rows()


@query("row_except", f"""
WITH {LINES_SURVIVORS}
SELECT 'base' AS side, * FROM (SELECT * FROM base1 EXCEPT SELECT * FROM actual1)
UNION ALL
SELECT 'actual' AS side, * FROM (SELECT * FROM actual1 EXCEPT SELECT * FROM base1)
""")
def row_except(spark, folder):
    return lines_comparison(spark, folder).row_except()


_SAME_LINE = " AND ".join(
    f"b.{c} IS NOT DISTINCT FROM a.{c}"
    for c in ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"]
)


@query("row_except_all", f"""
WITH {LINES_SIDES}
SELECT 'base' AS side, b.* FROM base b WHERE NOT EXISTS (SELECT 1 FROM actual a WHERE {_SAME_LINE})
UNION ALL
SELECT 'actual' AS side, a.* FROM actual a WHERE NOT EXISTS (SELECT 1 FROM base b WHERE {_SAME_LINE})
""")
def row_except_all(spark, folder):
    return lines_comparison(spark, folder).row_except(dedupe=False)


@query("multiset_diff", f"""
WITH {LINES_SIDES}
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate,
  CAST(sum(nb) AS BIGINT) AS n_base, CAST(sum(na) AS BIGINT) AS n_actual
FROM (SELECT *, 1 AS nb, 0 AS na FROM base UNION ALL SELECT *, 0 AS nb, 1 AS na FROM actual)
GROUP BY ALL HAVING sum(nb) <> sum(na)
""")
def multiset_diff(spark, folder):
    return lines_comparison(spark, folder).multiset_diff()


@query("schema_diff", """
SELECT 'c_mktsegment' AS column_name, 'base' AS side, 'string' AS data_type, count(c_mktsegment) AS n_values
FROM customer
UNION ALL
SELECT 'segment', 'actual', 'string', count(CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END) FROM customer
""")
def schema_diff(spark, folder):
    return frames.schema_diff(*customers_pair(spark, folder), count_values=True)


@query("passed_columns", """
SELECT col_name FROM (
  SELECT 'c_name' AS col_name, count(*) FILTER (WHERE b.c_name IS DISTINCT FROM a.c_name) AS n
  FROM customer b JOIN customer a USING (c_custkey)
  UNION ALL
  SELECT 'c_nationkey', count(*) FILTER (WHERE b.c_nationkey IS DISTINCT FROM a.c_nationkey)
  FROM customer b JOIN customer a USING (c_custkey)
  UNION ALL
  SELECT 'c_acctbal', count(*) FILTER (WHERE c_custkey % 10 = 3) FROM customer) WHERE n = 0
""")
def passed_columns(spark, folder):
    return customers_comparison(spark, folder).passed_columns()


@query("verdict", f"""
WITH {LINES_CELLS}, {_extra_sql("x AS (SELECT 1)", LINES_KEY)}
SELECT 'FAIL' AS status, (SELECT count(*) FROM cells) AS mismatched_cells,
  (SELECT count(*) FROM ({_CHANGED_KEYS})) AS mismatched_keys,
  (SELECT count(*) FROM extra WHERE side = 'base') AS extra_base,
  (SELECT count(*) FROM extra WHERE side = 'actual') AS extra_actual
""")
def verdict(spark, folder):
    return reports.verdict(lines_comparison(spark, folder))


@query("verdict_same_side", f"""
WITH {LINES_SURVIVORS}, other AS (SELECT * FROM base1)
SELECT 'PASS' AS status, count(*) FILTER (WHERE b.l_quantity IS DISTINCT FROM o.l_quantity) AS mismatched_cells,
  count(*) FILTER (WHERE b.l_quantity IS DISTINCT FROM o.l_quantity) AS mismatched_keys,
  count(*) FILTER (WHERE o.l_orderkey IS NULL) AS extra_base,
  count(*) FILTER (WHERE b.l_orderkey IS NULL) AS extra_actual
FROM base1 b FULL JOIN other o USING (l_orderkey, l_linenumber)
""")
def verdict_same_side(spark, folder):
    base, _ = lines_pair(spark, folder)
    return reports.verdict(compare(base, base, LINES_KEY))


_SUMMARY = f"""
WITH {LINES_CELLS}, {_extra_sql("x AS (SELECT 1)", LINES_KEY)}, counts AS (
  SELECT l_orderkey, l_linenumber, sum(nb) AS nb, sum(na) AS na
  FROM (SELECT *, 1 AS nb, 0 AS na FROM base UNION ALL SELECT *, 0 AS nb, 1 AS na FROM actual) GROUP BY 1, 2)
SELECT metric, CAST(value AS VARCHAR) AS value FROM (
  SELECT 'Test Status' AS metric, 'FAIL' AS value
  UNION ALL SELECT 'Product Name', 'DAILY'
  UNION ALL SELECT 'Business Date', (SELECT min(l_shipdate) FROM base)
  UNION ALL SELECT 'Baseline PCM Batch ID', '11, 12'
  UNION ALL SELECT 'Regression PCM Batch ID', '21'
  UNION ALL SELECT 'Baseline CORE Batch ID', (SELECT min(l_quantity) FROM base)
  UNION ALL SELECT 'Regression CORE Batch ID', (SELECT min(l_quantity) FROM actual)
  UNION ALL SELECT 'Columns present in Baseline', '5'
  UNION ALL SELECT 'Columns present in Regression', '5'
  UNION ALL SELECT 'Records present in Baseline', (SELECT CAST(count(*) AS VARCHAR) FROM base)
  UNION ALL SELECT 'Records present in Regression', (SELECT CAST(count(*) AS VARCHAR) FROM actual)
  UNION ALL SELECT 'Primary Key Column Count', '2'
  UNION ALL SELECT 'Extra Records present in Baseline', (SELECT CAST(count(*) AS VARCHAR) FROM extra WHERE side = 'base')
  UNION ALL SELECT 'Extra Records present in Regression',
    (SELECT CAST(count(*) AS VARCHAR) FROM extra WHERE side = 'actual')
  UNION ALL SELECT 'Baseline Duplicate Records Count', (SELECT CAST(count(*) AS VARCHAR) FROM counts WHERE nb > 1)
  UNION ALL SELECT 'Regression Duplicate Records Count', (SELECT CAST(count(*) AS VARCHAR) FROM counts WHERE na > 1)
  UNION ALL SELECT 'Mismatched Records Count', (SELECT CAST(count(*) AS VARCHAR) FROM ({_CHANGED_KEYS}))
  UNION ALL SELECT 'Mismatched Columns Count', (SELECT CAST(count(DISTINCT col_name) AS VARCHAR) FROM cells)
  UNION ALL SELECT 'All Columns Mapped', 'PASS'
  UNION ALL SELECT 'Unmapped Columns Count', '0'
  UNION ALL SELECT 'Baseline Excess Rows of Common Keys',
    (SELECT CAST(CAST(sum(nb - 1) AS BIGINT) AS VARCHAR) FROM counts WHERE nb > 0 AND na > 0)
  UNION ALL SELECT 'Regression Excess Rows of Common Keys',
    (SELECT CAST(CAST(sum(na - 1) AS BIGINT) AS VARCHAR) FROM counts WHERE nb > 0 AND na > 0))
"""


@query("summary", _SUMMARY)
def summary(spark, folder):
    return _summary_of(lines_comparison(spark, folder))


@query("summary_of_stored_findings", _SUMMARY)
def summary_of_stored_findings(spark, folder):
    """The same numbers from the stored findings, clean keys only counted."""
    return _summary_of(lines_comparison(spark, folder).stored())


def _summary_of(cmp):
    least = sets.smallest_value(cmp.base, ["l_shipdate", "l_quantity"])
    return reports.summary(cmp, {
        "product": "DAILY",
        "business_date": least.select("l_shipdate").scalar(),
        "baseline_batch": "11, 12",
        "regression_batch": "21",
        "baseline_core_batch": least.select("l_quantity").scalar(),
        "regression_core_batch": sets.smallest_value(cmp.actual, ["l_quantity"]).scalar(),
    })


@query("nonnull_diff_cells", f"""
WITH {ORDERS_CELLS}
SELECT col_name, count(base_value) AS base_count, count(actual_value) AS actual_count FROM cells GROUP BY 1
""")
def nonnull_diff_cells(spark, folder):
    return reports.nonnull_diff_cells(orders_comparison(spark, folder).changed_cells())


@query("mismatch_totals", f"""
WITH {ORDERS_CELLS}
SELECT count(DISTINCT o_orderkey) AS mismatched_keys, count(DISTINCT col_name) AS mismatched_columns FROM cells
""")
def mismatch_totals(spark, folder):
    return reports.mismatch_totals(orders_comparison(spark, folder).changed_cells(), ORDERS_KEY)


@query("typed_changed_cells", """
SELECT o_orderkey, 'o_totalprice' AS col_name, CAST(b AS VARCHAR) AS base_value, CAST(a AS VARCHAR) AS actual_value
FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS b, CAST(CAST(o_totalprice AS DECIMAL(15,2))
  + CASE WHEN o_orderkey % 25 = 4 THEN 1 ELSE 0 END AS DECIMAL(15,2)) AS a FROM orders
  WHERE o_orderkey % 101 <> 0 AND o_orderkey % 97 <> 0) WHERE a <> b
""")
def typed_changed_cells(spark, folder):
    """Values compared by type, keys kept as numbers, one column left out."""
    return compare(*orders_pair(spark, folder), ORDERS_KEY, exclude=["o_orderstatus"], value_mode="typed").changed_cells()


@query("rounded_changed_cells", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'c_acctbal' AS col_name, CAST(b AS VARCHAR) AS base_value,
  CAST(a AS VARCHAR) AS actual_value
FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(15,3)) AS b,
  CAST(CAST(c_acctbal AS DECIMAL(15,3)) + CASE WHEN c_custkey % 10 = 1 THEN 0.001 WHEN c_custkey % 10 = 2 THEN 0.007
    ELSE 0 END AS DECIMAL(15,3)) AS a FROM customer)
WHERE round(CAST(a AS DOUBLE), 2) <> round(CAST(b AS DOUBLE), 2)
""")
def rounded_changed_cells(spark, folder):
    """A tolerance of two digits hides a change in the third."""
    base = table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,3)"))
    key = F.col("c_custkey")
    shift = F.when(key % 10 == 1, F.lit("0.001")).when(key % 10 == 2, F.lit("0.007")).otherwise(F.lit("0"))
    moved = (F.col("c_acctbal") + shift.cast("decimal(4,3)")).cast("decimal(15,3)")
    return compare(base, base.withColumn("c_acctbal", moved), ["c_custkey"], tolerance=2).changed_cells()


@query("control_total", """
WITH sums AS (
  SELECT sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS b0, sum(CAST(l_quantity AS DECIMAL(28,2))) AS b1,
    sum(CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_extendedprice AS DECIMAL(28,2)) END) AS a0,
    sum(CAST(l_quantity AS DECIMAL(28,2))) AS a1
  FROM lineitem WHERE l_shipdate = TIMESTAMP '1998-06-01 00:00:00')
SELECT 'l_extendedprice' AS metric, CAST(b0 AS VARCHAR) AS base_value, CAST(a0 AS VARCHAR) AS actual_value,
  CAST(a0 - b0 AS VARCHAR) AS delta, CASE WHEN a0 IS NOT DISTINCT FROM b0 THEN 'true' ELSE 'false' END AS ok FROM sums
UNION ALL
SELECT 'l_quantity', CAST(b1 AS VARCHAR), CAST(a1 AS VARCHAR), CAST(a1 - b1 AS VARCHAR),
  CASE WHEN a1 IS NOT DISTINCT FROM b1 THEN 'true' ELSE 'false' END FROM sums
""")
def control_totals(spark, folder):
    lines = table(spark, folder, "lineitem")
    actual = lines.withColumn("l_extendedprice", F.when(F.col("l_orderkey") % 97 != 0, F.col("l_extendedprice")))
    day = F.col("l_shipdate") == F.lit("1998-06-01").cast("timestamp_ntz")
    totals = control_total(lines, actual, ["l_extendedprice", "l_quantity"], where=day, scale=2)
    return totals.select("metric", *[F.col(c).cast("string").alias(c)
                                     for c in ("base_value", "actual_value", "delta", "ok")])


@query("control_total_whole_table", """
SELECT 'o_totalprice' AS metric, CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) FILTER (WHERE o_orderkey % 101 <> 0) AS VARCHAR)
    AS base_value,
  CAST(sum(CAST(o_totalprice AS DECIMAL(28,2)) + CASE WHEN o_orderkey % 25 = 4 THEN 1 ELSE 0 END)
    FILTER (WHERE o_orderkey % 97 <> 0) AS VARCHAR) AS actual_value
FROM orders
""")
def control_total_whole_table(spark, folder):
    totals = control_total(*orders_pair(spark, folder), ["o_totalprice"], scale=2)
    return totals.select("metric", *[F.col(c).cast("string").alias(c) for c in ("base_value", "actual_value")])


@query("control_total_full_scale", """
WITH v AS (SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS DECIMAL(28,0)) / 10000 AS x FROM lineitem),
t AS (SELECT CAST(sum(CAST(x AS DECIMAL(28,4))) AS DECIMAL(28,4)) AS b,
  CAST(sum(CAST(x AS DECIMAL(28,4))) FILTER (WHERE l_orderkey % 9999 <> 1) AS DECIMAL(28,4)) AS a FROM v)
SELECT 'x' AS metric, CAST(b AS VARCHAR) AS base_value, CAST(a AS VARCHAR) AS actual_value, CAST(a - b AS VARCHAR) AS delta,
  CASE WHEN a = b THEN 'true' ELSE 'false' END AS ok FROM t
""")
def control_total_full_scale(spark, folder):
    """Values of four decimals, each of which would vanish if it were rounded to two before the sum."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(28,0)")
    lines = table(spark, folder, "lineitem").select("l_orderkey", (cents / 10000).cast("decimal(28,4)").alias("x"))
    totals = control_total(lines, lines.where("l_orderkey % 9999 <> 1"), ["x"], scale=4)
    return totals.select("metric", *[F.col(c).cast("string").alias(c)
                                     for c in ("base_value", "actual_value", "delta", "ok")])


@query("row_counts", f"""
WITH {LINES_SIDES} SELECT 'base' AS side, count(*) AS n FROM base UNION ALL SELECT 'actual', count(*) FROM actual
""")
def row_counts(spark, folder):
    return sets.row_counts(*lines_pair(spark, folder))


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(spark, folder):
    return sets.distinct_rows(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"))


@query("dedupe_by_key", f"WITH {LINES_SURVIVORS} SELECT * FROM base1")
def dedupe_by_key(spark, folder):
    base, _ = lines_pair(spark, folder)
    return sets.dedupe_by_key(frames.cast_all_string(base), LINES_KEY)


@query("min_scalar", """
SELECT CAST(min(o_orderdate) AS VARCHAR) AS o_orderdate, min(o_orderpriority) AS o_orderpriority FROM orders
""")
def min_scalar(spark, folder):
    return frames.cast_all_string(
        sets.smallest_value(table(spark, folder, "orders"), ["o_orderdate", "o_orderpriority"])
    )


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark, folder):
    return sets.distinct_values(table(spark, folder, "orders"), "o_orderpriority")


@query("row_fingerprint", f"""
WITH {ORDERS_SIDES}
SELECT b.o_orderkey,
  CASE WHEN b.o_custkey IS DISTINCT FROM a.o_custkey OR b.o_orderstatus IS DISTINCT FROM a.o_orderstatus
    OR b.o_totalprice IS DISTINCT FROM a.o_totalprice OR b.o_orderdate IS DISTINCT FROM a.o_orderdate
    OR b.o_orderpriority IS DISTINCT FROM a.o_orderpriority THEN 1 ELSE 0 END AS row_changed,
  CASE WHEN coalesce(b.o_orderstatus, 'NULL_VALUE') <> coalesce(a.o_orderstatus, 'NULL_VALUE') THEN 1 ELSE 0 END
    AS status_changed,
  CASE WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN b.o_orderstatus END AS base_status,
  CASE WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN a.o_orderstatus END AS actual_status
FROM base b JOIN actual a USING (o_orderkey)
""")
def row_fingerprint(spark, folder):
    base, actual = (frames.cast_all_string(side) for side in orders_pair(spark, folder))
    names = base.columns
    b = frames.suffix_columns(base.withColumn("print", fingerprint(names)), "_b", ORDERS_KEY)
    a = frames.suffix_columns(actual.withColumn("print", fingerprint(names)), "_a", ORDERS_KEY)
    both = b.join(a, ORDERS_KEY)
    carrier = change_carrier(F.col("o_orderstatus_b"), F.col("o_orderstatus_a"), F.col("print_b"))
    return both.withColumn("carrier", carrier).select(
        "o_orderkey",
        differs(F.col("print_b"), F.col("print_a")).cast("int").alias("row_changed"),
        differs_plain(F.col("o_orderstatus_b"), F.col("o_orderstatus_a")).cast("int").alias("status_changed"),
        F.col("carrier").getItem(0).alias("base_status"),
        F.col("carrier").getItem(1).alias("actual_status"),
    )
