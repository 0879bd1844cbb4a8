"""Queries of the cell-grid and XML tree comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywise.catalog.pairs import ORDERS_SIDES, orders_pair
from tallywise.catalog.registry import query, table
from tallywise.functions.labels import cell_name, column_letters
from tallywise.operators import grid
from tallywise.operators.frames import cast_all_string
from tallywise.operators.tree import compare_documents
from tallywise.plans.reports import any_difference
from tallywise.sources.cells import to_cells
from tallywise.sources.xmldocs import malformed_documents, shred_xml

# Market segments are sheets; each side lacks one of them.
_COLUMNS = ["c_name", "c_nationkey", "c_acctbal"]


def _sheets(spark, folder):
    """Base and actual cells; actual moves some balances and empties some names."""
    base = table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,3)"))
    key = F.col("c_custkey")
    shift = F.when(key % 10 == 1, "0.001").when(key % 10 == 2, "1.000").otherwise("0.000").cast("decimal(5,3)")
    actual = base.withColumns({
        "c_acctbal": (F.col("c_acctbal") + shift).cast("decimal(15,3)"),
        "c_name": F.when(key % 25 != 3, F.col("c_name")),
    })
    segment = F.col("c_mktsegment")
    sides = base.where(segment != "FURNITURE"), actual.where(segment != "MACHINERY")
    return [to_cells(side, "c_mktsegment", _COLUMNS, order_by=[key]) for side in sides]


_CELLS = """
base_rows AS (
  SELECT c_mktsegment AS sheet, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS row_no,
    c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(15,3)) AS VARCHAR) AS c_acctbal
  FROM customer WHERE c_mktsegment <> 'FURNITURE'),
actual_rows AS (
  SELECT c_mktsegment AS sheet, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS row_no,
    CASE WHEN c_custkey % 25 <> 3 THEN c_name END AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(CAST(CAST(c_acctbal AS DECIMAL(15,3)) + CASE WHEN c_custkey % 10 = 1 THEN 0.001 WHEN c_custkey % 10 = 2
      THEN 1.000 ELSE 0.000 END AS DECIMAL(15,3)) AS VARCHAR) AS c_acctbal
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
base_cells AS (
  SELECT sheet, row_no, 1 AS col_no, 'A' AS letter, c_name AS value FROM base_rows
  UNION ALL SELECT sheet, row_no, 2, 'B', c_nationkey FROM base_rows
  UNION ALL SELECT sheet, row_no, 3, 'C', c_acctbal FROM base_rows),
actual_cells AS (
  SELECT sheet, row_no, 1 AS col_no, 'A' AS letter, c_name AS value FROM actual_rows
  UNION ALL SELECT sheet, row_no, 2, 'B', c_nationkey FROM actual_rows
  UNION ALL SELECT sheet, row_no, 3, 'C', c_acctbal FROM actual_rows),
joined AS (
  SELECT b.sheet, b.row_no, b.col_no, b.letter || b.row_no AS cell_name, b.value AS base_value, a.value AS actual_value
  FROM base_cells b JOIN actual_cells a USING (sheet, row_no, col_no)),
diff AS (SELECT * FROM joined WHERE base_value IS DISTINCT FROM actual_value),
diff_rounded AS (
  SELECT * FROM joined WHERE CASE
    WHEN try_cast(base_value AS DOUBLE) IS NOT NULL AND try_cast(actual_value AS DOUBLE) IS NOT NULL
    THEN round(CAST(base_value AS DOUBLE), 2) <> round(CAST(actual_value AS DOUBLE), 2)
    ELSE base_value IS DISTINCT FROM actual_value END)
"""


@query("grid_cells", f"WITH {_CELLS} SELECT sheet, row_no, col_no, value FROM base_cells")
def grid_cells(spark, folder):
    return _sheets(spark, folder)[0]


@query("grid_diff", f"WITH {_CELLS} SELECT * FROM diff")
def grid_diff(spark, folder):
    return grid.grid_diff(*_sheets(spark, folder))


@query("grid_diff_rounded", f"WITH {_CELLS} SELECT * FROM diff_rounded")
def grid_diff_rounded(spark, folder):
    return grid.grid_diff(*_sheets(spark, folder), round_off=2)


@query("grid_sheet_counts", f"WITH {_CELLS} SELECT sheet, count(*) AS n FROM diff GROUP BY 1")
def grid_sheet_counts(spark, folder):
    return grid.sheet_diff_counts(grid.grid_diff(*_sheets(spark, folder)))


@query("grid_status", f"WITH {_CELLS} SELECT count(*) AS diff_count, 'compare complete' AS message FROM diff")
def grid_status(spark, folder):
    return grid.grid_status(*_sheets(spark, folder))


@query("grid_status_no_common_sheets", """
SELECT CASE WHEN count(*) FILTER (WHERE c_custkey < 0) > 0 THEN 0 ELSE -1 END::BIGINT AS diff_count,
  'No Common sheets found' AS message FROM customer
""")
def grid_status_no_common_sheets(spark, folder):
    base, actual = _sheets(spark, folder)
    return grid.grid_status(base, actual.withColumn("sheet", F.concat("sheet", F.lit("_2"))))


@query("grid_report", f"WITH {_CELLS} SELECT sheet, cell_name, base_value, actual_value FROM diff")
def grid_report(spark, folder):
    return grid.grid_report(grid.grid_diff(*_sheets(spark, folder)))


@query("sheet_set_ops", """
SELECT DISTINCT c_mktsegment AS sheet, CASE c_mktsegment WHEN 'FURNITURE' THEN 'actual' WHEN 'MACHINERY' THEN 'base'
  ELSE 'both' END AS side FROM customer
""")
def sheet_set_ops(spark, folder):
    return grid.sheet_presence(*_sheets(spark, folder))


@query("cell_names", """
SELECT c_custkey, CASE
    WHEN n < 26 THEN chr(65 + n)
    WHEN n < 702 THEN chr(CAST(64 + n // 26 AS INTEGER)) || chr(CAST(65 + n % 26 AS INTEGER))
    ELSE chr(CAST(65 + (n - 702) // 676 AS INTEGER)) || chr(CAST(65 + ((n - 26) // 26) % 26 AS INTEGER))
      || chr(CAST(65 + n % 26 AS INTEGER)) END AS letters,
  c_nationkey + 1 AS row_no
FROM (SELECT c_custkey, c_nationkey, CAST(c_custkey % 16384 AS INTEGER) AS n FROM customer)
""")
def cell_names(spark, folder):
    number = F.col("c_custkey") % 16384 + 1
    named = table(spark, folder, "customer").select(
        "c_custkey", column_letters(number).alias("letters"),
        cell_name(F.col("c_nationkey") + 1, number).alias("cell"),
    )
    row = F.expr("substring(cell, length(letters) + 1)")
    return named.select("c_custkey", "letters", row.cast("int").alias("row_no"))


# Fields in alphabetical order, so that sorting siblings keeps them in place.
_FIELDS = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]


def _order_documents(spark, folder):
    sides = [cast_all_string(side) for side in orders_pair(spark, folder)]
    return [side.select(F.col("o_orderkey").alias("doc_id"), F.to_xml(F.struct(*_FIELDS)).alias("xml")) for side in sides]


# A null field is left out of the document: the price then stands where the
# status was, and the parent has one child less.
_TREE = f"""
WITH {ORDERS_SIDES}, j AS (
  SELECT o_orderkey AS doc_id, b.o_orderstatus AS bs, a.o_orderstatus AS s, b.o_totalprice AS bp, a.o_totalprice AS p
  FROM base b JOIN actual a USING (o_orderkey))
SELECT doc_id, '/ROW/o_orderstatus' AS path, 'Text' AS kind, bs AS base_value, s AS actual_value FROM j
  WHERE s IS NOT NULL AND bs <> s
UNION ALL
SELECT doc_id, '/ROW/o_totalprice', 'Text', bp, p FROM j WHERE s IS NOT NULL AND bp <> p
UNION ALL SELECT doc_id, '/ROW', 'Children count', '6', '5' FROM j WHERE s IS NULL
UNION ALL SELECT doc_id, '/ROW', 'Tag', 'o_orderstatus', 'o_totalprice' FROM j WHERE s IS NULL
UNION ALL SELECT doc_id, '/ROW/o_orderstatus', 'Text', bs, p FROM j WHERE s IS NULL
UNION ALL SELECT coalesce(b.o_orderkey, a.o_orderkey), '', 'Document', CASE WHEN b.o_orderkey IS NOT NULL THEN 'present' END,
  CASE WHEN a.o_orderkey IS NOT NULL THEN 'present' END
  FROM base b FULL JOIN actual a ON b.o_orderkey = a.o_orderkey WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL
"""


@query("tree_diff", _TREE)
def tree_differences(spark, folder):
    return compare_documents(*_order_documents(spark, folder), "doc_id", "xml", ignore_whitespace=True)


@query("tree_diff_strict", f"""
{_TREE} UNION ALL
SELECT doc_id, '/ROW/o_orderstatus', 'Tail', chr(10) || '    ', chr(10) FROM j WHERE s IS NULL
""")
def tree_differences_strict(spark, folder):
    return compare_documents(*_order_documents(spark, folder), "doc_id", "xml")


@query("compare_documents", _TREE)
def compared_documents(spark, folder):
    """The differences of ``tree_diff``; documents whose texts are equal are only checked for parse errors."""
    return compare_documents(*_order_documents(spark, folder), "doc_id", "xml", ignore_whitespace=True)


@query("tree_verdict", f"SELECT CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS differences FROM ({_TREE})")
def tree_verdict(spark, folder):
    return any_difference(compare_documents(*_order_documents(spark, folder), "doc_id", "xml", ignore_whitespace=True))


def _attribute_doc(order: list[str], flag):
    """``<lines><line .../></lines>`` with attributes written in the given order."""
    shown = {
        "no": F.concat(F.lit('no="'), F.col("l_linenumber").cast("string"), F.lit('"')),
        "flag": F.concat(F.lit('flag="'), flag, F.lit('"')),
    }
    attributes = F.concat_ws(" ", *[shown[name] for name in order])
    return F.concat(F.lit("<lines><line "), attributes, F.lit("/></lines>"))


@query("tree_attribute_diff", """
SELECT row_id AS doc_id, '/lines/line' AS path, 'Attributes' AS kind,
  '{"flag":"' || l_returnflag || '","no":"' || l_linenumber || '"}' AS base_value,
  '{"flag":"Z","no":"' || l_linenumber || '"}' AS actual_value
FROM (SELECT DISTINCT l_orderkey || '/' || l_partkey || '/' || l_suppkey || '/' || l_linenumber AS row_id,
        l_orderkey, l_linenumber, l_returnflag FROM lineitem
      QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber) = 1)
WHERE l_orderkey % 10 = 3
""")
def tree_attribute_diff(spark, folder):
    """Attribute order does not matter, their values do."""
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem").groupBy(*ids).agg(
        F.count("*").alias("n"), F.min("l_returnflag").alias("l_returnflag")
    ).where("n = 1").withColumn("doc_id", F.concat_ws("/", *ids))
    flag = F.when(F.col("l_orderkey") % 10 == 3, "Z").otherwise(F.col("l_returnflag"))
    base = lines.select("doc_id", _attribute_doc(["no", "flag"], F.col("l_returnflag")).alias("xml"))
    actual = lines.select("doc_id", _attribute_doc(["flag", "no"], flag).alias("xml"))
    return compare_documents(base, actual, "doc_id", "xml")


@query("malformed_xml", "SELECT page_id AS doc_id FROM pages")
def malformed_xml(spark, folder):
    """No page is well-formed XML: each is reported, none is lost."""
    nodes = shred_xml(table(spark, folder, "pages"), "page_id", "html")
    return malformed_documents(nodes).select("doc_id")


@query("xml_nodes", f"""
WITH {ORDERS_SIDES}
SELECT o_orderkey AS doc_id, '/ROW' AS parent_path, f.tag AS tag, f.text AS text, f.place AS place
FROM (SELECT o_orderkey, unnest([
    {{'tag': 'o_custkey', 'text': o_custkey, 'place': '0'}}, {{'tag': 'o_orderdate', 'text': o_orderdate, 'place': '1'}},
    {{'tag': 'o_orderkey', 'text': o_orderkey, 'place': '2'}},
    {{'tag': 'o_orderpriority', 'text': o_orderpriority, 'place': '3'}},
    {{'tag': 'o_orderstatus', 'text': o_orderstatus, 'place': '4'}},
    {{'tag': 'o_totalprice', 'text': o_totalprice, 'place': '5'}}]) AS f FROM base)
""")
def xml_nodes(spark, folder):
    base, _ = _order_documents(spark, folder)
    leaves = shred_xml(base, "doc_id", "xml").where(F.size("ord_path") == 1)
    return leaves.select("doc_id", "parent_path", "tag", "text", F.array_join("ord_path", "/").alias("place"))
