"""Base and actual sides derived from the tables by fixed rules.

Each pair exists twice, as DataFrames and as SQL common table expressions.
Prices are compared as decimals, whose text is the same in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.catalog.registry import table
from tallywise.plans.comparison import Comparison, compare

# -- orders: unique key ---------------------------------------------------------

ORDERS_KEY = ["o_orderkey"]
ORDERS_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)"))
    key = F.col("o_orderkey")
    status = F.when(key % 50 == 7, None).when(key % 10 == 3, "X").otherwise(F.col("o_orderstatus"))
    price = F.col("o_totalprice") + F.when(key % 25 == 4, 1).otherwise(0)
    changed = orders.withColumns({"o_orderstatus": status, "o_totalprice": price.cast("decimal(15,2)")})
    return orders.where(key % 101 != 0), changed.where(key % 97 != 0)


def orders_comparison(spark: SparkSession, folder: str) -> Comparison:
    return compare(*orders_pair(spark, folder), ORDERS_KEY)


ORDERS_SIDES = """
base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
         CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
         CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 101 <> 0),
actual AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 10 = 3 THEN 'X' ELSE o_orderstatus END
           AS o_orderstatus,
         CAST(CAST(CAST(o_totalprice AS DECIMAL(15,2))
              + CASE WHEN o_orderkey % 25 = 4 THEN 1 ELSE 0 END AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
         CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0)
"""


def cells_sql(base: str, actual: str, key: list[str], values: list[str]) -> str:
    """A ``SELECT`` of the changed cells of two relations with unique keys."""
    on = " AND ".join(f"b.{k} IS NOT DISTINCT FROM a.{k}" for k in key)
    parts = [
        f"SELECT {', '.join('b.' + k for k in key)}, '{v}' AS col_name, b.{v} AS base_value, a.{v} AS actual_value "
        f"FROM {base} b JOIN {actual} a ON {on} WHERE b.{v} IS DISTINCT FROM a.{v}"
        for v in values
    ]
    return " UNION ALL ".join(parts)


ORDERS_CELLS = f"{ORDERS_SIDES}, cells AS ({cells_sql('base', 'actual', ORDERS_KEY, ORDERS_VALUES)})"

# -- line items: key with duplicates --------------------------------------------

LINES_KEY = ["l_orderkey", "l_linenumber"]
LINES_VALUES = ["l_quantity", "l_returnflag", "l_shipdate"]


def lines_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, folder, "lineitem").select(*LINES_KEY, *LINES_VALUES)
    key = F.col("l_orderkey")
    flag = F.when(key % 50 == 7, None).when(key % 10 == 3, "Z").otherwise(F.col("l_returnflag"))
    return lines.where(key % 101 != 0), lines.withColumn("l_returnflag", flag).where(key % 97 != 0)


def lines_comparison(spark: SparkSession, folder: str) -> Comparison:
    return compare(*lines_pair(spark, folder), LINES_KEY)


_LINES_SIDE = """
  SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         CAST(l_quantity AS VARCHAR) AS l_quantity, {flag} AS l_returnflag, CAST(l_shipdate AS VARCHAR) AS l_shipdate
  FROM lineitem WHERE l_orderkey % {gap} <> 0
"""
LINES_SIDES = (
    "base AS (" + _LINES_SIDE.format(flag="l_returnflag", gap=101) + "), actual AS ("
    + _LINES_SIDE.format(
        flag="CASE WHEN l_orderkey % 50 = 7 THEN NULL WHEN l_orderkey % 10 = 3 THEN 'Z' ELSE l_returnflag END", gap=97
    ) + ")"
)
_SURVIVORS = """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_quantity NULLS FIRST, l_returnflag NULLS FIRST, l_shipdate NULLS FIRST) AS rn FROM {side}) WHERE rn = 1
"""
LINES_SURVIVORS = (
    f"{LINES_SIDES}, base1 AS ({_SURVIVORS.format(side='base')}), actual1 AS ({_SURVIVORS.format(side='actual')})"
)
LINES_CELLS = f"{LINES_SURVIVORS}, cells AS ({cells_sql('base1', 'actual1', LINES_KEY, LINES_VALUES)})"

# -- customers: equal column counts, unmatched names -----------------------------


def customers_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,2)"))
    key = F.col("c_custkey")
    segment = F.when(key % 4 != 0, F.col("c_mktsegment"))
    balance = F.col("c_acctbal") + F.when(key % 10 == 3, 1).otherwise(0)
    changed = customers.withColumns({"segment": segment, "c_acctbal": balance.cast("decimal(15,2)")})
    return customers, changed.drop("c_mktsegment")


def customers_comparison(spark: SparkSession, folder: str) -> Comparison:
    return compare(*customers_pair(spark, folder), ["c_custkey"])
