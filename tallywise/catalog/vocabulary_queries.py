"""Queries of vocabularies and gazetteers that come as tables, of exact totals and of the learned classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywise.catalog.registry import query, table
from tallywise.operators import control, learned, places, standardise, vocabulary

# -- the nearest name -----------------------------------------------------------

#: Half of the customers have a short name, half a long one.
_NAME = "CASE WHEN c_custkey % 2 = 0 THEN substr(md5('n' || c_custkey), 1, 14) ELSE md5('n' || c_custkey) END"


@query("nearest_name", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 6 THEN upper({_NAME}) END AS name
FROM orders JOIN customer ON c_custkey = o_custkey
""")
def nearest_name(spark, folder):
    """Names of customers with up to three letters lost, changed, added or swapped, against the table of all names."""
    name = F.expr(_NAME)
    names = table(spark, folder, "customer").select("c_custkey", F.upper(name).alias("name"))
    orders = table(spark, folder, "orders").join(table(spark, folder, "customer").select("c_custkey"), F.col("c_custkey") == F.col("o_custkey"))
    typed = F.expr(f"""CASE o_orderkey % 7 WHEN 0 THEN n WHEN 1 THEN '  ' || upper(n) WHEN 2 THEN substr(n, 1, 4) || substr(n, 6)
      WHEN 3 THEN 'x' || n || 'x' WHEN 4 THEN overlay(n PLACING '-' FROM 3) WHEN 5 THEN substr(n, 2, 5) || '_' || substr(n, 7)
      ELSE 'xyz' || n END""")
    typed = orders.select("o_orderkey", name.alias("n")).select("o_orderkey", typed.alias("who"))
    return vocabulary.nearest_name(typed, "who", names, "name").drop("who")


# -- names inside texts ----------------------------------------------------------

@query("redact_names", r"""
WITH names AS (
  SELECT unnest(regexp_extract_all(text, '[A-Z][a-z]{2,}')) AS name FROM benchmark
  UNION SELECT unnest(regexp_extract_all(text, '[A-Z][a-z]{2,} [a-z]{2,}')) FROM benchmark),
p AS (SELECT '(^|[^\p{L}\p{M}\p{N}])(' || string_agg(name, '|' ORDER BY length(name) DESC, name) || ')([^\p{L}\p{M}\p{N}]|$)' AS p FROM names)
SELECT doc_id, regexp_replace(regexp_replace(text, p, '\1*\3', 'g'), p, '\1*\3', 'g') AS text FROM documents, p
""")
def redact_names(spark, folder):
    """Capitalised words of the benchmark, alone and with a word behind them, as the table of names."""
    items = table(spark, folder, "benchmark")
    alone = items.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{2,}"), F.lit(0))).alias("name"))
    pairs = items.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{2,} [a-z]{2,}"), F.lit(0))).alias("name"))
    return vocabulary.redact_names(table(spark, folder, "documents").select("doc_id", "text"), "text", alone.union(pairs))


# -- places ------------------------------------------------------------------------

#: Twenty names for the suppliers' towns, so that many nations have a town of each name.
_TOWN = "CASE WHEN s_suppkey % 3 = 0 THEN 'Port ' ELSE 'New Port ' END || 'Town' || (s_suppkey % 7)"
_GAZETTEER = f"""
cities AS (SELECT {_TOWN} AS city, n_name AS state, 'R' || n_regionkey AS country, max(s_acctbal) AS weight
  FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL)
"""


def _places(spark, folder):
    town = F.expr(_TOWN)
    suppliers = table(spark, folder, "supplier").join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    region = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))
    cities = suppliers.select(town.alias("city"), F.col("n_name").alias("state"), region.alias("country"), "s_acctbal")
    cities = cities.groupBy("city", "state", "country").agg(F.max("s_acctbal").alias("weight"))
    none = F.lit(None).cast("string")
    states = table(spark, folder, "nation").select(
        F.lit("state").alias("kind"), F.col("n_name").alias("name"), none.alias("city"), F.col("n_name").alias("state"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"), F.lit(0.0).alias("weight"),
    )
    return cities.select(F.lit("city").alias("kind"), F.col("city").alias("name"), "city", "state", "country", "weight").union(states)


_TYPED_PLACE = f"""
asked AS (
  SELECT c_custkey, c_custkey % 3 AS way, {_TOWN.replace('s_suppkey', 'c_custkey // 3')} AS town, n_name AS nation, 'R' || n_regionkey AS region
  FROM customer JOIN nation ON n_nationkey = c_nationkey)
"""


@query("resolve_places", f"""
WITH {_GAZETTEER}, {_TYPED_PLACE},
best AS (SELECT city, state, country FROM cities
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY weight DESC, state DESC, country DESC) = 1)
SELECT c_custkey, CASE way WHEN 2 THEN NULL ELSE coalesce(b.city, c.city) END AS city,
  CASE way WHEN 0 THEN CASE WHEN b.city IS NOT NULL THEN b.state ELSE c.state END ELSE nation END AS state,
  CASE way WHEN 0 THEN CASE WHEN b.city IS NOT NULL THEN b.country ELSE c.country END ELSE region END AS country
FROM asked LEFT JOIN best b ON b.city = town LEFT JOIN best c ON c.city = replace(town, 'New ', '')
""")
def resolve_places(spark, folder):
    """A town alone (its heaviest namesake), a town with its nation in other case, a nation alone.

    Where only ``Port Town1`` is known, it is what ``New Port Town1`` names.
    """
    asked = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    town = F.expr(_TOWN.replace("s_suppkey", "(c_custkey div 3)"))
    text = F.expr("CASE c_custkey % 3 WHEN 0 THEN town WHEN 1 THEN lower(n_name) || ' - ' || upper(town) ELSE '(' || n_name || ')' END")
    asked = asked.withColumn("town", town).select("c_custkey", text.alias("text"))
    return places.resolve_places(asked, "text", _places(spark, folder)).drop("text")


@query("parse_addresses", f"""
WITH {_TYPED_PLACE}
SELECT c_custkey, (c_custkey % 9999 + 1) || CASE way WHEN 0 THEN ' Harbor Way' WHEN 1 THEN ' Port Town1 Mews, Flat 2' ELSE ' Via Uno' END AS street,
  town AS city, nation AS state, (10000 + c_custkey % 80000) || CASE way WHEN 1 THEN '-0042' ELSE '' END AS zip
FROM asked
""")
def parse_addresses(spark, folder):
    """Streets of no listed kind, one that holds a town's name, ZIP+4, and three orders of the parts."""
    asked = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    town = F.expr(_TOWN.replace("s_suppkey", "(c_custkey div 3)"))
    text = F.expr("""CASE c_custkey % 3
      WHEN 0 THEN concat(c_custkey % 9999 + 1, ' Harbor Way, ', town, ', ', n_name, ' ', 10000 + c_custkey % 80000)
      WHEN 1 THEN concat(10000 + c_custkey % 80000, '-0042 ', c_custkey % 9999 + 1, ' Port Town1 Mews, Flat 2, ', town, ', ', n_name)
      ELSE concat(town, ', ', n_name, ', ', c_custkey % 9999 + 1, ' Via Uno ', 10000 + c_custkey % 80000) END""")
    asked = asked.withColumn("town", town).select("c_custkey", text.alias("text"))
    nations = _places(spark, folder)
    towns = asked.sparkSession.createDataFrame(
        [("city", f"{p}Town{i}", f"{p}Town{i}", None, None, 0.0) for p in ("Port ", "New Port ") for i in range(7)], places.GAZETTEER
    )
    return places.parse_addresses(asked, "text", nations.where("kind = 'state'").union(towns)).drop("text")


# -- products ------------------------------------------------------------------------

@query("standardise_products", """
SELECT s_suppkey, 'Maker' || s_nationkey AS brand, 'Line' || s_suppkey || ' ' || (s_suppkey % 30 + 1) || ' Pro' AS model,
  CASE WHEN s_suppkey % 2 = 0 THEN '256GB' END AS storage,
  concat_ws(' ', 'Maker' || s_nationkey, 'Line' || s_suppkey || ' ' || (s_suppkey % 30 + 1) || ' Pro',
    CASE WHEN s_suppkey % 2 = 0 THEN '256GB' END) AS name
FROM supplier
UNION ALL SELECT -1 - s_suppkey, NULL, '7', NULL, '7' FROM supplier
""")
def standardise_products(spark, folder):
    """One product family per supplier as the table, its words in either order; and products of no known family."""
    suppliers = table(spark, folder, "supplier")
    families = suppliers.selectExpr("concat('LINE', s_suppkey) AS word", "concat('Maker', s_nationkey) AS brand", "concat('Line', s_suppkey) AS family")
    text = F.expr("""CASE WHEN s_suppkey % 2 = 0 THEN concat('line', s_suppkey, ' ', s_suppkey % 30 + 1, ' pro (256 gb)')
      ELSE concat(s_suppkey % 30 + 1, ' PRO / line', s_suppkey) END""")
    known = suppliers.select("s_suppkey", text.alias("text"))
    other = suppliers.select((-1 - F.col("s_suppkey")).alias("s_suppkey"), F.lit("thing 7").alias("text"))
    return standardise.standardise_products(known.union(other), "text", families).drop("text")


# -- totals -------------------------------------------------------------------------

@query("exact_totals", """
WITH v AS (SELECT event_id, CAST(round(value * 100) AS HUGEINT) AS cents, CAST(event_id % 24 AS INT) AS k FROM events),
t AS (SELECT sum(CAST(cents * CAST('1' || repeat('0', k) AS HUGEINT) AS HUGEINT)) AS b,
    sum(CASE WHEN event_id <> 13 THEN CAST(cents * CAST('1' || repeat('0', k) AS HUGEINT) AS HUGEINT) END) AS a FROM v),
s AS (SELECT unnest(['base', 'actual', 'delta']) AS side, unnest([b, a, a - b]) AS total FROM t),
d AS (SELECT side, CASE WHEN total < 0 THEN '-' ELSE '' END AS sign, lpad(CAST(abs(total) AS VARCHAR), 40, '0') AS digits FROM s)
SELECT side, sign || regexp_replace(regexp_replace(ltrim(substr(digits, 1, 27), '0') || '.' || substr(digits, 28), '^\\.', '0.'),
  '\\.?0+$', '') AS total FROM d
""")
def exact_totals(spark, folder):
    """Values from 1e-13 to 1e13 in one column; the sides differ in one value."""
    events = table(spark, folder, "events")
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    rows = events.select("event_id", F.concat(cents, F.lit("e"), (F.col("event_id") % 24 - 13).cast("string")).cast("double").alias("x"))
    totals = control.exact_totals(rows, rows.where("event_id <> 13"), ["x"])
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_exact").alias("total")) for s in ("base", "actual", "delta")])
    return totals.select(F.inline(sides))


# -- the learned classifier ----------------------------------------------------------

@query("classify_learned")
def classify_learned(spark, folder):
    """Quality by a classifier learned from three quarters of the labels; the rest is marked as held out."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    known = docs.join(labels, "doc_id").withColumn("held_out", held_out)
    path = learned.fit_classifier(known.where("not held_out"), "text", "quality")
    return learned.classify_learned(known, "text", path, "predicted").drop("text")
