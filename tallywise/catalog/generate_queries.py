"""Queries of generating, rebalancing, masking and redacting."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywise.catalog.registry import query, table
from tallywise.operators import generate, privacy, sets


def _uniform(ident: str, name: str, seed: int = 0) -> str:
    text = f"md5(CAST({ident} AS VARCHAR) || ':{seed}:{name}')"
    return f"(CAST('0x' || substr({text}, 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def _picked(uniform: str, values: list) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][CAST(floor({uniform} * {len(values)}) AS INTEGER) + 1]"


@query("synthesise", f"""
SELECT c_custkey, CAST(DATE '2025-01-01' + CAST(floor({_uniform('c_custkey', 'date', 7)} * 365) AS INTEGER) AS VARCHAR)
    AS date,
  'Customer ' || CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
    ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
  round(10.0::DOUBLE + {_uniform('c_custkey', 'order_total', 7)} * 490.0::DOUBLE, 2)
    * CASE WHEN {_uniform('c_custkey', 'sign')} < 0.2 THEN -1.0 ELSE 1.0 END::DOUBLE AS order_total,
  CAST(floor({_uniform('c_custkey', 'rating', 7)} * 5) + 1 AS INTEGER) AS rating,
  {_picked(_uniform('c_custkey', 'review_text', 7), ['Works well.', 'Too slow.', 'Fair price.'])} AS review_text
FROM customer
""")
def synthesise(spark, folder):
    """A made-up order and review for every customer."""
    made = generate.synthesise(table(spark, folder, "customer"), "c_custkey", {
        "date": generate.date_between("2025-01-01", 365),
        "customer_id": generate.numbered_label("Customer "),
        "order_total": generate.amount_between(10.0, 500.0, negative_share=0.2),
        "rating": generate.integer_between(1, 5),
        "review_text": generate.one_of(["Works well.", "Too slow.", "Fair price."]),
    }, seed=7)
    return made.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("synthesise_series", f"""
WITH daily AS (
  SELECT s_suppkey, CAST(unnest(generate_series(DATE '2025-01-01', DATE '2025-02-04', INTERVAL 1 DAY)) AS DATE) AS d
  FROM supplier)
SELECT s_suppkey, CAST(d AS VARCHAR) AS date, round((200.0::DOUBLE
    + {_uniform("s_suppkey || '/' || CAST(d AS VARCHAR)", 'sales', 3)} * 100.0::DOUBLE)
  * CASE WHEN dayofweek(d) IN (0, 6) THEN 1.6 ELSE 1.0 END::DOUBLE, 2) AS total_sales
FROM daily
""")
def synthesise_series(spark, folder):
    """Five weeks of sales per supplier."""
    series = generate.synthesise_series(
        table(spark, folder, "supplier"), "s_suppkey", "2025-01-01", 35, 200.0, 100.0, 1.6, seed=3
    )
    return series.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


_NUMBERED = "row_number() OVER ({part}ORDER BY {id})"


@query("augment", f"""
WITH sized AS (SELECT *, {_NUMBERED.format(part='', id='p_partkey')} AS idx, count(*) OVER () AS n FROM part),
line AS (SELECT regr_slope(p_retailprice, p_size) AS s FROM part),
copies AS (
  SELECT *, unnest(range(CAST(1 + CASE WHEN idx <= n // 2 THEN 1 ELSE 0 END AS BIGINT))) AS copy_no FROM sized),
moved AS (
  SELECT *, CAST(round(p_size * (1 + 0.2::DOUBLE * (2 * {_uniform("p_partkey || '/' || copy_no", 'p_size', 5)} - 1)), 2)
    AS DOUBLE) AS x FROM copies)
SELECT p_partkey, copy_no, p_brand, CAST(trunc(x) AS INTEGER) AS p_size,
  round(p_retailprice + s * (x - p_size), 2) AS p_retailprice
FROM moved, line
""")
def augment(spark, folder):
    """Half as many rows again on top of one copy of each part; prices follow sizes."""
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    count = parts.agg(F.count("*").alias("n"))
    wanted = (count.scalar() + F.floor(count.scalar() / 2)).cast("bigint")
    return generate.augment(parts, "p_partkey", wanted, {"p_size": 0.2}, ("p_size", "p_retailprice"), seed=5)


@query("rebalance", f"""
WITH sized AS (
  SELECT doc_id, toxic, {_NUMBERED.format(part='PARTITION BY toxic ', id='doc_id')} AS idx,
    count(*) OVER (PARTITION BY toxic) AS n FROM labels),
wanted AS (SELECT *, max(n) OVER () - n AS needed FROM sized)
SELECT doc_id, toxic, 0 AS is_copy FROM labels
UNION ALL
SELECT doc_id, toxic, 1 FROM (
  SELECT doc_id, toxic, unnest(range(CAST(needed // n + CASE WHEN idx <= needed % n THEN 1 ELSE 0 END AS BIGINT)))
  FROM wanted WHERE needed > 0)
""")
def rebalance(spark, folder):
    return generate.rebalance(table(spark, folder, "labels").select("doc_id", "toxic"), "toxic", "doc_id")


@query("rebalanced_distribution", """
SELECT toxic, max(n) OVER () AS n FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)
""")
def rebalanced_distribution(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return sets.class_distribution(generate.rebalance(labels, "toxic", "doc_id"), "toxic")


def _with_edges(spark, folder):
    """Readings with extreme cases that lack a date."""
    readings = table(spark, folder, "events").select(F.col("ts").alias("date"), "value")
    cases = spark.createDataFrame([(-40.0,), (55.0,), (0.0,), (1e6,), (-0.01,)], "value double")
    return readings, generate.inject_edge_cases(
        readings, cases, {"date": F.lit("2025-05-14 00:00:00").cast("timestamp_ntz")}
    )


@query("edge_cases", """
SELECT strftime(ts, '%Y-%m-%d') AS date, value FROM events
UNION ALL SELECT '2025-05-14', unnest([-40.0, 55.0, 0.0, 1e6, -0.01]::DOUBLE[])
""")
def edge_cases(spark, folder):
    _, after = _with_edges(spark, folder)
    return after.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "value")


@query("range_profile", """
SELECT 'before' AS stage, 'value' AS col_name, min(value) + 0.0 AS min_value, max(value) + 0.0 AS max_value FROM events
UNION ALL SELECT 'after', 'value', least(min(value), -40.0), greatest(max(value), 1e6) FROM events
""")
def range_profile(spark, folder):
    before, after = _with_edges(spark, folder)
    return sets.range_profile(before, ["value"]).select(F.lit("before").alias("stage"), "*").unionByName(
        sets.range_profile(after, ["value"]).select(F.lit("after").alias("stage"), "*")
    )


# -- personal data --------------------------------------------------------------

def _people(spark, folder):
    key = F.col("c_custkey")
    name = F.concat(F.lit("Jane "), F.initcap("c_mktsegment"))
    return table(spark, folder, "customer").select(
        key, name.alias("name"), F.concat(F.lit("jane."), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("123-456-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
        "c_name", F.col("c_nationkey").alias("age"), F.col("c_acctbal").alias("salary"),
    )


@query("mask_columns", """
SELECT c_custkey, 'J*** ' || substr(c_mktsegment, 1, 1) || '***' AS name, 'j***@example.com' AS email,
  '***-***-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone, sha256('key:' || c_name) AS c_name,
  c_nationkey AS age, c_acctbal AS salary
FROM customer
""")
def mask_columns(spark, folder):
    kinds = {"name": "name", "email": "email", "phone": "phone", "c_name": "token"}
    return privacy.mask_columns(_people(spark, folder), kinds, key="key")


_FIRST = _picked(_uniform("c_custkey", "first", 11), privacy.FIRST_NAMES)
_LAST = _picked(_uniform("c_custkey", "last", 11), privacy.LAST_NAMES)


@query("surrogate_pii", f"""
SELECT c_custkey, {_FIRST} || ' ' || {_LAST} AS name, lower({_FIRST}) || '.' || lower({_LAST}) || '@example.com' AS email,
  '555-010-' || lpad(CAST(CAST(floor({_uniform('c_custkey', 'phone', 11)} * 10000) AS BIGINT) AS VARCHAR), 4, '0')
    AS phone,
  c_nationkey AS age, round(c_acctbal * (1 + 0.05::DOUBLE * (2 * {_uniform('c_custkey', 'salary', 11)} - 1)), 2) AS salary
FROM customer
""")
def surrogate_pii(spark, folder):
    people = _people(spark, folder).drop("c_name")
    kinds = {"name": "name", "email": "email", "phone": "phone"}
    return privacy.surrogate_pii(people, "c_custkey", kinds, {"salary": 0.05}, seed=11)


_NAMES = ["Henry", "Toronto", "Elle", "Hein"]


#: Numbers as the SQL sees them; neighbours share the character between them, so they are replaced twice.
_NUMBERS_SQL = (
    r"(^|[^0-9A-Za-z])(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}|\d{13,19}|\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}([ -]?\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5}"
    r"|(\+?\d{1,2}[ .-])?(\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}([ .-]?\d{2,4}){2,5}|\d{3}-\d{2}-\d{4}"
    r"|[A-Z]{2}\d\d( ?[A-Z\d]{4}){2,7}( ?[A-Z\d]{1,3})?)([^0-9A-Za-z]|$)"
)


def _redacted_sql(text: str) -> str:
    text = f"regexp_replace({text}, '[\\p{{L}}\\p{{M}}\\p{{N}}._%+-]+@[\\p{{L}}\\p{{M}}\\p{{N}}-]+(\\.[\\p{{L}}\\p{{M}}\\p{{N}}-]+)+', '*', 'g')"
    for _ in range(2):
        text = f"regexp_replace({text}, '{_NUMBERS_SQL}', '\\1*\\9', 'g')"
    text = f"regexp_replace({text}, '((ID|Id|id)[:#]? ?)\\d\\d\\d\\d+', '\\1*', 'g')"
    name = r"(^|[^\p{L}\p{N}])(Henry|Toronto|Elle|Hein)([^\p{L}\p{M}\p{N}]|$)"
    for _ in range(2):  # neighbours share the character between them
        text = f"regexp_replace({text}, '{name}', '\\1*\\3', 'g')"
    return text


@query("redact_text", f"SELECT doc_id, {_redacted_sql('text')} AS text FROM documents")
def redact_text(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", privacy.redact_text(F.col("text"), _NAMES).alias("text"))


@query("redact_conversations", f"SELECT conv_id, turn, {_redacted_sql('text')} AS text FROM conversations")
def redact_conversations(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", privacy.redact_text(F.col("text"), _NAMES).alias("text"))
