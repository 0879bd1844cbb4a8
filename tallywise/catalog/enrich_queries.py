"""Queries of imputing, converting, standardising and classifying."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywise.catalog.registry import query, table
from tallywise.operators import enrich, sets, standardise

_SPLIT_TITLE = """array_to_string(list_transform(string_split(lower({c}), ' '),
  lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"""


@query("title_case", f"""
SELECT p_partkey, {_SPLIT_TITLE.format(c="p_name")} AS name, {_SPLIT_TITLE.format(c="p_type || ' part'")} AS kind FROM part
""")
def title_case(spark, folder):
    mixed = F.concat(F.upper(F.substring("p_name", 1, 2)), F.expr("substring(p_name, 3)"))
    return table(spark, folder, "part").select(
        "p_partkey", standardise.title_case(mixed).alias("name"),
        standardise.title_case(F.concat("p_type", F.lit(" PART"))).alias("kind"),
    )


# -- type conversion ------------------------------------------------------------

_WORDS = [*standardise.UNIT_WORDS, "twenty", "thirty-one", "forty two", "Ninety-Nine"]
_NUMBERS = [*range(20), 20, 31, 42, 99]


def _dirty_parts(spark, folder):
    """Sizes as digits, decimals, words and junk; dates in four layouts."""
    key = F.col("p_partkey")
    word = F.element_at(F.array(*[F.lit(w) for w in _WORDS]), (key % len(_WORDS) + 1).cast("int"))
    size = (
        F.when(key % 4 == 0, F.col("p_size").cast("string"))
        .when(key % 4 == 1, F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".5")))
        .when(key % 4 == 2, word)
        .otherwise("many")
    )
    day = F.date_add(F.lit("1994-12-04").cast("date"), (key % 3000).cast("int"))
    date = (
        F.when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(key % 5 == 2, F.date_format(day, "MMMM d, yyyy"))
        .when(key % 5 == 3, F.date_format(day, "MMM d,, ''yy"))
        .otherwise("soon")
    )
    ident = F.lpad(key.cast("string"), 9, "0")
    return table(spark, folder, "part").select(
        "p_partkey", ident.alias("ident"), size.alias("size"), date.alias("day")
    )


_RULES = {"ident": "int", "size": "double", "day": "date"}
_DAY = "CAST(DATE '1994-12-04' + CAST(p_partkey % 3000 AS INTEGER) AS VARCHAR)"
_NUMBER_LIST = "[" + ", ".join(str(n) for n in _NUMBERS) + "]"


@query("convert_types", f"""
SELECT p_partkey, CAST(p_partkey AS INTEGER) AS ident,
  CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size + 0.5
    WHEN 2 THEN {_NUMBER_LIST}[p_partkey % {len(_NUMBERS)} + 1] END AS DOUBLE) AS size,
  CASE WHEN p_partkey % 5 <> 4 THEN {_DAY} END AS day
FROM part
""")
def convert_types(spark, folder):
    done = standardise.convert_types(_dirty_parts(spark, folder), _RULES)
    return done.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("conversion_rejects", """
SELECT p_partkey, 'size' AS col_name, 'many' AS raw_value FROM part WHERE p_partkey % 4 = 3
UNION ALL SELECT p_partkey, 'day', 'soon' FROM part WHERE p_partkey % 5 = 4
""")
def conversion_rejects(spark, folder):
    return standardise.conversion_rejects(_dirty_parts(spark, folder), _RULES, ["p_partkey"])


# -- imputation -----------------------------------------------------------------

@query("impute_lookup", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE 'known' END AS n_name
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def impute_lookup(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey"),
        F.when(F.col("c_custkey") % 3 != 0, "known").alias("n_name"),
    )
    return enrich.impute_lookup(customers, "n_name", "n_nationkey", table(spark, folder, "nation")).drop("n_nationkey")


def _mode_sql(target: str, group: str) -> str:
    return f"""
      SELECT {group}, {target} AS best FROM (SELECT {group}, {target}, count(*) AS n FROM holes
        WHERE {target} IS NOT NULL AND {group} IS NOT NULL GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY n DESC, {target}) = 1"""


@query("fill_mode", f"""
WITH holes AS (
  SELECT p_partkey, CASE WHEN p_partkey % 5 <> 2 THEN p_brand END AS p_brand,
    CASE WHEN p_partkey % 7 <> 2 THEN p_type END AS p_type, p_size FROM part)
SELECT p_partkey, coalesce(h.p_brand, b.best) AS p_brand, coalesce(h.p_type, t.best) AS p_type
FROM holes h LEFT JOIN ({_mode_sql('p_brand', 'p_size')}) b ON b.p_size = h.p_size
LEFT JOIN ({_mode_sql('p_type', 'p_brand')}) t ON t.p_brand = h.p_brand
""")
def fill_mode(spark, folder):
    key = F.col("p_partkey")
    holes = table(spark, folder, "part").select(
        key, F.when(key % 5 != 2, F.col("p_brand")).alias("p_brand"),
        F.when(key % 7 != 2, F.col("p_type")).alias("p_type"), "p_size",
    )
    return enrich.impute_any(holes, {"p_brand": ["p_size"], "p_type": ["p_brand"]}).drop("p_size")


_LINE_HOLES = """
holes AS (SELECT l_returnflag, l_linestatus, l_orderkey,
  CASE WHEN l_orderkey % 6 <> 1 THEN l_extendedprice END AS price,
  CASE WHEN l_orderkey % 7 <> 1 THEN CAST(l_quantity AS INTEGER) END AS quantity FROM lineitem)
"""


def _line_holes(spark, folder):
    key = F.col("l_orderkey")
    price = F.when(key % 6 == 1, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    quantity = F.when(key % 7 != 1, F.col("l_quantity").cast("int"))
    return table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", key, price.alias("price"), quantity.alias("quantity")
    )


_BY = ["l_returnflag", "l_linestatus"]


@query("impute_numeric", f"""
WITH {_LINE_HOLES}, means AS (
  SELECT l_returnflag, l_linestatus, sum(CAST(price AS DECIMAL(28,6))) / count(price) AS p,
    sum(quantity) / count(quantity) AS q FROM holes GROUP BY 1, 2)
SELECT l_orderkey, l_returnflag, l_linestatus, round(coalesce(price, CAST(p AS DOUBLE)), 4) AS price,
  coalesce(quantity, CAST(round(q) AS INTEGER)) AS quantity
FROM holes JOIN means USING (l_returnflag, l_linestatus)
""")
def impute_numeric(spark, folder):
    """NaN prices and null quantities, both filled by the mean of their group."""
    filled = enrich.impute_numeric(_line_holes(spark, folder), {"price": "double", "quantity": "int"}, _BY)
    return filled.withColumn("price", F.round("price", 4))


@query("impute_numeric_overall", f"""
WITH {_LINE_HOLES}
SELECT l_orderkey, round(coalesce(price, (SELECT CAST(sum(CAST(price AS DECIMAL(28,6))) / count(price) AS DOUBLE)
  FROM holes)), 4) AS price FROM holes
""")
def impute_numeric_overall(spark, folder):
    holes = _line_holes(spark, folder).select("l_orderkey", "price")
    return enrich.impute_numeric(holes, {"price": "double"}).withColumn("price", F.round("price", 4))


@query("impute_median", """
WITH holes AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 6 <> 1 THEN p_retailprice END AS price FROM part),
medians AS (SELECT p_brand, quantile_disc(price, 0.5) AS m FROM holes GROUP BY 1)
SELECT p_partkey, p_brand, coalesce(price, m) AS price FROM holes JOIN medians USING (p_brand)
""")
def impute_median(spark, folder):
    holes = table(spark, folder, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_partkey") % 6 != 1, F.col("p_retailprice")).alias("price")
    )
    return enrich.impute_numeric(holes, {"price": "double"}, ["p_brand"], how="median")


@query("impute_regression", """
WITH holes AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 6 <> 1 THEN p_retailprice END AS price FROM part),
line AS (SELECT regr_slope(price, p_size) AS s, regr_intercept(price, p_size) AS i FROM holes)
SELECT p_partkey, p_size, round(coalesce(price, s * p_size + i), 4) AS price FROM holes, line
""")
def impute_regression(spark, folder):
    holes = table(spark, folder, "part").select(
        "p_partkey", "p_size", F.when(F.col("p_partkey") % 6 != 1, F.col("p_retailprice")).alias("price")
    )
    return enrich.impute_regression(holes, "price", "p_size").withColumn("price", F.round("price", 4))


# -- time series ----------------------------------------------------------------

def _daily_events(spark, folder):
    """Daily totals per event type with days left out and values emptied."""
    day = F.dayofmonth("day")
    totals = (
        table(spark, folder, "events")
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    )
    kept = totals.where((day % 5 != 2) | day.isin(1, 30))
    return kept.withColumn("total", F.when((day % 7 != 3) & (day != 30), F.col("total")))


_SERIES = """
daily AS (
  SELECT event_type, CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM events GROUP BY 1, 2),
kept AS (
  SELECT event_type, day, CASE WHEN day(day) % 7 <> 3 AND day(day) <> 30 THEN total END AS total FROM daily
  WHERE day(day) % 5 <> 2 OR day(day) IN (1, 30)),
ends AS (SELECT event_type, min(day) AS lo, max(day) AS hi FROM kept GROUP BY 1),
calendar AS (SELECT event_type, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM ends),
filled AS (
  SELECT event_type, day, total,
    last_value(CASE WHEN total IS NOT NULL THEN day END IGNORE NULLS) OVER up AS d0, last_value(total IGNORE NULLS) OVER up AS v0,
    first_value(CASE WHEN total IS NOT NULL THEN day END IGNORE NULLS) OVER down AS d1, first_value(total IGNORE NULLS) OVER down AS v1
  FROM calendar LEFT JOIN kept USING (event_type, day)
  WINDOW up AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    down AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
"""


def _shown(series):
    return series.withColumns({
        "day": F.date_format("day", "yyyy-MM-dd"), "total": F.round("total", 4), "filled": F.col("filled").cast("int")
    })


@query("fill_series_locf", f"""
WITH {_SERIES}
SELECT event_type, CAST(day AS VARCHAR) AS day, round(coalesce(total, v0, v1), 4) AS total,
  CASE WHEN total IS NULL THEN 1 ELSE 0 END AS filled FROM filled
""")
def fill_series_locf(spark, folder):
    return _shown(enrich.fill_series(_daily_events(spark, folder), "day", "total", ["event_type"]))


@query("fill_series_linear", f"""
WITH {_SERIES}
SELECT event_type, CAST(day AS VARCHAR) AS day, round(coalesce(total, CASE WHEN d1 > d0
    THEN v0 + (v1 - v0) * (CAST(day - d0 AS DOUBLE) / (d1 - d0)) ELSE coalesce(v0, v1) END, v0, v1), 4) AS total,
  CASE WHEN total IS NULL THEN 1 ELSE 0 END AS filled FROM filled
""")
def fill_series_linear(spark, folder):
    """Chunks of four days, so that most gaps cross a chunk."""
    series = enrich.fill_series(_daily_events(spark, folder), "day", "total", ["event_type"], "linear", chunk_days=4)
    return _shown(series)


# -- vocabularies ---------------------------------------------------------------

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("standardise_category", """
WITH typed AS (
  SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_mktsegment WHEN 1 THEN lower(c_mktsegment)
    WHEN 2 THEN substr(c_mktsegment, 1, 2) || substr(c_mktsegment, 4) WHEN 3 THEN 'Home & Car' ELSE 'zzzzzzzzzzzz' END
    AS raw FROM customer),
near AS (
  SELECT c_custkey, raw, min_by(name, (levenshtein(lower(raw), lower(name)), name)) AS name,
    min(levenshtein(lower(raw), lower(name))) AS edits
  FROM typed CROSS JOIN (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS name)
  GROUP BY ALL)
SELECT c_custkey, raw, CASE WHEN raw = 'Home & Car' THEN 'HOUSEHOLD' WHEN edits <= 3 THEN name END AS segment FROM near
""")
def standardise_category(spark, folder):
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    raw = (
        F.when(key % 5 == 0, segment).when(key % 5 == 1, F.lower(segment))
        .when(key % 5 == 2, F.concat(F.substring(segment, 1, 2), F.expr("substring(c_mktsegment, 4)")))
        .when(key % 5 == 3, "Home & Car").otherwise("zzzzzzzzzzzz")
    )
    rows = table(spark, folder, "customer").select("c_custkey", raw.alias("raw"))
    found = standardise.standardise_category(F.col("raw"), {"home & car": "HOUSEHOLD"}, _SEGMENTS)
    return rows.select("c_custkey", "raw", found.alias("segment"))


@query("value_mapping", """
SELECT o_orderkey, n_name AS nation FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT o_orderkey, NULL FROM orders ANTI JOIN customer ON c_custkey = o_custkey
""")
def value_mapping(spark, folder):
    """A mapping table as large as the customers, not a literal."""
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    aliases = customers.select(F.concat(F.lit("Cust "), F.col("c_custkey").cast("string")).alias("alias"),
                               F.col("n_name").alias("canonical"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.concat(F.lit(" CUST "), F.col("o_custkey").cast("string")).alias("who")
    )
    return standardise.value_mapping(orders, "who", aliases, "nation").drop("who")


@query("standardise_product", """
SELECT p_partkey, 'Apple' AS brand, 'iPhone ' || (p_size % 15 + 1) || ' Pro Max' AS model,
  (64 * (1 + p_partkey % 4)) || 'GB' AS storage,
  'Apple iPhone ' || (p_size % 15 + 1) || ' Pro Max ' || (64 * (1 + p_partkey % 4)) || 'GB' AS name
FROM part
""")
def standardise_product(spark, folder):
    number = (F.col("p_size") % 15 + 1).cast("string")
    size = (64 * (1 + F.col("p_partkey") % 4)).cast("string")
    raw = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("iPhone "), number, F.lit(" Pro Max "), size, F.lit("GB")))
        .when(F.col("p_partkey") % 3 == 1,
              F.concat(F.lit("Apple iphone "), number, F.lit(" pro max ("), size, F.lit(" gb)")))
        .otherwise(F.concat(number, F.lit(" Pro Max iPhone - "), size, F.lit("GB")))
    )
    return table(spark, folder, "part").select("p_partkey", standardise.standardise_product(raw).alias("p")).select(
        "p_partkey", "p.*"
    )


_CITIES = [("Springfield", "Ohio", "OH"), ("Los Angeles", "Cali", "CA"), ("New York", "NY", "NY"),
           ("Salem", "Oregon", "OR"), ("Fargo", "North Dakota", "ND")]


def _pick(entry: int):
    listed = F.array(*[F.lit(city[entry]) for city in _CITIES])
    return F.element_at(listed, (F.col("c_custkey") % len(_CITIES) + 1).cast("int"))


def _pick_sql(entry: int) -> str:
    return "[" + ", ".join(f"'{city[entry]}'" for city in _CITIES) + f"][c_custkey % {len(_CITIES)} + 1]"


@query("parse_address", f"""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN (c_custkey % 9999 + 1) || ' Main St, Apt ' || c_nationkey
    WHEN 1 THEN (c_custkey % 9999 + 1) || ' Elm Avenue'
    ELSE (c_custkey % 9999 + 1) || ' Oak Rd Suite ' || (c_nationkey + 100) END AS street,
  CASE c_custkey % 3 WHEN 1 THEN 'Chicago' ELSE {_pick_sql(0)} END AS city,
  CASE c_custkey % 3 WHEN 1 THEN 'IL' ELSE {_pick_sql(2)} END AS state,
  CAST(10000 + c_custkey % 80000 AS VARCHAR) AS zip
FROM customer
""")
def parse_address(spark, folder):
    """The parts in three orders; house numbers have up to four digits."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    house = (key % 9999 + 1).cast("string")
    code = (10000 + key % 80000).cast("string")
    raw = (
        F.when(key % 3 == 0, F.concat(house, F.lit(" Main St, Apt "), nation, F.lit(", "), _pick(0), F.lit(", "),
                                      _pick(1), F.lit(" "), code))
        .when(key % 3 == 1, F.concat(code, F.lit(" "), house, F.lit(" Elm Avenue, Chicago")))
        .otherwise(F.concat(_pick(0), F.lit(" "), house, F.lit(" Oak Rd Suite "), nation + 100, F.lit(" "), _pick(1),
                            F.lit(" "), code))
    )
    return table(spark, folder, "customer").select("c_custkey", standardise.parse_address(raw).alias("a")).select(
        "c_custkey", "a.*"
    )


@query("normalise_location", f"""
SELECT c_custkey, CASE c_custkey % 4 WHEN 3 THEN 'San Francisco' ELSE {_pick_sql(0)} END AS city,
  CASE c_custkey % 4 WHEN 3 THEN 'CA' ELSE {_pick_sql(2)} END AS state,
  CASE c_custkey % 4 WHEN 2 THEN 'Canada' ELSE 'USA' END AS country
FROM customer
""")
def normalise_location(spark, folder):
    key = F.col("c_custkey")
    raw = (
        F.when(key % 4 == 0, F.concat(_pick(0), F.lit(", "), _pick(1)))
        .when(key % 4 == 1, F.concat(_pick(0), F.lit(", "), _pick(2), F.lit(", U.S.")))
        .when(key % 4 == 2, F.concat(_pick(0), F.lit(", "), _pick(1), F.lit(", Canada")))
        .otherwise("San Fran")
    )
    return table(spark, folder, "customer").select(
        "c_custkey", standardise.normalise_location(raw).alias("l")
    ).select("c_custkey", "l.*")


# -- classes --------------------------------------------------------------------

_RULE_WORDS = {
    "English": ["the", "of", "and", "with", "that", "was"],
    "French": ["le", "la", "un", "une", "dans", "qui"],
    "German": ["der", "die", "den", "ver", "von", "und"],
    "Spanish": ["de", "los", "el", "que", "en", "por"],
}
_SCORES = ", ".join(
    f"len(list_intersect(words, {words})) AS s{i}" for i, words in enumerate(_RULE_WORDS.values())
)


@query("classify_text", f"""
WITH scored AS (
  SELECT doc_id, {_SCORES} FROM (
    SELECT doc_id, list_distinct(string_split_regex(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS words FROM documents))
SELECT doc_id, CASE WHEN greatest(s0, s1, s2, s3) = 0 THEN 'Other' WHEN s0 >= greatest(s1, s2, s3) THEN 'English'
  WHEN s1 >= greatest(s2, s3) THEN 'French' WHEN s2 >= s3 THEN 'German' ELSE 'Spanish' END AS label
FROM scored
""")
def classify_text(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", standardise.classify_text(F.col("text"), _RULE_WORDS).alias("label"))


@query("class_distribution", "SELECT quality, count(*) AS n FROM labels GROUP BY 1")
def class_distribution(spark, folder):
    return sets.class_distribution(table(spark, folder, "labels"), "quality")
