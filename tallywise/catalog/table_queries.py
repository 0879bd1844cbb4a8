"""Queries of sources, sinks, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywise.catalog.pairs import ORDERS_CELLS, orders_comparison, orders_pair
from tallywise.catalog.registry import query, table
from tallywise.functions import dates, labels
from tallywise.functions.columns import trimmed_list
from tallywise.functions.records import event_payload, fill_missing, first_json_value, parse_json
from tallywise.operators import frames
from tallywise.operators.enrich import map_distinct, merge_response, render_prompt
from tallywise.plans import reports
from tallywise.plans.flows import compare_queries
from tallywise.session import scratch_path
from tallywise.sources import manifest, records
from tallywise.sources.delimited import read_delimited, read_report, write_report
from tallywise.sources.tables import from_batch, from_query


# -- sources and sinks ----------------------------------------------------------

@query("source_sql", """
SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS VARCHAR) AS total
FROM orders GROUP BY 1
""")
def source_sql(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("tw_orders")
    return from_query(spark, """
        SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS STRING) AS total
        FROM tw_orders GROUP BY o_orderpriority""")


@query("source_batch", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def source_batch(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("tw_orders")
    batch = from_batch(spark, "tw_orders", "o_orderpriority", "1-URGENT, 2-HIGH")
    return batch.select("o_orderkey", "o_orderpriority")


@query("delimited_roundtrip", """
SELECT CAST(c_custkey AS VARCHAR) AS cust_key, c_name, c_mktsegment || ', ' || c_nationkey AS market_and_nation
FROM customer
""")
def delimited_roundtrip(spark, folder):
    """Blanks in names, the separator inside values and single quotes around them."""
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("cust key "), "c_name",
        F.concat_ws(", ", "c_mktsegment", "c_nationkey").alias("market and nation"),
    )
    path = scratch_path(spark, "delimited")
    rows.write.options(header=True, sep=",", quote="'").csv(path)
    return read_delimited(spark, path, sep=",")


@query("report_roundtrip", f"""
WITH {ORDERS_CELLS}, pairs AS (SELECT col_name, base_value, actual_value, count(*) AS n FROM cells GROUP BY ALL)
SELECT col_name, base_value, actual_value, CAST(n AS VARCHAR) AS n FROM pairs QUALIFY row_number() OVER (
  PARTITION BY col_name ORDER BY n DESC, base_value NULLS FIRST, actual_value NULLS FIRST) <= 99
""")
def report_roundtrip(spark, folder):
    pairs = reports.top_value_pairs(reports.value_pair_counts(orders_comparison(spark, folder).changed_cells()))
    path = scratch_path(spark, "report")
    write_report(pairs, path)
    return read_report(spark, path)


@query("full_diff_report", f"WITH {ORDERS_CELLS} SELECT * FROM cells")
def full_diff_report(spark, folder):
    """The whole run of two queries, down to the written report of all cells."""
    base, actual = orders_pair(spark, folder)
    base.createOrReplaceTempView("tw_base")
    actual.createOrReplaceTempView("tw_actual")
    out = scratch_path(spark, "run")
    compare_queries(spark, "SELECT * FROM tw_base", "SELECT * FROM tw_actual", "o_orderkey", out, full_diff=True)
    return read_report(spark, f"{out}/Diffs")


@query("json_records", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events
UNION ALL
SELECT event_id, user_id, 'user' FROM events
""")
def json_records(spark, folder):
    """Two records per event inside the first value of an object."""
    first = F.struct(parse_json(F.col("props"), "k bigint").getField("k").alias("k"), F.col("event_type").alias("kind"))
    second = F.struct(F.col("user_id").alias("k"), F.lit("user").alias("kind"))
    wrapped = F.to_json(F.struct(F.array(first, second).alias("records"), F.lit("x").alias("note")))
    events = table(spark, folder, "events").select("event_id", wrapped.alias("doc"))
    return records.explode_json_records(events, "doc", "k bigint, kind string")


@query("first_json_value", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def first_value(spark, folder):
    return table(spark, folder, "events").select("event_id", first_json_value(F.col("props")).alias("k"))


@query("malformed_records", "SELECT event_id FROM events WHERE event_id % 7 = 3")
def malformed(spark, folder):
    broken = F.when(F.col("event_id") % 7 == 3, F.expr("substring(props, 2)")).otherwise(F.col("props"))
    events = table(spark, folder, "events").withColumn("props", broken)
    return records.malformed_records(events, "props", "k bigint").select("event_id")


@query("record_json", """
SELECT event_id, event_id AS back_id, event_type AS back_type, CAST(ts AS DATE) || '' AS back_day FROM events
""")
def record_json(spark, folder):
    """One JSON record per row, read back field by field."""
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    made = records.to_json_records(events, ["event_id", "event_type", "day"])
    back = parse_json(F.col("record"), "event_id bigint, event_type string, day string")
    return made.select("event_id", back.getField("event_id").alias("back_id"),
                       back.getField("event_type").alias("back_type"), back.getField("day").alias("back_day"))


@query("batched_records", """
SELECT c_custkey, c_name, CAST((n - 1) // 50 AS BIGINT) AS batch_no
FROM (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS n
  FROM customer)
""")
def batched_records(spark, folder):
    """Lists of fifty records as one prompt would take them, read back row by row."""
    lists = records.batch_json_records(table(spark, folder, "customer"), "c_custkey", ["c_custkey", "c_name"], 50)
    back = F.inline(F.from_json("records", "array<struct<c_custkey:bigint, c_name:string>>"))
    return lists.select("batch_no", back)


@query("manifest_check", """
SELECT source AS report, count(*) FILTER (WHERE source < 'src15' OR doc_id % 10 <> 0) AS expected,
  count(*) AS actual_files, count(DISTINCT lang) AS dirs, count(*) FILTER (WHERE doc_id % 6 = 0) AS zero_byte_files,
  CASE WHEN count(*) = count(*) FILTER (WHERE source < 'src15' OR doc_id % 10 <> 0) THEN 1 ELSE 0 END AS ok
FROM documents GROUP BY 1
UNION ALL
SELECT 'none' AS report, count(*), 0, 0, 0, 0 FROM documents
""")
def manifest_check(spark, folder):
    """Documents as a file listing: report by source, folder by language."""
    docs = table(spark, folder, "documents")
    length = F.when(F.col("doc_id") % 6 == 0, 0).otherwise(F.col("n_chars"))
    files = docs.select(F.col("source").alias("report"), F.col("lang").alias("folder"), length.alias("length"))
    wanted = F.count_if((F.col("source") < "src15") | (F.col("doc_id") % 10 != 0)).alias("expected_count")
    expected = docs.groupBy(F.col("source").alias("report")).agg(wanted)
    absent = docs.agg(F.count("*").alias("expected_count")).select(F.lit("none").alias("report"), "expected_count")
    checked = manifest.manifest_check(files, expected.unionByName(absent))
    return checked.withColumn("ok", F.col("ok").cast("int"))


# -- projections and filters ----------------------------------------------------

@query("key_projection", "SELECT l_orderkey, l_linenumber FROM lineitem")
def key_projection(spark, folder):
    return frames.select_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("drop_and_suffix", """
SELECT o_orderkey, o_custkey AS o_custkey_b, o_orderstatus AS o_orderstatus_b FROM orders WHERE o_orderstatus = 'F'
""")
def drop_and_suffix(spark, folder):
    orders = frames.drop_columns(
        table(spark, folder, "orders"),
        trimmed_list("o_totalprice, o_orderdate, o_orderpriority, not_there, "), ["o_orderkey"],
    )
    return frames.suffix_columns(orders, "_b", ["o_orderkey"]).where("o_orderstatus_b = 'F'")


@query("fill_nulls", """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN 'NULL_VALUE' WHEN o_orderkey % 10 = 3 THEN 'X'
  ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 97 <> 0
""")
def fill_nulls(spark, folder):
    _, actual = orders_pair(spark, folder)
    return frames.fill_nulls(actual.select("o_orderkey", "o_orderstatus"))


@query("point_in_time", "SELECT o_orderkey FROM orders WHERE o_orderdate = TIMESTAMP '1998-06-01 00:00:00'")
def point_in_time(spark, folder):
    import datetime

    day = datetime.datetime(1998, 6, 1)
    return frames.at_point(table(spark, folder, "orders"), "o_orderdate", day).select("o_orderkey")


@query("filter_range", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
  AND o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey % 9 <> 0
""")
def filter_range(spark, folder):
    orders = table(spark, folder, "orders").withColumn("archived", F.col("o_orderkey") % 9 == 0)
    kept = frames.filter_range(
        orders, "o_orderdate", "1997-01-01", "1997-12-31",
        members={"o_orderpriority": ["1-URGENT", "5-LOW"], "o_custkey": []}, archived_col="archived",
    )
    return kept.select("o_orderkey", "o_orderpriority")


@query("name_cleanup", """
SELECT p_partkey, p_name, replace(p_name, 'red', 'scarlet') AS new_name FROM part WHERE contains(p_name, 'red')
""")
def name_cleanup(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return frames.names_containing(parts, "p_name", "red", "scarlet", "new_name")


@query("sorted_head", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderkey DESC LIMIT 10")
def sorted_head(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return frames.head(orders, [F.asc("o_custkey"), F.desc("o_orderkey")], 10)


@query("sorted_tail", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey DESC, o_orderkey DESC LIMIT 10
""")
def sorted_tail(spark, folder):
    return frames.tail(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"], 10)


@query("append_rows", """
SELECT s_suppkey AS id, s_name AS name, NULL AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer
""")
def append_rows(spark, folder):
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return frames.append_rows(suppliers, customers)


# -- scalar functions -----------------------------------------------------------

@query("table_label", """
SELECT p_partkey, upper(CASE WHEN p_partkey % 7 = 0 THEN 'IPV' ELSE replace(p_name, ' ', '_') || '_' || p_type END)
  AS label,
  'TC_' || upper(CASE WHEN p_partkey % 7 = 0 THEN 'IPV' ELSE replace(p_name, ' ', '_') || '_' || p_type END)
  || '_REGRESSION' AS run
FROM part
""")
def table_label(spark, folder):
    own = F.concat(F.lit("db.risk_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.lower("p_type"),
                   F.lit("_daily"))
    name = F.when(F.col("p_partkey") % 7 == 0, "db.ipv_position_consumption").otherwise(own)
    label = labels.product_label(name)
    return table(spark, folder, "part").select(
        "p_partkey", label.alias("label"), labels.run_label(label).alias("run")
    )


@query("date_label", "SELECT o_orderkey, strftime(o_orderdate, '%-d %b') AS label FROM orders")
def date_label(spark, folder):
    day = dates.iso_date(F.col("o_orderdate"))
    return table(spark, folder, "orders").select("o_orderkey", labels.day_month(day).alias("label"))


@query("duration_label", """
SELECT o_orderkey, CASE WHEN s // 60 = 0 THEN (s % 60) || ' SECONDS' WHEN s % 60 = 0 THEN (s // 60) || ' MINUTES'
  ELSE (s // 60) || ' MINUTES & ' || (s % 60) || ' SECONDS' END AS label
FROM (SELECT o_orderkey, o_custkey % 300 AS s FROM orders)
""")
def duration_label(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", labels.duration_label(F.col("o_custkey") % 300).alias("label")
    )


@query("string_date_functions", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS stamp,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed_day,
  o_orderstatus || '+' || o_custkey AS items, trim(replace(o_orderpriority, '-', ' ')) AS priority,
  CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS price,
  'DAILY_REPORT_' || strftime(o_orderdate, '%Y_%m_%d_%M') || '_' || o_orderkey AS report
FROM orders
""")
def string_date_functions(spark, folder):
    orders = table(spark, folder, "orders")
    day = dates.iso_date(F.col("o_orderdate"))
    text = F.when(F.col("o_orderkey") % 3 == 0, "not a date").otherwise(day)
    items = labels.split_trimmed(F.concat(F.lit(" "), "o_orderstatus", F.lit(" , "), F.col("o_custkey").cast("string")))
    price = F.when(F.col("o_orderkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return orders.select(
        "o_orderkey", day.alias("day"), dates.iso_stamp(F.col("o_orderdate")).alias("stamp"),
        dates.iso_date(dates.to_stamp(text, "yyyy-MM-dd")).alias("parsed_day"),
        F.array_join(items, "+").alias("items"),
        F.trim(labels.replaced_name(F.col("o_orderpriority"), "-", " ")).alias("priority"),
        fill_missing(price, F.lit(0.0), "double").alias("price"),
        labels.report_name(F.lit("DAILY"), F.col("o_orderdate"), F.col("o_orderkey")).alias("report"),
    )


@query("payload_json", """
SELECT event_id, 'uploaded' AS action, CAST(user_id AS VARCHAR) AS author, strftime(ts, '%Y-%m-%d') AS day,
  strftime(ts, '%-d %b') AS slice, event_type AS kind, 'Pending' AS state FROM events
""")
def payload_json(spark, folder):
    day = dates.iso_date(F.col("ts"))
    payload = event_payload(
        F.lit("uploaded"), dates.iso_stamp(F.col("ts")), F.col("user_id").cast("string"), day, labels.day_month(day),
        F.concat(F.lit("file_"), F.col("event_id").cast("string")), F.col("event_type"),
    )
    events = table(spark, folder, "events").select("event_id", F.to_json(payload).alias("doc"))
    return events.select(
        "event_id", *[F.get_json_object("doc", path).alias(name) for name, path in (
            ("action", "$.actionLog[0].action"), ("author", "$.author"), ("day", "$.dateRange.from"),
            ("slice", "$.timeSlices[0]"), ("kind", "$.type"), ("state", "$.state"),
        )]
    )


@query("prompt_render", """
SELECT c_custkey, 'Classify ' || c_name || ' of ' || coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END, 'None')
  || '. Return only the answer.' AS prompt FROM customer
""")
def prompt_render(spark, folder):
    customers = table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    )
    prompts = render_prompt(customers, "Classify {c_name} of {c_mktsegment}. Return only the answer.")
    return prompts.select("c_custkey", "prompt")


def _stub(values):
    """Stands in for a caller's model."""
    import pandas as pd

    return pd.DataFrame({"label": values.str.lower(), "size": values.str.len().astype("int64")})


@query("map_distinct", """
SELECT c_custkey, lower(c_mktsegment) AS label, length(c_mktsegment) AS size FROM customer
""")
def map_over_distinct(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return map_distinct(customers, "c_mktsegment", _stub, "label string, size bigint").drop("c_mktsegment")


def _answers(prompts):
    """A stub model that answers in JSON."""
    import pandas as pd

    return pd.DataFrame({"answer": '{"Segment": "' + prompts.str.slice(0, 3) + '", "Nation": "7"}'})


@query("merge_response", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN substr(c_name, 1, 3) ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 5 = 0 THEN 7 ELSE c_nationkey END AS c_nationkey
FROM customer
""")
def merged_response(spark, folder):
    """Prompt per row, answer per distinct prompt, merged by field; what was there stays."""
    holes = table(spark, folder, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"),
    )
    answered = map_distinct(holes, "c_name", _answers, "answer string")
    merged = merge_response(answered, "answer", "Segment string, Nation string",
                            {"c_mktsegment": "Segment", "c_nationkey": "Nation"})
    return merged.drop("c_name")
