"""The sample inputs with the results they were written for."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywise.operators import enrich, standardise as st
from tallywise.functions import dates, labels
from tallywise.functions.records import first_json_value, missing_as_null
from tests.conftest import rows


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def test_missing_author_by_title(spark):
    schema = "Title string, Author string, Genre string"
    books = spark.createDataFrame([
        ("The Great Gatsby", "F. Scott Fitzgerald", "Novel"), ("To Kill a Mockingbird", "Harper Lee", "Fiction"),
        ("1984", "George Orwell", "Dystopian"), ("Pride and Prejudice", None, "Romance"),
    ], schema)
    ref = spark.createDataFrame([("Pride and Prejudice", "Jane Austen"), ("1984", "someone else")], "Title string, Author string")
    found = dict((r["Title"], r["Author"]) for r in enrich.impute_lookup(books, "Author", "Title", ref).collect())
    assert found["Pride and Prejudice"] == "Jane Austen" and found["1984"] == "George Orwell" and len(found) == 4


def test_any_missing_column_from_the_rows_as_they_came(spark):
    books = spark.createDataFrame([
        (None, "Austen", "Romance"), ("Emma", "Austen", "Romance"), ("Emma", None, "Romance"), ("1984", None, None),
    ], "title string, author string, genre string")
    found = enrich.impute_any(books, {"title": ["author"], "author": ["title"], "genre": ["author"]})
    assert rows(found) == [("1984", None, None), ("Emma", "Austen", "Romance"), ("Emma", "Austen", "Romance"),
                           ("Emma", "Austen", "Romance")]


def test_missing_numbers(spark):
    nan = float("nan")
    products = spark.createDataFrame(
        [("A", 10.99, 100.0), ("B", nan, 150.0), ("C", 15.50, None), ("D", 8.75, 200.0), ("E", nan, 175.0)],
        "Product string, Price double, Quantity double",
    )
    filled = enrich.impute_numeric(products, {"Price": "double", "Quantity": "int"})
    found = {r["Product"]: (r["Price"], r["Quantity"]) for r in filled.collect()}
    assert found["B"][0] == pytest.approx((10.99 + 15.50 + 8.75) / 3) and found["C"][1] == 156
    assert filled.schema["Quantity"].dataType.simpleString() == "int"
    median = {r["Product"]: r["Price"] for r in enrich.impute_numeric(products, {"Price": "double"}, how="median").collect()}
    assert median["E"] == 10.99
    with pytest.raises(ValueError):
        enrich.impute_numeric(products, {"Price": "double"}, how="guess")


def test_missing_numbers_on_a_line(spark):
    phones = spark.createDataFrame(
        [("a", 10.0, 1.0), ("b", 20.0, 2.0), ("c", None, 4.0), ("d", 30.0, 3.0)], "p string, price double, days double"
    )
    found = {r["p"]: r["price"] for r in enrich.impute_regression(phones, "price", "days").collect()}
    assert found["c"] == pytest.approx(40.0) and found["a"] == 10.0


TEMPERATURES = [20, 22, None, 19, 18, None, 23, 25, 24, None]


@pytest.mark.parametrize("chunk", [1, 3, 366])
@pytest.mark.parametrize("how,expected", [
    ("locf", [20, 22, 22, 19, 18, 18, 23, 25, 24, 24]), ("linear", [20, 22, 20.5, 19, 18, 20.5, 23, 25, 24, 24]),
])
def test_series(spark, how, expected, chunk):
    start = datetime.date(2023, 1, 1)
    data = [(start + datetime.timedelta(i), None if v is None else float(v)) for i, v in enumerate(TEMPERATURES)]
    df = spark.createDataFrame(data, "Date date, Temperature double")
    found = enrich.fill_series(df, "Date", "Temperature", how=how, chunk_days=chunk).orderBy("Date").collect()
    assert [r["Temperature"] for r in found] == expected
    assert [r["filled"] for r in found] == [v is None for v in TEMPERATURES]
    # The same days left out instead of empty.
    sparse = df.where("Temperature IS NOT NULL OR Date = '2023-01-10'")
    again = enrich.fill_series(sparse, "Date", "Temperature", how=how, chunk_days=chunk).orderBy("Date").collect()
    assert [r["Temperature"] for r in again] == expected


def test_series_keys_stay_apart_and_leading_gaps_fill_backward(spark):
    df = spark.createDataFrame(
        [("a", "2023-01-01", None), ("a", "2023-03-01", 5.0), (None, "2023-01-01", 1.0), (None, "2023-01-03", 3.0)],
        "k string, d string, v double",
    ).withColumn("d", F.to_date("d"))
    found = enrich.fill_series(df, "d", "v", ["k"], how="linear", chunk_days=7)
    assert found.where("k = 'a'").count() == 60
    assert rows(found.where("k = 'a'").select("v").distinct()) == [(5.0,)]
    assert [r["v"] for r in found.where("k IS NULL").orderBy("d").collect()] == [1.0, 2.0, 3.0]


def test_second_row_of_a_day_comes_back(spark):
    df = spark.createDataFrame([("2023-01-01", 1.0), ("2023-01-01", 2.0), ("2023-01-03", 4.0)], "d string, v double")
    found = rows(enrich.fill_series(df.withColumn("d", F.to_date("d")), "d", "v").select(F.dayofmonth("d"), "v"))
    assert len(found) == 4 and {(1, 1.0), (1, 2.0), (3, 4.0)} < set(found)


def test_mixed_types(spark):
    df = spark.createDataFrame([
        ("001", "10.5", "2023-01-01"), ("002", "15", "01/15/2023"), ("003", "twenty", "March 1, 2023"),
        ("00006", "thirty-one", "Dec 4,, '94"), ("x", "many", "soon"),
    ], "ID string, Value string, Date string")
    rules = {"ID": "int", "Value": "double", "Date": "date"}
    day = datetime.date
    assert [tuple(r) for r in st.convert_types(df, rules).collect()] == [
        (1, 10.5, day(2023, 1, 1)), (2, 15.0, day(2023, 1, 15)), (3, 20.0, day(2023, 3, 1)), (6, 31.0, day(1994, 12, 4)),
        (None, None, None),
    ]
    bad = st.conversion_rejects(df, rules, [])
    assert rows(bad) == [("Date", "soon"), ("ID", "x"), ("Value", "many")]
    with pytest.raises(ValueError):
        st.convert_types(df, {"ID": "colour"})


def test_number_words(spark):
    cases = {"zero": 0, "Nineteen": 19, "ninety nine": 99, "twenty zero": None, "one two": None, "": None, "thirty": 30}
    df = column(spark, cases).select("c", st.number_from_words(F.col("c")).alias("n"))
    assert {r["c"]: r["n"] for r in df.collect()} == cases


def test_addresses(spark):
    df = column(spark, [
        "123 Main St, Apt 4, New York, NY 10001", "60601 456 Elm Avenue, Chicago",
        "Los Angeles 789 Oak Rd Suite 100 Cali 90001",
    ])
    assert [tuple(r) for r in df.select(st.parse_address(F.col("c")).alias("a")).select("a.*").collect()] == [
        ("123 Main St, Apt 4", "New York", "NY", "10001"), ("456 Elm Avenue", "Chicago", "IL", "60601"),
        ("789 Oak Rd Suite 100", "Los Angeles", "CA", "90001"),
    ]


def test_locations(spark):
    df = column(spark, ["New York, NY", "Los Angeles, California", "Chicago, IL, USA", "San Fran", "Paris"])
    assert [tuple(r) for r in df.select(st.normalise_location(F.col("c")).alias("a")).select("a.*").collect()] == [
        ("New York", "NY", "USA"), ("Los Angeles", "CA", "USA"), ("Chicago", "IL", "USA"),
        ("San Francisco", "CA", "USA"), ("Paris", None, None),
    ]


def test_title_case(spark):
    df = column(spark, ["RED apple", "Green BANANA", "yellow Lemon", "ORANGE orange"])
    assert [r[0] for r in df.select(st.title_case(F.col("c"))).collect()] == [
        "Red Apple", "Green Banana", "Yellow Lemon", "Orange Orange"]


def test_categories(spark):
    names = ["IT", "Information Technology", "Tech", "I.T.", "Information Tech", "Cyber", "Cyberscryity", "Cybersecurity",
             "Gardening tools"]
    aliases = {"Information Technology": "IT", "Tech": "IT", "I.T.": "IT", "Information Tech": "IT", "Cyber": "Cybersecurity"}
    found = column(spark, names).select(st.standardise_category(F.col("c"), aliases, ["IT", "Cybersecurity"]))
    assert [r[0] for r in found.collect()] == ["IT"] * 5 + ["Cybersecurity"] * 3 + [None]
    many = aliases | {f"alias {i}": "IT" for i in range(300)}
    assert column(spark, ["Tech"]).select(st.standardise_category(F.col("c"), many, ["IT"])).first()[0] == "IT"
    table = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    mapped = st.value_mapping(column(spark, ["tech ", "zzz"]), "c", table, "kind")
    assert rows(mapped) == [("tech ", "IT"), ("zzz", None)]


def test_products(spark):
    df = column(spark, ["iPhone 12 Pro Max 256GB", "Apple iphone 12 pro max (256 gb)", "12 Pro Max iPhone - 256GB", "pear"])
    found = [tuple(r) for r in df.select(st.standardise_product(F.col("c")).alias("p")).select("p.*").collect()]
    assert found[:3] == [("Apple", "iPhone 12 Pro Max", "256GB", "Apple iPhone 12 Pro Max 256GB")] * 3
    assert found[3] == (None, None, None, "")


def test_classes(spark):
    news = {"Technology": ["tech", "microsoft", "amazon", "apple", "nasdaq"], "Sports": ["gymnasts", "olympics", "score"]}
    texts = ["Apple, Microsoft, and Amazon all beat expectations, driving the NASDAQ.",
             "one of the greatest gymnasts on her return to the Olympics", "A quiet day."]
    found = column(spark, texts).select(st.classify_text(F.col("c"), news))
    assert [r[0] for r in found.collect()] == ["Technology", "Sports", "Other"]
    people = {"Tech Enthusiast": ["electronics"], "Beauty Lover": ["cosmetics"], "Home & Garden": ["gardening"]}
    texts = ["John Doe, 35 years old, buys electronics frequently", "Jane Smith, 28 years old, purchases cosmetics monthly",
             "Bob Johnson, 50 years old, buys gardening supplies occasionally"]
    assert [r[0] for r in column(spark, texts).select(st.classify_text(F.col("c"), people)).collect()] == list(people)


def test_a_late_keyword_counts(spark):
    text = "word " * 30000 + "olympics"
    assert column(spark, [text]).select(st.classify_text(F.col("c"), {"Sports": ["olympics"]})).first()[0] == "Sports"


def test_prompts(spark):
    df = spark.createDataFrame([("A", None)], "Product string, Price double")
    made = enrich.render_prompt(df, "Predict: {Product}, {Price}. Row: {*}").first()["prompt"]
    assert made == 'Predict: A, None. Row: {"Product":"A","Price":null}'


def test_one_call_per_distinct_value(spark, tmp_path):
    log = str(tmp_path / "calls")

    def score(values):
        with open(log, "a") as out:
            out.writelines(f"{v}\n" for v in values)
        return pd.DataFrame({"size": values.str.len()})

    df = spark.createDataFrame([("a",), ("bb",), ("a",), (None,)], "c string").repartition(3)
    assert rows(enrich.map_distinct(df, "c", score, "size bigint", parallelism=2)) == [
        ("a", 1), ("a", 1), ("bb", 2), (None, None)]
    assert sorted(open(log).read().split()) == ["a", "bb"]


def test_responses_fill_only_what_is_missing(spark):
    df = spark.createDataFrame([
        (1, 9.5, None, '{"Price": "1", "Quantity": "3"}'), (2, float("nan"), 4, '{"Price": "2.5"}'), (3, None, None, "not json"),
    ], "id int, Price double, Quantity int, answer string")
    merged = enrich.merge_response(df, "answer", "Price string, Quantity string", {"Price": "Price", "Quantity": "Quantity"})
    assert rows(merged) == [(1, 9.5, 3), (2, 2.5, 4), (3, None, None)]


def test_small_functions(spark):
    df = column(spark, [0])
    one = df.select(
        labels.duration_label(F.lit(45)).alias("s"), labels.duration_label(F.lit(120)).alias("m"),
        labels.duration_label(F.lit(125)).alias("ms"), labels.day_month(F.lit("2025-05-09")).alias("d"),
        labels.product_label(F.lit("db.ipv_position_consumption")).alias("ipv"),
        labels.product_label(F.lit("db.risk_daily_position_v")).alias("p"),
        labels.product_label(F.lit("db.one")).alias("one"),
        labels.run_label(F.lit("A B")).alias("r"),
        labels.split_trimmed(F.lit(" a| b |c"), "|").alias("l"),
        dates.iso_stamp(F.lit("2025-05-09 10:11:12").cast("timestamp_ntz")).alias("z"),
        first_json_value(F.lit('{"x": [1, 2], "y": 3}')).alias("j"), first_json_value(F.lit("{}")).alias("j0"),
        missing_as_null(F.lit(float("nan")), "double").alias("nan"),
    ).first().asDict()
    assert one == {
        "s": "45 SECONDS", "m": "2 MINUTES", "ms": "2 MINUTES & 5 SECONDS", "d": "9 May", "ipv": "IPV",
        "p": "DAILY_POSITION", "one": "", "r": "TC_A_B_REGRESSION", "l": ["a", "b", "c"],
        "z": "2025-05-09T10:11:12.000Z", "j": "[1,2]", "j0": None, "nan": None,
    }
