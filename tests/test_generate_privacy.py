from pyspark.sql import functions as F

from tallywise.operators import generate, privacy, sets
from tests.conftest import rows


def reviews(spark):
    data = [(i, f"good {i}", 1) for i in range(5)] + [(5, "Disappointed with the quality.", 0)]
    return spark.createDataFrame(data, "id int, review string, sentiment int")


def test_rebalance(spark):
    df = reviews(spark)
    assert [tuple(r) for r in sets.class_distribution(df, "sentiment").collect()] == [(1, 5), (0, 1)]
    even = generate.rebalance(df, "sentiment", "id")
    assert {tuple(r) for r in sets.class_distribution(even, "sentiment").collect()} == {(1, 5), (0, 5)}
    assert rows(even.where("is_copy = 0").drop("is_copy")) == rows(df)
    assert rows(even.where("is_copy = 1").select("id").distinct()) == [(5,)]


def test_rebalance_spreads_copies_and_raises_every_class(spark):
    df = spark.range(1, 101).select("id", F.when(F.col("id") <= 70, "a").when(F.col("id") <= 91, "b").otherwise("c").alias("y"))
    even = generate.rebalance(df, "y", "id")
    assert rows(even.groupBy("y").count()) == [("a", 70), ("b", 70), ("c", 70)]
    spread = even.groupBy("y", "id").count().groupBy("y").agg(F.max("count") - F.min("count")).collect()
    assert all(r[1] <= 1 for r in spread)


def test_balanced_input_gets_no_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, y string")
    assert generate.rebalance(df, "y", "id").count() == 2


def test_augment_keeps_schema_and_relation(spark):
    seed = spark.createDataFrame([(1, 25, 50000), (2, 40, 75000)], "id int, age int, income int")
    more = generate.augment(seed, "id", 3, {"age": 0.3}, ("age", "income"), seed=1)
    assert more.count() == 3 and more.drop("copy_no").schema == seed.schema
    both = generate.append_rows(seed, more.drop("copy_no")).orderBy("age").collect()
    assert [r["age"] for r in both] == sorted(r["age"] for r in both)
    # Both seed rows lie on one line, and so do the new ones, up to rounding.
    assert all(abs(r["income"] - (50000 + (r["age"] - 25) * 5000 / 3)) < 5000 / 3 + 1 for r in both)
    assert rows(more) == rows(generate.augment(seed.repartition(3), "id", 3, {"age": 0.3}, ("age", "income"), seed=1))


def test_synthesise(spark):
    spec = {
        "date": generate.date_between("2025-01-01", 30), "customer": generate.numbered_label("Customer "),
        "total": generate.amount_between(1.0, 9.0, negative_share=0.5), "rating": generate.integer_between(1, 5),
        "text": generate.one_of(["a", "b"]),
    }
    made = generate.synthesise(generate.id_range(spark, 2000), "id", spec)
    facts = made.agg(F.count_distinct("customer"), F.min("rating"), F.max("rating"), F.min(F.abs("total")), F.max("total"),
                     F.count_if(F.col("total") < 0), F.min("date").cast("string"), F.max("date").cast("string")).first()
    assert tuple(facts)[:3] == (2000, 1, 5)
    assert facts[3] >= 1.0 and facts[4] <= 9.0 and 850 < facts[5] < 1150
    assert (facts[6], facts[7]) == ("2025-01-01", "2025-01-30")
    assert made.where("id = 7").first()["customer"] == "Customer 007"
    assert rows(made) == rows(generate.synthesise(generate.id_range(spark, 2000).repartition(7), "id", spec))


def test_series_peaks_on_weekends(spark):
    df = generate.synthesise_series(generate.id_range(spark, 1), "id", "2025-01-01", 35, 200.0, 10.0, 2.0)
    by_kind = dict(rows(df.groupBy(F.dayofweek("date").isin(1, 7).alias("w")).agg(F.min("total_sales"))
                        .select(F.col("w").cast("int"), F.col("min(total_sales)"))))
    assert df.count() == 35 and by_kind[1] >= 400 > by_kind[0]


def test_edge_cases(spark):
    weather = spark.createDataFrame([("2023-01-01", 12.0, 3.0)], "date string, temperature double, wind double")
    cases = spark.createDataFrame([(-45.0, 60.0), (52.0, 0.0)], "temperature double, wind double")
    after = generate.inject_edge_cases(weather, cases, {"date": F.lit("2024-01-01"), "wind": F.lit(-1.0)})
    assert rows(sets.range_profile(weather, ["temperature"])) == [("temperature", 12.0, 12.0)]
    assert rows(sets.range_profile(after, ["temperature", "wind"])) == [("temperature", -45.0, 52.0), ("wind", 0.0, 60.0)]
    assert after.where("date = '2024-01-01'").count() == 2


PEOPLE = [("John Doe", "john@example.com", "123-456-7890", 30, 50000), ("Jane Smith", "jane@example.com", "234-567-8901", 25, 60000),
          ("Bob Johnson", "bob@example.com", "345-678-9012", 45, 75000)]
KINDS = {"Name": "name", "Email": "email", "Phone": "phone"}


def people(spark):
    return spark.createDataFrame(PEOPLE, "Name string, Email string, Phone string, Age int, Salary int")


def test_masks(spark):
    found = rows(privacy.mask_columns(people(spark), KINDS))
    assert found[0] == ("B*** J***", "b***@example.com", "***-***-9012", 45, 75000)
    tokens = privacy.mask_columns(people(spark), {"Name": "token"}, key="k")
    assert tokens.select("Name").distinct().count() == 3
    assert not {r["Name"] for r in tokens.collect()} & {p[0] for p in PEOPLE}


def test_surrogates_keep_ages_and_stay_near_salaries(spark):
    made = privacy.surrogate_pii(people(spark), "Name", KINDS, {"Salary": 0.1}, seed=2).collect()
    assert sorted(r["Age"] for r in made) == [25, 30, 45]
    assert not {r["Name"] for r in made} & {p[0] for p in PEOPLE}
    assert all(r["Email"].endswith("@example.com") and r["Phone"].startswith("555-010-") for r in made)
    assert all(abs(r["Salary"] - before) <= 0.1 * before for r, before in
               zip(sorted(made, key=lambda r: r["Age"]), [60000, 50000, 75000]))


def test_redaction(spark):
    text = ("My name is Henry and I live in Toronto and I was having trouble accessing my bank account "
            "(account ID: 125526). Could you please help me?")
    cases = {
        text: "My name is * and I live in * and I was having trouble accessing my bank account (account ID: *). "
              "Could you please help me?",
        "Mail a.b+c@mail.example.com, call (123) 456-7890 or 123-456-7890 from 10.0.0.1": "Mail *, call * or * from *",
        "card 4111 1111 1111 1111 ssn 123-45-6789": "card * ssn *",
        "card 4111111111111111123 or 1234-5678-9012-3456-7, 3782 822463 10005.": "card * or *, *.",
        "two 4465758382889437 4465758382889437 cards": "two * * cards",
        "not an address: 10.0.0.12345, nor a card: 12345678901234567890123": "not an address: 10.0.0.12345, nor a card: 12345678901234567890123",
        "josé@exämple.com, DE89 3704 0044 0532 0130 00, GB29NWBK60161331926819": "*, *, *",
        "+44 20 7946 0958 and +1 (663) 555-6869 and 123-45-67890": "* and * and 123-45-67890",
        "nothing here": "nothing here",
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert [r[0] for r in df.select(privacy.redact_text(F.col("c"), ["Henry", "Toronto"])).collect()] == list(cases.values())
    many = [f"Name{i}x" for i in range(450)] + ["J. (Jo) Doe"]
    one = df.limit(1).select(privacy.redact_text(F.lit("Name7x, Name449x and J. (Jo) Doe"), many)).first()[0]
    assert one == "*, * and *"
    tail = "x " * 50000
    long = spark.createDataFrame([(tail + "a@b.co",)], "c string")
    assert long.select(privacy.redact_text(F.col("c"))).first()[0] == tail + "*"
