import random

import pytest
from pyspark.sql import functions as F

from tallywise.operators.numbering import number_in_order, repeat_rows, start_in_order
from tallywise.operators.sets import duplicate_rows
from tests.conftest import rows


def grouped(spark):
    """One group holds most rows; many values repeat."""
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.7 else rng.choice("abc"), rng.randrange(50), i) for i in range(2000)]
    return data, spark.createDataFrame(data, "g string, v int, id int").repartition(5)


@pytest.mark.parametrize("heavy", [0, 300, 10**6])
def test_numbers_follow_the_values_alone(spark, heavy):
    data, df = grouped(spark)
    expected = []
    for g in {r[0] for r in data}:
        expected += [(*r, i + 1) for i, r in enumerate(sorted(r for r in data if r[0] == g))]
    order = [F.col("v"), F.col("id")]
    assert rows(number_in_order(df, ["g"], order, "n", heavy)) == sorted(expected, key=repr)
    assert rows(number_in_order(df.repartition(3, "v"), ["g"], order, "n", heavy)) == sorted(expected, key=repr)


@pytest.mark.parametrize("heavy", [0, 10**6])
def test_starts_sum_the_weights_before(spark, heavy):
    data, df = grouped(spark)
    found = {r["id"]: r["s"] for r in start_in_order(df, ["g"], [F.col("v"), F.col("id")], F.col("v"), "s", heavy).collect()}
    for g in {r[0] for r in data}:
        total = 0
        for _, v, i in sorted(r for r in data if r[0] == g):
            assert found[i] == total
            total += v


@pytest.mark.parametrize("heavy", [0, 10**6])
def test_numbers_without_groups(spark, heavy):
    _, df = grouped(spark)
    found = number_in_order(df, [], [F.col("id")], "n", heavy)
    assert sorted((r["n"], r["id"]) for r in found.collect()) == [(i + 1, i) for i in range(2000)]


@pytest.mark.parametrize("heavy", [0, 5, 10**6])
def test_duplicate_rows_are_numbered_by_their_values(spark, heavy):
    rng = random.Random(4)
    data = [(rng.choice(["k", "k", "k", "l", None]), rng.choice([1, 2, None]), rng.choice("ab")) for _ in range(200)] + [("once", 1, "a")]
    df = spark.createDataFrame(data, "k string, v int, w string").repartition(5)
    first = lambda r: (r[1] is not None, r[1] or 0, r[2])
    expected = []
    for k in {r[0] for r in data}:
        expected += [(*r, i + 1) for i, r in enumerate(sorted((r for r in data if r[0] == k), key=first)) if i]
    assert rows(duplicate_rows(df, ["k"], heavy=heavy)) == sorted(expected, key=repr)
    keys = spark.createDataFrame([(None,), ("once",)], "k string")
    assert rows(duplicate_rows(df, ["k"], None, keys, heavy)) == sorted((r for r in expected if r[0] is None), key=repr)


def test_duplicate_rows_take_few_exchanges_and_no_checkpoint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id % 100 AS k", "id AS v")
        keys = spark.range(50).selectExpr("id AS k")
        for found in (duplicate_rows(df, ["k"], None, keys), number_in_order(df, ["k"], [F.col("v")], "n")):
            plan = found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
            assert plan.count("Exchange ") <= 4 and "ExistingRDD" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_given_order_with_ties_still_numbers_every_row(spark):
    df = spark.range(300).select(F.lit("x").alias("g"), F.lit(1).alias("v"))
    found = number_in_order(df.repartition(4), ["g"], [F.col("v")], "n")
    assert sorted(r["n"] for r in found.collect()) == list(range(1, 301))


def test_null_groups_count_as_one(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, id int")
    found = rows(number_in_order(df, ["g"], [F.col("id")], "n"))
    assert sorted(r[2] for r in found if r[0] is None) == [1, 2]


@pytest.mark.parametrize("per_task", [1, 3, 1000])
def test_repeat_rows(spark, per_task):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7)], "v string, n bigint")
    found = rows(repeat_rows(df, "n", "i", per_task))
    assert found == [("b", 0)] + [("c", i) for i in range(7)]
