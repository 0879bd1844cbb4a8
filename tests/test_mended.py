"""Nested values, fills, masks, redaction, classes and documents outside the samples."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywise import compare
from tallywise.operators import enrich, generate, privacy, standardise
from tallywise.operators.tree import compare_documents, tree_diff
from tallywise.sources.xmldocs import shred_xml

from .conftest import rows

NESTED = [
    ("array('a, b')", "array('a', 'b')"), ("array(cast(null as string))", "array('null')"),
    ("named_struct('x', '1, 2', 'y', '3')", "named_struct('x', '1', 'y', '2, 3')"),
    ("array(map('a', 1, 'b', 2))", "array(map('a', 1, 'b', 3))"),
]


@pytest.mark.parametrize("left, right", NESTED)
@pytest.mark.parametrize("mode", ["string", "typed"])
def test_nested_values_that_differ(spark, left, right, mode):
    base, actual = (spark.sql(f"SELECT 1 AS id, {v} AS v") for v in (left, right))
    cmp = compare(base, actual, pk=["id"], value_mode=mode)
    assert cmp.changed_cells().count() == 1
    assert cmp.narrowed().changed_cells().count() == 1
    assert compare(base, base, pk=["id"], value_mode=mode).changed_cells().count() == 0


def test_equal_maps_inside_a_struct(spark):
    base = spark.sql("SELECT 1 AS id, struct(map('a', 1, 'b', 2) AS m) AS v")
    actual = spark.sql("SELECT 1 AS id, struct(map('b', 2, 'a', 1) AS m) AS v")
    assert compare(base, actual, pk=["id"]).changed_cells().count() == 0


def test_fills_leave_values_as_they_are(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big,), (None,), (1,)], "x bigint")
    assert big in [r[0] for r in enrich.impute_numeric(df, {"x": "bigint"}).collect()]
    tiny = spark.createDataFrame([(1e-9,), (3e-9,), (None,)], "x double")
    assert sorted(r[0] for r in enrich.impute_numeric(tiny, {"x": "double"}).collect()) == pytest.approx([1e-9, 2e-9, 3e-9])
    huge = spark.createDataFrame([(1e23,), (4.0,), (None,)], "x double")
    assert max(r[0] for r in enrich.impute_numeric(huge, {"x": "double"}).where("x < 1e23 and x > 5").collect()) == pytest.approx(5e22)
    days = spark.createDataFrame([("2024-01-01", big), ("2024-01-03", big)], "d string, v bigint")
    assert {r["v"] for r in enrich.fill_series(days, "d", "v").where("not filled").collect()} == {big}


def test_model_that_loses_answers(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "x string").coalesce(1)
    with pytest.raises(Exception, match="answers"):
        enrich.map_distinct(df, "x", lambda s: pd.DataFrame({"y": s.head(1)}), "y string", parallelism=1).collect()


def test_null_class_is_raised(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, None)], "id int, c string")
    assert generate.rebalance(df, "c", "id").where("c is null").count() == 3


def test_masks_of_any_script_and_shape(spark):
    df = spark.createDataFrame([("李雷", "nobody", "12"), ("Éric Noël", "a@b.org", "123-456-7890")], "n string, e string, p string")
    found = privacy.mask_columns(df, {"n": "name", "e": "email", "p": "phone"})
    assert rows(found) == sorted([("李***", "***", "***"), ("É*** N***", "a***@b.org", "***-***-7890")], key=repr)
    with pytest.raises(ValueError):
        privacy.mask_columns(df, {"n": "token"})


def test_names_end_where_words_end(spark):
    df = spark.createDataFrame([("Henryson met Ellen in Torontos; Henry, Elle Henry.",)], "t string")
    names = ["Henry", "Elle", "Toronto", "son"]
    expected = "Henryson met Ellen in Torontos; *, * *."
    for listed in (names, names + [f"Nobody{i}" for i in range(400)]):
        assert df.select(privacy.redact_text(F.col("t"), listed)).first()[0] == expected


def test_keywords_of_any_spelling(spark):
    df = spark.createDataFrame([("a MACHINE-learning text",), ("über 5G networks",)], "t string")
    rules = {"ML": ["Machine Learning"], "Net": ["5G", "Über"]}
    assert [r[0] for r in df.select(standardise.classify_text(F.col("t"), rules)).collect()] == ["ML", "Net"]


def test_documents_of_one_side_and_broken_ones(spark):
    base = spark.createDataFrame([(1, "<a/>"), (2, "<a>"), (3, "<a x='1'/>"), (5, "<a/>")], "id long, x string")
    actual = spark.createDataFrame([(2, "<a>"), (3, "<a x='2'/>"), (4, "<a/>"), (5, "<a/>")], "id long, x string")
    whole = tree_diff(shred_xml(base, "id", "x"), shred_xml(actual, "id", "x"))
    found = compare_documents(base, actual, "id", "x")
    assert rows(found) == rows(whole)
    assert sorted((r["doc_id"], r["kind"]) for r in found.collect()) == [(1, "Document"), (2, "Parse error"), (3, "Attributes"), (4, "Document")]
