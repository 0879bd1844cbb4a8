"""Traps and properties of the key-based comparison."""

import random

import pytest
from pyspark.sql import functions as F

from tallywise import compare
from tallywise.operators import frames, sets
from tallywise.plans import reports
from tests.conftest import rows

SCHEMA = "k string, j string, x string, y string"


def sides(spark, base, actual, schema=SCHEMA):
    return spark.createDataFrame(base, schema), spark.createDataFrame(actual, schema)


def random_rows(rng, n, keys):
    values = [None, "", "a", "b", "a||b"]
    return [(rng.choice([None, *map(str, range(keys))]), rng.choice([None, "p", "q"]), rng.choice(values),
             rng.choice(values)) for _ in range(n)]


def brute(base, actual):
    """Plain-Python comparison by the first two columns."""
    def order(row):
        return [(v is not None, v or "") for v in row[2:]]

    def groups(side):
        out = {}
        for row in side:
            out.setdefault(row[:2], []).append(row)
        return out

    b, a = groups(base), groups(actual)
    cells, extra, dup = [], [], []
    for key in set(b) | set(a):
        if key in b and key in a:
            left, right = min(b[key], key=order), min(a[key], key=order)
            cells += [(*key, n, left[i], right[i]) for i, n in ((2, "x"), (3, "y")) if left[i] != right[i]]
        else:
            extra.append(("base" if key in b else "actual", *key))
        dup += [(s, *key, len(g[key])) for s, g in (("base", b), ("actual", a)) if len(g.get(key, [])) > 1]
    return sorted(cells, key=repr), sorted(extra, key=repr), sorted(dup, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_sides_match_brute_force(spark, seed):
    rng = random.Random(seed)
    base, actual = random_rows(rng, 60, 12), random_rows(rng, 50, 14)
    cells, extra, dup = brute(base, actual)
    cmp = compare(*sides(spark, base, actual), ["k", "j"])
    assert rows(cmp.changed_cells()) == cells
    assert rows(cmp.extra_keys()) == extra
    assert rows(cmp.duplicate_keys()) == dup
    assert rows(cmp.narrowed().changed_cells()) == cells
    joined = compare(*sides(spark, base, actual), ["k", "j"], co_located=True)
    assert rows(joined.changed_cells()) == cells
    assert rows(joined.extra_keys()) == extra
    assert rows(joined.duplicate_keys()) == dup
    kept = cmp.stored()
    assert rows(kept.changed_cells()) == cells
    assert rows(kept.extra_keys()) == extra
    assert rows(kept.duplicate_keys()) == dup
    assert rows(reports.summary(kept)) == rows(reports.summary(cmp))
    assert sum(r["diff_count"] for r in cmp.column_diff_counts().collect()) == len(cells)
    for side, name in ((base, "base"), (actual, "actual")):
        lonely = sum(1 for key in extra if key[0] == name)
        assert lonely + cmp.common_keys().count() == len({row[:2] for row in side})
    pairs = reports.value_pair_counts(cmp.changed_cells())
    assert pairs.agg(F.sum("n")).first()[0] == len(cells)


def test_swapping_sides_swaps_results(spark):
    rng = random.Random(9)
    base, actual = sides(spark, random_rows(rng, 40, 9), random_rows(rng, 40, 9))
    one, two = compare(base, actual, ["k", "j"]), compare(actual, base, ["k", "j"])
    swapped = two.changed_cells().select("k", "j", "col_name", F.col("actual_value"), F.col("base_value"))
    assert rows(one.changed_cells()) == rows(swapped)
    other = F.when(F.col("side") == "base", "actual").otherwise("base")
    assert rows(one.extra_keys()) == rows(two.extra_keys().withColumn("side", other))


def test_partitioning_does_not_matter(spark):
    rng = random.Random(4)
    base, actual = sides(spark, random_rows(rng, 80, 9), random_rows(rng, 80, 9))
    one = compare(base, actual, ["k", "j"])
    two = compare(base.repartition(7), actual.repartition(3, "x"), ["k", "j"])
    for result in ("changed_cells", "extra_keys", "duplicate_keys", "duplicate_rows", "row_except", "changed_rows"):
        assert rows(getattr(one, result)()) == rows(getattr(two, result)())


def test_same_side_passes_with_empty_results(spark):
    rng = random.Random(2)
    base, _ = sides(spark, random_rows(rng, 40, 30), [])
    cmp = compare(base, base, ["k", "j"])
    assert reports.verdict(cmp).first()["status"] == "PASS"
    for result in (cmp.changed_cells(), cmp.extra_keys(), cmp.row_except(), cmp.multiset_diff(), cmp.changed_rows(),
                   cmp.column_diff_counts(), cmp.wide_diff()):
        assert result.isEmpty()
    assert rows(cmp.passed_columns()) == [("x",), ("y",)]


def test_null_and_delimiter_keys_stay_apart(spark):
    base = [(None, "a", "1", None), ("a", None, "2", None), ("a||b", "c", "3", None)]
    actual = [(None, "a", "1", None), ("a", None, "9", None), ("a", "b||c", "3", None)]
    cmp = compare(*sides(spark, base, actual), ["k", "j"])
    assert rows(cmp.changed_cells()) == [("a", None, "x", "2", "9")]
    assert rows(cmp.extra_keys()) == [("actual", "a", "b||c"), ("base", "a||b", "c")]


def test_null_differs_from_empty_and_moving_null_is_seen(spark):
    base = [("1", "", None, ""), ("2", "", "a", None)]
    actual = [("1", "", "", ""), ("2", "", None, "a")]
    cmp = compare(*sides(spark, base, actual), ["k", "j"])
    expected = [("1", "", "x", None, ""), ("2", "", "x", "a", None), ("2", "", "y", None, "a")]
    assert rows(cmp.changed_cells()) == sorted(expected, key=repr)
    assert rows(cmp.narrowed().changed_cells()) == sorted(expected, key=repr)


def test_duplicates_on_one_side_only(spark):
    base = [("1", "", "b", ""), ("1", "", "a", ""), ("1", "", "a", ""), ("2", "", "z", "")]
    actual = [("1", "", "a", "")]
    cmp = compare(*sides(spark, base, actual), ["k", "j"])
    assert cmp.changed_cells().isEmpty()
    assert rows(cmp.duplicate_keys()) == [("base", "1", "", 3)]
    assert rows(cmp.duplicate_rows()) == [("base", "1", "", "a", "", 2), ("base", "1", "", "b", "", 3)]
    facts = dict(rows(reports.summary(cmp)))
    assert facts["Baseline Duplicate Records Count"] == "1"
    assert facts["Baseline Excess Rows of Common Keys"] == "2"
    assert reports.verdict(cmp, ignore_extras=True).first()["status"] == "PASS"
    assert reports.verdict(cmp, ignore_extras=True, strict=True).first()["status"] == "FAIL"


@pytest.mark.parametrize("base,actual,status", [
    ([], [], "EMPTY_BOTH"), ([], [("1", "", "", "")], "EMPTY_BASE"), ([("1", "", "", "")], [], "EMPTY_ACTUAL"),
])
def test_empty_sides(spark, base, actual, status):
    left, right = sides(spark, base, actual)
    cmp = compare(left, right, ["k", "j"])
    assert frames.input_status(left, right) == status
    assert reports.verdict(cmp).first()["status"] == status
    assert cmp.changed_cells().isEmpty()
    assert cmp.extra_keys().count() == len(base) + len(actual)
    assert not frames.exists(cmp.changed_rows())


def test_equal_column_counts_with_unmatched_names(spark):
    base = spark.createDataFrame([("1", "a", "b")], "k string, x string, old string")
    actual = spark.createDataFrame([("1", "a", "b")], "k string, x string, new string")
    cmp = compare(base, actual, ["k"])
    assert cmp.columns == ("x",)
    assert rows(frames.schema_diff(base, actual)) == [("new", "actual", "string"), ("old", "base", "string")]
    facts = dict(rows(reports.summary(cmp)))
    assert facts["All Columns Mapped"] == "FAIL" and facts["Unmapped Columns Count"] == "2"
    assert facts["Test Status"] == "PASS"


def test_schema_diff_of_equal_schemas_is_empty(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert frames.schema_diff(df, df).isEmpty()
    assert frames.schema_diff(df, df, count_values=True).columns[-1] == "n_values"


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError, match="base"):
        compare(df, df, ["c"])
    with pytest.raises(KeyError, match="actual"):
        compare(df, df.drop("a"), ["a"])
    with pytest.raises(ValueError, match="excluded"):
        compare(df, df, ["a"], exclude=["a"])
    with pytest.raises(ValueError, match="value mode"):
        compare(df, df, ["a"], value_mode="other")


def test_all_columns_are_keys(spark):
    base, actual = (spark.createDataFrame(v, "total string") for v in ([("10",)], [("11",)]))
    cmp = compare(base, actual, ["total"])
    assert rows(cmp.extra_keys()) == [("actual", "11"), ("base", "10")]
    assert cmp.changed_cells().isEmpty() and cmp.column_diff_counts().isEmpty() and cmp.passed_columns().isEmpty()
    assert reports.verdict(cmp).first()["status"] == "FAIL"


def test_odd_column_names(spark):
    base = spark.createDataFrame([("1", "a", "p")], ["k.1", "x y", "it's a`b\\"])
    actual = spark.createDataFrame([("1", "b", "p")], ["k.1", "x y", "it's a`b\\"])
    cmp = compare(base, actual, ["k.1"])
    assert rows(cmp.changed_cells()) == [("1", "x y", "a", "b")]
    assert rows(cmp.passed_columns()) == [("it's a`b\\",)]
    assert cmp.wide_diff().columns == ["k.1", "x y_baseline", "x y_actual"]
    assert rows(cmp.stored().changed_cells()) == rows(cmp.narrowed().changed_cells()) == [("1", "x y", "a", "b")]


def test_columns_named_like_the_sides(spark):
    schema = "a string, b string, nb string, na string, k string"
    base, actual = (spark.createDataFrame([("1", "x", v, "q", "w")], schema) for v in ("r", "s"))
    for shape in (False, True):
        cmp = compare(base, actual, ["a", "b"], co_located=shape)
        assert rows(cmp.changed_cells()) == [("1", "x", "nb", "r", "s")]
        assert reports.verdict(cmp).first()["mismatched_cells"] == 1
        assert cmp.extra_keys().isEmpty() and cmp.duplicate_rows().isEmpty() and cmp.extra_rows("base").isEmpty()
        assert cmp.multiset_diff().count() == cmp.row_except(dedupe=False).count() == cmp.row_except().count() == 2


def test_many_columns(spark):
    names = [f"c{i}" for i in range(150)]
    base = spark.range(5).select(F.col("id").alias("k"), *[F.lit(i).alias(c) for i, c in enumerate(names)])
    actual = base.withColumn("c7", F.lit(0)).withColumn("c149", F.when(F.col("k") == 2, None).otherwise(F.col("c149")))
    for cmp in (compare(base, actual, ["k"]), compare(base, actual, ["k"], tolerance=1)):
        assert dict(rows(cmp.column_diff_counts())) == {"c7": 5, "c149": 1}
        assert cmp.changed_cells().count() == 6
        assert reports.verdict(cmp).first()["mismatched_cells"] == 6


def test_text_mode_shows_text(spark):
    base = spark.sql("SELECT 1 AS k, DATE'2024-01-01' AS d, true AS f, 1.5D AS v, 'x' AS extra")
    actual = spark.sql("SELECT 2 AS k, DATE'2024-01-01' AS d, true AS f, 1.5D AS v")
    cmp = compare(base, actual, ["k"])
    for df in (cmp.extra_keys(), cmp.extra_rows("base"), cmp.row_except(), cmp.row_except(dedupe=False),
               cmp.multiset_diff().drop("n_base", "n_actual"), cmp.changed_rows(), cmp.duplicate_rows().drop("rn")):
        assert {kind for _, kind in df.dtypes} == {"string"}
    assert rows(cmp.extra_rows("base")) == [("base", "1", "2024-01-01", "true", "1.5", "x")]
    assert rows(cmp.row_except())[0] == ("actual", "2", "2024-01-01", "true", "1.5")


def test_typed_values_and_maps(spark):
    schema = "k int, d double, m map<string,int>"
    base = spark.createDataFrame([(1, 1.0, {"a": 1, "b": 2}), (2, float("nan"), {"a": 1})], schema)
    actual = spark.createDataFrame([(1, 1.0, {"b": 2, "a": 1}), (2, float("nan"), {"a": 2})], schema)
    for mode in ("typed", "string"):
        cells = compare(base, actual, ["k"], value_mode=mode).changed_cells()
        assert [r["col_name"] for r in cells.collect()] == ["m"]


def test_tolerance(spark):
    base = spark.createDataFrame([("1", "2.001", "n/a"), ("2", "2.0", "x")], "k string, v string, t string")
    actual = spark.createDataFrame([("1", "2.0019", "n/a"), ("2", "2.1", "y")], "k string, v string, t string")
    cells = compare(base, actual, ["k"], tolerance=2).changed_cells()
    assert rows(cells) == [("2", "t", "x", "y"), ("2", "v", "2.0", "2.1")]


def test_heavy_key_is_whole(spark):
    """A third of the rows in one key, half of them identical."""
    heavy = spark.range(3000).select(
        F.lit("hot").alias("k"), F.lit("").alias("j"),
        F.when(F.col("id") < 1500, "same").otherwise(F.col("id").cast("string")).alias("x"), F.lit(None).cast("string").alias("y"),
    )
    rest = spark.range(6000).select(F.col("id").cast("string").alias("k"), F.lit("").alias("j"), F.lit("v").alias("x"),
                                    F.lit(None).cast("string").alias("y"))
    base, actual = heavy.unionByName(rest), rest.withColumn("x", F.lit("w"))
    cmp = compare(base, actual.unionByName(heavy.limit(1)), ["k", "j"])
    assert cmp.duplicate_keys().first()["n"] == 3000
    dup = cmp.duplicate_rows()
    assert dup.count() == 2999
    stats = dup.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first()
    assert tuple(stats) == (2, 3000, 2999)
    assert dup.where("x = 'same'").count() == 1500 - (0 if "1500" < "same" else 1)
    assert cmp.changed_cells().count() == 6000 + 1


def test_multiset_diff_agrees_with_cells(spark):
    rng = random.Random(6)
    base = {str(i): ("", rng.choice("ab"), rng.choice("ab")) for i in range(40)}
    actual = {str(i): ("", rng.choice("ab"), rng.choice("ab")) for i in range(40)}
    cmp = compare(*sides(spark, [(k, *v) for k, v in base.items()], [(k, *v) for k, v in actual.items()]), ["k", "j"])
    in_cells = {r["k"] for r in cmp.changed_cells().collect()}
    assert in_cells == {r["k"] for r in cmp.multiset_diff().collect()}


def test_caps_keep_the_first_by_key(spark):
    base = spark.range(2000).select(F.format_string("%05d", "id").alias("k"), F.lit("a").alias("x"))
    actual = base.withColumn("x", F.lit("b"))
    cmp = compare(base, actual, ["k"])
    cells = cmp.changed_cells()
    assert sorted(r["k"] for r in reports.sample_diffs(cells, ["k"]).collect()) == [f"{i:05d}" for i in range(24)]
    assert reports.sample_diffs(cells, ["k"], 1999).count() == 1999
    assert reports.sample_diffs(cells, ["k"], 5, by="column").count() == 5
    extras = compare(base, actual.limit(0), ["k"])
    assert sorted(r["k"] for r in reports.top_extras(extras).collect()) == [f"{i:05d}" for i in range(499)]


def test_top_group_cut_is_the_same_above_the_planners_limit(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.hash("id").alias("v"), "id")
    order = [F.asc("v"), F.asc("id")]
    large = sets.top_per_group(df, ["g"], order, 1200)
    plain = sets.top_per_group(df, ["g"], order, 999)
    assert rows(large.where("rn <= 999").select("g", "v", "id", "rn")) == rows(plain.select("g", "v", "id", "rn"))
    assert large.count() == 3600


def test_names_and_columns(spark):
    df = spark.createDataFrame([(1, 2)], [" a b ", "c"])
    assert frames.normalise_column_names(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError, match="clash"):
        frames.normalise_column_names(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))
    assert frames.drop_columns(df, ["", "zz", "c"]).columns == [" a b "]
    assert frames.suffix_columns(df, ".base", ["c"]).columns == [" a b .base", "c"]


def test_plan_has_one_exchange_and_prunes_values(spark, data):
    from tallywise.catalog.pairs import orders_comparison

    cmp = orders_comparison(spark, data)
    cells = cmp.changed_cells()._jdf.queryExecution().executedPlan().toString()
    assert cells.count("Exchange ") == 1 and "Join" not in cells
    keys = cmp.extra_keys()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in keys and "SortAggregate" not in keys


@pytest.mark.parametrize("name,pushed", [
    ("point_in_time", "EqualTo(o_orderdate,"), ("filter_range", "GreaterThanOrEqual(o_orderdate,"),
    ("source_batch", "In(o_orderpriority, ["), ("control_total", "EqualTo(l_shipdate,"),
    ("name_cleanup", "StringContains(p_name,red)"),
])
def test_filters_reach_the_scan(spark, data, name, pushed):
    from __spark_entry__ import queries

    plan = queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan[plan.index("PushedFilters"):]


def test_bucketed_tables_are_compared_without_a_shuffle(spark):
    base = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    for name, df in (("bucketed_base", base), ("bucketed_actual", base.withColumn("v", F.col("id") % 6))):
        df.write.mode("overwrite").bucketBy(4, "id").sortBy("id").saveAsTable(name)
    cmp = compare(spark.table("bucketed_base"), spark.table("bucketed_actual"), ["id"], co_located=True)
    plan = cmp._joined_pairs(cmp.base, cmp.actual)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert cmp.changed_cells().count() == base.where("id % 7 <> id % 6").count()
