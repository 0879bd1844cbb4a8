"""Vocabularies, gazetteers, exact totals, exact medians and the learned classifier against plain versions."""

import math
import random
import re
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from tallywise.operators import control, enrich, learned, places, standardise, vocabulary
from tests.conftest import rows

BIG = 2**53 + 1


# -- the nearest name -----------------------------------------------------------

def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


def plain_nearest(value, names, edits):
    if value is None:
        return None
    v = value.strip(" ").lower()
    near = min(((distance(v, n.strip(" ").lower()), n) for n in names if n and n.strip(" ") and abs(len(v) - len(n.strip(" "))) <= edits), default=(99, None))
    return near[1] if near[0] <= edits else None


def edited(rng, text, edits, letters):
    text = list(text)
    for _ in range(edits):
        i = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            text.insert(i, rng.choice(letters))
        elif text and kind == 1:
            text.pop(min(i, len(text) - 1))
        elif text:
            text[min(i, len(text) - 1)] = rng.choice(letters)
    return "".join(text)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_nearest_name_is_that_of_all_names(spark, edits):
    rng = random.Random(edits)
    letters = "abé"
    names = {"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 4, 6, 9, 22, 23, 24, 25, 26, 30, 60]))) for _ in range(150)}
    names |= {"Cybersecurity", "IT", "Ünïcode"}
    values = [edited(rng, rng.choice(sorted(names)), rng.randrange(edits + 2), letters) for _ in range(200)]
    values += ["Cyberscryity", " it ", "", None, "ÜNÏCODE", "zzzzzzzz", values[0], values[0], "x" * 500]
    df = spark.createDataFrame([(i, v, "other") for i, v in enumerate(values)], "id int, v string, _key string")
    table = spark.createDataFrame([(n, 1) for n in sorted(names)] + [(None, 2), ("", 3), ("  ", 4)], "name string, _value int")
    got = {r["id"]: r["near"] for r in vocabulary.nearest_name(df, "v", table, "near", edits).collect()}
    assert got == {i: plain_nearest(v, sorted(names), edits) for i, v in enumerate(values)}


def test_nearest_of_a_hundred_thousand_names(spark):
    rng = random.Random(7)
    names = spark.range(100_000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 8).alias("name"))
    known = sorted(r[0] for r in names.collect())
    values = [edited(rng, rng.choice(known), rng.randrange(3), "0123456789abcdef") for _ in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = vocabulary.nearest_name(df, "v", names, "near", 2)
    plan = df._jdf and found._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "broadcast)" not in plan
    # Brute force by one all-pairs query, for the test only.
    spark.createDataFrame([(v,) for v in set(values)], "v string").createOrReplaceTempView("asked_values")
    names.createOrReplaceTempView("asked_names")
    brute = spark.sql("""SELECT v, min(struct(d, name)).name AS near FROM (SELECT /*+ BROADCAST(asked_values) */ v, name, levenshtein(v, name, 2) AS d
      FROM asked_values CROSS JOIN asked_names) WHERE d >= 0 GROUP BY v""")
    expected = {r["v"]: r["near"] for r in brute.collect()}
    assert {r["v"]: r["near"] for r in found.collect()} == {v: expected.get(v) for v in values}


def test_nearest_name_of_no_rows_and_no_names(spark):
    df = spark.createDataFrame([("a",)], "v string")
    none = spark.createDataFrame([], "name string")
    assert rows(vocabulary.nearest_name(df, "v", none, "near")) == [("a", None)]
    assert rows(vocabulary.nearest_name(df.limit(0), "v", none, "near")) == []


# -- names inside texts ----------------------------------------------------------

TOKEN = re.compile(r"[^\W_]+")  # no marks in these texts


def plain_redaction(text, names):
    if text is None:
        return None
    cores = {re.sub(r"^[\W_]+|[\W_]+$", "", n) for n in names} - {""}
    spans = [m.span() for m in TOKEN.finditer(text)]
    out, i, at = [], 0, 0
    while i < len(spans):
        for j in range(len(spans) - 1, i - 1, -1):
            if text[spans[i][0] : spans[j][1]] in cores:
                out += [text[at : spans[i][0]], "*"]
                at, i = spans[j][1], j
                break
        i += 1
    return "".join(out) + text[at:]


def test_names_of_a_table_are_redacted_longest_first(spark):
    rng = random.Random(1)
    words = ["Ann", "Lee", "New", "York", "the", "von", "Ärzte", "x1", "Ö"]
    gaps = [" ", " ", " ", "-", ", ", "  ", ".", "\n", "_"]
    names = {" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 2, 3, 4]))) for _ in range(25)} | {"Ann-Lee", "St. York", "(New York)", "--", ""}
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(0, 40))) for _ in range(150)]
    texts += [None, "", "...", "Ann", "Anna Lee", "St. York", "  Ann Lee", "von der Leyen", "Ann " * 3000, "no names at all"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(0, texts[0], 7)], "id int, t string, _row int")
    table = spark.createDataFrame([(n,) for n in sorted(names)] + [(None,)], "name string")
    got = sorted((tuple(r) for r in vocabulary.redact_names(df.drop("_row"), "t", table).collect()), key=repr)
    expected = [(i, plain_redaction(t, names)) for i, t in enumerate(texts)] + [(0, plain_redaction(texts[0], names))]
    assert got == sorted(expected, key=repr)
    assert vocabulary.redact_names(df.drop("_row"), "t", table.limit(0)).where("t is not null").count() == len(texts)


def test_redaction_moves_texts_twice_and_rebuilds_a_batch_at_once(spark, capsys):
    texts = [None, "", "Ann", "Ann Lee.", "no", "x Ann,Lee y Ann  Lee", "\u00c4rzte \U0001d538 Ann"] * 30
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    names = spark.createDataFrame([("Ann",), ("Ann Lee",), ("\u00c4rzte",)], "name string")
    out = vocabulary.redact_names(df, "t", names)
    assert [r[0] for r in out.orderBy("id").select("t").collect()] == [None, "", "*", "*.", "no", "x *,Lee y *  Lee", "* \U0001d538 *"] * 30
    capsys.readouterr()
    out.explain("extended")
    assert capsys.readouterr().out.split("== Physical Plan ==")[0].split("== Optimized Logical Plan ==")[1].count("Join") == 1
    words, gaps = [["a", "b", "c"], None, [], ["d"]], [["", " ", "-", "."], None, ["..."], ["", ""]]
    splice = vocabulary._spliced("*")
    made = splice(pa.array(words, pa.list_(pa.string())), pa.array(gaps, pa.list_(pa.string())), pa.array([[0, 1], None, None, [0]], pa.list_(pa.int32())), pa.array([[2, 1], None, None, [1]], pa.list_(pa.int32())))
    assert made.to_pylist() == ["*-c.", None, None, "*"]
    none = pa.array([None, None], pa.list_(pa.string()))
    assert splice(none, none, pa.array([None, None], pa.list_(pa.int32())), pa.array([None, None], pa.list_(pa.int32()))).to_pylist() == [None, None]
    live = vocabulary._live(pa.array([["a", "b", "a"], None, [], ["b", "c"]], pa.list_(pa.string())), pa.array([["a"], None, [], ["c"]], pa.list_(pa.string())))
    assert live.to_pylist() == [[1, 3], [], [], [2]]


def test_redaction_by_a_million_names(spark):
    names = spark.range(1_000_000).select(F.concat(F.lit("Name"), F.col("id").cast("string"), F.lit(" Of Place")).alias("name"))
    texts = [f"so Name{i} Of Place and Name{i} Of, or Name{i} Of Placebo" for i in (0, 17, 999_999, 1_000_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = sorted(r[0] for r in vocabulary.redact_names(df, "t", names).collect())
    expected = [t.replace(f"Name{i} Of Place and", "* and") if i < 1_000_000 else t for i, t in zip((0, 17, 999_999, 1_000_000), texts)]
    assert got == sorted(expected)


# -- places -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def gazetteer(spark):
    found = [
        ("city", "Toronto", "Toronto", "ON", "Canada", 2.9), ("state", "Ontario", None, "ON", "Canada", 0.0), ("city", "Ontario", "Ontario", "CA", "USA", 0.2),
        ("city", "Boston", "Boston", "MA", "USA", 0.7), ("city", "Austin", "Austin", "TX", "USA", 0.9), ("city", "Springfield", "Springfield", "IL", "USA", 0.1),
        ("city", "Springfield", "Springfield", "MA", "USA", 0.2), ("city", "Paris", "Paris", None, "France", 2.1), ("city", "Paris", "Paris", "TX", "USA", 0.1),
        ("country", "France", None, None, "France", 0.0), ("city", "Kansas City", "Kansas City", "MO", "USA", 0.5), ("country", "Canada", None, None, "Canada", 0.0),
    ]
    return places.default_gazetteer(spark).union(spark.createDataFrame(found, places.GAZETTEER))


PLACES = [
    ("Toronto, Ontario", "Toronto", "ON", "Canada"), ("Boston", "Boston", "MA", "USA"), ("Springfield", "Springfield", "MA", "USA"),
    ("springfield (illinois)", "Springfield", "IL", "USA"), ("Springfield, Ohio", "Springfield", "OH", "USA"), ("Paris", "Paris", None, "France"),
    ("Paris, Texas", "Paris", "TX", "USA"), ("Kansas City", "Kansas City", "MO", "USA"), ("San Fran", "San Francisco", "CA", "USA"),
    ("New York, NY", "New York", "NY", "USA"), ("Nowhere Town, Texas", "Nowhere Town", "TX", "USA"), ("in or me", None, None, None), (None, None, None, None),
    ("", None, None, None), ("LA", "Los Angeles", "CA", "USA"), ("Boston, U.S.A.", "Boston", "MA", "USA"), ("Ontario", "Ontario", "CA", "USA"),
]


def test_places(spark, gazetteer):
    df = spark.createDataFrame([(i, p[0], "x") for i, p in enumerate(PLACES)], "id int, t string, kind string")
    found = {r["id"]: r for r in places.resolve_places(df, "t", gazetteer).collect()}
    assert len(found) == len(PLACES)
    for i, (text, *expected) in enumerate(PLACES):
        assert ([found[i][c] for c in ("city", "state", "country")], found[i]["kind"]) == (expected, "x"), text


ADDRESSES = [
    ("12 Harbor Way, Austin, TX", "12 Harbor Way", "Austin", "TX", None), ("12 Harbor Way, Austin, TX 78701-1234", "12 Harbor Way", "Austin", "TX", "78701-1234"),
    ("12 Boston Post Rd, Austin, TX", "12 Boston Post Rd", "Austin", "TX", None), ("123 Main St, Apt 4, Springfield, IL 62704", "123 Main St, Apt 4", "Springfield", "IL", "62704"),
    ("62704 123 Main St, Springfield, IL", "123 Main St", "Springfield", "IL", "62704"), ("Austin, 5 Elm Lane, TX", "5 Elm Lane", "Austin", "TX", None),
    ("7 Rue Une, Nowhere, TX 75001", "7 Rue Une, Nowhere", None, "TX", "75001"), ("Boston", None, "Boston", "MA", None), (None, None, None, None, None), ("", None, None, None, None),
    ("12 High Street, Little Snoring", "12 High Street", "Little Snoring", None, None),
]


def test_addresses(spark, gazetteer):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(ADDRESSES)], "id int, t string")
    found = {r["id"]: r for r in places.parse_addresses(df, "t", gazetteer).collect()}
    for i, (text, *expected) in enumerate(ADDRESSES):
        assert [found[i][c] for c in ("street", "city", "state", "zip")] == expected, text


def test_product_families_of_a_table(spark):
    families = spark.createDataFrame([("macbook", "Apple", "MacBook"), ("Galaxy", "Samsung", "Galaxy"), ("galaxy", "Other", "Galaxy")], "word string, brand string, family string")
    names = [("MacBook Air 13 256GB",), ("256 gb galaxy s24 ultra",), ("galaxy macbook",), ("unknown 5",), (None,), ("",)]
    found = standardise.standardise_products(spark.createDataFrame(names, "n string"), "n", families, ["Air", "Ultra"]).collect()
    assert {tuple(r) for r in found} == {
        ("MacBook Air 13 256GB", "Apple", "MacBook 13 Air", "256GB", "Apple MacBook 13 Air 256GB"),
        ("256 gb galaxy s24 ultra", "Other", "Galaxy Ultra", "256GB", "Other Galaxy Ultra 256GB"), ("galaxy macbook", "Other", "Galaxy", None, "Other Galaxy"),
        ("unknown 5", None, "5", None, "5"), (None, None, None, None, ""), ("", None, None, None, ""),
    }


# -- totals -----------------------------------------------------------------------

def totals(spark, base, actual, kind="double", order=1):
    sides = [spark.createDataFrame([(x,) for x in side[::order]], f"x {kind}") for side in (base, actual)]
    row = control.exact_totals(*sides, ["x"]).first()
    return row["base_exact"], row["actual_exact"], row["delta_exact"]


def test_totals_are_exact_in_any_order(spark):
    rng = random.Random(5)
    base = [rng.choice([-1, 1]) * rng.randrange(10**9) * 10.0 ** rng.randrange(-30, 30) for _ in range(400)] + [5e-324, 1.7976931348623157e308, -0.0, 1e-13, 1e30]
    actual = base[:-1]
    shown = spark.createDataFrame([(x,) for x in base], "x double").selectExpr("cast(x as string)").collect()
    exact = sum(Fraction(Decimal(r[0])) for r in shown)
    for order in (1, -1):
        b, a, d = totals(spark, base, actual, order=order)
        assert Fraction(b) == exact and Fraction(a) == exact - Fraction(10**30) and Fraction(d) == -Fraction(10**30)


@pytest.mark.parametrize("base, actual, expected", [
    ([1e-13, 4e-13], [0.0], ("0.0000000000005", "0", "-0.0000000000005")), ([0.1, 0.2], [0.3], ("0.3", "0.3", "0")), ([1e30], [1e30, None], ("1" + 30 * "0", "1" + 30 * "0", "0")),
    ([math.nan, 1.0], [1.0], ("NaN", "1", "NaN")), ([math.inf, 1.0], [math.inf], ("Infinity", "Infinity", "NaN")), ([math.inf, -math.inf], [2.0], ("NaN", "2", "NaN")),
    ([-math.inf], [2.0], ("-Infinity", "2", "Infinity")), ([None], [2.0], (None, "2", None)), ([], [], (None, None, None)), ([-1.5], [2.25], ("-1.5", "2.25", "3.75")),
])
def test_totals_of_special_values(spark, base, actual, expected):
    assert totals(spark, base, actual) == expected


def test_totals_of_wide_decimals_and_integers(spark):
    wide = [Decimal("99999999999999999999.999999999999999999")] * 3 + [-Decimal("0.5"), Decimal(0)]
    assert totals(spark, wide, wide, "decimal(38,18)")[0] == "299999999999999999999.499999999999999997"
    assert totals(spark, [2**63 - 1] * 3, [-(2**63)], "long") == (str(3 * (2**63 - 1)), str(-(2**63)), str(-(2**63) - 3 * (2**63 - 1)))
    assert totals(spark, [0.1, 0.2], [0.3], "float")[2] == "0"
    df = spark.createDataFrame([(1e-13,), (4e-13,)], "x double")
    found = control.control_total(df, df.where("x < 0"), ["x"]).first()
    assert found["ok"] is False and str(found["base_value"]) == "0.00"
    huge = spark.createDataFrame([(1e300,)], "x double")
    found = control.control_total(huge, huge, ["x"]).first()
    assert found["ok"] is True and found["base_value"] is None
    assert control.control_total(huge, huge, ["x"], scale=None).first()["base_value"] == "1" + 300 * "0"


# -- medians ----------------------------------------------------------------------

def test_median_of_a_large_group_is_exact(spark):
    n = 1_200_001
    df = spark.range(n).select(
        F.when(F.col("id") % 1000 == 0, "small").otherwise("large").alias("g"), F.when(F.col("id") % 7 != 3, (F.col("id") * 7919 % n).cast("double") / 3).alias("x"), "id"
    )
    got = {r["_k"]["g"]: r["_f0"] for r in enrich.exact_median(df, ["g"], ["x"]).collect()}
    ids = np.arange(n, dtype=np.int64)
    x, there = (ids * 7919 % n) / 3, ids % 7 != 3
    for g, member in (("small", ids % 1000 == 0), ("large", ids % 1000 != 0)):
        v = np.sort(x[member & there])
        assert got[g] == v[(len(v) - 1) // 2]


def test_medians_of_small_and_odd_groups(spark):
    rng = random.Random(2)
    data = {g: [rng.choice([1.0, 2.0, 2.5, -7.0, 1e300, math.inf, -math.inf, 0.0]) for _ in range(n)] for g, n in enumerate([1, 2, 3, 4, 5, 10, 101, 1000])}
    df = spark.createDataFrame([(g, x, 3) for g, v in data.items() for x in v] + [(50, None, 3), (None, 4.0, 3), (0, math.nan, 3), (0, None, None)], "g int, x double, i int")
    got = {r["_k"]["g"]: (r["_f0"], r["_f1"]) for r in enrich.exact_median(df, ["g"], ["x", "i"]).collect()}
    for g, v in data.items():
        assert got[g] == (sorted(v)[(len(v) - 1) // 2], 3.0)
    assert got[50] == (None, 3.0) and got[None] == (4.0, 3.0)
    filled = enrich.impute_numeric(df.where("g = 6 or g = 50"), {"x": "double"}, how="median")
    assert filled.where("x is null").count() == 0
    assert rows(enrich.impute_numeric(df.limit(0), {"x": "double"}, ["g"], how="median")) == []


# -- the learned classifier ----------------------------------------------------------

@pytest.fixture(scope="module")
def taught(spark):
    rng = random.Random(3)
    words = {"sport": ["goal", "team", "match", "coach"], "tech": ["chip", "code", "cloud", "data"], "food": ["soup", "bread", "salt", "oven"]}
    common = ["the", "a", "was", "with", "and"]
    texts = [(label, " ".join(rng.choice(own if rng.random() < 0.3 else common) for _ in range(30))) for label, own in words.items() for _ in range(120)]
    return spark.createDataFrame([(i, t, label) for i, (label, t) in enumerate(texts)], "probability int, t string, label string")


def test_learned_classes_hold_out_of_sample(spark, taught):
    path = learned.fit_classifier(taught.where("probability % 4 <> 0"), "t", "label", features=1 << 12)
    found = learned.classify_learned(taught.where("probability % 4 = 0"), "t", path, "guess")
    assert found.columns == ["probability", "t", "label", "guess", "guess_score"]
    assert found.where("guess = label").count() >= 0.95 * found.count()


def test_scores_follow_from_the_coefficients(spark, taught):
    from pyspark.ml import PipelineModel

    two = taught.where("label <> 'food'")
    path = learned.fit_classifier(two, "t", "label", features=1 << 10)
    model = PipelineModel.load(path)
    idf, line = model.stages[3], model.stages[4]
    found = learned.classify_learned(two, "t", path, "guess").select("t", "guess", "guess_score").limit(40).collect()
    counted = model.stages[2].transform(model.stages[1].transform(two.withColumn("text", F.col("t"))))
    listed = [(r["t"], r["counts"].toArray()) for r in counted.select("t", "counts").collect()]
    counts = dict(listed)
    held_by = sum((c > 0).astype(int) for _, c in listed)
    assert np.allclose(idf.idf.toArray(), np.log((len(listed) + 1) / (held_by + 1)), atol=1e-9)
    for r in found:
        x = counts[r["t"]] * idf.idf.toArray()
        p = 1 / (1 + math.exp(-(float(line.coefficients.toArray() @ x) + line.intercept)))
        assert r["guess"] == model.stages[0].labels[int(p > 0.5)] and abs(r["guess_score"] - max(p, 1 - p)) < 1e-9


def test_sample_is_bounded(spark, taught):
    many = taught.unionAll(taught.where("label = 'tech'").withColumn("t", F.concat("t", F.lit(" more"))))
    sample = learned.labelled_sample(many, "t", "label", 50)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert set(sizes) == {"sport", "tech", "food"} and all(20 <= n <= 90 for n in sizes.values())
    assert rows(sample) == rows(learned.labelled_sample(many.repartition(7), "t", "label", 50))


def test_keys_of_names_and_values_meet_within_the_edits_and_are_few():
    import pyarrow as pa

    rng = random.Random(7)

    def changed(text, edits):
        for _ in range(edits):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", "x", "\U0001f600"]) + text[at + rng.randrange(2):]
        return text

    for edits in (1, 2, 3):
        names = ["".join(rng.choice("abcd\u00e9") for _ in range(rng.randrange(1, 40))) for _ in range(300)]
        values = [changed(n, edits) for n in names]
        of_names = vocabulary._keys_of(vocabulary._name_keys, edits)(pa.array(names)).to_pylist()
        of_values = vocabulary._keys_of(vocabulary._value_keys, edits)(pa.array(values)).to_pylist()
        assert all(set(x) & set(y) for x, y in zip(of_names, of_values))
    long_value = vocabulary._keys_of(vocabulary._value_keys, 2)(pa.array(["0123456789" * 4])).to_pylist()[0]
    assert len(long_value) <= 19  # 75 places before
    assert vocabulary._keys_of(vocabulary._value_keys, 2)(pa.array([], pa.string())).to_pylist() == []


def test_places_are_worked_out_once_per_row(spark):
    towns = spark.createDataFrame([("city", "Port", "Port", "Ohio", "USA", 1.0), ("state", "Ohio", None, "Ohio", "USA", 0.0)], places.GAZETTEER)
    texts = spark.createDataFrame([("12 Low Way, Port, Ohio 12345",)], "text string")
    found = places.resolve_places(texts, "text", towns)
    # Inside the lambdas of states and countries the whole city was worked out again for each of them.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_max(") == 3
    assert rows(found.drop("text")) == [("Port", "Ohio", "USA")]
    assert rows(places.parse_addresses(texts, "text", towns).drop("text")) == [("12 Low Way", "Port", "Ohio", "12345")]
