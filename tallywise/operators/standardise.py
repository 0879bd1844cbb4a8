"""Converting, standardising and classifying text columns by rules."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import col
from tallywise.functions.dates import parse_date
from tallywise.session import stored

# Number words.
UNIT_WORDS = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
    "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen",
]
TEN_WORDS = ["twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety"]

# States of the USA with their postal codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO",
    "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID",
    "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA",
    "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY", "North Carolina": "NC",
    "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA",
    "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX",
    "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA", "West Virginia": "WV",
    "Wisconsin": "WI", "Wyoming": "WY",
}
# Informal names, and the state of cities written without one.
STATE_NICKNAMES = {"Cali": "CA", "Calif": "CA", "Mass": "MA", "Penn": "PA", "Tex": "TX"}
CITY_STATES = {"Chicago": "IL", "Los Angeles": "CA", "New York": "NY", "San Francisco": "CA"}
CITY_NICKNAMES = {"San Fran": "San Francisco", "LA": "Los Angeles", "NYC": "New York"}
COUNTRY_ALIASES = {"USA": "USA", "US": "USA", "U.S.": "USA", "U.S.A.": "USA", "United States": "USA"}
STREET_WORDS = ["Street", "St", "Avenue", "Ave", "Road", "Rd", "Boulevard", "Blvd", "Lane", "Ln", "Drive", "Dr"]
UNIT_MARKS = ["Apt", "Suite", "Unit"]


def _literal_map(entries: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def _lookup(entries: Mapping[str, object], key: Column) -> Column:
    return F.try_element_at(_literal_map(entries), key)


def _lowered(entries: Mapping[str, str]) -> dict[str, str]:
    return {k.lower(): v for k, v in entries.items()}


def title_case(text: Column) -> Column:
    """First letter of each word in upper case, the rest in lower case."""
    return F.initcap(text)


# -- type conversion ----------------------------------------------------------

def number_from_words(text: Column) -> Column:
    """0 to 99 in words, e.g. ``thirty-one``; null for other text."""
    values = {w: float(i) for i, w in enumerate(UNIT_WORDS)} | {w: 10.0 * (i + 2) for i, w in enumerate(TEN_WORDS)}
    words = F.split(F.lower(F.trim(text)), "[ -]+")
    numbers = F.transform(words, lambda w: _lookup(values, w))
    ten, unit = F.try_element_at(numbers, F.lit(1)), F.try_element_at(numbers, F.lit(2))
    return F.when(F.size(words) == 1, ten).when(
        (F.size(words) == 2) & (ten >= 20) & unit.between(1, 9), ten + unit
    )


def converted(text: Column, kind: str) -> Column:
    """Text as ``int``, ``double`` or ``date``; null when it is none."""
    if kind == "double":
        return F.coalesce(F.trim(text).try_cast("double"), number_from_words(text))
    if kind == "date":
        return parse_date(text)
    if kind == "int":
        return F.coalesce(F.trim(text).try_cast("int"), number_from_words(text).cast("int"))
    raise ValueError(f"no conversion to {kind!r}")


def convert_types(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Convert columns by ``rules``; what cannot be converted becomes null."""
    return df.withColumns({c: converted(col(c), kind) for c, kind in rules.items()})


def conversion_rejects(df: DataFrame, rules: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per value that could not be converted."""
    tries = F.array(*[
        F.struct(F.lit(c).alias("col_name"), col(c).cast("string").alias("raw_value"),
                 (col(c).isNotNull() & converted(col(c), kind).isNull()).alias("bad"))
        for c, kind in rules.items()
    ])
    bad = F.filter(tries, lambda t: t["bad"])
    return df.select(*[col(c) for c in keep], F.inline(bad)).drop("bad")


# -- places -------------------------------------------------------------------

def _any_of(words: Sequence[str]) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


def _state_entries() -> dict[str, str]:
    codes = {code: code for code in STATE_CODES.values()}
    return _lowered({**STATE_CODES, **STATE_NICKNAMES, **codes})


def parse_address(text: Column) -> Column:
    """Struct ``street, city, state, zip``, whatever order the parts come in."""
    states = _state_entries()
    code = F.regexp_extract(text, r"(?:^|[^0-9])([0-9]{5})(?:[^0-9]|$)", 1)
    rest = F.regexp_replace(text, r"(^|[^0-9])[0-9]{5}([^0-9]|$)", "$1$2")
    street_pattern = (
        rf"(?i)([0-9]+ [a-z0-9 ]*?(?:{_any_of(STREET_WORDS)})(?:[.,]* +(?:{_any_of(UNIT_MARKS)})[ .]*[a-z0-9]+)?)(?:[ ,.]|$)"
    )
    street = F.regexp_extract(rest, street_pattern, 1)
    rest = _tidy(F.regexp_replace(rest, street_pattern, " "))
    ending = F.regexp_extract(rest, rf"(?i)[ ,]+({_any_of(list(states))})$", 1)
    city = _tidy(F.when(ending != "", F.substring(rest, F.lit(1), F.length(rest) - F.length(ending))).otherwise(rest))
    state = F.coalesce(_lookup(states, F.lower(ending)), _lookup(_lowered(CITY_STATES), F.lower(city)))
    return F.struct(_nonempty(street).alias("street"), _nonempty(city).alias("city"), state.alias("state"),
                    _nonempty(code).alias("zip"))


def _tidy(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, " +", " "), "^[ ,]+|[ ,]+$", "")


def _nonempty(text: Column) -> Column:
    return F.when(text != "", text)


def normalise_location(text: Column) -> Column:
    """Struct ``city, state, country`` of ``city[, state[, country]]``."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))

    def part(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i))

    city = F.coalesce(_lookup(_lowered(CITY_NICKNAMES), F.lower(part(1))), _nonempty(part(1)))
    state = F.coalesce(
        _lookup(_state_entries(), F.lower(part(2))), _lookup(_lowered(CITY_STATES), F.lower(city))
    )
    named = F.coalesce(_lookup(_lowered(COUNTRY_ALIASES), F.lower(part(3))), part(3))
    country = F.coalesce(named, F.when(state.isNotNull(), "USA"))
    return F.struct(city.alias("city"), state.alias("state"), country.alias("country"))


# -- closed vocabularies ------------------------------------------------------

def standardise_category(text: Column, aliases: Mapping[str, str], canon: Sequence[str], max_edits: int = 3) -> Column:
    """Canonical name by alias, by equal text, or by the nearest name in edits.

    The nearest name must be within ``max_edits``; ties go to the first in
    alphabetical order. The vocabulary is part of the expression; one that comes
    as a table goes through ``value_mapping`` first.
    """
    lowered = F.lower(F.trim(text))
    known = _lowered({**{c: c for c in canon}, **aliases})
    near = F.array(*[
        F.struct(F.levenshtein(lowered, F.lit(c.lower())).alias("edits"), F.lit(c).alias("name"))
        for c in sorted(canon)
    ])
    best = F.array_min(near)
    return F.coalesce(
        _lookup(known, lowered), F.when(best.getField("edits") <= max_edits, best.getField("name"))
    )


def value_mapping(df: DataFrame, column: str, aliases: DataFrame, out: str) -> DataFrame:
    """Map values through a table ``alias, canonical`` of any size.

    The planner broadcasts the table when its size allows and shuffles otherwise.
    """
    table = aliases.groupBy(F.lower("alias").alias("_alias")).agg(F.min("canonical").alias(out))
    return df.withColumn("_alias", F.lower(F.trim(col(column)))).join(table, "_alias", "left").drop("_alias")


# Product families with their brand, and model words in order.
PRODUCT_FAMILIES = {"iphone": ("Apple", "iPhone"), "galaxy": ("Samsung", "Galaxy"), "pixel": ("Google", "Pixel")}
MODEL_WORDS = ["Pro", "Plus", "Ultra", "Max", "Mini"]


def product_words(text: Column) -> Column:
    """The words of a product's name in lower case, without its storage."""
    bare = F.regexp_replace(F.lower(text), "[0-9]+ *(gb|tb)", " ")
    return F.split(F.regexp_replace(bare, "[^\\p{L}\\p{M}\\p{N}]+", " "), " ")


def product_struct(text: Column, words: Column, brand: Column, family: Column, model_words: Sequence[str]) -> Column:
    """Struct ``brand, model, storage, name``: the model is the family, the first number and the model words in order."""
    size, unit = (F.regexp_extract(F.lower(text), "([0-9]+) *(gb|tb)", i) for i in (1, 2))
    storage = F.when(size != "", F.concat(size, F.upper(unit)))
    number = F.try_element_at(F.filter(words, lambda w: w.rlike("^[0-9]+[a-z]?$")), F.lit(1))
    extras = [F.when(F.array_contains(words, w.lower()), w) for w in model_words]
    model = _nonempty(F.concat_ws(" ", family, number, *extras))
    return F.struct(brand.alias("brand"), model.alias("model"), storage.alias("storage"),
                    F.concat_ws(" ", brand, model, storage).alias("name"))


def standardise_product(text: Column) -> Column:
    """Struct ``brand, model, storage, name`` of a product written in any order; the families are the fixed ones."""
    words = product_words(text)
    family = F.lit(None).cast("string")
    brand = F.lit(None).cast("string")
    for word, (maker, shown) in reversed(PRODUCT_FAMILIES.items()):
        family = F.when(F.array_contains(words, word), shown).otherwise(family)
        brand = F.when(F.array_contains(words, word), maker).otherwise(brand)
    return product_struct(text, words, brand, family, MODEL_WORDS)


def standardise_products(df: DataFrame, column: str, families: DataFrame, model_words: Sequence[str] = MODEL_WORDS) -> DataFrame:
    """Add ``brand, model, storage, name`` by a table ``word, brand, family`` of product families of any size.

    The words of a name are joined with the table; of several families the one named first counts. A brand's own name in the text is
    not needed. Names without a known family keep what is left. Runs jobs; the rows are written once, as they get a key.
    """
    keyed = stored(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_words", product_words(col(column))), "products")
    known = families.groupBy(F.lower("word").alias("_word")).agg(F.min(F.struct("brand", "family")).alias("_f"))
    met = keyed.select("_row", F.posexplode("_words").alias("_at", "_word")).join(known, "_word")
    found = stored(met.groupBy("_row").agg(F.min(F.struct("_at", "_f")).alias("_best")), "families")
    best = F.col("_best._f")
    both = keyed.join(found, "_row", "left")
    product = product_struct(col(column), F.col("_words"), best.getField("brand"), best.getField("family"), model_words)
    return both.select(*[col(c) for c in df.columns], product.alias("_product")).select(*[col(c) for c in df.columns], "_product.*")


def classify_text(text: Column, rules: Mapping[str, Sequence[str]], default: str = "Other") -> Column:
    """The label whose keywords occur most, out of a closed set.

    The score counts the distinct keywords found as whole words or phrases in the
    whole text, whatever their case and the punctuation between words; ties go to
    the label named first, no hit to ``default``.
    """
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^\\p{L}\\p{M}\\p{N}]+", " "), F.lit(" "))

    def plain(keyword: str) -> str:
        return " " + " ".join("".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in keyword.lower()).split()) + " "

    scores = F.array(*[
        F.struct(sum((words.contains(w).cast("int") for w in sorted(set(map(plain, keywords)) - {"  "})), F.lit(0)).alias("score"),
                 F.lit(-i).alias("rank"), F.lit(label).alias("label"))
        for i, (label, keywords) in enumerate(rules.items())
    ])
    best = F.array_max(scores)
    return F.when(best.getField("score") > 0, best.getField("label")).otherwise(default)
