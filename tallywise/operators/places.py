"""Places in free text, resolved against a gazetteer that is a table.

A gazetteer has one row per spelling of a place: ``kind`` (``city``, ``state`` or ``country``), ``name`` (the spelling),
``city``, ``state``, ``country`` (what it stands for; a state has no city, a country only itself) and ``weight`` (which
of several places of one name is meant when nothing else tells, e.g. inhabitants). Several rows may share a name.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions.columns import col, cols
from tallywise.operators.standardise import CITY_NICKNAMES, CITY_STATES, COUNTRY_ALIASES, STATE_CODES, STATE_NICKNAMES
from tallywise.operators.vocabulary import between_words, longest_first, name_spans, words_of
from tallywise.session import stored

#: Names up to this length count only as they are written: ``OR`` is a state, ``or`` is none.
AS_WRITTEN = 2
GAZETTEER = "kind string, name string, city string, state string, country string, weight double"


def default_gazetteer(spark: SparkSession) -> DataFrame:
    """The states of the USA with codes and informal names, and the few cities known by name alone."""
    country = "USA"
    rows = [("country", alias, None, None, shown, 0.0) for alias, shown in COUNTRY_ALIASES.items()]
    for name, code in {**STATE_CODES, **STATE_NICKNAMES}.items():
        rows += [("state", name, None, code, country, 0.0), ("state", code, None, code, country, 0.0)]
    for name, state in CITY_STATES.items():
        rows.append(("city", name, name, state, country, 0.0))
    for name, city in CITY_NICKNAMES.items():
        rows.append(("city", name, city, CITY_STATES[city], country, 0.0))
    return spark.createDataFrame(sorted(set(rows), key=repr), GAZETTEER)


def _normal(text: Column) -> Column:
    """Lower case but for the shortest words, white space as single blanks."""
    words, gaps = words_of(text), between_words(F.regexp_replace(text, "\\s+", " "))

    def plain(w: Column) -> Column:
        return F.when(F.length(w) > AS_WRITTEN, F.lower(w)).otherwise(w)

    parts = F.zip_with(F.transform(words, plain), F.slice(gaps, 2, F.size(words)), lambda w, g: F.concat(w, g))
    return F.when(F.size(words) > 0, F.concat(F.element_at(gaps, 1), F.array_join(parts, ""))).otherwise(text)


def _longest(at: pa.Array, n: pa.Array) -> pa.Array:
    spans = [[a for a, _ in longest_first(x, y)] if x is not None else None for x, y in zip(at.to_pylist(), n.to_pylist())]
    return pa.array(spans, pa.list_(pa.int32()))


def _hits(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``_row`` and ``_hits``: what the names in a text may stand for; of names inside one another the longest count."""
    known = places.select("kind", _normal(F.col("name")).alias("run"), "city", "state", "country", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    known = known.withColumn("run", F.regexp_replace(F.regexp_replace("run", "^[^\\p{L}\\p{M}\\p{N}]+", ""), "[^\\p{L}\\p{M}\\p{N}]+$", ""))
    known = stored(known.where("run <> ''").distinct(), "places")
    spans = stored(name_spans(texts, "_row", "_normal", known.select(F.col("run").alias("name"))), "place_spans")
    apart = spans.groupBy("_row").agg(F.collect_list(F.struct("at", "n")).alias("s"))
    longest = F.arrow_udf(_longest, "array<int>")
    apart = apart.select("_row", longest("s.at", "s.n").alias("begins"), F.col("s").alias("s"))
    kept = F.filter("s", lambda x: F.array_contains("begins", x["at"]) & ~F.exists("s", lambda y: (y["at"] == x["at"]) & (y["n"] > x["n"])))
    kept = apart.select("_row", F.inline(kept))
    named = spans.join(kept, ["_row", "at", "n"]).join(known, "run")
    return named.groupBy("_row").agg(F.collect_list(F.struct("kind", "at", "n", "city", "state", "country", "weight")).alias("_hits"))


def _set_off(h: Column) -> Column:
    """On how many sides a name is set off by a comma or by the text's end."""
    after = h["at"] + h["n"]
    before = (h["at"] == 0) | F.element_at("_gaps", h["at"] + 1).contains(",")
    return before.cast("int") + ((after == F.size("_words")) | F.element_at("_gaps", after + 1).contains(",")).cast("int")


def _with_place(df: DataFrame) -> DataFrame:
    """Add ``_place``: city, state and country with where each was named; a state or country that is named settles the city.

    Steps are columns of their own: inside a lambda, an expression would be worked out again for every element.
    """
    def of(kind: str) -> Column:
        return F.filter("_hits", lambda h: h["kind"] == kind)

    df = df.withColumns({"_cities": of("city"), "_states": of("state"), "_countries": of("country")})

    def agreement(c: Column) -> Column:
        same_state = F.exists("_states", lambda s: (s["state"] == c["state"]) & s["country"].eqNullSafe(c["country"]) & (s["at"] != c["at"]))
        same_country = F.exists("_countries", lambda k: (k["country"] == c["country"]) & (k["at"] != c["at"]))
        return F.when(same_state, 2).otherwise(0) + F.when(same_country, 1).otherwise(0)

    df = df.withColumn("_city", F.array_max(F.transform("_cities", lambda c: F.struct(
        agreement(c).alias("agreement"), _set_off(c).alias("set_off"), c["n"].alias("n"), c["weight"].alias("weight"), (-c["at"]).alias("first"),
        c["city"].alias("city"), c["state"].alias("state"), c["country"].alias("country"),
    ))))
    city = F.col("_city")
    city_at = -city["first"]
    df = df.withColumns({
        "_state": F.array_max(F.transform(
            F.filter("_states", lambda s: ~(s["at"] == F.coalesce(city_at, F.lit(-1)))),
            lambda s: F.struct((s["state"].eqNullSafe(city["state"])).alias("agrees"), s["at"].alias("at"), s["n"].alias("n"), s["state"].alias("state"), s["country"].alias("country")),
        )),
        "_country": F.array_max(F.transform(
            F.filter("_countries", lambda k: ~(k["at"] == F.coalesce(city_at, F.lit(-1)))),
            lambda k: F.struct(k["at"].alias("at"), k["n"].alias("n"), k["country"].alias("country")),
        )),
    })
    state, country = F.col("_state"), F.col("_country")
    # A place of another state than the one named lends its name, not its own state and country.
    foreign = state.isNotNull() & ~state["state"].eqNullSafe(city["state"])
    own_state, own_country = F.when(~foreign, city["state"]), F.when(~foreign, city["country"])
    spans = F.array_compact(F.array(
        F.when(city.isNotNull(), F.struct(city_at.alias("at"), city["n"].alias("n"))),
        F.when(state.isNotNull(), F.struct(state["at"].alias("at"), state["n"].alias("n"))),
        F.when(country.isNotNull(), F.struct(country["at"].alias("at"), country["n"].alias("n"))),
    ))
    return df.withColumn("_place", F.when(F.col("_hits").isNotNull(), F.struct(
        city["city"].alias("city"), F.coalesce(state["state"], own_state).alias("state"),
        F.coalesce(country["country"], state["country"], own_country).alias("country"), F.array_sort(spans).alias("spans"),
    )))


def _located(df: DataFrame, text: Column, places: DataFrame) -> DataFrame:
    """The rows with ``_text``, its words and gaps, and ``_place`` (null where no name of the gazetteer stands)."""
    keyed = stored(df.withColumn("_text", text).withColumn("_row", F.monotonically_increasing_id()), "placed_texts")
    texts = keyed.select("_row", _normal(F.col("_text")).alias("_normal"))
    both = keyed.join(stored(_hits(texts, places), "place_hits"), "_row", "left")
    return _with_place(both.withColumns({"_words": words_of(F.col("_text")), "_gaps": between_words(F.col("_text"))}))


def _free_text(begin: Column, end: Column) -> Column:
    """The text from word ``begin`` up to before word ``end`` (from 0), without what surrounds it."""
    inner = F.transform(F.sequence(begin, end - 1), lambda i: F.concat(
        F.element_at("_words", i + 1), F.when(i < end - 1, F.element_at("_gaps", i + 2)).otherwise(F.lit("")),
    ))
    return F.when(end > begin, F.array_join(inner, ""))


def resolve_places(df: DataFrame, column: str, places: DataFrame) -> DataFrame:
    """Add ``city``, ``state`` and ``country`` of what a text names, by a gazetteer of any size.

    Names are found as whole words, the longest at each place; case does not count but for names of up to
    ``AS_WRITTEN`` letters. Of several places of one name the one whose state or country is named too is meant, else the
    one of the largest ``weight``. A state that is named outranks the city's own. A first part without any known name
    (``Toronto`` before a comma, where only ``Ontario`` is known) is taken for the city. Runs jobs when called.
    """
    found = _located(df, col(column).cast("string"), places)
    place = F.col("_place")
    first = F.try_element_at(place["spans"], F.lit(1))["at"]
    unknown = F.when(place["city"].isNull() & (first > 0), _free_text(F.lit(0), first))
    return found.select(
        *cols(df.columns), F.coalesce(place["city"], unknown).alias("city"), place["state"].alias("state"), place["country"].alias("country"),
    )


ZIP = "(?:^|[^0-9-])([0-9]{5}(?:-[0-9]{4})?)(?![0-9-])"


def parse_addresses(df: DataFrame, column: str, places: DataFrame) -> DataFrame:
    """Add ``street``, ``city``, ``state``, ``zip`` of an address, whatever order its parts come in.

    The place is resolved as in ``resolve_places``, so a street may hold the name of a city. The street is what begins
    with a house number and ends before the place that was resolved; the ZIP code is the last number of five digits,
    with or without four more. A part without any known name is taken for the city. Runs jobs when called.
    """
    raw = col(column).cast("string")
    codes = F.regexp_extract_all(raw, F.lit(ZIP), F.lit(1))
    code = F.when(F.size(codes) > 0, F.element_at(codes, -1))
    at = F.length(raw) - F.position(F.reverse(code), F.reverse(raw)) - F.length(code) + 2
    rest = F.when(code.isNull(), raw).otherwise(F.concat(F.substring(raw, F.lit(1), at - 1), F.lit(","), F.substring(raw, at + F.length(code), F.length(raw))))
    found = _located(df.withColumn("_zip", code), rest, places)
    place, words = F.col("_place"), F.col("_words")
    n = F.size(words)
    found = found.withColumn("_spans", F.coalesce(place["spans"], F.array().cast("array<struct<at:int,n:int>>")))

    def in_place(i: Column) -> Column:
        return F.exists("_spans", lambda s: (s["at"] <= i) & (i < s["at"] + s["n"]))

    # Columns of their own, as in _with_place.
    found = found.withColumn("_house", F.array_min(F.filter(
        F.transform(words, lambda w, i: F.when(w.rlike("^[0-9]") & ~in_place(i), i)), lambda i: i.isNotNull(),
    )))
    house = F.col("_house")
    found = found.withColumns({
        "_stop": F.coalesce(F.array_min(F.transform(F.filter("_spans", lambda s: s["at"] > house), lambda s: s["at"])), n),
        # Without a known place behind it, a street ends at the last comma.
        "_last": F.array_max(F.filter(F.transform("_gaps", lambda g, i: F.when(g.contains(",") & (i > house) & (i < n), i)), lambda i: i.isNotNull())),
    })
    stop, last = F.col("_stop"), F.col("_last")
    found = found.withColumn("_end", F.when((stop == n) & place["city"].isNull() & last.isNotNull(), last).otherwise(stop))
    first = F.coalesce(F.try_element_at("_spans", F.lit(1))["at"], n)
    found = found.withColumns({
        "_begin": F.when(house.isNull() | (house > 0), F.lit(0)).otherwise(F.col("_end")),
        "_until": F.when(house > 0, F.least(house, first)).when((stop == n) & last.isNotNull(), n).otherwise(first),
    })
    street = F.when(house.isNotNull(), _free_text(house, F.col("_end")))
    begin, until = F.col("_begin"), F.col("_until")
    unknown = F.when(place["city"].isNull() & (until > begin), _free_text(begin, until))
    return found.select(
        *cols(df.columns), street.alias("street"), F.coalesce(place["city"], unknown).alias("city"), place["state"].alias("state"), F.col("_zip").alias("zip"),
    )
