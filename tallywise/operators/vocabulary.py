"""Vocabularies that come as tables: the nearest name within some edits, and the longest names inside texts.

Both are equality joins on keys that follow from the strings, so neither side has to fit into memory and no name is
tried on a row that shares no key with it.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import col, cols
from tallywise.session import stored

# -- the nearest name -----------------------------------------------------------

#: Names up to this length are found by what is left when letters are removed, longer ones by a piece that is unchanged.
SHORT = 24


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.array([pow(base, i, 1 << 64) for i in range(n + 1)], np.uint64)


def _prefixes(texts: list[str], size: int) -> np.ndarray:
    """Of texts of ``size`` letters a matrix of hash sums up to each letter."""
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), size).astype(np.uint64)
    out = np.zeros((len(texts), size + 1), np.uint64)
    np.cumsum((letters + np.uint64(1)) * _powers(_BASE, size)[:size][::-1], axis=1, out=out[:, 1:])
    return out


def _key(sums: np.ndarray, *parts: int) -> np.ndarray:
    """Hash sums with numbers mixed in, as keys whose bits are all alike."""
    for part in parts:
        sums = (sums ^ np.uint64(part + 1)) * np.uint64(0xBF58476D1CE4E5B9)
        sums = sums ^ (sums >> np.uint64(29))
    sums = sums * np.uint64(0x94D049BB133111EB)
    return (sums ^ (sums >> np.uint64(32))).view(np.int64)


def _deletions(sums: np.ndarray, edits: int) -> list[np.ndarray]:
    """Keys of the spellings that removing up to ``edits`` letters leaves."""
    size, out = sums.shape[1] - 1, []
    powers = _powers(_INVERSE, edits)
    for gone in range(min(edits, size) + 1):
        places = np.array(list(combinations(range(size), gone)), np.int64).reshape(comb(size, gone), gone)
        total = np.zeros((len(sums), len(places)), np.uint64)
        for i in range(gone + 1):  # what stands between two removed letters moves by those behind it
            begin = places[:, i - 1] + 1 if i else np.zeros(len(places), np.int64)
            end = places[:, i] if i < gone else np.full(len(places), size)
            total += (sums[:, end] - sums[:, begin]) * powers[gone - i]
        out.append(_key(total, 0, size - gone))
    return out


def _cut(size: int, pieces: int, i: int) -> int:
    """Where piece i of a name begins when it is cut into pieces that differ by one letter at most; from 0."""
    return size * i // pieces


def _piece(sums: np.ndarray, begin: int, end: int, size: int, i: int) -> np.ndarray:
    """Keys of the letters from ``begin`` to ``end`` as piece i of a name of ``size`` letters."""
    power = np.uint64(pow(_INVERSE, sums.shape[1] - 1 - end, 1 << 64))
    return _key((sums[:, [end]] - sums[:, [begin]]) * power, 1, size, i)


def _name_keys(sums: np.ndarray, edits: int) -> list[np.ndarray]:
    """Of a short name its deletions, of a long one its ``edits + 1`` pieces: one of them is left by any ``edits`` edits."""
    size = sums.shape[1] - 1
    if size <= SHORT:
        return _deletions(sums, edits)
    return [_piece(sums, _cut(size, edits + 1, i), _cut(size, edits + 1, i + 1), size, i) for i in range(edits + 1)]


def _value_keys(sums: np.ndarray, edits: int) -> list[np.ndarray]:
    """The keys under which a name within ``edits`` edits of a value lies, whatever the name's length."""
    size = sums.shape[1] - 1
    out = _deletions(sums, edits) if size <= SHORT + edits else []
    for of_name in range(max(size - edits, SHORT + 1), size + edits + 1):  # a length the name may have
        for i in range(edits + 1):
            begin, end = _cut(of_name, edits + 1, i), _cut(of_name, edits + 1, i + 1)
            # Some piece is unchanged with i edits at most before it and edits - i at most behind it.
            for shift in range(-i, i + 1):
                if abs(size - of_name - shift) <= edits - i and begin + shift >= 0 and end + shift <= size:
                    out.append(_piece(sums, begin + shift, end + shift, of_name, i))
    return out


def _keys_of(keys: Callable[[np.ndarray, int], list[np.ndarray]], edits: int) -> Callable[[pa.Array], pa.Array]:
    """The distinct keys of each text of a batch; texts of one length are done together."""
    def lists(texts: pa.Array) -> pa.Array:
        by_size: dict[int, list[int]] = {}
        given = texts.to_pylist()
        for row, text in enumerate(given):
            by_size.setdefault(len(text), []).append(row)
        order, counts, values = [], [], []
        for size, of_size in by_size.items():
            # Long texts have thousands of deletions, so few go at a time.
            step = max(1, 200_000 // (1 + comb(size, edits))) if size <= SHORT + edits else 2_000
            for at in range(0, len(of_size), step):
                some = of_size[at:at + step]
                found = keys(_prefixes([given[r] for r in some], size), edits)
                matrix = np.sort(np.concatenate(found, axis=1), axis=1) if found else np.zeros((len(some), 0), np.int64)
                new = np.ones(matrix.shape, bool)
                new[:, 1:] = matrix[:, 1:] != matrix[:, :-1]
                order += some
                counts.append(new.sum(axis=1))
                values.append(matrix[new])
        ends = np.cumsum(np.concatenate([[0], *counts]))
        flat = np.concatenate([np.zeros(0, np.int64), *values])
        made = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat, pa.int64()))
        return made.take(pa.array(np.argsort(np.array(order, np.int64)), pa.int64())).cast(pa.list_(pa.int64()))

    return lists


def nearest_name(df: DataFrame, column: str, names: DataFrame, out: str, max_edits: int = 2, name: str = "name") -> DataFrame:
    """Add the name of a table that is nearest to a column in edits, null beyond ``max_edits``.

    Case and white space around do not count; ties go to the first name in alphabetical order. The table may have any
    size: two strings within ``k`` edits share a spelling left by removing up to ``k`` letters of either, and a name cut
    into ``k + 1`` pieces keeps one of them within ``k`` edits, moved by ``k`` letters at most. Names of up to
    ``SHORT`` letters are joined by the first, longer ones by the second, and what meets is verified by edit distance.
    Each distinct value is looked up once, and only one that is no name itself by these keys, which meet as numbers:
    the spellings join what has met. Null values and null or empty names match nothing. Runs jobs when called.
    """
    values = df.select(F.lower(F.trim(col(column).cast("string"))).alias("_value")).where("_value is not null").distinct()
    known = names.select(col(name).cast("string").alias("_name"), F.lower(F.trim(col(name).cast("string"))).alias("_plain"))
    known = known.where("_plain <> ''").groupBy("_plain").agg(F.min("_name").alias("_name"))
    known = stored(known.withColumn("_n", F.monotonically_increasing_id()), "names")
    values = values.join(known.select(F.col("_plain").alias("_value"), F.col("_name").alias("_same")), "_value", "left")
    values = stored(values.withColumn("_v", F.monotonically_increasing_id()), "values")
    other = values.where("_same is null").select("_v", "_value")
    left = other.select("_v", F.explode(F.arrow_udf(_keys_of(_value_keys, max_edits), "array<bigint>")("_value")).alias("_key"))
    right = known.select("_n", F.explode(F.arrow_udf(_keys_of(_name_keys, max_edits), "array<bigint>")("_plain")).alias("_key"))
    met = stored(left.join(right, "_key").select("_v", "_n").distinct(), "name_pairs")
    edits = F.levenshtein("_value", "_plain", max_edits)
    met = met.join(known, "_n").join(other, "_v").select("_value", "_name", edits.alias("_edits")).where("_edits >= 0")
    best = met.groupBy("_value").agg(F.min(F.struct("_edits", "_name")).alias("_best"))
    same = values.where("_same is not null").select("_value", F.col("_same").alias("_found"))
    found = stored(same.unionByName(best.select("_value", F.col("_best._name").alias("_found"))), "nearest_names")
    keyed = df.withColumn("_value", F.lower(F.trim(col(column).cast("string")))).join(found, "_value", "left")
    return keyed.select(*[col(c) for c in df.columns if c != out], F.col("_found").alias(out))


# -- names inside texts ----------------------------------------------------------

#: A word of any script; what lies between two words is kept as it is.
WORD = "[\\p{L}\\p{M}\\p{N}]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def between_words(text: Column) -> Column:
    """What stands before, between and behind the words: one more entry than there are words."""
    return F.split(text, WORD, -1)


def trimmed_name(name: Column) -> Column:
    """A name from its first to its last letter or digit."""
    return F.regexp_replace(F.regexp_replace(name, "^[^\\p{L}\\p{M}\\p{N}]+", ""), "[^\\p{L}\\p{M}\\p{N}]+$", "")


def _live(words: pa.Array, heads: pa.Array) -> pa.Array:
    """Places (from 1) of the words that are among the heads of their row; all rows of a batch are done together.

    The heads of a row are all its words that any name begins with, so those of other rows add none.
    """
    count = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    found = np.flatnonzero(pc.is_in(words.flatten(), value_set=heads.flatten().unique()).to_numpy(zero_copy_only=False))
    ends = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
    row = np.searchsorted(ends, found, "right") - 1
    offsets = np.searchsorted(found, ends).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array((found - ends[row] + 1).astype(np.int32)))


def _spans(words: Column, gaps: Column, sizes: Column, heads: Column) -> Column:
    """Every run of words that begins at one of the places ``heads`` and has as many words as one of the names there."""
    def runs(i: Column) -> Column:
        lengths = F.filter(F.try_element_at(sizes, F.element_at(words, i)), lambda m: i + m - 1 <= F.size(words))
        return F.transform(lengths, lambda m: F.struct(
            (i - 1).alias("at"), m.alias("n"),
            F.when(m == 1, F.element_at(words, i)).otherwise(F.concat(F.element_at(words, i), F.array_join(F.flatten(F.transform(
                F.sequence(F.lit(1), m - 1), lambda j: F.array(F.element_at(gaps, i + j), F.element_at(words, i + j)),
            )), ""))).alias("run"),
        ))

    return F.flatten(F.transform(heads, runs))


def name_spans(texts: DataFrame, row: str, text: str, names: DataFrame, name: str = "name") -> DataFrame:
    """``row``, ``at``, ``n``, ``run``: every place where a name of the table stands in a text as whole words.

    ``at`` counts words from 0 and ``n`` is the number of words; names inside longer ones are found too. Case counts.
    Names are taken from their first to their last letter or digit; what lies between their words must be the same.

    Words of texts are joined with the first words of names, then runs of as many words as such names have with the
    names themselves: equality joins both, for a table of any size. Runs jobs when called.
    """
    known = names.select(trimmed_name(col(name).cast("string")).alias("run")).where("run <> ''").distinct()
    known = stored(known.select("run", F.element_at(words_of(F.col("run")), 1).alias("head"), F.size(words_of(F.col("run"))).alias("n")), "names")
    heads = stored(known.groupBy("head").agg(F.array_sort(F.collect_set("n")).alias("sizes")), "name_heads")
    rows = texts.select(col(row).alias("_row"), F.explode(F.array_distinct(words_of(col(text)))).alias("head"))
    sizes = rows.join(heads, "head").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("head", "sizes"))).alias("sizes"))
    live = texts.select(col(row).alias("_row"), col(text).alias("_text")).join(stored(sizes, "live_names"), "_row")
    # Columns of their own: inside the lambdas of _spans they would be cut out of the text again for every word.
    live = live.select("_row", words_of(F.col("_text")).alias("_words"), between_words(F.col("_text")).alias("_gaps"), "sizes")
    live = live.withColumn("_heads", F.arrow_udf(_live, "array<int>")("_words", F.map_keys("sizes")))
    runs = live.select("_row", F.inline(_spans(F.col("_words"), F.col("_gaps"), F.col("sizes"), F.col("_heads"))))
    return runs.join(known.select("run"), "run").select(F.col("_row").alias(row), "at", "n", "run")


def longest_first(at: list[int], n: list[int]) -> list[tuple[int, int]]:
    """Of spans that overlap the one that begins first counts, of those the longest."""
    out, free = [], 0
    for begin, size in sorted(zip(at, n), key=lambda s: (s[0], -s[1])):
        if begin >= free:
            out.append((begin, size))
            free = begin + size
    return out


def _spliced(put: str):
    """Texts from their words and what lies between, with spans replaced; rows without spans give null.

    What a text is made of, gap and word in turn, is taken as one list of pieces for the whole batch.
    """
    def splice(words: pa.Array, gaps: pa.Array, at: pa.Array, n: pa.Array) -> pa.Array:
        known = at.is_valid()
        n_words = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        n_gaps = gaps.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        size = n_words + n_gaps
        ends = np.cumsum(size)
        place = np.arange(size.sum()) - np.repeat(ends - size, size)
        of_words, of_gaps = words.flatten().cast(pa.large_string()), gaps.flatten().cast(pa.large_string())
        first_gap = np.repeat(np.cumsum(n_gaps) - n_gaps, size)
        first_word = np.repeat(np.cumsum(n_words) - n_words, size) + len(of_gaps)
        piece = np.where(place % 2 == 0, first_gap, first_word) + place // 2
        spans = [
            (int(ends[row] - size[row]) + 2 * begin + 1, 2 * count - 2)
            for row, (some, counts) in enumerate(zip(at.to_pylist(), n.to_pylist())) if some is not None
            for begin, count in longest_first(some, counts)
        ]
        begin, more = np.array(spans, np.int64).reshape(-1, 2).T
        piece[begin] = len(of_gaps) + len(of_words)
        gone = np.zeros(len(piece), bool)
        gone[np.repeat(begin + 1 - (np.cumsum(more) - more), more) + np.arange(more.sum())] = True
        taken = pa.concat_arrays([of_gaps, of_words, pa.array([put], pa.large_string())]).take(pa.array(piece[~gone]))
        left = np.concatenate(([0], np.cumsum(~gone)))[np.concatenate(([0], ends))]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), taken), pa.scalar("", pa.large_string()))
        return pc.if_else(known, texts, pa.scalar(None, pa.large_string())).cast(pa.string())

    return splice


def redact_names(df: DataFrame, text: str, names: DataFrame, put: str = "*", name: str = "name") -> DataFrame:
    """Replace the names of a table in a text column; of names that overlap the first counts, of those the longest.

    What counts as a name is said in ``name_spans``. Texts without a name, and null ones, stay as they are. Runs jobs
    when called; the rows are written once, as they get a key of their own.
    """
    keyed = stored(df.withColumn("_row", F.monotonically_increasing_id()), "texts")
    found = name_spans(keyed, "_row", text, names)
    found = found.groupBy("_row").agg(F.collect_list(F.struct("at", "n")).alias("_spans"))
    found = stored(found.select("_row", F.col("_spans.at").alias("_at"), F.col("_spans.n").alias("_n")), "name_spans")
    both, hit = keyed.join(found, "_row", "left"), F.col("_at").isNotNull()
    splice = F.arrow_udf(_spliced(put), "string")
    new = splice(F.when(hit, words_of(col(text))), F.when(hit, between_words(col(text))), "_at", "_n")
    return both.withColumn(text, F.coalesce(new, col(text))).select(*cols(df.columns))
