"""Near duplicates by MinHash bands, verified by odd sketches and confirmed on full sets of shingles.

1. One pass over the texts gives each row its set's digest, ``BANDS * ROWS`` MinHash samples folded into one 64-bit key
   per band, and an odd sketch: each sample flips one bit of a bitmap, so that a bit holds the parity of the samples on
   it. Equal sets become one class.
2. Classes with a common band key are candidates. The XOR of two odd sketches is the odd sketch of the samples in
   which they differ; its population count estimates their number, and a pair whose count a pair at the threshold
   practically never reaches is no candidate any more. A second odd sketch, of all shingles of a set, does the same for
   the shingles in which two sets differ; as a count never exceeds that number, it is sharp for sets of up to some
   hundred shingles. Both are part of the join's condition, so such pairs never become rows.
3. What is left is confirmed on full sets. No group is expanded into all its pairs: each class is first compared with
   one leader, twice; after that only pairs of classes that are still in different components are compared, and of
   those each one that its sizes and sketches leave possible.

A pair at a similarity of 0.8 shares no band with probability ``(1 - 0.8**ROWS)**BANDS``, 5e-8, and is rejected by its
sketches with at most ``LOSS``; more similar pairs are lost less often still. Sets are compared as 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words
from tallywise.llm.batching import small_batches, trimmed
from tallywise.llm.components import components
from tallywise.session import stored

#: Bands, and MinHash samples in each.
BANDS, ROWS = 32, 4
#: Words of 64 bits of an odd sketch; a class has two, of its samples and of its whole set.
SKETCH = 16
BITS = 64 * SKETCH
#: Probability with which sketches may reject a pair at the threshold.
LOSS = 1e-9
#: Standard deviations by which the count of a sketch may exceed its mean; beyond lies about a part in 10**10.
DEVIATIONS = 6.5
#: Turns of comparing each class with one leader, before all pairs still open are compared.
TURNS = 2
#: Texts whose sketches are counted at once.
TEXTS = 2048

_numbers = np.random.default_rng(20_261_201).integers(1 << 63, size=(3, BANDS * ROWS), dtype=np.uint64)
#: One permutation of hashes per sample: exclusive or, then an odd factor. The third row places samples in the sketch.
XORS, FACTORS, PLACES = _numbers[0], _numbers[1] * np.uint64(2) + np.uint64(1), _numbers[2]

_ROW = "doc_id long, h long, n long, cid binary, bands array<long>, sketch array<long>"


def samples(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash samples (rows) of the sets (columns) that begin at ``starts`` in ``values``."""
    out = np.empty((BANDS * ROWS, len(starts)), np.uint64)
    held = np.empty_like(values)
    for i in range(BANDS * ROWS):
        np.bitwise_xor(values, XORS[i], out=held)
        np.multiply(held, FACTORS[i], out=held)
        out[i] = np.minimum.reduceat(held, starts)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (columns) of each set (rows); keys of different bands differ."""
    grouped = found.reshape(BANDS, ROWS, -1)
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], found.shape[1], axis=1)
    for j in range(ROWS):
        key = words.mixed(key * np.uint64(words.MULTIPLIER) + grouped[:, j])
    return key.T.copy().view(np.int64)


def parities(place: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Bitmaps (rows, as 64-bit words) of n owners in which a bit is the parity of how often its place was met."""
    out = []
    for lo in range(0, n, TEXTS):  # owners come in ascending order
        hi = min(n, lo + TEXTS)
        i, j = np.searchsorted(owner, [lo, hi])
        odd = np.bincount(place[i:j] + BITS * (owner[i:j] - lo), minlength=(hi - lo) * BITS) & 1
        out.append(np.packbits(odd.astype(np.uint8).reshape(hi - lo, BITS), axis=1).view(np.int64))
    return np.concatenate(out) if out else np.zeros((0, SKETCH), np.int64)


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """The parity bitmap of each set's samples (rows), as 64-bit words."""
    place = (words.mixed(found ^ PLACES[:, None]) % np.uint64(BITS)).astype(np.int64)
    return parities(place.T.reshape(-1), np.repeat(np.arange(found.shape[1]), BANDS * ROWS), found.shape[1])


def whole_sketches(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The parity bitmap of all shingles of each set (rows)."""
    place = (words.mixed(values ^ PLACES[0]) % np.uint64(BITS)).astype(np.int64)
    return parities(place, np.repeat(np.arange(len(at) - 1), np.diff(at)), len(at) - 1)


def most_differing(percent: int) -> int:
    """The largest bit count of two XORed sketches that a pair at the threshold exceeds with at most ``LOSS``.

    The number of differing samples is binomial; two flips a differing sample move a walk on the number of odd bits.
    """
    k, s = BANDS * ROWS, percent / 100
    walk = np.zeros(BITS + 1)
    walk[0] = 1.0
    up, down = 1 - np.arange(BITS + 1) / BITS, np.arange(BITS + 1) / BITS
    total = np.zeros(BITS + 1)
    for differing in range(k + 1):
        total += math.comb(k, differing) * (1 - s) ** differing * s ** (k - differing) * walk
        for _ in range(2):
            step = np.zeros(BITS + 1)
            step[1:] += (walk * up)[:-1]
            step[:-1] += (walk * down)[1:]
            walk = step
    beyond = np.cumsum(total[::-1])[::-1]
    return int(np.flatnonzero(beyond > LOSS).max())


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), rows.shape[1]).cast(pa.list_(pa.int64()))


def _digests(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """128 bits of each set, whatever the order and number of its shingles' occurrences in the text."""
    sums = np.zeros((len(at) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        for i in range(2):
            sums[full, i] = np.add.reduceat(words.mixed(values ^ np.uint64(0x1234567 + i)), at[:-1][full])
    return pa.array([x.tobytes() for x in sums], pa.binary())


def _first_pass(k: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in words.batches(texts):
                values, at = words.shingle_sets(texts[lo:hi], k)
                n = np.diff(at)
                full = np.flatnonzero(n)
                bands, sketch = np.zeros((hi - lo, BANDS), np.int64), np.zeros((hi - lo, 2 * SKETCH), np.int64)
                if len(full):
                    found = samples(values, at[:-1][full])
                    bands[full], sketch[full, :SKETCH] = band_keys(found), odd_sketches(found)
                    sketch[:, SKETCH:] = whole_sketches(values, at)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(n.astype(np.int64)), _digests(values, at),
                    _lists(bands), _lists(sketch),
                ], ["doc_id", "h", "n", "cid", "bands", "sketch"])

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in words.batches(texts):
                values, at = words.shingle_sets(texts[lo:hi], k)
                grams = pa.array([values[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())
                yield pa.RecordBatch.from_arrays([_digests(values, at), grams], ["cid", "grams"])

    return run


def _overlaps(batches):
    for batch in batches:
        both = [
            len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
            for x, y in zip(batch.column(4), batch.column(5))
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(both, pa.int64())], ["a", "b", "na", "nb", "o"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets reach the threshold; ``sets`` holds ``rid``, ``n`` and sorted ``grams``."""
    left = sets.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    right = sets.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    side_by_side = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ga", "gb")
    counted = side_by_side.mapInArrow(trimmed(_overlaps), "a long, b long, na long, nb long, o long")
    return counted.where(f"100 * o >= {percent} * (na + nb - o)").select("a", "b")


def _apart(first: int = 0) -> str:
    """The bit count of two sketches' XOR, from the given word on."""
    return " + ".join(f"bit_count(ha[{i}] ^ hb[{i}])" for i in range(first, first + SKETCH))


def _possible(percent: int, most: int) -> str:
    """Whether two classes can link by their sizes and by their sketches.

    Sets at the threshold differ in ``d`` shingles at most, which set ``d`` bits at most, and in the mean as many as the
    walk on odd bits reaches.
    """
    d = f"((na + nb) * {100 - percent} / {100 + percent})"
    mean = f"{BITS / 2} * (1 - exp(-2 * {d} / {BITS}))"
    variance = f"greatest(1, {BITS / 4} * (1 - exp(-4 * {d} / {BITS})) - {d} * exp(-4 * {d} / {BITS}))"
    whole = f"{_apart(SKETCH)} <= least({d}, {mean} + {DEVIATIONS} * sqrt({variance}))"
    return f"100 * least(na, nb) >= {percent} * greatest(na, nb) and {_apart()} <= {most} and {whole}"


def _leader_pairs(members: DataFrame, turn: int, percent: int, most: int) -> DataFrame:
    """Each class and the leader most similar by sketch, among the leaders of its bands in other components.

    At first a band is led by the class that meets most others over all its bands, as does the text that others are
    copies of, later by its smallest class.
    """
    leader = (F.min("rid") if turn % 2 else F.max_by("rid", "weight")).alias("a")
    lead = members.groupBy("band").agg(leader, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band", "a")
    led = members.select("band", F.col("rid").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"), F.col("sketch").alias("ha"))
    lead = stored(lead.join(led, ["band", "a"]), "dedup_leaders")
    mine = members.select("band", F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"), F.col("sketch").alias("hb"))
    met = mine.join(lead, "band").where(f"ca <> cb and {_possible(percent, most)}")
    apart = F.expr(f"cast({_apart()} as long) * {1 << 32} + pmod(a, {1 << 32})")  # the nearest, of those any one
    nearest = met.select("b", "a", apart.alias("apart")).groupBy("b").agg(F.min_by("a", "apart").alias("a"))
    return nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _open_pairs(members: DataFrame, percent: int, most: int) -> DataFrame:
    """All pairs with a common band key in different components that sizes and sketches leave possible."""
    held = members.groupBy("band", "comp").agg(F.count("*").alias("c"))
    held = held.groupBy("band").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("comps"))
    held = stored(held.where("comps > 1").select("band", "main"), "dedup_open")
    still = stored(members.join(held, "band"), "dedup_open_members")
    left = still.where("comp <> main").select("band", F.col("rid").alias("x"), F.col("n").alias("na"), F.col("comp").alias("ca"), F.col("sketch").alias("ha"))
    right = still.select("band", F.col("rid").alias("y"), F.col("n").alias("nb"), F.col("comp").alias("cb"), F.col("sketch").alias("hb"))
    met = left.join(right, "band").where(f"ca <> cb and {_possible(percent, most)}")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest ``doc_id`` reachable by links) and ``kept`` for every row.

    Needs the columns ``doc_id`` and ``text`` and looks at no others. A null or empty text, or one without words, has no
    shingle, links with nothing and is kept; a text of fewer than k words has its whole sequence as one. Rows are
    decided by their text, so rows without ``doc_id``, and rows that share one, link like any other. ``component_id``
    is null only where no row of the component has an id. ``kept`` is whether ``doc_id`` equals ``component_id``, both
    null included: rows that repeat the smallest id of a component are all kept. An empty table gives an empty frame.
    Runs jobs when called.
    """
    small_batches(docs.sparkSession)
    most = most_differing(percent)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    rows = texts.mapInArrow(trimmed(_first_pass(k)), _ROW).withColumn("place", F.monotonically_increasing_id())
    rows = stored(rows, "dedup_rows")

    # Classes are numbered in the order of their smallest id: the smallest class of a component holds its smallest id.
    first = rows.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("first_id"), F.min("place").alias("place"))
    first = first.orderBy(F.col("first_id").asc_nulls_last(), "cid").withColumn("rid", F.monotonically_increasing_id())
    first = stored(first, "dedup_numbered")
    classes = stored(rows.drop("cid").join(first, "place"), "dedup_classes")
    bands = classes.select("rid", "n", F.explode("bands").alias("band"))
    common = stored(bands.groupBy("band").agg(F.count("*").alias("c")).where("c > 1"), "dedup_bands")
    members = stored(bands.join(common, "band"), "dedup_banded")
    met = members.groupBy("rid").agg(F.sum("c").alias("weight"))
    known = stored(classes.select("rid", "sketch").join(met, "rid"), "dedup_sketches")
    members = stored(members.drop("c").join(known, "rid"), "dedup_members")

    # The sets of all classes with a common band, read again from one text of each.
    wanted = classes.join(known.select("rid"), "rid", "left_semi")
    wanted = stored(wanted.select("rid", "cid", "n", "doc_id", "h"), "dedup_wanted")
    again = texts.alias("t").join(wanted.alias("w"), F.expr("t.h = w.h and t.doc_id <=> w.doc_id"), "left_semi").select("text")
    grams = again.mapInArrow(trimmed(_sets(k)), "cid binary, grams binary").dropDuplicates(["cid"])
    sets = stored(grams.join(wanted.select("rid", "cid", "n"), "cid").select("rid", "n", "grams"), "dedup_sets")

    links, comp = None, None
    for turn in range(TURNS + 1):
        now = members.withColumn("comp", F.col("rid")) if comp is None else members.join(
            comp.withColumnRenamed("id", "rid"), "rid", "left"
        ).withColumn("comp", F.coalesce("comp", "rid"))
        pairs = _leader_pairs(now, turn, percent, most) if turn < TURNS else _open_pairs(now, percent, most)
        pairs = stored(pairs, "dedup_pairs")
        found = stored(confirmed(pairs, sets, percent), "dedup_links")
        links = found if links is None else links.union(found)
        comp = components(links)
    name = classes.select(F.col("rid").alias("comp"), F.col("first_id").alias("component_id"))
    moved = stored(comp.where("id <> comp").join(name, "comp").select(F.col("id").alias("rid"), "component_id"), "dedup_moved")
    of_class = classes.select("rid", "cid", "first_id").join(moved, "rid", "left")
    of_class = stored(of_class.select("cid", F.coalesce("component_id", "first_id").alias("component_id"), F.lit(True).alias("known")), "dedup_components")
    named = rows.select("doc_id", "n", "cid").join(of_class, "cid", "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
