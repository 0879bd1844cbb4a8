"""Near duplicates by the Jaccard similarity of word n-grams, counted by vertical partitions.

All n-grams have one global order, by document frequency and then by hash. Their hash space is cut into fragments. The
overlap of a pair is counted in each fragment separately and the counts are summed per pair; a pair links when
``100 * overlap >= percent * union``. No pair is lost, and no group is expanded into all its pairs:

1. Of each text the n-grams of a few fragments are dealt out by hash, and those that occur in one text only are
   counted per text. A text with so many of them that the rest is below the threshold has no partner and is done.
2. Equal sets become one class, and only the classes left are read again and kept with all their n-grams.
3. A linked pair shares an n-gram among the first ``n - ceil(percent * n / 100) + 1`` of either set in the global
   order. Among the classes with such a common n-gram, each is first counted against one leader, twice; after
   that only pairs of classes that are still in different components are counted, each of them that its sizes and
   the n-grams it has alone leave possible.

Texts are compared as 64-bit hashes of n-grams.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm import words
from tallywise.llm.batching import small_batches, trimmed
from tallywise.llm.components import components
from tallywise.llm.sketch import holding
from tallywise.session import stored

#: Of eight parts of the hash space, those dealt out in the first step. More of them cost more shuffle and leave fewer
#: texts for the second; the result is the same.
FIRST_PARTS = 3
#: Fragments in which overlaps are counted.
FRAGMENTS = 4
#: Fragments whose sizes alone rule out pairs: the sizes of two sets differ by no more than the sets.
SIZED = 128
#: Turns of comparing each class with one leader, before all pairs still open are compared.
TURNS = 2
#: Stands for an n-gram that several texts of a chunk have.
MARK = 0xFFFF


def _first_pass(buckets: int, k: int):
    def run(frames):
        task = TaskContext.get().partitionId()
        seq = 0
        for pdf in frames:
            texts = pdf["text"].tolist()
            for lo, hi in words.batches(texts):
                values, at = words.shingle_sets(texts[lo:hi], k)
                n = np.diff(at)
                owner = np.repeat(np.arange(hi - lo), n)
                chunk = (task << 32) + seq
                seq += 1
                sums = np.zeros((2, hi - lo), np.uint64)
                full = n > 0
                if len(values):
                    for i in range(2):
                        salt = np.uint64(0x1234567 + i)
                        sums[i][full] = np.add.reduceat(words.mixed(values ^ salt), at[:-1][full])
                docs = pd.DataFrame({
                    "kind": "text", "chunk": chunk, "idx": np.arange(hi - lo), "doc_id": pdf["doc_id"].tolist()[lo:hi],
                    "h": pdf["h"].to_numpy()[lo:hi], "n": n, "cid": [sums[:, i].tobytes() for i in range(hi - lo)],
                })
                docs["h"] = docs["h"].astype("Int64")
                dealt = (values >> np.uint64(61)) < FIRST_PARTS
                tok, own = values[dealt], owner[dealt]
                bucket = ((tok >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                low = (tok & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                order = np.lexsort((low, bucket))
                low, own, bucket = low[order], own[order].astype(np.uint16), bucket[order]
                if len(low):
                    begins = np.concatenate(([True], (low[1:] != low[:-1]) | (bucket[1:] != bucket[:-1])))
                    single = begins & np.concatenate((begins[1:], [True]))
                    own = np.where(single, own, np.uint16(MARK))[begins]
                    low, bucket = low[begins], bucket[begins]
                cut = np.searchsorted(bucket, np.arange(buckets + 1))
                some = [b for b in range(buckets) if cut[b] < cut[b + 1]]
                posts = pd.DataFrame({
                    "kind": "post", "chunk": chunk, "bucket": some,
                    "low": [low[cut[b] : cut[b + 1]].tobytes() for b in some],
                    "own": [own[cut[b] : cut[b + 1]].tobytes() for b in some],
                })
                yield pd.concat([docs, posts], ignore_index=True)[_FIRST.names]

    return run


_FIRST = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("chunk", T.LongType()), T.StructField("idx", T.LongType()),
    T.StructField("doc_id", T.StringType()), T.StructField("h", T.LongType()), T.StructField("n", T.LongType()), T.StructField("cid", T.BinaryType()),
    T.StructField("bucket", T.IntegerType()), T.StructField("low", T.BinaryType()), T.StructField("own", T.BinaryType()),
])


def _single_in_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per chunk, how many n-grams of each of its texts no other text has, in one bucket."""
    low = [np.frombuffer(x, np.uint32) for x in pdf["low"]]
    own = np.concatenate([np.frombuffer(x, np.uint16) for x in pdf["own"]])
    row = np.repeat(np.arange(len(low)), [len(x) for x in low])
    low = np.concatenate(low)
    order = np.argsort(low, kind="stable")
    s = low[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    single = np.zeros(len(s), bool)
    single[order] = new & np.concatenate((new[1:], [True]))
    single &= own != MARK
    row, own = row[single], own[single]
    cut = np.searchsorted(row, np.arange(len(pdf) + 1))
    counts = [np.bincount(own[cut[i] : cut[i + 1]]).astype(np.uint32).tobytes() for i in range(len(pdf))]
    return pd.DataFrame({"chunk": pdf["chunk"], "counts": counts})


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(0, np.int64)
    for raw in pdf["counts"]:
        x = np.frombuffer(raw, np.uint32)
        if len(x) > len(total):
            total = np.concatenate((total, np.zeros(len(x) - len(total), np.int64)))
        total[: len(x)] += x
    at = np.flatnonzero(total)
    return pd.DataFrame({"chunk": pdf["chunk"].iloc[0], "idx": at, "single": total[at]})


def _sets(k: int, holds):
    def run(frames):
        for pdf in frames:
            texts = pdf["text"][holds(pdf["key"].to_numpy())].tolist()
            for lo, hi in words.batches(texts):
                values, at = words.shingle_sets(texts[lo:hi], k)
                grams = [values[at[i] : at[i + 1]].view(np.int64) for i in range(hi - lo)]
                cid = []
                for i in range(hi - lo):
                    v = values[at[i] : at[i + 1]]
                    cid.append(b"".join(words.mixed(v ^ np.uint64(0x1234567 + j)).sum(dtype=np.uint64).tobytes() for j in range(2)))
                sizes = [np.bincount(g.view(np.uint64) >> np.uint64(57), minlength=SIZED).astype(np.int32) for g in grams]
                yield pd.DataFrame({"cid": cid, "n": np.diff(at), "grams": grams, "sizes": sizes})

    return run


def _fragments(frames):
    for pdf in frames:
        rid, n, frag, grams = [], [], [], []
        for r, m, g in zip(pdf["rid"], pdf["n"], pdf["grams"]):
            v = np.sort(np.asarray(g, np.int64).view(np.uint64))
            cut = np.searchsorted(v >> np.uint64(62), np.arange(FRAGMENTS + 1))
            for f in range(FRAGMENTS):
                if cut[f] < cut[f + 1]:
                    rid.append(r), n.append(m), frag.append(f), grams.append(v[cut[f] : cut[f + 1]].tobytes())
        yield pd.DataFrame({"rid": rid, "n": n, "frag": frag, "grams": grams})


def _overlaps(frames):
    for pdf in frames:
        both = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(pdf["ga"], pdf["gb"])
        ]
        yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "na": pdf["na"], "nb": pdf["nb"], "part": both})


def linked(pairs: DataFrame, fragments: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose partial overlaps, summed over the fragments, reach the threshold."""
    left = fragments.select(F.col("rid").alias("a"), F.col("n").alias("na"), "frag", F.col("grams").alias("ga"))
    right = fragments.select(F.col("rid").alias("b"), F.col("n").alias("nb"), "frag", F.col("grams").alias("gb"))
    side_by_side = pairs.join(left, "a").join(right, ["b", "frag"]).select("a", "b", "na", "nb", "ga", "gb")
    parts = side_by_side.mapInPandas(trimmed(_overlaps), "a long, b long, na long, nb long, part long")
    total = parts.groupBy("a", "b").agg(F.sum("part").alias("o"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    return total.where(f"100 * o >= {percent} * (na + nb - o)").select("a", "b")


def _near(percent: int) -> str:
    """Whether two classes can link by their sizes and by how many of their n-grams any other class has."""
    return (
        f"100 * least(na, nb) >= {percent} * greatest(na, nb) and "
        f"{100 + percent} * least(sa, sb) >= {percent} * (na + nb)"
    )


def _leader_pairs(prefixes: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each class and the leader with which it shares most n-grams, of those in another component.

    A leader of the first turn has fewest n-grams of its own, as has the text that others are copies of.
    """
    order = F.struct(F.col("n") - F.col("s") if turn == 0 else F.lit(0), F.xxhash64("rid", F.lit(turn)))
    lead = prefixes.groupBy("gram").agg(
        F.min(F.struct(order.alias("o"), "rid", "n", "s", "comp")).alias("l"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
    ).where("lo <> hi").select("gram", F.col("l.rid").alias("a"), F.col("l.n").alias("na"), F.col("l.s").alias("sa"), F.col("l.comp").alias("ca"))
    met = prefixes.join(lead, "gram").where("ca <> comp").withColumnsRenamed({"n": "nb", "s": "sb"}).where(_near(percent))
    shared = met.groupBy(F.col("rid").alias("b"), "a").agg(F.count("*").alias("shared"))
    best = shared.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _open_pairs(prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs with a common n-gram in different components that the sizes of their fragments leave possible."""
    held = prefixes.groupBy("gram", "comp").agg(F.count("*").alias("c"))
    held = held.groupBy("gram").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("comps"))
    open_lists = prefixes.join(held.where("comps > 1").select("gram", "main"), "gram")
    open_lists = open_lists.join(sets.select("rid", "sizes"), "rid")
    left = open_lists.where("comp <> main").select("gram", F.col("sizes").alias("ha"), F.col("rid").alias("x"), F.col("n").alias("na"), F.col("s").alias("sa"), F.col("comp").alias("cx"))
    right = open_lists.select("gram", F.col("sizes").alias("hb"), F.col("rid").alias("y"), F.col("n").alias("nb"), F.col("s").alias("sb"), F.col("comp").alias("cy"))
    apart = f"aggregate(zip_with(ha, hb, (p, q) -> abs(p - q)), 0, (t, x) -> t + x) * {100 + percent} <= {100 - percent} * (na + nb)"
    met = left.join(right, "gram").where(f"cx <> cy and {_near(percent)} and {apart}")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest ``doc_id`` reachable by links) for every row.

    Needs the columns ``doc_id`` and ``text`` and looks at no others. A null or empty text, or one without words, has
    no n-gram and links with nothing; a text of fewer than k words has its whole sequence as one. Repeated rows each
    get a row. Rows are decided by their text, so those without ``doc_id``, and those that share one, link like any other;
    ``component_id`` is null only where no row of the component has an id.
    An empty table gives an empty frame. Runs jobs when called.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ids travel as text: beside a null pandas would make them floating-point numbers.
    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    first = stored(texts.mapInPandas(trimmed(_first_pass(buckets, k)), _FIRST), "ngrams")
    counts = first.where("kind = 'post'").select("bucket", "chunk", "low", "own").groupBy("bucket")
    counts = counts.applyInPandas(_single_in_bucket, "chunk long, counts binary")
    single = counts.groupBy("chunk").applyInPandas(_summed, "chunk long, idx long, single long")
    rows = first.where("kind = 'text'").select("chunk", "idx", F.col("doc_id").cast("long").alias("doc_id"), "h", "n", "cid")
    rows = rows.join(single, ["chunk", "idx"], "left").withColumn("single", F.coalesce("single", F.lit(0)))
    room = F.expr(f"n > 0 and single < n - ceil(n * {percent} / 100.0D) + 1")
    rows = rows.select("doc_id", "h", "n", "cid", room.alias("open"), F.monotonically_increasing_id().alias("place"))
    rows = stored(rows, "ngram_rows")

    # Classes are numbered in the order of their smallest id: the smallest class of a component holds its smallest id.
    classes = rows.where("open").groupBy("cid").agg(F.min("doc_id").alias("first_id"), F.min("place").alias("place"))
    classes = classes.orderBy(F.col("first_id").asc_nulls_last(), "cid").withColumn("rid", F.monotonically_increasing_id())
    classes = stored(classes, "ngram_classes")
    # Texts are read again by id, those without one by a hash of the text. They stay where they lie: a sketch of what is
    # looked for tells them apart, and of the few others that it lets pass the join with the classes is rid.
    def sought(doc_id, h):
        return F.xxhash64(doc_id.cast("string"), F.when(doc_id.isNull(), h))

    wanted = rows.select("place", "h").join(classes.select("place", "first_id"), "place")
    wanted = stored(wanted.select(sought(F.col("first_id"), F.col("h")).alias("key")), "ngram_wanted")
    # Tested where the sets are made: a function of its own would keep a second Python worker for each core.
    again = texts.select(sought(F.col("doc_id"), F.col("h")).alias("key"), "text")
    sets = again.mapInPandas(trimmed(_sets(k, holding(wanted))), "cid binary, n long, grams array<long>, sizes array<int>")
    sets = sets.join(classes.select("cid", "rid"), "cid").dropDuplicates(["cid"])
    sets = stored(sets.select("rid", "n", "grams", "sizes"), "ngram_sets")
    # Made again in each turn: written, they would be a second copy of the sets.
    fragments = sets.select("rid", "n", "grams").mapInPandas(trimmed(_fragments), "rid long, n long, frag int, grams binary")

    grams = sets.select("rid", "n", F.explode("grams").alias("gram"))
    common = stored(grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1"), "ngram_frequencies")
    shared = grams.join(common, "gram").groupBy("rid", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("g"))
    keep = F.expr(f"cast(n - ceil(n * {percent} / 100.0D) + 1 - (n - size(g)) as int)")
    prefixes = shared.withColumn("keep", keep).where("keep > 0")
    prefixes = stored(prefixes.select("rid", "n", F.size("g").alias("s"), F.explode(F.slice("g", F.lit(1), F.col("keep"))).alias("e")).select("rid", "n", "s", "e.gram"), "ngram_prefixes")

    links, comp = None, None
    for turn in range(TURNS + 1):
        now = prefixes.withColumn("comp", F.col("rid")) if comp is None else prefixes.join(
            comp.withColumnRenamed("id", "rid"), "rid", "left"
        ).withColumn("comp", F.coalesce("comp", "rid"))
        pairs = stored(_leader_pairs(now, turn, percent) if turn < TURNS else _open_pairs(now, sets, percent), "ngram_pairs")
        found = stored(linked(pairs, fragments, percent), "ngram_links")
        links = found if links is None else links.union(found)
        comp = components(links)
    name = classes.select(F.col("rid").alias("comp"), F.col("first_id").alias("component_id"))
    moved = stored(comp.where("id <> comp").join(name, "comp").select(F.col("id").alias("rid"), "component_id"), "ngram_moved")
    of_class = classes.join(moved, "rid", "left").select("cid", F.coalesce("component_id", "first_id").alias("component_id"), F.lit(True).alias("known"))
    of_class = stored(of_class, "ngram_components")
    named = rows.where("open").join(of_class, "cid", "left")
    alone = rows.where("not open")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")).union(
        alone.select("doc_id", "n", "doc_id")
    )
