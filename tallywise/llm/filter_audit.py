"""Which filter removes which documents, for every order of the filters, by min-plus removal ranks.

A document matters to the audit only by the set of filters it fails: a mask. One pass over the texts counts rows per part
and mask, so what is left are at most 32 rows a part, whatever the number of documents. For them

* the mask matrix ``M`` holds 0 where a mask fails a filter and infinity elsewhere,
* the position matrix ``P`` is the inverse of every permutation: at which step an order applies a filter,
* and their min-plus product, the minimum over filters of ``M + P``, is the step that removes a mask under an order.

The counts are scattered by that step; a filter that a mask fails at a later step was redundant there.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words
from tallywise.llm.batching import small_batches, trimmed
from tallywise.session import stored

FILTERS = "ABCDE"
#: Fixed values of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 50, 65, 5, b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that continue a character in UTF-8.
CONTINUED = bytes(range(0x80, 0xC0))
#: Step of what no filter removes.
NEVER = len(FILTERS) + 1
#: Texts up to this size are cut into words at once, longer ones in blocks.
AT_ONCE = 1 << 22

ORDERS = list(itertools.permutations(range(len(FILTERS))))
#: Filter applied at each step (columns) of each order (rows), and its inverse: the step of each filter.
APPLIED = np.array(ORDERS)
POSITION = np.argsort(APPLIED, axis=1) + 1
NAMES = ["".join(FILTERS[f] for f in order) for order in ORDERS]

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_mask(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 0 to 3."""
    if len(text) <= AT_ONCE:
        found = text.split()  # of bytes: cuts at exactly the six ASCII white-space characters
        n, distinct = len(found), len(set(found))
    else:
        n, seen = 0, set()
        for lo, hi in words.blocks(text):
            found = text[lo:hi].split()
            n += len(found)
            seen.update(found)
        distinct = len(seen)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return (n < LEAST_WORDS) | (100 * distinct < LEAST_DISTINCT * n) << 1 | (100 * capitals > MOST_CAPITALS * points) << 2 | (symbols > 0) << 3


def _read(batches):
    for batch in batches:
        mask, digest = [], []
        for text in batch.column(2).cast(pa.binary()):
            raw = text.as_py() or b""
            mask.append(text_mask(raw))
            digest.append(hashlib.blake2b(raw, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())],
            ["doc_id", "part", "mask", "digest"],
        )


def masked(docs: DataFrame, part: str = "source") -> DataFrame:
    """``doc_id``, ``part`` and ``mask`` of every row; bit 4 of the mask (E) is set where a smaller ``doc_id`` has the text.

    Texts are compared by 128-bit digests. A null text is empty. A row without ``doc_id`` has no smaller one and never
    fails E; rows that repeat a ``doc_id`` do not fail E because of each other.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    rows = stored(rows.mapInArrow(trimmed(_read), "doc_id long, part string, mask int, digest binary"), "audit_rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = stored(first.where("first < last").select("digest", "first"), "audit_first")
    late = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return rows.join(first, "digest", "left").select("doc_id", "part", (F.col("mask") + 16 * late).alias("mask"))


def removal_steps() -> np.ndarray:
    """The min-plus product: the removing step of every mask (rows) under every order (columns), ``NEVER`` if none."""
    fails = (np.arange(1 << len(FILTERS))[:, None] >> np.arange(len(FILTERS))) & 1
    m = np.where(fails == 1, 0.0, np.inf)
    steps = (m[:, None, :] + POSITION[None]).min(axis=2)
    return np.where(np.isinf(steps), NEVER, steps).astype(np.int64)


def interactions(mask: np.ndarray, weights: np.ndarray, steps: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per order and step from masks and their weights: rows, good rows, toxic rows (columns).

    ``unique_fails`` and ``shapley`` are per filter and are laid out by the filter each order applies at each step.
    """
    orders = np.arange(len(ORDERS))
    at = steps[mask]
    lost = np.zeros((3, len(ORDERS), NEVER + 1), np.int64)
    for kind in range(3):
        np.add.at(lost[kind], (orders[None, :], at), weights[:, kind, None])
    fails = (mask[:, None, None] >> APPLIED[None]) & 1
    later = fails * (at[:, :, None] < np.arange(1, NEVER)[None, None, :])
    removed = lost[0][:, 1:NEVER]
    alone = np.array([weights[mask == 1 << f, 0].sum() for f in range(len(FILTERS))], np.int64)
    shapley = np.take_along_axis(removed, POSITION - 1, axis=1).sum(axis=0)
    return {
        "kept": weights[:, 0].sum() - np.cumsum(removed, axis=1), "removed": removed,
        "redundant": (later * weights[:, 0, None, None]).sum(axis=0), "unique_fails": alone[APPLIED],
        "good_lost": lost[1][:, 1:NEVER], "toxic_lost": lost[2][:, 1:NEVER], "shapley": shapley[APPLIED],
    }


def _of_part(table: pa.Table) -> pa.Table:
    weights = np.stack([table[c].to_numpy() for c in ("n", "good", "toxic")], axis=1)
    counts = interactions(table["mask"].to_numpy().astype(np.int64), weights, removal_steps())
    cells = len(ORDERS) * len(FILTERS)
    return pa.table({
        "part": pa.array([table["part"][0].as_py()] * cells, pa.string()),
        "filter_order": pa.array(np.repeat(NAMES, len(FILTERS)).tolist(), pa.string()),
        "step": pa.array(np.tile(np.arange(1, NEVER), len(ORDERS)).astype(np.int32)),
        **{k: pa.array(v.reshape(-1).astype(np.int64)) for k, v in counts.items()},
    })


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of ``RESULT``.

    ``docs`` needs ``doc_id``, ``text`` and the column named by ``part``; ``labels`` needs ``doc_id``, ``quality`` and
    ``toxic``. Other columns are not looked at. A null part is the empty string. A row is good (toxic) if any label row
    of its ``doc_id`` has quality (toxic) 1; a null ``doc_id`` has no label. Repeated rows each count. An empty table
    gives an empty frame. Runs jobs when called.
    """
    rows = masked(docs, part)
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    marks = stored(marks.where("good = 1 or toxic = 1"), "audit_labels")
    counts = rows.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
    )
    return stored(counts, "audit_masks").groupBy("part").applyInArrow(_of_part, RESULT)
