"""Quality of texts by a byte convolutional network over overlapping chunks of the whole text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm import byte_cnn
from tallywise.llm.batching import beside, small_batches
from tallywise.llm.language_id import drawn_windows, mean_log
from tallywise.llm.samples import labelled, remainder
from tallywise.session import stored

#: Labelled texts of each class from which chunks are drawn, and chunks of each.
PER_CLASS, CHUNKS = 1000, 4
HELD_OUT, HELD_OUT_REST = 4, 2
THRESHOLD = 0.7


def sampled_texts(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """``doc_id``, ``text``, ``quality``, ``_h`` of a bounded sample of labelled rows that are not held out."""
    usable = labels.where("quality in (0, 1)").where(remainder("doc_id", HELD_OUT) != HELD_OUT_REST)
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = stored(labelled(usable, "quality", per_class), "quality-sample")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> byte_cnn.Network | None:
    """Learn from a bounded sample of chunks; the classes weigh alike. None without both."""
    small_batches(docs.sparkSession)
    found = drawn_windows(sampled_texts(docs, labels, per_class), "quality", CHUNKS)
    if found["y"].nunique() < 2:
        return None
    x = np.frombuffer(b"".join(found["bytes"]), np.uint8).reshape(len(found), -1)
    return byte_cnn.trained(x, found["y"].to_numpy().astype(int), 2, widths=(3, 8), steps=800)


def score_quality(docs: DataFrame, net: byte_cnn.Network | None) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1, higher is better) and ``predicted``, from ``text`` alone.

    A chunk's filters are max-pooled into its log-odds; the mean over all chunks of the text gives the
    probability. A null or empty text is one chunk of spaces. Without a network every score is 0.5. Existing columns of these
    names are replaced; repeated rows stay; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop("score", "predicted")

    def run(texts: list) -> list[pa.Array]:
        if net is None:
            score = np.full(len(texts), 0.5)
        else:
            log = mean_log(net, texts).astype(np.float64).reshape(len(texts), 2)
            score = 1 / (1 + np.exp(log[:, 0] - log[:, 1]))
        return [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return kept.mapInArrow(beside(run, "text", kept.columns, ["score", "predicted"]), T.StructType([*kept.schema.fields, *added]))

