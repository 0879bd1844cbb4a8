"""Bounded samples of labelled rows, drawn by hashes and so the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 30


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def labelled(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label, and at most twice that in all.

    Adds ``_h``, the hash that chose them. Runs a job that counts the labels.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).collect()
    if not counts:
        return rows.limit(0).withColumn("_h", F.lit(0).cast("long"))
    pick = F.xxhash64("doc_id", F.lit("sample")).bitwiseAND((1 << BITS) - 1)
    rate = F.create_map(*[F.lit(x) for r in counts for x in (r[0], min(1 << BITS, (per_class << BITS) // r["count"]))])
    chosen = rows.withColumn("_h", pick).where(F.col("_h") < rate[F.col(label)])
    return chosen.orderBy("_h", "doc_id").limit(2 * per_class * len(counts))
