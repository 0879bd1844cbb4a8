"""Reproducible pseudo-random numbers from hashes.

``rand()`` changes when a task is run again on other partitions; a hash of the
row's own id does not, so a lost executor cannot change generated data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(row_id: Column, name: str, seed: int = 0) -> Column:
    """A double in [0, 1) from the first 32 bits of an MD5."""
    text = F.concat_ws(":", row_id.cast("string"), F.lit(str(seed)), F.lit(name))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def pick(uniform: Column, values: list) -> Column:
    """One of ``values`` by a number in [0, 1)."""
    place = F.floor(uniform * len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), place)


def spread_key(columns: list[Column]) -> Column:
    """MD5 of the columns' text; used to split a large group into even buckets."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns]))
