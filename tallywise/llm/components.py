"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.session import stored


def components(links: DataFrame) -> DataFrame:
    """``id``, ``comp`` (the smallest id reachable) for every end of the links ``a``, ``b``.

    Each turn hooks every component to its smallest neighbour, shortens the pointers twice, and contracts the links.
    Only links between different components are left, so the turns end after about the logarithm of the longest path.
    All frames are written to the shared folder; only their row counts come to the driver.
    """
    ends = links.select(F.col("a").alias("ca"), F.col("b").alias("cb")).where("ca <> cb")
    edges = stored(ends.union(ends.select("cb", "ca")).distinct(), "links")
    label = None
    while edges.count():
        hook = edges.groupBy(F.col("ca").alias("c")).agg(F.min("cb").alias("m"))
        hook = stored(hook.select("c", F.least("c", "m").alias("p")), "hooks")
        twice = hook.alias("h").join(hook.alias("g"), F.col("h.p") == F.col("g.c"), "left")
        hook = stored(twice.select("h.c", F.coalesce("g.p", "h.p").alias("p")), "hooks")
        twice = hook.alias("h").join(hook.alias("g"), F.col("h.p") == F.col("g.c"), "left")
        hook = stored(twice.select("h.c", F.coalesce("g.p", "h.p").alias("p")), "hooks")
        if label is None:
            label = hook.select(F.col("c").alias("id"), F.col("p").alias("comp"))
        else:
            moved = label.alias("l").join(hook.alias("h"), F.col("l.comp") == F.col("h.c"), "left")
            label = stored(moved.select("l.id", F.coalesce("h.p", "l.comp").alias("comp")), "labels")
        one = edges.join(hook.select(F.col("c").alias("ca"), F.col("p").alias("pa")), "ca")
        both = one.join(hook.select(F.col("c").alias("cb"), F.col("p").alias("pb")), "cb")
        edges = stored(both.where("pa <> pb").select(F.col("pa").alias("ca"), F.col("pb").alias("cb")).distinct(), "links")
    if label is None:
        return edges.select(F.col("ca").alias("id"), F.col("cb").alias("comp"))
    return label
