"""Rows whose keys may be among given ones, found where they lie: a Bloom filter instead of a shuffle of what is beside
the keys.

A row of a given key always passes. Others pass rarely, so whoever needs exactly the given rows compares the few left.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words

#: Bits for each key and how many of them it sets: about 0.25 % of other keys pass. The filter ends at 16 MB, for 8 million
#: keys; beyond that more of the others pass, and no given one is lost.
BITS, SET, LARGEST = 16, 4, 1 << 27
#: Bits that are put together in one group.
SLICE = 1 << 16


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key (a row for each of ``SET``); ``size`` is a power of two."""
    h = words.mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(0x51ED270B))
    step = words.mixed(h) | np.uint64(1)
    turns = np.arange(SET, dtype=np.uint64)[:, None]
    return ((h + turns * step) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def _cut(size: int):
    def run(frames):
        for pdf in frames:
            at = np.unique(_places(pdf["key"].to_numpy(), size))
            first = np.flatnonzero(np.diff(at // SLICE, prepend=-1))
            parts = np.split((at % SLICE).astype(np.uint16), first[1:]) if len(at) else []
            yield pd.DataFrame({"slice": at[first] // SLICE, "places": [x.tobytes() for x in parts]})

    return run


def _slice(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(SLICE, bool)
    for raw in pdf["places"]:
        bits[np.frombuffer(raw, np.uint16)] = True
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def holding(keys: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """Which of some whole numbers may be among the keys (the only column, read twice; nulls do not count), for use in tasks.

    What comes to the driver, and goes with the function to the tasks, is a filter of ``LARGEST`` bits at most. Runs jobs
    when called.
    """
    held = keys.toDF("key").where("key is not null").select(F.col("key").cast("long").alias("key"))
    size = min(LARGEST, max(SLICE, 1 << (BITS * held.count()).bit_length()))
    slices = held.mapInPandas(_cut(size), "slice long, places binary").groupBy("slice").applyInPandas(_slice, "slice long, bits binary")
    table = np.zeros((size // SLICE, SLICE // 8), np.uint8)
    for row in slices.collect():
        table[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    table = table.reshape(-1)

    def holds(values: np.ndarray) -> np.ndarray:
        at = _places(values, size)
        return (table[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)).all(axis=0).astype(bool)

    return holds


def may_be_among(keys: DataFrame) -> Callable[[Column], Column]:
    """Whether a column of whole numbers may be among the keys; null is not. Runs jobs when called."""
    holds = holding(keys)

    def passes(values: pa.Array) -> pa.Array:
        return pa.array(holds(values.fill_null(0).to_numpy(zero_copy_only=False)) & values.is_valid().to_numpy(zero_copy_only=False))

    return F.arrow_udf(passes, "boolean")
