"""Packing texts into sequences by minimum bin slack.

A text's ids are cut into pieces of ``capacity``, one that is a multiple of ``grain``, and one shorter than ``grain``: then
lengths meet exactly even in a small corpus. Which pieces share a sequence depends on their lengths only,
so the plan is made from the counts per length: at most ``capacity`` numbers, whatever the size of the corpus. For each
window the longest length left is taken, and a bitset subset-sum over the lengths left finds the multiset that fills
the rest closest to capacity; walking the bitsets back gives how many pieces of each length it uses. The same window
is repeated as often as the counts allow, after which one length has fewer left than the window uses. So the plan has
a number of windows bounded by the lengths and the logarithm of their counts.

Pieces are numbered within their length by partition, and look up their window by that number.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywise.llm import words
from tallywise.llm.batching import small_batches, trimmed
from tallywise.llm.tokens import Encoder, byte_runs, gathered
from tallywise.session import stored


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to ``capacity`` from below."""
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        most = min(counts[length], capacity // length)
        if not most:
            continue
        steps.append((length, most, reach))
        left, some = most, 1
        while left:
            some = min(some, left)
            reach |= (reach << (some * length)) & mask
            left -= some
            some *= 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        n = next(n for n in range(most + 1) if total >= n * length and before >> (total - n * length) & 1)
        if n:
            used[length] = n
            total -= n * length
    return used


def windows(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Windows as (pieces of each length, repetitions) that use up the counts."""
    counts = {length: n for length, n in counts.items() if n}
    plan = []
    while counts:
        longest = max(counts)
        used = fullest({x: n - (x == longest) for x, n in counts.items()}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[x] // n for x, n in used.items())
        for x, n in used.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        plan.append((used, times))
    return plan


def layout(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows of (length, first number, pieces per window, first sequence, offset of the first), by length and number."""
    rows, numbered, sequence = [], {}, 0
    for used, times in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            first = numbered.get(length, 0)
            rows.append((length, first, used[length], sequence, offset))
            numbered[length] = first + used[length] * times
            offset += length * used[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def cuts(n: int, capacity: int, grain: int) -> list[int]:
    """Where the pieces of n ids begin, and n."""
    whole, rest = n - n % capacity, n % capacity
    return sorted({*range(0, whole, capacity), whole, whole + rest - rest % grain, n})


def _pieces(vocabulary: str, end_id: int, capacity: int, grain: int, keep_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "number", *["ids"] * keep_ids]

    def run(batches):
        encoder = Encoder(vocabulary)
        part, numbered = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in gathered(batches, 2 * words.BLOCK):
            for lo, hi in byte_runs(batch.column(1), 8 * words.BLOCK):
                ids, at = encoder.encode(batch.column(1).slice(lo, hi - lo))
                rows, held = [], []
                for i in range(hi - lo):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
                    at_own = cuts(len(own), capacity, grain)
                    for start, end in zip(at_own, at_own[1:]):
                        piece, n = own[start:end], end - start
                        rows.append((lo + i, start, n, zlib.crc32(piece.tobytes()), len(own), part, int(numbered[n])))
                        numbered[n] += 1
                        if keep_ids:
                            held.append(piece.astype(np.int64))
                table = np.array(rows, np.int64).reshape(-1, 7)
                columns = [batch.column(0).take(pa.array(table[:, 0])), *[pa.array(table[:, j]) for j in range(1, 7)]]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(held, pa.list_(pa.int64()))] * keep_ids, names)

    return run


def _placed(table: np.ndarray):
    def run(batches):
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            number = batch.column("number").to_numpy() + batch.column("before").to_numpy()
            length = batch.column("length").to_numpy()
            row = table[np.searchsorted(keys, (length << 44) + number, "right") - 1]
            turn = number - row[:, 1]
            kept = [c for c in batch.schema.names if c not in ("part", "number", "before")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(row[:, 3] + turn // row[:, 2]), pa.array(row[:, 4] + turn % row[:, 2] * length)],
                [*kept, "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 1024, grain: int = 16, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``text`` is encoded with the vocabulary file and followed by ``end_id``; ``keep_ids`` adds the piece's ``ids``. A
    null or empty text is the end id alone, an empty table gives no rows, and each repeated row is packed. Other
    columns are ignored. At most 2**44 pieces may have one length. Runs jobs when called.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, number long"
    ids = ", ids array<long>" if keep_ids else ""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(rows.mapInArrow(trimmed(_pieces(vocabulary, end_id, capacity, grain, keep_ids)), schema + ids), "pieces")
    held = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length
    table = layout(windows(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ids + ", sequence_id long, offset long"
    return pieces.join(before, ["part", "length"]).select(*pieces.columns, "before").mapInArrow(trimmed(_placed(table)), out)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids``, from pieces packed with ``keep_ids``; a sequence holds at most its capacity."""
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return grouped.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
