"""Hard negatives of anchors by a secondary-sort shuffle of scored pairs.

Scores are integer inner products of scaled vectors. Anchors fall into groups that a task can hold, rows into ranges;
each group meets each range in a tile. A tile is a run of a sorted partition: its anchors come first and stay, its rows
stream past in the order of their ids, a block at a time. So no frame of pairs of blocks is ever made, joined or
broadcast, and what a task holds does not grow with the table. What leaves a tile is what can be in the result: of each
anchor the best positives, and, once the positives of the whole table are known, the best negatives inside each
positive's window.

These pairs are packed into byte keys (anchor, descending score, positive before negative, id), partitioned by the
anchor and sorted within partitions by the shuffle. One iterator runs over a partition's keys: a positive opens its
window, a negative goes to every open window that its score reaches, and a window closes when it is full or the scores
have fallen below it. Nothing of an anchor is held but its open windows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywise.llm.batching import small_batches, trimmed
from tallywise.session import stored

#: Rows and anchors of a block; a pair of blocks is one matrix of scores in a task.
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 1024
#: Anchors of a group, and components of all their vectors: what a task holds.
GROUP_ANCHORS, GROUP_VALUES = 1 << 16, 1 << 22
#: Tiles to share the work, as far as there are blocks for them; rows of a tile at most.
TILES, TILE_ROWS = 48, 1 << 19
#: Rows of a block that are compared at once: at first, when nothing is known of an anchor's best, and at most.
FIRST_ROWS, STEP_ROWS = 256, 512
#: Scores of an anchor in a block that are sorted with others; of more, the best are taken first.
FEW = 32
#: Largest integers that doubles and singles hold exactly with all smaller ones.
EXACT, EXACT_SINGLE = 1 << 53, 1 << 24
BIAS = 1 << 63
LOWEST, HIGHEST = -BIAS, BIAS - 1
#: Layout of a key: unsigned and big-endian, so that bytes sort as the numbers do.
KEY = ">QQBQ"


def _matrix(lists: pa.Array) -> tuple[np.ndarray, int]:
    """Vectors as rows of a matrix, padded with zeros; the largest size of a component."""
    flat, size = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(size.max(initial=0))), flat.dtype)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
    return out, max(int(flat.max(initial=0)), -int(flat.min(initial=0)))


def scores(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Integer inner products of all rows of a with all rows of b, in the fastest type that is exact.

    ``most`` bounds the product of two components.
    """
    k = min(a.shape[1], b.shape[1])
    if most * max(k, 1) >= BIAS:
        raise ValueError("scores do not fit into 64 bits")
    kind = np.float32 if most * max(k, 1) < EXACT_SINGLE else np.float64 if most * max(k, 1) < EXACT else np.int64
    return a[:, :k].astype(kind) @ b[:, :k].T.astype(kind)


def _comparable(bounds: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Bounds in the type of the scores; no score reaches the number at which they are cut."""
    if kind == np.int64:
        return bounds
    end = EXACT_SINGLE if kind == np.float32 else EXACT
    return np.clip(bounds, -end, end).astype(kind)


def best(s: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k highest allowed scores of each row, ties by column."""
    out = []
    for row in np.flatnonzero(allowed.any(axis=1)):
        at = np.flatnonzero(allowed[row])
        if len(at) > k:
            v = s[row, at]
            bound = np.partition(v, len(v) - k)[len(v) - k]
            above = at[v > bound]
            at = np.concatenate((above, at[v == bound][: k - len(above)]))
        out.append(np.stack((np.full(len(at), row), at)))
    both = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def _true(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of what is true in a matrix that is mostly false: eight at a time are passed over."""
    flat = np.ascontiguousarray(mask).ravel()
    whole = len(flat) // 8 * 8
    some = np.flatnonzero(flat[:whole].view(np.uint64) != 0)[:, None] * 8 + np.arange(8)
    at = np.concatenate((some.ravel(), np.arange(whole, len(flat))))
    return np.divmod(at[flat[at]], mask.shape[1])


class _Anchors:
    """A block of anchors and the ``k`` best rows seen so far inside each of their windows of scores.

    Rows must come in the order of their places, among those of one label at least: once a window is full, a score has
    to be higher than its last one to enter it.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: pa.Array, least: np.ndarray, most: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.k, self.same = ids, labels, k, same
        self.vectors, self.largest = _matrix(q)
        self.least, self.most = least, most  # by anchor and window
        self.width, self.seen = least.shape[1], 0
        self.held = np.zeros(least.size, np.int64)
        self.best = np.zeros((3, least.size, k), np.int64)  # scores, places and ids

    def compare(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, largest: int, place: np.ndarray) -> None:
        """Take what belongs to the best from a block of rows, which are sorted by label and place."""
        if self.same:
            part = slice(np.searchsorted(labels, self.labels.min()), np.searchsorted(labels, self.labels.max(), "right"))
        elif (self.labels == self.labels[0]).all():
            part = np.flatnonzero(labels != self.labels[0])
        else:
            part = slice(None)
        ids, labels, vectors, place = ids[part], labels[part], vectors[part], place[part]
        i = 0
        while i < len(ids):
            j = min(len(ids), i + min(max(FIRST_ROWS, self.seen), STEP_ROWS))
            self._step(ids[i:j], labels[i:j], vectors[i:j], largest, place[i:j])
            self.seen, i = self.seen + j - i, j

    def _step(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, largest: int, place: np.ndarray) -> None:
        def paired(row, col):
            equal = self.labels[row] == labels[col]
            return equal & (self.ids[row] != ids[col]) if self.same else ~equal

        s = scores(self.vectors, vectors, self.largest * largest)
        least, most = _comparable(self.least, s.dtype), _comparable(self.most, s.dtype)
        low, high = least.min(axis=1), most.max(axis=1)
        hit = np.flatnonzero(s.max(axis=1) >= low)  # few, once the windows are full
        if not len(hit):
            return
        s = s[hit]
        inside = (s >= low[hit, None]) & (s <= high[hit, None])
        at, col = _true(inside)
        count = np.bincount(at, minlength=len(hit))
        many, few = np.flatnonzero(count > FEW), count[at] <= FEW
        at, col = at[few], col[few]
        row, found = hit[at], []
        right = paired(row, col)
        row, col, v = row[right], col[right], s[at[right], col[right]]
        dense = s[many]
        allowed = inside[many] & paired(hit[many][:, None], np.arange(len(ids))[None, :])
        for w in range(self.width):
            ok = (v >= least[row, w]) & (v <= most[row, w])
            found.append((row[ok] * self.width + w, v[ok], col[ok]))
            if len(many):
                within = allowed & (dense >= least[hit[many], w, None]) & (dense <= most[hit[many], w, None])
                at, where = best(dense, within, self.k)
                found.append((hit[many[at]] * self.width + w, dense[at, where], where))
        window, v, col = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(window):
            self._merge(window, np.stack((v.astype(np.int64), place[col], ids[col])))

    def _merge(self, window: np.ndarray, new: np.ndarray) -> None:
        changed = np.unique(window)
        there = np.arange(self.k)[None, :] < self.held[changed, None]
        window = np.concatenate((np.repeat(changed, self.held[changed]), window))
        new = np.concatenate((self.best[:, changed][:, there], new), axis=1)
        order = np.lexsort((new[1], -new[0], window))
        window = window[order]
        first = np.flatnonzero(np.diff(window, prepend=-1))
        rank = np.arange(len(window)) - np.repeat(first, np.diff(first, append=len(window)))
        kept = rank < self.k
        window, rank = window[kept], rank[kept]
        self.best[:, window, rank] = new[:, order[kept]]
        self.held[window] = rank + 1  # the last one of a window stays
        full = changed[self.held[changed] == self.k]
        self.least.flat[full] = np.maximum(self.least.flat[full], self.best[0, full, -1] + 1)

    def pairs(self) -> pa.RecordBatch:
        """The best of all windows; a row that is in several windows of an anchor is given once."""
        window, rank = np.nonzero(np.arange(self.k)[None, :] < self.held[:, None])
        score, place, ids = self.best[:, window, rank]
        _, once = np.unique(np.stack((window // self.width, place)), axis=1, return_index=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[window[once] // self.width], pa.int64()), pa.array(score[once], pa.int64()), pa.array(ids[once], pa.int64())],
            ["anchor_id", "score", "vec_id"],
        )


def _runs(batches):
    """Parts of batches that are of one tile and one kind: tile, whether rows (or else anchors), part."""
    for batch in batches:
        if not batch.num_rows:
            continue
        tile, is_row = batch.column("tile").to_numpy(), batch.column("is_row").to_numpy()
        cut = np.flatnonzero((np.diff(tile) != 0) | (np.diff(is_row) != 0)) + 1
        for i, j in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            yield int(tile[i]), bool(is_row[i]), batch.slice(i, j - i)


def _numbers(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(table.column(c).to_numpy() for c in ("vec_id", "label"))


def _table(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _search(k: int, windows_of, same: bool):
    """For ``mapInArrow``: of each tile's anchors, the ``k`` best rows of the same or of another label in each window.

    ``windows_of`` takes some anchors and gives the least and the highest score of each one's windows.
    """
    def blocks(parts: list[pa.RecordBatch]) -> list[_Anchors]:
        anchors = _table(parts)
        anchors = anchors.take(pa.array(np.argsort(anchors.column("label").to_numpy(), kind="stable")))
        some = [anchors.slice(i, BLOCK_ANCHORS) for i in range(0, anchors.num_rows, BLOCK_ANCHORS)]
        return [_Anchors(*_numbers(x), x.column("q"), *windows_of(x), k, same) for x in some]

    def compare(held: list[_Anchors], parts: list[pa.RecordBatch], seen: int) -> int:
        if not (held and parts):
            return seen
        rows = _table(parts)
        ids, labels = _numbers(rows)
        vectors, largest = _matrix(rows.column("q"))
        order = np.argsort(labels, kind="stable") if same else np.arange(len(ids))
        for x in held:
            x.compare(ids[order], labels[order], vectors[order], largest, seen + order)
        return seen + len(ids)

    def run(batches):
        now, held, parts, seen = None, [], [], 0
        for tile, is_row, part in _runs(batches):
            if tile != now:
                compare(held, parts, seen)
                yield from (x.pairs() for x in held)
                now, held, parts, seen, anchors = tile, [], [], 0, []
            if not is_row:
                anchors.append(part)
                continue
            if anchors:
                held, anchors = blocks(anchors), []
            parts.append(part)
            if sum(x.num_rows for x in parts) >= BLOCK_ROWS or sum(len(x.column("q").flatten()) for x in parts) >= GROUP_VALUES:
                seen, parts = compare(held, parts, seen), []
        compare(held, parts, seen)
        yield from (x.pairs() for x in held)

    return run


def _any_score(anchors: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.full((anchors.num_rows, 1), LOWEST), np.full((anchors.num_rows, 1), HIGHEST)


def _around_tops(low: int, high: int):
    """A window for each of an anchor's positive scores, from ``low`` to ``high`` percent of it."""
    def windows_of(anchors: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        tops = anchors.column("tops").to_pylist()
        shape = (len(tops), max(map(len, tops)))
        least, most = np.full(shape, HIGHEST), np.full(shape, LOWEST)
        for i, some in enumerate(tops):  # as Python's integers, which do not overflow
            for j, top in enumerate(some):
                least[i, j] = max(LOWEST, min(HIGHEST, -(-low * top // 100)))
                most[i, j] = max(LOWEST, min(HIGHEST, high * top // 100))
        return least, most

    return windows_of


def packed(anchor: int, score: int, negative: int, vec_id: int) -> bytes:
    """A key whose byte order is that of (anchor, descending score, positive before negative, id)."""
    return struct.pack(KEY, anchor + BIAS, BIAS - 1 - score, negative, vec_id + BIAS)


def by_anchor(key: bytes) -> int:
    return zlib.crc32(key[:8])


def windows(keys, k: int, low: int, high: int):
    """(anchor, positive, rank, negative, both scores) from sorted keys, holding only the open windows of one anchor."""
    anchor, open_ = None, []
    for key, _ in keys:
        a, s, negative, vec_id = struct.unpack(KEY, key)
        score, vec_id = BIAS - 1 - s, vec_id - BIAS
        if a != anchor:
            anchor, open_ = a, []
        if not negative:
            open_.append([vec_id, score, 0])
            continue
        left = []
        for window in open_:
            positive, top, given = window
            if 100 * score < low * top:
                continue  # later scores are lower still
            if 100 * score <= high * top:
                window[2] = given = given + 1
                yield a - BIAS, positive, given, vec_id, top, score
            if given < k:
                left.append(window)
        open_ = left


def _tiled(rows: DataFrame, anchors: DataFrame, n_groups: int, n_ranges: int) -> DataFrame:
    """Each group of anchors beside each range of rows: partitions sorted by tile, anchors first, rows by their ids.

    Anchors are copied once a range and rows once a group, on their way into the one shuffle; there is no join.
    """
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumn("range", F.pmod(F.xxhash64("place"), F.lit(n_ranges)).cast("int")).withColumn("group", everywhere(n_groups))
    anchors = anchors.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(n_groups)).cast("int")).withColumn("range", everywhere(n_ranges))
    tile = (F.col("group").cast("long") * n_ranges + F.col("range")).alias("tile")
    member = [tile, "is_row", "vec_id", "label", "q", "tops"]
    both = anchors.withColumn("is_row", F.lit(0)).select(*member).union(
        rows.withColumn("is_row", F.lit(1)).withColumn("tops", F.lit(None).cast("array<long>")).select(*member)
    )
    # More partitions than tiles, so that few hold two.
    return both.repartition(4 * n_groups * n_ranges, "tile").sortWithinPartitions("tile", "is_row", "vec_id")


def mine_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Needs ``vec_id``, ``label`` and ``embedding`` and looks at no other column. Anchors are the rows whose ``vec_id`` is
    divisible by ``every``. An anchor's positives are its best rows of the same label under another ``vec_id``; the
    negatives of a positive are the best rows of another label whose score lies between ``low`` and ``high`` percent of
    the positive's. Higher scores come first, ties by smaller ``vec_id``.

    Rows with a null ``vec_id``, ``label`` or vector, or a null or non-finite component, take no part. Vectors of
    different lengths are compared as if the shorter one went on with zeros, so an empty one scores 0. Rows that repeat
    a ``vec_id`` count one by one as positives and negatives; as an anchor such an id is taken once, with the smallest
    label and vector. A table without anchors, or without rows, gives an empty frame. Scores that do not fit into 64
    bits raise an error. Runs jobs when called.
    """
    spark = rows.sparkSession
    small_batches(spark)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    vector = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("int"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    valid = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    kept = stored(valid.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("q"),
        F.monotonically_increasing_id().alias("place"),
    ), "mining_rows")
    anchors = kept.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("a"))
    anchors = stored(anchors.select("vec_id", "a.label", "a.q"), "mining_anchors")
    n_rows = kept.count()
    n_anchors, n_values = anchors.agg(F.count("*"), F.coalesce(F.sum(F.size("q").cast("long")), F.lit(0))).first()
    if not n_anchors:
        return spark.createDataFrame([], out)
    n_groups = max(-(-n_anchors // GROUP_ANCHORS), -(-n_values // GROUP_VALUES))
    n_ranges = min(-(-n_rows // BLOCK_ROWS), max(-(-TILES // n_groups), -(-n_rows // TILE_ROWS)))

    pair = "anchor_id long, score long, vec_id long"
    plain = anchors.withColumn("tops", F.lit(None).cast("array<long>"))
    found = _tiled(kept, plain, n_groups, n_ranges).mapInArrow(trimmed(_search(positives, _any_score, True)), pair)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    top = stored(found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives).drop("n"), "mining_positives")
    known = top.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list("score"), asc=False).alias("tops"))
    # Stored vectors take far less room than in memory, so the size of their file is no ground for a broadcast.
    ranked = stored(anchors.hint("merge").join(known, "vec_id"), "mining_ranked_anchors")
    near = _tiled(kept, ranked, n_groups, n_ranges).mapInArrow(trimmed(_search(negatives, _around_tops(low, high), False)), pair)
    within = stored(near, "mining_negatives")

    scored = top.withColumn("negative", F.lit(0)).union(within.withColumn("negative", F.lit(1)))
    keys = scored.rdd.map(lambda r: (packed(r.anchor_id, r.score, r.negative, r.vec_id), None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = keys.repartitionAndSortWithinPartitions(parts, by_anchor)
    mined = in_order.mapPartitions(lambda it: windows(it, negatives, low, high))
    return stored(spark.createDataFrame(mined, out, verifySchema=False), "mining_result")
