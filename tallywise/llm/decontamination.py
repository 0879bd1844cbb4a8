"""Benchmark items inside texts, found by latent semantic retrieval and confirmed word by word.

1. Words, without case and punctuation, are hashed into features. One pass counts in how many passages each occurs.
2. A second pass makes the randomised singular value decomposition of all TF-IDF passages: with a random test matrix
   of few columns every task sums ``A' (A omega)`` over its passages, and from that sum (the Nystrom form) the leading
   right singular vectors and values follow on the driver, whatever the number of passages.
3. A third pass slides windows of each item's length over all texts. Windows and items are compared by cosine in the
   whitened latent space; for those above a bound the longest common subsequence of words says how much of the item, and
   how much of its answer (what follows its last sentence end), is there in order. A paraphrase keeps both.
4. The cosine misses some paraphrases, and short items by their alignment. An exact gate finds these: a stretch that holds
   enough of an item holds some of any large enough choice of its words, so places where few of its rarest words lie
   close together are all there is to confirm. What the rule accepts in any stretch of the length is found.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words
from tallywise.llm.batching import small_batches, trimmed

FEATURES, RANK, OVERSAMPLE = 4096, 48, 8
#: Words of a passage of the decomposition, of a unit by which windows move, and of the longest query.
PASSAGE, UNIT, LONGEST = 64, 8, 64
#: Least cosine of a candidate; shares of an item in order that are a leak, alone or with its answer.
COSINE = 0.6
ALONE, WITH_ANSWER, ANSWER = 0.8, 0.55, 0.6
SLICES, FAN_IN = 64, 64
#: Rows that are added at once.
SLOTS = 8
#: Rare words of an item that lie close together, for the exact gate; any number finds the same.
CLOSE = 5
SENTENCE_END = re.compile(r"[.!?:](?=\s|$)")


def _hashes(texts: list):
    """Hash and text of every bare lower-case word."""
    data, at = words.joined([(t or "").lower() for t in texts])
    start, _, h = words.word_spans(data, bare=True)
    return h, np.searchsorted(at, start, "right") - 1


def _sums(table: np.ndarray, at: np.ndarray, count: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Sums of the (weighted) rows ``table[at]`` over runs of the given lengths, none of which is empty.

    Rows are added eight at a time, column by column of a grid; numpy adds runs of rows one by one and far slower.
    """
    lines = -(-count // SLOTS)
    begin = np.cumsum(lines) - lines
    place = np.arange(len(at)) + np.repeat(begin * SLOTS - (np.cumsum(count) - count), count)
    grid = np.zeros(int(lines.sum()) * SLOTS, np.int64)
    grid[place] = at
    share = np.zeros(len(grid), table.dtype)
    share[place] = 1 if weight is None else weight
    grid, share = grid.reshape(-1, SLOTS), share.reshape(-1, SLOTS)
    out = np.empty((len(grid), table.shape[1]), table.dtype)
    for lo in range(0, len(grid), 2048):  # as much as stays in the cache
        some, of = grid[lo : lo + 2048], share[lo : lo + 2048, :, None]
        total = table[some[:, 0]] * of[:, 0]
        for i in range(1, SLOTS):
            total += table[some[:, i]] * of[:, i]
        out[lo : lo + 2048] = total
    return out if len(lines) == len(out) else _sums(out, np.arange(len(out)), lines)


def _entries(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, feature and frequency of each feature of each passage, by passage."""
    h, owner = _hashes(texts)
    count = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate(([0], np.cumsum(count)))
    per = -(-count // PASSAGE)
    passage = np.concatenate(([0], np.cumsum(per)))[owner] + (np.arange(len(h)) - begin[owner]) // PASSAGE
    key = passage * FEATURES + (h >> np.uint64(52)).astype(np.int64)
    if len(key) and key[-1] < (1 << 32) - FEATURES:  # passages ascend; half the width sorts in half the time
        key = key.astype(np.uint32)
    key = np.sort(key)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    key, tf = key[first].astype(np.int64), np.diff(first, append=len(key))
    return key // FEATURES, key % FEATURES, tf


def _total(parts: DataFrame, columns: int) -> np.ndarray:
    """Sum of the arrays (FEATURES, columns) of all tasks, given as ``slice``, ``part``, ``raw``, in two steps by slices."""
    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in pdf["raw"])
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "part": [0], "raw": [total.tobytes()]})

    kind = "slice int, part long, raw binary"
    some = parts.withColumn("turn", F.col("part") % FAN_IN).groupBy("slice", "turn").applyInPandas(added, kind)
    rows = some.groupBy("slice").applyInPandas(added, kind).collect()  # a few numbers for each feature
    out = np.zeros((SLICES, FEATURES // SLICES * columns))
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["raw"])
    return out.reshape(FEATURES, columns)


def _sliced(total: np.ndarray) -> pd.DataFrame:
    part = TaskContext.get().partitionId()
    raw = [x.tobytes() for x in total.astype(float).reshape(SLICES, -1)]
    return pd.DataFrame({"slice": np.arange(SLICES, dtype=np.int32), "part": part, "raw": raw})


def _frequencies(frames):
    total = np.zeros((FEATURES, 2))
    for pdf in frames:
        texts = pdf["text"].tolist()
        for lo, hi in words.batches(texts, words.BLOCK):
            passage, feature, _ = _entries(texts[lo:hi])
            total[:, 0] += np.bincount(feature, minlength=FEATURES)
            total[0, 1] += passage[-1] + 1 if len(passage) else 0
    yield _sliced(total)


def _range(idf: np.ndarray, omega: np.ndarray):
    def run(frames):
        total = np.zeros(omega.shape)
        for pdf in frames:
            texts = pdf["text"].tolist()
            for lo, hi in words.batches(texts, words.BLOCK):
                passage, feature, tf = _entries(texts[lo:hi])
                if not len(passage):
                    continue
                first = np.flatnonzero(np.diff(passage, prepend=-1))
                at = np.cumsum(np.diff(passage, prepend=passage[0]) > 0)
                value = (tf * idf[feature]).astype(np.float32)
                norm = np.sqrt(np.add.reduceat(value**2, first))
                value /= np.maximum(norm, 1e-9)[at]
                y = _sums(omega, feature, np.diff(first, append=len(feature)), value)
                order = np.argsort(feature.astype(np.uint16), kind="stable")
                feature = feature[order]
                new = np.flatnonzero(np.diff(feature, prepend=-1))
                total[feature[new]] += _sums(y, at[order], np.diff(new, append=len(feature)), value[order])
        yield _sliced(total)

    return run


def latent_space(docs: DataFrame, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Whitened latent vector (FEATURES, RANK) and rarity of each feature, from all passages of ``text``."""
    slices = "slice int, part long, raw binary"
    texts = docs.select("text")
    counted = _total(texts.mapInPandas(trimmed(_frequencies), slices), 2)
    idf = np.log((1 + counted[0, 1]) / (1 + counted[:, 0])) + 1
    omega = np.linalg.qr(np.random.default_rng(seed).standard_normal((FEATURES, RANK + OVERSAMPLE)))[0].astype(np.float32)
    image = _total(texts.mapInPandas(trimmed(_range(idf, omega)), slices), RANK + OVERSAMPLE)
    shift = 1e-6 * max(np.linalg.norm(image), 1e-9)
    image = image + shift * omega
    core = omega.T @ image
    root = np.linalg.cholesky((core + core.T) / 2 + 1e-9 * max(1e-9, np.trace(core)) * np.eye(len(core)))
    vectors, values, _ = np.linalg.svd(np.linalg.solve(root, image.T).T, full_matrices=False)
    return (idf[:, None] * vectors[:, :RANK] / np.maximum(values[:RANK], 1e-3 * max(values[0], 1e-9))).astype(np.float32), idf


def common_subsequence(item: list, window: list) -> int:
    """Length of the longest common subsequence, with the item's places as bits of one number."""
    masks: dict = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in window:
        u = row & masks.get(w, 0)
        row = (row + u | row - u) & full
    return len(item) - row.bit_count()


class Queries:
    """Items, or parts of long ones, as word hashes, their answers, latent vectors by window size, and rarest words.

    A leak holds at least ``WITH_ANSWER`` of the n words of an item, t words. Of its n - t + k rarest words it then
    holds at least k, in a stretch of ``reach`` words: the longest that is confirmed.
    """

    def __init__(self, items: list[tuple], table: np.ndarray, rarity: np.ndarray):
        self.ids, self.items, self.answers = [], [], []
        for item_id, text in items:
            text = text or ""
            ends = [m.end() for m in SENTENCE_END.finditer(text) if text[m.end() :].strip()]
            h = _hashes([text])[0]
            answer = _hashes([text[ends[-1] :]])[0] if ends else h
            n = -(-len(h) // LONGEST)
            for part in np.array_split(h, n) if n else []:
                self.ids.append(item_id)
                self.items.append(part.tolist())
                self.answers.append(answer.tolist() if n == 1 else part.tolist())
        self.units = np.array([max(1, round(len(x) / UNIT)) for x in self.items], int)
        self.vectors = np.zeros((len(self.items), table.shape[1]), np.float32)
        for i, x in enumerate(self.items):
            v = table[(np.array(x, np.uint64) >> np.uint64(52)).astype(np.int64)].sum(0)
            self.vectors[i] = v / max(1e-9, float(np.linalg.norm(v)))
        size = np.array([len(x) for x in self.items], int)
        self.reach = self.units * UNIT + 2 * (size // 4 + UNIT)
        least = [math.ceil(WITH_ANSWER * n - 1e-9) for n in size]
        self.close = np.array([min(CLOSE, t) for t in least], int)
        pairs = set()
        for q, x in enumerate(self.items):
            rare = sorted(x, key=lambda w: (-rarity[w >> 52], w))
            pairs |= {(w, q) for w in rare[: len(x) - least[q] + int(self.close[q])]}
        pairs = sorted(pairs)
        self.rare, count = np.unique(np.array([w for w, _ in pairs], np.uint64), return_counts=True)
        self.rare_at = np.concatenate(([0], np.cumsum(count)))
        self.rare_of = np.array([q for _, q in pairs], np.int64)
        self.marked = np.zeros(1 << 20, bool)
        self.marked[self.rare >> np.uint64(44)] = True
        self.least = np.array(least, int)
        # Each word of the items has a number, the last one stands for all others, and in each item a mask of its places.
        self.words = np.unique(np.array([w for x in self.items for w in x], np.uint64))
        self.first = np.searchsorted(self.words, np.arange((1 << 20) + 1, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        self.first[-1] = len(self.words)
        self.masks = []
        for x in self.items:
            mask: dict = {}
            for i, w in enumerate(x):
                mask[w] = mask.get(w, 0) | 1 << i
            number = np.searchsorted(self.words, np.array(list(mask), np.uint64))
            self.masks.append((number, np.array(list(mask.values()), np.uint64)))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The number of each word."""
        top = (h >> np.uint64(44)).astype(np.int64)
        out, end = self.first[top].astype(np.int64), self.first[top + 1]
        same = out < end
        same[same] = self.words[out[same]] == h[same]
        more = np.flatnonzero(~same & (end - out > 1))
        out[~same] = len(self.words)
        if len(more):
            at = np.minimum(np.searchsorted(self.words, h[more]), len(self.words) - 1)
            out[more] = np.where(self.words[at] == h[more], at, len(self.words))
        return out

    def held(self, number: np.ndarray, query: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether the words from ``lo`` to ``hi`` hold enough of a query in any order; without that none of it is a leak."""
        out = np.zeros(len(query), bool)
        order = np.argsort(query, kind="stable")
        mask = np.zeros(len(self.words) + 1, np.uint64)
        bounds = np.flatnonzero(np.concatenate(([True], np.diff(query[order]) != 0, [True]))) if len(order) else [0]
        for begin, end in zip(bounds[:-1], bounds[1:]):
            q = query[order[begin]]
            at, bits = self.masks[q]
            mask[at] = bits
            for part in range(begin, end, 10_000):
                own = order[part : min(part + 10_000, end)]
                own = own[hi[own] > lo[own]]
                size = hi[own] - lo[own]
                if not len(own):
                    continue
                ends = np.cumsum(size)
                words_at = np.arange(ends[-1]) + np.repeat(lo[own] - (ends - size), size)
                found = np.bitwise_or.reduceat(mask[number[words_at]], ends - size)
                out[own] = np.bitwise_count(found) >= self.least[q]
            mask[at] = 0
        return out


def _shares(queries: Queries, q: int, h: np.ndarray) -> tuple[float, float]:
    window = h.tolist()
    item, answer = queries.items[q], queries.answers[q]
    held = set(window)
    if sum(w in held for w in item) < WITH_ANSWER * len(item):  # no order of these words is a leak
        return 0.0, 0.0
    return common_subsequence(item, window) / len(item), common_subsequence(answer, window) / max(1, len(answer))


def _leaks(share: float, answer: float) -> bool:
    return share >= ALONE or (share >= WITH_ANSWER and answer >= ANSWER)


def _close(queries: Queries, h: np.ndarray, owner: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(text, query, from, to) of all stretches around places where enough of a query's rarest words are close together."""
    at = np.flatnonzero(queries.marked[h >> np.uint64(44)])
    slot = np.minimum(np.searchsorted(queries.rare, h[at]), len(queries.rare) - 1)
    same = queries.rare[slot] == h[at]
    at, slot = at[same], slot[same]
    n = queries.rare_at[slot + 1] - queries.rare_at[slot]
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    query = queries.rare_of[np.repeat(queries.rare_at[slot], n) + nth]
    at = np.repeat(at, n)
    order = np.argsort(query.astype(np.uint16) if len(queries.items) < 1 << 16 else query, kind="stable")
    query, at = query[order], at[order]
    last = np.arange(len(at)) + queries.close[query] - 1
    first = np.flatnonzero(last < len(at))
    last = last[first]
    near = (query[first] == query[last]) & (owner[at[first]] == owner[at[last]]) & (at[last] - at[first] < queries.reach[query[first]])
    first, last = first[near], last[near]
    if not len(first):
        return np.zeros((0, 4), np.int64)
    query, doc = query[first], owner[at[first]]
    lo = np.maximum(begin[doc], at[last] - queries.reach[query] + 1)
    hi = np.minimum(begin[doc + 1], at[first] + queries.reach[query])
    new = np.ones(len(first), bool)
    new[1:] = (query[1:] != query[:-1]) | (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])
    new = np.flatnonzero(new)
    end = hi[np.append(new[1:], len(first)) - 1]
    return np.stack([doc[new], query[new], lo[new], end], axis=1)


def _confirmed(queries: Queries, q: int, h: np.ndarray) -> tuple[float, float, int, int] | None:
    """Shares, start and end of the best of the first windows of a query's reach that hold a leak, if one does."""
    if not _leaks(*_shares(queries, q, h)):  # nor does any part of it
        return None
    own, reach, best = set(queries.items[q]), int(queries.reach[q]), None
    for lo in [i for i, w in enumerate(h.tolist()) if w in own]:
        if best is not None and lo >= until:
            break
        hi = min(lo + reach, len(h))
        share, answer = _shares(queries, q, h[lo:hi])
        if _leaks(share, answer):
            until = lo + reach if best is None else until
            best = max(best or (0.0, 0.0, 0, 0), (share, answer, lo, hi), key=lambda x: x[:2])
    return best


def _searched(queries: Queries, table: np.ndarray):
    def of(texts: list):
        h, owner = _hashes(texts)
        if not len(h):
            return
        count = np.bincount(owner, minlength=len(texts))
        begin = np.concatenate(([0], np.cumsum(count)))
        place = np.arange(len(h)) - begin[owner]
        starts = np.flatnonzero(place % UNIT == 0)
        sums = _sums(table, (h >> np.uint64(52)).astype(np.int64), np.diff(starts, append=len(h)))
        unit_owner = owner[starts]
        last = np.searchsorted(unit_owner, unit_owner, "right")
        unit, number = np.arange(len(starts)), queries.numbers(h)
        edge = np.append(starts, len(h))
        found = []
        z, length = sums.copy(), 1
        for size in np.unique(queries.units):
            for length in range(length, size):  # windows grow by the unit behind them, up to the text's end
                z[:-length] += sums[length:] * (unit + length < last)[:-length, None]
            length = int(size)
            own = np.flatnonzero(queries.units == size)
            for lo in range(0, len(starts), 8192):
                norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", z[lo : lo + 8192], z[lo : lo + 8192])), 1e-9)
                cosine = z[lo : lo + 8192] @ queries.vectors[own].T
                s, q = np.divmod(np.flatnonzero(cosine >= np.float32(COSINE) * norm[:, None]), len(own))
                found.append((cosine[s, q] / norm[s], s + lo, np.minimum(s + lo + size, last[s + lo]), own[q]))
        cosine, s, e, query = (np.concatenate(x) for x in zip(*found))
        text, margin = unit_owner[s], np.array([len(x) // 4 + UNIT for x in queries.items], int)[query]
        from_word, to_word = np.maximum(begin[text], starts[s] - margin), np.minimum(begin[text + 1], edge[e] + margin)
        keep = np.flatnonzero(queries.held(number, query, from_word, to_word))
        keep = keep[np.lexsort((-e[keep], -s[keep], -cosine[keep], query[keep], text[keep]))]
        best: dict[tuple, tuple] = {}
        sure = set()
        for i in keep.tolist():
            doc, q, lo, hi = int(text[i]), int(query[i]), int(from_word[i]), int(to_word[i])
            if (doc, q) in sure:
                continue
            share, answer = _shares(queries, q, h[lo:hi])
            if _leaks(share, answer):
                row = (share, answer, float(cosine[i]), int(lo - begin[doc]), int(hi - begin[doc]))
                key = (doc, queries.ids[q])
                best[key] = max(best.get(key, row), row)
                sure.add((doc, q))
        near = _close(queries, h, owner, begin)
        near = near[queries.held(number, near[:, 1], near[:, 2], near[:, 3])]
        for doc, q, lo, hi in near.tolist():
            if (doc, q) in sure or (leak := _confirmed(queries, q, h[lo:hi])) is None:
                continue
            share, answer, first, end = leak
            z = table[(h[lo + first : lo + end] >> np.uint64(52)).astype(np.int64)].sum(0)
            cosine = float(z @ queries.vectors[q]) / max(1e-9, float(np.linalg.norm(z)))
            row = (share, answer, cosine, int(lo + first - begin[doc]), int(lo + end - begin[doc]))
            key = (doc, queries.ids[q])
            best[key] = max(best.get(key, row), row)
        for (doc, item_id), row in sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1]))):
            yield doc, item_id, row

    def run(frames):
        for pdf in frames:
            texts, rows = pdf["text"].tolist(), []
            for lo, hi in words.batches(texts, words.BLOCK):
                for doc, item_id, (share, answer, cosine, first, end) in of(texts[lo:hi]):
                    rows.append((pdf["doc_id"].iat[lo + doc], None if item_id is None else str(item_id), cosine, share, answer, first, end))
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "word_start", "word_end"])
            yield out

    return run


#: Ids travel as text: a null beside them makes pandas turn integers into floating-point numbers.
_ROWS = "doc_id string, item_id string, cosine double, lcs_share double, answer_share double, word_start long, word_end long"
FOUND = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double, word_start long, word_end long"


def find_leaks(docs: DataFrame, benchmark: DataFrame, block: int = 2000) -> DataFrame:
    """One row per text and benchmark item found in it: ``doc_id``, ``item_id``, shares, cosine, and where (in words).

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other columns are ignored. The items are the
    query set: they come to the driver in blocks, and each block is held against all texts. Null and empty texts and
    items without a word match nothing; repeated rows each match; empty tables give no rows. Runs jobs when called.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    out, held, table = spark.createDataFrame([], FOUND), [], None
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text").toLocalIterator()
    for row in chain(items, [None]):
        if row is not None:
            held.append((row["item_id"], row["text"]))
        if held and (row is None or len(held) >= block):
            table, rarity = latent_space(texts) if table is None else (table, rarity)
            queries = Queries(held, table, rarity)
            held = []
            if queries.items:
                found = texts.mapInPandas(trimmed(_searched(queries, table)), _ROWS)
                out = out.union(found.withColumns({c: F.col(c).cast("long") for c in ("doc_id", "item_id")}))
    return out
