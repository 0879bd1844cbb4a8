"""Words, shingles and line hashes of whole texts as numpy arrays.

A batch of texts is one byte string with a newline after each text, cut into blocks at white space so that memory is
bounded by the block and not by a text. White space is ASCII (``\\x09-\\x0d`` and ``\\x20``).
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))
BYTE_VALUE[SPACE] = 0
#: The other way to cut: everything but ASCII letters and digits and the bytes of other characters parts words.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
MARKS_VALUE = np.where(MARKS, np.uint64(0), BYTE_VALUE)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        for name, base in (("up", MULTIPLIER), ("down", pow(MULTIPLIER, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def blocks(data: bytes, size: int = BLOCK):
    """(start, end) of blocks that end behind white space; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        if end < len(data):
            view = np.frombuffer(data, np.uint8, end - at, at)
            found = np.flatnonzero(SPACE[view])
            while not len(found) and end < len(data):
                more = min(end + size, len(data))
                found = np.flatnonzero(SPACE[np.frombuffer(data, np.uint8, more - end, end)]) + (end - at)
                end = more
            end = at + int(found[-1]) + 1 if len(found) else len(data)
        yield at, end
        at = end


def word_spans(data: bytes, bare: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a byte string, in order; ``bare`` words are cut at punctuation too."""
    parts, value = (MARKS, MARKS_VALUE) if bare else (SPACE, BYTE_VALUE)
    starts, ends, hashes = [], [], []
    for lo, hi in blocks(data):
        view = np.frombuffer(data, np.uint8, hi - lo, lo)
        edge = np.diff(np.concatenate(([True], parts[view], [True])).astype(np.int8))
        s, e = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(s):
            continue
        up, down = _power(len(view))
        sums = np.add.reduceat(value[view] * up[: len(view)], s)
        starts.append(s + lo)
        ends.append(e + lo)
        hashes.append(mixed(sums * down[s] + (e - s).astype(np.uint64)))
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def joined(texts: list, lower: bool = False) -> tuple[bytes, np.ndarray]:
    """The batch's bytes and where each text begins; null is empty."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    if lower:
        parts = [p.lower() for p in parts]  # bytes: only A-Z changes
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=at[1:])
    return b"\n".join(parts) + b"\n" if parts else b"", at


def grams(hashes: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of k words inside one text, and the position of its first word."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(hashes) - k + 1
    at = np.flatnonzero(owner[:m] == owner[k - 1 :])
    h = hashes[:m].copy()
    for j in range(1, k):
        h = h * np.uint64(MULTIPLIER) + hashes[j : m + j]
    return mixed(h[at]), at


def shingle_sets(texts: list, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text, sorted: (values, offsets by text).

    A text with fewer words has its whole sequence as one shingle, one without words has none.
    """
    data, at = joined(texts, lower=True)
    start, _, h = word_spans(data)
    owner = np.searchsorted(at, start, "right") - 1
    values, first = grams(h, owner, k)
    own = owner[first]
    count = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        begin = np.concatenate(([0], np.cumsum(count)))
        whole = []
        for d in short:
            acc = np.uint64(count[d])
            with np.errstate(over="ignore"):
                for x in h[begin[d] : begin[d + 1]]:
                    acc = acc * np.uint64(MULTIPLIER) + x
            whole.append(acc)
        values = np.concatenate((values, mixed(np.array(whole, np.uint64) ^ np.uint64(0x5BD1E995))))
        own = np.concatenate((own, short))
    order = np.lexsort((values, own))
    values, own = values[order], own[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    values, own = values[keep], own[keep]
    return values, np.searchsorted(own, np.arange(len(texts) + 1))


def batches(texts: list, size: int = BLOCK, most: int = 60_000):
    """(from, to) of runs of texts of about the given length together, of a bounded number of texts."""
    lo, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "") + 1
        if i > lo and (total + n > size or i - lo >= most):
            yield lo, i
            lo, total = i, 0
        total += n
    if len(texts) > lo:
        yield lo, len(texts)
