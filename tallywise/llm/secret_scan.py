"""Secrets in texts: fixed patterns, and runs of high entropy.

The patterns are those of assignments, access keys and long hexadecimal runs. Besides, every run of characters that a
key may have is a candidate, without what a pattern has found and without scheme, host and path of links. A window slides over it; the counts of the characters in the window, kept for each
character class (digits, lower case, upper case, marks) and in all, change by one step at either end, and so does their
entropy. A window is hot if it has mixed classes and, in all, many bits a character, or if within each class the entropy
is about that of random characters of the class, whose alphabet is hexadecimal where the whole window is. So keys in
hexadecimal, base32 and base64 are held to what their own alphabet allows. The stretch covered by hot windows is a span
of kind ``entropy``, unless an allow-list names it (links, file paths, e-mail, dates, numbers, words) or a pattern has
found it already.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.functions.columns import quoted
from tallywise.llm.batching import beside, small_batches

# The three patterns and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: A name or a value of an assignment inside a candidate; = at the end fills a value up.
VALUE = re.compile(r"[^=]+=*$|[^=]+")
#: Values that look random and are none: links and paths, identifiers of several words, dates and plain numbers.
ALLOWED = [
    re.compile(r"[0-9_=+/-]+"),
    re.compile(r"[A-Za-z]+"),
    re.compile(r"(?:[A-Za-z]{2,}|[0-9]+)(?:[_/=+-]+(?:[A-Za-z]{2,}|[0-9]{1,4}))+[_/=+-]*"),
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(.{1,8})\1+.{0,8}"),
]
#: Values of under ``WINDOW`` characters only: words with numbers, times, account numbers with their country.
ALLOWED_SHORT = [
    re.compile(r"(?!(?:[^0-9]*[0-9]+(?![0-9])){3})(?:[A-Z][a-z]{2,}|[a-z]{4,}|[a-z]{2,3}(?=[A-Z])|[A-Z]{2,5}(?=[A-Z][a-z]{2})|[0-9]{1,4}|[_/+-])+=?"),
    re.compile(r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9-]+Z?"),
    re.compile(r"[A-Z]{2}[0-9]{13,}"),
]
#: Links without their user-info, query and fragment, and hosts of e-mail addresses.
LINK = re.compile(r"://(\S*)|\bwww\.[\w.~%/+=:@-]*|@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.I)
PLACE = re.compile(r"[\w.~%/+=:@-]*")
WITH_PASSWORD = re.compile(r"[^\s/?#@:]*:(?!(?:[0-9]+)?(?:[/?#]|$))[^\s?#]*@|[^\s/?#]*@")
WINDOW, SHORT = 24, 16
#: Bits a character in the window, at least, and character classes in it.
BITS, CLASSES = 3.6, 2
#: Bits a character that the entropy within the classes may stay below that of random characters, and that where all
#: characters but one are of one class.
SLACK, STRICT_SLACK = 0.4, 0.2
#: Symbols of each class, and in a hexadecimal window.
SYMBOLS, HEX_SYMBOLS = (10, 26, 26, 5), (10, 6, 6, 5)
HEXADECIMAL = re.compile(r"[0-9a-fA-F]*")


def _class(c: str) -> int:
    return 0 if "0" <= c <= "9" else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3


def entropy_windows(text: str, width: int = WINDOW) -> list[tuple[float, list[float], int]]:
    """For each window: its entropy in bits, the entropy inside each class, and the number of classes with two or more.

    With counts c that sum to n, entropy is log2(n) - sum(c * log2(c)) / n; one step changes two counts.
    """
    log = [0.0] + [k * math.log2(k) for k in range(1, width + 2)]  # one more while a character comes before one goes
    counts: dict[str, int] = {}
    total, size, inner = 0.0, [0] * 4, [0.0] * 4
    out = []
    for i, c in enumerate(text):
        k = counts.get(c, 0)
        counts[c] = k + 1
        step = log[k + 1] - log[k]
        total += step
        g = _class(c)
        size[g] += 1
        inner[g] += step
        if i >= width:
            gone = text[i - width]
            k = counts[gone]
            counts[gone] = k - 1
            step = log[k] - log[k - 1]
            total -= step
            g = _class(gone)
            size[g] -= 1
            inner[g] -= step
        if i >= width - 1:
            each = [math.log2(n) - s / n if n else 0.0 for n, s in zip(size, inner)]
            out.append((math.log2(width) - total / width, each, sum(n >= 2 for n in size)))
    return out


@lru_cache(maxsize=None)
def expected_entropy(symbols: int, n: int) -> float:
    """Mean entropy of n characters drawn evenly from an alphabet."""
    p = 1 / symbols
    mean = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) * k * math.log2(k) for k in range(1, n + 1))
    return math.log2(n) - symbols * mean / n if n else 0.0


def _hot(value: str, width: int = WINDOW) -> list[int]:
    """Where windows begin that look random."""
    out = []
    for i, (bits, each, classes) in enumerate(entropy_windows(value, width)):
        window = value[i : i + width]
        if classes >= CLASSES and bits >= BITS:
            out.append(i)
            continue
        size = [0] * 4
        for c in window:
            size[_class(c)] += 1
        if sum(n > 0 for n in size) < CLASSES:
            continue
        symbols = HEX_SYMBOLS if HEXADECIMAL.fullmatch(window) else SYMBOLS
        short = sum(n * (expected_entropy(a, n) - h) for a, n, h in zip(symbols, size, each)) / width
        if short <= (SLACK if classes >= CLASSES else STRICT_SLACK) and size[1] + size[2] > 1:
            out.append(i)
    return out


def _link_places(text: str) -> list[tuple[int, int]]:
    """Where links name hosts and paths, and e-mail addresses hosts."""
    out, at = [], 0
    while (m := LINK.search(text, at)) is not None:
        lo, hi = m.span()
        if m[1] is not None:
            user = WITH_PASSWORD.match(text, m.start(1), m.end(1))
            lo = user.end() if user else m.start(1)
            hi = PLACE.match(text, lo).end()
        out.append((lo, hi))
        at = max(hi, m.start() + 1)
    return out


def _without(lo: int, hi: int, cut: list[tuple[int, int]]):
    """What is left of a stretch without others, which are in order."""
    for a, b in cut[bisect_left(cut, lo, key=lambda x: x[1]):]:
        if a >= hi:
            break
        if lo < a:
            yield lo, a
        lo = max(lo, b)
    if lo < hi:
        yield lo, hi


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _entropy_spans(text: str, base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found = list(CANDIDATE.finditer(text))
    if not found:
        return []
    cut, out = _merged(base + _link_places(text)), []
    for m in found:
        for lo, hi in _without(m.start(), m.end(), cut):
            value = text[lo:hi]
            if len(value) < SHORT or any(p.fullmatch(value) for p in ALLOWED):
                continue
            if len(value) >= WINDOW and (hot := _hot(value)):
                out.append((lo + hot[0], lo + hot[-1] + WINDOW))
            for v in [*VALUE.finditer(value), *([re.match(".*", value)] if len(value) < WINDOW else [])]:
                if not SHORT <= len(v[0]) < WINDOW or any(p.fullmatch(v[0]) for p in ALLOWED + ALLOWED_SHORT):
                    continue
                if hot := _hot(v[0], SHORT):
                    out.append((lo + v.start() + hot[0], lo + v.start() + hot[-1] + SHORT))
    return _merged(out)


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then in the order of the kinds; positions in code points, end exclusive."""
    text = text or ""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX_RUN.finditer(text)]
    found += [(lo, hi, "entropy") for lo, hi in _entropy_spans(text, [(lo, hi) for lo, hi, _ in found])]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{lo}:{hi}" for lo, hi, kind in spans)


def _scan(texts: list) -> list[pa.Array]:
    rows = []
    for text in texts:
        spans = spans_of(text)
        base = [s for s in spans if s[2] != "entropy"]
        n = {kind: sum(s[2] == kind for s in base) for kind in KINDS}
        rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
    return [pa.array([r[i] for r in rows], pa.int64() if i < 3 else pa.string()) for i in range(5)]


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``doc_id``, ``text``: counts and spans of the secrets found.

    ``spans`` is ``kind:start:end`` joined by commas; ``base_sha256`` is the hash of the spans of the patterns alone. A
    null text is empty and has no span. Rows are handled one by one: repeated rows give equal results, other columns are
    ignored, an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scan = beside(_scan, "text", ["doc_id"], ["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return rows.mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None) -> str | None:
    """The text with every span, merged where they overlap, replaced by ``[secret]``."""
    if text is None:
        return None
    out, at = [], 0
    for lo, hi, _ in spans_of(text):
        if hi <= at:
            continue
        if lo >= at:
            out += [text[at:lo], "[secret]"]
        at = hi
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, column: str = "text") -> DataFrame:
    """The rows with secrets replaced in ``column``; other columns stay, null stays null."""
    keep = [c for c in docs.columns if c != column]
    run = beside(lambda texts: [pa.array([redacted(t) for t in texts], pa.string())], column, keep, [column])
    small_batches(docs.sparkSession)
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(column, T.StringType())])
    return docs.mapInArrow(run, schema).select(*[F.col(quoted(c)) for c in docs.columns])
