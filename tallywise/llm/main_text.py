"""Main text of HTML pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words, which score positive, and tags, which score negative; menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments score far below. One linear scan finds the contiguous run
of the highest sum, and its blocks are the text. How much a word in a block of some kind or a tag scores is learned
from labelled pages: those whose markup names the article say which words and tags lie inside it.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm.batching import beside, small_batches, trimmed

# What HTML says about its elements, and how pages name the parts that are no article.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video head select".split())
OUT = frozenset("nav footer aside form menu button dialog header label input datalist fieldset".split())
NAMES = frozenset(
    "ad ads adbox adslot banner nav navbar menu footer header masthead topbar aside social share sharing related popup modal "
    "overlay widget toolbar pager pagination login signup search form alert disclaimer reply replies respond discussion "
    "contentinfo complementary disqus toc skip consent gdpr subscribe hidden".split()
)
BEGINNINGS = ("comment", "advert", "sidebar", "cookie", "breadcrumb", "newsletter", "promo", "sponsor", "navig", "notice", "notif", "recommend")
WHOLE = frozenset("html body main article".split())
CLOSED_BY_BLOCK = "p"

TAG = r"""</?[a-zA-Z](?:[^"'>]|"[^"]*"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|$)"""
TOKEN = re.compile(rf"<!--.*?(?:-->|$)|(?P<tag>{TAG})|<[!?][^>]*(?:>|$)|(?P<text>[^<]+|<)", re.S)
HEAD = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
UNSEEN = re.compile(r"""\s(?:hidden(?=[\s>/=])(?!\s*=\s*["']?until)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Score of a word or tag of a kind no labelled page has, and the bounds of learned scores.
WORD, MARK, FLOOR, CEILING = 1.0, -0.5, -4.0, 2.0
TAG_FLOOR = -1.0
#: A word left out scores little below nothing: a run may go on behind an advert, but does not begin or end with one.
BARRED = -0.05
#: About so many labelled pages are read to learn scores, drawn by a hash of their id.
LABELLED_PAGES = 2000


def _named_out(tag: str) -> bool:
    for m in NAMED.finditer(tag):
        for word in PIECE.findall(m[2] or m[3] or m[4] or ""):
            low = word.lower()
            if low in NAMES or low.startswith(BEGINNINGS):
                return True
    return bool(UNSEEN.search(tag))


def units(page: str):
    """(kind, name, text, barred, inside) of every tag and run of text: inside is whether an article element is open.

    ``kind`` is ``tag`` or ``words``; ``name`` the tag, or the block that holds the words; a block tag has text None.
    """
    stack: list[list] = []  # name, barred by it, comments
    barred = articles = 0
    at, lower = 0, None
    while at < len(page):
        m = TOKEN.match(page, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        if m["text"] is not None:
            block = next((s[0] for s in reversed(stack) if s[0] in BLOCKS), "body")
            yield "words", block, m["text"], barred > 0, articles > 0
            continue
        if m["tag"] is None:
            continue
        head = HEAD.match(m["tag"])
        name = head[2].lower()
        if head[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    was = barred > 0
                    for gone in stack[k:]:
                        barred -= gone[1]
                        articles -= gone[0] in ("article", "main") and not gone[2]
                    del stack[k:]
                    break
            else:
                was = barred > 0
            yield "tag", name, None, was, articles > 0
            continue
        if name in RAW and not m["tag"].endswith("/>"):
            if lower is None:
                lower = page.lower()
                if len(lower) != len(page):  # a few letters change length
                    lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in page)
            end = lower.find(f"</{name}", at)
            if name in ("title", "head") and end < 0:
                continue
            if name != "head":
                close = page.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else len(page)
                continue
        if name in BLOCKS and stack and stack[-1][0] == CLOSED_BY_BLOCK:
            stack.pop()
        if name in VOID or m["tag"].endswith("/>"):
            yield "tag", name, None, barred > 0, articles > 0
            continue
        names_out = _named_out(m["tag"]) and name not in ("html", "body", "main")
        comment = any(s[2] for s in stack) or (names_out and "comment" in m["tag"].lower())
        if name in ("article", "main") and not comment and not names_out:
            for s in stack:  # an article is never a part of what is left out
                barred -= s[1]
                s[1] = 0
        out = names_out or name == "head" or (name in OUT and not (name == "header" and articles))
        own = int(out and name not in ("html", "body"))
        is_article = name in ("article", "main") and not comment
        articles += is_article
        barred += own
        stack.append([name, own, comment if name in ("article", "main") else comment])
        yield "tag", name, None, barred > 0, articles > 0


def tag_kind(name: str) -> str:
    return f"tag:{name}" if name in BLOCKS or name in VOID or name in ("a", "b", "i", "em", "strong", "span", "code", "u") else "tag:other"


def _marks_its_article(seen: list) -> bool:
    """Whether some words that are not left out lie inside an article."""
    return any(kind == "words" and inside and not barred and text.strip() for kind, _, text, barred, inside in seen)


def main_text(page: str | None, scores: dict[str, float]) -> str:
    """The blocks of the best run, one a line; empty for an empty page or one without a positive word."""
    page = page or ""
    seen = list(units(page))
    marked = _marks_its_article(seen)
    parts: list[tuple[float, bool, str | None, bool]] = []  # score, breaks the block, text, barred
    for kind, name, text, barred, inside in seen:
        if kind == "tag":
            parts.append((BARRED if barred else scores.get(tag_kind(name), MARK), name in BLOCKS, " " if name == "br" else None, barred))
        else:
            n = len(text.split())
            score = scores.get(f"words:{name}", WORD) if inside or not marked else scores.get("words:outside", FLOOR)
            parts.append((n * (BARRED if barred else score), False, text, barred))
    best, lo, hi, run, begin = 0.0, 0, 0, 0.0, 0
    for i, (score, *_) in enumerate(parts):
        if run <= 0:
            run, begin = 0.0, i
        run += score
        if run > best:
            best, lo, hi = run, begin, i + 1
    blocks, now = [], []
    for _, breaks, text, barred in parts[lo:hi]:
        if breaks:
            blocks.append("".join(now))
            now = []
        elif text is not None and not barred:
            now.append(text)
    blocks.append("".join(now))
    lines = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def _count(frames):
    for pdf in frames:
        held: dict[str, list[int]] = {}
        for page in pdf["html"]:
            seen = list(units(page))
            if not _marks_its_article(seen):
                continue
            for kind, name, text, barred, inside in seen:
                if barred:
                    continue
                key, n = (tag_kind(name), 1) if kind == "tag" else (f"words:{name}" if inside else "words:outside", len(text.split()))
                if n:
                    pair = held.setdefault(key if not key.startswith("words:") or name in BLOCKS or not inside else "words:body", [0, 0])
                    pair[0 if inside else 1] += n
        yield pd.DataFrame([(k, a, b) for k, (a, b) in held.items()], columns=["kind", "inside", "outside"])


def learned_scores(pages: DataFrame, most: int = LABELLED_PAGES) -> dict[str, float]:
    """Scores by kind of word and tag from about ``most`` pages that mark their article.

    A kind scores the logarithm of its odds of lying inside, against a prior of 20 sightings at its default, within
    bounds; tags score from ``TAG_FLOOR`` to ``MARK / 5``, so that only words raise a run and no tag ends one. Only sums by kind come to the driver, a few dozen.
    """
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    count = max(1, marked.count())
    place = F.xxhash64(F.col("page_id").cast("long")).bitwiseAND((1 << 30) - 1)
    some = marked.where(place < min(1 << 30, (most << 30) // count)).select("html")
    sums = some.mapInPandas(trimmed(_count), "kind string, inside long, outside long").groupBy("kind").agg(F.sum("inside"), F.sum("outside")).collect()
    out = {}
    for kind, inside, outside in sums:
        prior = WORD if kind.startswith("words:") else MARK
        odds = math.log((inside + 1) / (outside + 1))
        n = inside + outside
        score = min(CEILING, max(FLOOR, (20 * prior + n * odds) / (20 + n)))
        out[kind] = max(TAG_FLOOR, min(score, MARK / 5)) if kind.startswith("tag:") else score
    return out


def extract_main_text(pages: DataFrame, scores: dict[str, float] | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` per row of ``page_id``, ``url``, ``html``.

    Without ``scores`` they are learned from the pages. A null or empty page has an empty text; repeated rows each have
    theirs; other columns are ignored; an empty table gives no rows. Runs a job when it learns.
    """
    small_batches(pages.sparkSession)
    scores = learned_scores(pages) if scores is None else scores

    def run(pages: list) -> list[pa.Array]:
        text = [main_text(page, scores) for page in pages]
        return [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(beside(run, "html", ["page_id", "url"], ["text", "n_chars"]), "page_id long, url string, text string, n_chars long")
