"""Quality rules by labelling lines: a linear-chain conditional random field marks content and boilerplate.

Every line has a few measures (shares of symbols, capitals, digits and exclamation marks, words that repeat the word before, words in
repeated passages, equality to an earlier line, length). The field gives each line a score per label from
them and each pair of neighbours a score per pair of labels; Viterbi decoding finds the best labels of all lines
together. A text is kept where enough of its characters lie in content lines. The counts of the plain rules come from
the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words
from tallywise.llm.batching import small_batches, trimmed
from tallywise.llm.quality_cnn import sampled_texts

SYMBOLS = b"#*$%&|<>"
PASSAGE = 8
#: Least share of characters in content lines.
CONTENT_SHARE = 0.5
#: Labelled texts of each class from which the field learns.
PER_CLASS = 500
BOILERPLATE, CONTENT = 0, 1


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


CLASSES = [_table(SYMBOLS), _table(b"|"), _table(bytes(range(65, 91))), _table(b"0123456789"), _table(b"!"), _table(bytes([*range(97, 123), *range(128, 256)]))]
START_OF_CHARACTER = np.array([(b & 0xC0) != 0x80 for b in range(256)], np.uint8)


@dataclass
class Field:
    """Scores of the measures per label, of neighbouring labels, and of the first label."""

    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of values between neighbouring edges."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def measured(texts: list) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """Counts per text; measures and characters per line; where each text's lines begin."""
    data, at = words.joined(texts)
    view = np.frombuffer(data, np.uint8)
    start, end, h = words.word_spans(data)
    owner = np.searchsorted(at, start, "right") - 1
    line_end = np.flatnonzero(view == 10) + 1
    line_at = np.concatenate(([0], line_end))
    lines_from = np.searchsorted(line_at, at)
    word_from = np.searchsorted(start, at)
    # words in windows of eight that the text has twice or more
    gram, place = words.grams(h, owner, PASSAGE)
    order = np.lexsort((gram, owner[place]))
    g, o = gram[order], owner[place][order]
    same = (g[1:] == g[:-1]) & (o[1:] == o[:-1])
    twice = np.concatenate(([False], same))[: len(g)] | np.concatenate((same, [False]))[: len(g)]
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, place[order][twice], 1)
    np.add.at(cover, place[order][twice] + PASSAGE, -1)
    repeated = (np.cumsum(cover[:-1]) > 0).astype(np.int64)
    # characters
    symbol = CLASSES[0][view]
    in_word = START_OF_CHARACTER[view] * ~words.SPACE[view]
    word_line = np.searchsorted(line_at, start, "right") - 1
    n_lines = len(line_at) - 1
    words_in_line = np.bincount(word_line, minlength=n_lines)
    chars = _sums(in_word, line_at)
    # lines equal to an earlier line of the same text
    seen_before = np.zeros(n_lines, bool)
    for t in range(len(texts)):
        lo, hi = lines_from[t], lines_from[t + 1]
        if hi - lo > 1:
            seen = set()
            for k in range(lo, hi):
                if words_in_line[k]:
                    line = data[line_at[k] : line_at[k + 1] - 1]
                    if line in seen:
                        seen_before[k] = True
                    seen.add(line)
    again = np.zeros(len(h), np.int64)
    again[1:] = (h[1:] == h[:-1]) & (word_line[1:] == word_line[:-1])
    per = np.maximum(1, chars)
    shares = [np.sqrt(_sums(c[view], line_at) / per) for c in CLASSES]
    n = np.maximum(1, words_in_line)
    measures = np.stack([
        np.ones(n_lines), *shares, np.bincount(word_line, again, n_lines) / n, np.bincount(word_line, repeated, n_lines) / n,
        seen_before, np.minimum(chars, 400) / 400, words_in_line < 4, np.minimum(chars / n, 20) / 20,
    ], 1)
    counts = pd.DataFrame({
        "n_words": np.diff(word_from), "word_chars": _sums(in_word, at), "n_symbols": _sums(symbol, at),
        "n_dup_lines": _sums(seen_before, lines_from), "n_repeat_words": _sums(repeated, word_from),
    })
    return counts, measures, chars, lines_from


def decoded(field: Field, measures: np.ndarray) -> np.ndarray:
    """The best labels of a text's lines, by Viterbi; ties go to content."""
    unary = measures @ field.weights
    (p00, p01), (p10, p11) = field.pairs.tolist()
    rows = unary.tolist()
    a, b = rows[0][0] + float(field.first[0]), rows[0][1] + float(field.first[1])
    back = []
    for u0, u1 in rows[1:]:
        from_a, from_b = a + p00, b + p10
        to_b_a, to_b_b = a + p01, b + p11
        back.append((from_b >= from_a, to_b_b >= to_b_a))
        a, b = max(from_a, from_b) + u0, max(to_b_a, to_b_b) + u1
    label = int(b >= a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return np.array(out[::-1])


def _expected(unary: np.ndarray, field: Field):
    """Marginals of labels and of neighbouring labels, by the forward-backward sums in logarithms."""
    n = len(unary)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    alpha[0] = unary[0] + field.first
    for i in range(1, n):
        alpha[i] = unary[i] + np.logaddexp(alpha[i - 1, 0] + field.pairs[0], alpha[i - 1, 1] + field.pairs[1])
    for i in range(n - 2, -1, -1):
        right = unary[i + 1] + beta[i + 1]
        beta[i] = np.logaddexp(field.pairs[:, 0] + right[0], field.pairs[:, 1] + right[1])
    z = np.logaddexp(*alpha[-1])
    pairs = np.zeros((2, 2))
    for i in range(1, n):
        pairs += np.exp(alpha[i - 1][:, None] + field.pairs + (unary[i] + beta[i])[None, :] - z)
    return np.exp(alpha + beta - z), pairs


def fitted(sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = 10, seed: int = 11) -> Field:
    """Maximum likelihood by stochastic gradient steps over (measures, labels) of line sequences, each measure at its own scale."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([x for x, _ in sequences])
    scale = 1 / np.maximum(1e-3, np.sqrt((every**2).mean(0)))
    sequences, k = [(x * scale, y) for x, y in sequences], every.shape[1]
    field = Field(np.zeros((k, 2)), np.zeros((2, 2)), np.zeros(2))
    step, total = 0, epochs * len(sequences)
    for _ in range(epochs):
        for s in rng.permutation(len(sequences)):
            x, y = sequences[s]
            rate = 0.3 * (1 - step / (total + 1)) / max(1, len(y)) ** 0.5
            step += 1
            marginal, pairs = _expected(x @ field.weights, field)
            truth = np.eye(2)[y]
            field.weights += rate * (x.T @ (truth - marginal) - 1e-3 * field.weights)
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:-1], y[1:]), 1)
            field.pairs += rate * (seen - pairs)
            field.first += rate * (truth[0] - marginal[0])
    field.weights *= scale[:, None]
    return field


def fit_field(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_lines: int = 40) -> Field | None:
    """Learn from a bounded sample of labelled texts, of each up to ``most_lines`` lines spread over the whole text.

    Lines of good texts are content and lines of bad ones boilerplate. Texts are put one behind the other in a drawn
    order, four to a sequence, so that labels also change inside a sequence. None without both classes.
    """
    def run(frames):
        for pdf in frames:
            _, measures, _, begin = measured(pdf["text"].tolist())
            out = []
            for t in range(len(pdf)):
                lines = np.arange(begin[t], begin[t + 1])
                if len(lines) > most_lines:
                    lines = lines[np.linspace(0, len(lines) - 1, most_lines).astype(int)]
                out.append((pdf["_h"].iat[t], pdf["doc_id"].iat[t], pdf["quality"].iat[t], measures[lines].tobytes()))
            yield pd.DataFrame(out, columns=["h", "doc_id", "y", "lines"])

    found = sampled_texts(docs, labels, per_class).mapInPandas(trimmed(run), "h long, doc_id long, y int, lines binary").toPandas()
    if found["y"].nunique() < 2:
        return None
    found = found.sort_values(["h", "doc_id", "y"], ignore_index=True)
    order = np.random.default_rng(5).permutation(len(found))
    k = measured(["x"])[1].shape[1]
    each = [(np.frombuffer(found["lines"][i]).reshape(-1, k), int(found["y"][i])) for i in order]
    sequences = []
    for lo in range(0, len(each), 4):
        part = each[lo : lo + 4]
        sequences.append((np.concatenate([x for x, _ in part]), np.concatenate([np.full(len(x), y) for x, y in part])))
    return fitted(sequences)


def apply_rules(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per row of ``doc_id``, ``text``: counts, ``base_failed``, ``kept``, ``content_share`` and ``labels``.

    ``labels`` has one character a line, C or B. A null text has no words and fails the plain rules, as does any text under 20 words.
    Without a field every line is content. Repeated rows each get a row; other columns are ignored; an empty table gives
    no rows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "labels"]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in words.batches(texts):
                counts, measures, chars, begin = measured(texts[lo:hi])
                share, labels = [], []
                for t in range(hi - lo):
                    own = slice(begin[t], begin[t + 1])
                    y = np.ones(begin[t + 1] - begin[t], int) if field is None else decoded(field, measures[own])
                    total = chars[own].sum()
                    share.append(float(chars[own][y == CONTENT].sum() / total) if total else 0.0)
                    labels.append("".join("BC"[i] for i in y))
                failed = (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])
                out = counts.assign(base_failed=failed, content_share=share, labels=labels)
                out["kept"] = ~failed & (out["content_share"] >= CONTENT_SHARE)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(out[n].to_numpy()) for n in names[:-1]], pa.array(labels, pa.string())], ["doc_id", *names])

    small_batches(docs.sparkSession)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, labels string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(run), schema)
