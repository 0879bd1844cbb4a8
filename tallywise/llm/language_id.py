"""Language of texts by a byte convolutional network trained on labelled rows of the same corpus."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm import byte_cnn
from tallywise.llm.batching import beside, small_batches, trimmed
from tallywise.llm.samples import labelled, remainder

#: Labelled texts per language from which windows are drawn, and windows of each: a bounded sample, whatever the corpus.
PER_LANGUAGE, WINDOWS = 600, 3
#: Steps of training at least, windows of a step, and passes over all windows at least.
STEPS, ROWS, PASSES = 500, 64, 4
HELD_OUT = 5
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    net: byte_cnn.Network | None


def drawn_windows(rows: DataFrame, label: str, per_text: int) -> pd.DataFrame:
    """A few windows of each text of a bounded sample, at places drawn by the text's hash, with its label."""
    def run(frames):
        for pdf in frames:
            out = []
            for h, doc_id, text, y in zip(pdf["_h"], pdf["doc_id"], pdf["text"], pdf[label]):
                all_of = byte_cnn.windows(text)
                for i in np.random.default_rng(int(h)).permutation(len(all_of))[:per_text]:
                    out.append((h, -1 if pd.isna(doc_id) else doc_id, int(i), y, all_of[i].tobytes()))
            yield pd.DataFrame(out, columns=["h", "doc_id", "place", "y", "bytes"])

    small_batches(rows.sparkSession)
    kind = dict(rows.dtypes)[label]
    found = rows.mapInPandas(trimmed(run), f"h long, doc_id long, place long, y {kind}, bytes binary").toPandas()
    return found.sort_values(["h", "doc_id", "place", "y"], ignore_index=True)


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from rows whose ``lang`` is not null and that are not held out. Bounded by ``per_language`` texts each."""
    usable = docs.where(F.col("lang").isNotNull() & (remainder("doc_id", HELD_OUT) != 0))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    found = drawn_windows(labelled(usable, "lang", per_language), "lang", WINDOWS)
    languages = sorted(found["y"].unique())
    if not languages:
        return LanguageModel([], None)
    x = np.frombuffer(b"".join(found["bytes"]), np.uint8).reshape(len(found), -1)
    y = np.array([languages.index(v) for v in found["y"]])
    return LanguageModel(languages, byte_cnn.trained(x, y, len(languages), steps=max(STEPS, -(-PASSES * len(x) // ROWS)), rows=ROWS))


def mean_log(net: byte_cnn.Network, texts: list, most: int = 4096) -> np.ndarray:
    """Mean log-probability of each class over all windows of each text."""
    out, run, count = [], [], 0

    def flush():
        if run:
            logs = np.log(byte_cnn.probabilities(net, np.concatenate(run)) + 1e-9)
            at = np.cumsum([0, *[len(w) for w in run]])
            out.extend(np.add.reduceat(logs, at[:-1]) / np.diff(at)[:, None])
            run.clear()

    for text in texts:
        w = byte_cnn.windows(text)
        if len(w) > most:  # a long text alone, without a copy of its windows
            flush()
            count = 0
            parts = [np.log(byte_cnn.probabilities(net, w[lo : lo + most]) + 1e-9).sum(0) for lo in range(0, len(w), most)]
            out.append(np.sum(parts, 0) / len(w))
            continue
        run.append(w)
        count += len(w)
        if count >= most:
            flush()
            count = 0
    flush()
    return np.array(out)


def predicted(model: LanguageModel, texts: list) -> tuple[list[str], list[float]]:
    """Language and score of each text; the unknown one, with score 0, where a text has no letter."""
    if model.net is None or not len(texts):
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    log = mean_log(model.net, texts).astype(np.float64)
    p = np.exp(log - log.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    letters = [any(map(str.isalpha, t or "")) for t in texts]
    return (
        [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)],
        [float(p[i, b]) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, letters))],
    )


def identify_languages(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, from ``text`` alone.

    Without a model it is learned from the rows (``doc_id``, ``text``, ``lang``). Null, empty and letterless texts are
    ``und``, and so is every text where nothing is labelled. Existing columns of these names are replaced; repeated rows
    stay; an empty table gives no rows. Runs jobs when it learns.
    """
    small_batches(docs.sparkSession)
    model = fit_languages(docs) if model is None else model
    kept = docs.drop("lang_pred", "score")

    def run(texts: list) -> list[pa.Array]:
        found, score = predicted(model, texts)
        return [pa.array(found, pa.string()), pa.array(score, pa.float64())]

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return kept.mapInArrow(beside(run, "text", kept.columns, ["lang_pred", "score"]), T.StructType([*kept.schema.fields, *added]))
