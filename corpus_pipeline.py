"""From ``documents`` to packed training sequences in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a frame that is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions.columns import cols
from tallywise.llm.decontamination import find_leaks
from tallywise.llm.jaccard_join import jaccard_join
from tallywise.llm.language_id import UNKNOWN, identify_languages
from tallywise.llm.packing import pack
from tallywise.llm.queries import VOCABULARY
from tallywise.llm.secret_scan import redact_secrets
from tallywise.llm.sketch import may_be_among
from tallywise.session import stored

#: Texts whose language scores less are rejected, as are those without a letter.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts in a language that the corpus labels; empty, null and letterless ones go."""
    found = identify_languages(docs)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*cols(docs.columns))


def _keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a key of their own, written once so that it stays the same (``doc_id`` may be null or repeated), and
    its name, which no column of ``docs`` has."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), name), key


def _without(keyed: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not among those of ``gone``; only rows that a sketch takes for them are moved and compared."""
    suspect = may_be_among(gone)
    moved = keyed.where(suspect(F.col(row))).join(gone, row, "left_anti")
    return keyed.where(~suspect(F.col(row))).unionByName(moved)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of texts linked by five-word shingles at 0.8: that of the smallest ``doc_id``, null last."""
    keyed, row = _keyed(docs, "rows")
    classes = jaccard_join(keyed.select(F.col(row).alias("doc_id"), "text"), k=5, percent=80)
    classes = stored(classes.select(F.col("doc_id").alias(row), "component_id"), "classes")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    first = classes.join(keyed.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(order).alias("first"))
    copies = stored(classes.select(row).join(first.select(f"first.{row}"), row, "left_anti"), "copies")
    return _without(keyed, row, copies).select(*cols(docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without a benchmark item."""
    keyed, row = _keyed(docs, "rows")
    leaks = find_leaks(keyed.select(F.col(row).alias("doc_id"), "text"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    leaks = stored(leaks.select(F.col("doc_id").alias(row)).distinct(), "leaks")
    return _without(keyed, row, leaks).select(*cols(docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All texts, with each secret replaced; ``n_chars`` is that of the new text."""
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*cols(docs.columns))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of all texts in sequences of 1024 ids."""
    return pack(docs, VOCABULARY, end_id=0, capacity=1024)


STAGES = [
    ("language_id", language), ("near_duplicates", near_duplicates), ("decontamination", decontaminated),
    ("secrets", without_secrets), ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), name)
    return docs
