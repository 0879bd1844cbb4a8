"""Ids beyond 2**53 stay what they are beside a null in the same batch, in every operator."""

import numpy as np
import pytest

from tallywise.llm import (
    decontamination, filter_audit, jaccard_join, language_id, main_text, near_dedup, packing, quality_cnn, quality_rules, queries, secret_scan, token_files, warc,
)

IDS = [None, 2**53 + 1, 2**63 - 1, -(2**63), -(2**53) - 1, 7]
ITEM = "which planet of our solar system has the largest number of known moons today. It is Saturn by a wide margin."


def text(i):
    return " ".join(f"w{x}" for x in np.random.default_rng(i).integers(0, 9999, 80)) + f" {ITEM} key=abcdef{i}"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text(k), 2**53 + 1 + k, None if k else 3) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long, other long").coalesce(1)


def pages(docs):
    return docs.selectExpr("doc_id page_id", "cast(null as string) url", "concat('<html><body><article><p>', text, '</p></article></body></html>') html")


def leaks(docs):
    items = docs.sparkSession.createDataFrame([(2**53 + 1, ITEM), (None, "")], "item_id long, text string")
    found = decontamination.find_leaks(docs, items)
    assert {r["item_id"] for r in found.collect()} == {2**53 + 1}
    return found


def read_back(docs):
    index = token_files.write_token_files(docs, queries.VOCABULARY, 2)
    return token_files.read_token_files(index)


OPERATORS = {
    "op1": lambda d: packing.pack(d, queries.VOCABULARY, 0), "op2": read_back, "op3": lambda d: main_text.extract_main_text(pages(d)).withColumnRenamed("page_id", "doc_id"),
    "op4": secret_scan.scan_secrets, "redact": secret_scan.redact_secrets, "op5": jaccard_join.jaccard_join,
    "op6": lambda d: language_id.identify_languages(d, language_id.LanguageModel([], None)), "op7": lambda d: quality_cnn.score_quality(d, None),
    "op8": lambda d: warc.read_warc(warc.write_warc(pages(d))).withColumnRenamed("page_id", "doc_id"), "op9": leaks,
    "op10": lambda d: quality_rules.apply_rules(d, None), "op11": near_dedup.near_duplicates, "op12": lambda d: filter_audit.masked(d.withColumnRenamed("other", "source")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_stay(docs, name):
    found = OPERATORS[name](docs).collect()
    assert {r["doc_id"] for r in found} == set(IDS)
    for column in ("n_chars", "other"):
        if found and column in found[0].__fields__ and name in ("redact", "op6", "op7"):
            assert {(r["doc_id"], r[column]) for r in found} == {(r["doc_id"], r[column]) for r in docs.collect()}


def test_a_null_id_links_texts_in_the_join(spark):
    w = [f"w{x}" for x in np.random.default_rng(5).integers(0, 99_999, 228)]
    rows = [(5, " ".join(w[:200])), (None, " ".join(w[13:213])), (7, " ".join(w[26:226])), (2**53 + 1, " ".join(w[26:226]) + " end")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: 5, None: 5, 7: 5, 2**53 + 1: 5}
    alone = spark.createDataFrame([rows[0], rows[2], (None, "x y z"), (None, "x y z")], "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard_join.jaccard_join(alone).select("doc_id", "component_id").collect()), key=repr) == [(5, 5), (7, 7), (None, None), (None, None)]
