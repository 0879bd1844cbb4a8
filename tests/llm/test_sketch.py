"""Rows are found by a sketch where they lie: no given key is lost, few others pass, and no text crosses the network."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywise.llm import jaccard_join, sketch


@pytest.mark.parametrize("count, largest", [(0, 1 << 27), (1, 1 << 27), (20_000, 1 << 27), (20_000, 1 << 16)])
def test_no_key_is_lost_and_few_others_pass(spark, monkeypatch, count, largest):
    monkeypatch.setattr(sketch, "LARGEST", largest)
    kept = spark.range(count).select((F.col("id") * 1_000_003 - 2**62).alias("k"))
    passes = sketch.may_be_among(kept.union(spark.createDataFrame([(None,)], "k long")))
    assert kept.where(passes(F.col("k"))).count() == count
    others = spark.range(50_000).select((F.col("id") * 1_000_003 + 7).alias("k"))
    passed = others.where(passes(F.col("k"))).count()
    assert passed == 0 if not count else largest == 1 << 16 or passed < 500
    assert spark.createDataFrame([(None,)], "k long").where(passes(F.col("k"))).count() == 0


@pytest.fixture()
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def texts():
    rng = np.random.default_rng(2)
    made = [" ".join(f"w{x}" for x in rng.integers(0, 99_999, 120)) for _ in range(40)]
    return [(i, f"{t} {'end' if i >= 40 else ''}") for i, t in enumerate(made + made[:10])]


def exchanged(frame, capsys):
    """The columns of all exchanges of a frame's plan."""
    capsys.readouterr()
    frame.explain("formatted")
    plan = capsys.readouterr().out.split("Initial Plan")[-1]
    return set(re.findall(r"(\w+)#", " ".join(re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: (.*)$", plan, re.M))))


def test_the_join_reads_texts_again_without_a_shuffle_of_them(spark, monkeypatch, capsys, no_broadcast):
    plans = {}

    def seen(frame, name, stored=jaccard_join.stored):
        plans[name] = exchanged(frame, capsys)
        return stored(frame, name)

    monkeypatch.setattr(jaccard_join, "stored", seen)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_join(spark.createDataFrame(texts(), "doc_id long, text string")).collect()}
    assert found == {i: i % 40 for i in range(50)}
    assert "grams" in plans["ngram_sets"]
    assert not {"text", "h"} & plans["ngram_sets"]


def test_only_suspects_are_moved_when_rows_are_dropped(spark, capsys, no_broadcast):
    docs = spark.createDataFrame([*texts(), (None, "alone here"), (3, "with an id that is not its own"), (3, None)], "doc_id long, text string").withColumn("n_chars", F.length("text"))
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted(((r[0], r[1]) for r in docs.collect() if r[0] is None or r[0] < 40), key=repr)
    keyed, row = corpus_pipeline._keyed(docs, "rows")
    gone = keyed.where("doc_id % 5 = 0").select(row)
    left = corpus_pipeline._without(keyed, row, gone)
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, keyed.where("doc_id is null or doc_id % 5 <> 0").collect()), key=repr)
    capsys.readouterr()
    left.explain()
    plan = capsys.readouterr().out.split("Initial Plan")[-1]
    assert plan.count("Exchange ") == 2 and "Filter NOT pythonUDF" in plan and "Union" in plan, "one branch is not moved"
