"""Each stage on rows with clashing columns, nulls, empties, repeats and long texts; the whole against its own stages' rules."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seatplan.llm import queries

#: Names that stages use inside.
OWN = [
    "n_words", "word_chars", "log_ppl", "low", "high", "kept", "base_failed", "_same", "_lang", "_measured", "_m", "_doc", "_row", "score", "_score", "_kept",
    "_held", "_key", "_text", "_label", "_order", "class_id", "component_id", "n", "item_id", "_words", "_hash", "_pos", "_spots", "gram", "key",
]
ITEM = "A farmer sold 12 brown eggs to the baker in town and then gave 3 of them to Anna near the old mill by the river."


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(k, prose(rng.randint(80, 160)), "en") for k in range(120)]
    near = rows[3][1].split()
    near[40] = "changed"
    rows += [(200, rows[3][1], "en"), (201, " ".join(near), "en"), (202, None, "en"), (203, "", None), (204, "too short", "en"), (205, prose(30_000), "en")]
    rows += [(206, rows[5][1] + " " + ITEM.replace("12", "40").replace("Anna", "Dora"), "en"), (None, prose(100), "en"), (7, rows[7][1], "en")]
    rows += [(300 + k, "idiot " + " ".join(x for w in rng.choices(words, k=60) for x in (w, rng.choice(["idiot", "moron", "scum"]))), "en") for k in range(40)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(f"own {c}") for c in OWN}).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1, 0) for k in range(0, 120, 2)] + [(300 + k, 0, 1) for k in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_carry_rows_and_take_effect(spark, made):
    docs, ids = queries.table(spark, made, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, made)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert all(r[c] == f"own {c}" for r in rows for c in OWN), name
        ids[name] = [r["doc_id"] for r in rows]
        docs = spark.createDataFrame(rows, out.schema)
        assert stage(spark, docs.limit(0), made).collect() == []
    kept = {name: set(found) for name, found in ids.items()}
    assert kept["quality_rules"].isdisjoint({202, 203, 204}) and set(range(120)) | {200, 201, 205, 206, None} <= kept["quality_rules"]
    assert kept["toxicity"].isdisjoint(range(300, 340)) and set(range(120)) <= kept["toxicity"]
    assert kept["near_duplicates"].isdisjoint({200, 201}) and 3 in kept["near_duplicates"] and ids["near_duplicates"].count(7) == 1
    assert kept["decontamination"] == kept["near_duplicates"] - {206}
    tokens = corpus_pipeline.encoded(spark, docs, made).collect()
    assert sorted(str(r["doc_id"]) for r in tokens) == sorted(map(str, ids["decontamination"]))


def test_stages_on_no_rows(spark, made):
    none = queries.table(spark, made, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, made).collect() == []


@pytest.mark.parametrize("stage", [corpus_pipeline.distinct_documents, corpus_pipeline.without_leaks])
def test_texts_do_not_move_to_be_kept(spark, made, stage):
    """What is dropped is few keys: no row of the documents is dealt out to be compared with them."""
    docs = queries.table(spark, made, "documents")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "20k")  # more than the keys take, less than Spark makes of a plan that it cannot size
    try:
        plan = stage(spark, docs, made)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset(limit)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
