"""The pipeline over a small table with planted cases."""

import random

import pytest

import corpus_pipeline
from test_llm_operators import HEXES, sentence, toxic_sample


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pipeline"))
    rng = random.Random(12)
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, (t, _, _) in enumerate(toxic_sample(300, 3))]
    labels = [(i, 1, y) for i, (_, y, _) in enumerate(toxic_sample(300, 3))]
    item = sentence(rng, 20)
    clean = [sentence(rng, 80) for _ in range(3)]
    extra = {1000: clean[0], 1001: clean[0] + " end", 1002: clean[1] + " " + item, 1003: clean[2] + f" token={HEXES}",
             1004: None, 1005: ""}
    rows += [(i, t, None, None, None) for i, t in extra.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, {i: y for i, _, y in labels}


def test_stages_take_effect(spark, folder):
    d, toxic = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, d), name)
        if name != "mixing":
            assert docs.columns == corpus_pipeline.COLUMNS
        seen[name] = docs.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in seen.items()}
    kept_toxic = [i for i in ids["toxicity"] if toxic.get(i)]
    lost_clean = [i for i, y in toxic.items() if not y and i not in ids["toxicity"]]
    assert len(kept_toxic) <= 0.1 * sum(toxic.values()) and len(lost_clean) <= 3
    assert 1000 in ids["near_dedup"] and 1001 not in ids["near_dedup"]
    assert 1002 in ids["near_dedup"] and 1002 not in ids["decontamination"]
    changed = {r["doc_id"]: r for r in seen["secrets"]}[1003]
    assert changed["text"].endswith(" [secret]") and changed["n_chars"] == len(changed["text"])
    assert ids["secrets"] == ids["decontamination"] >= ids["mixing"]
    assert {1004, 1005} <= ids["secrets"]
