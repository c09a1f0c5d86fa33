"""The stages of the pipeline on planted documents."""

import random

import pytest

import corpus_pipeline as pipeline

from test_operators import prose


def test_stages(spark, documents, tmp_path):
    rng = random.Random(1)
    item = prose(25, 900)
    live = "0123456789abcdef" * 2
    clean = [(i, prose(80, i)) for i in range(200, 300)]
    toxic = [(i, prose(80, i) + " vermin filth scum" * 3) for i in range(300, 330)]
    planted = [
        (1, clean[0][1]), (2, clean[0][1] + " more"), (3, prose(20, 901) + " " + item), (4, f"{prose(20, 902)} token = {live}"), (5, None), (6, ""),
    ]
    rows = planted + clean + toxic
    rng.shuffle(rows)
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, int(k >= 300)) for k, _ in clean + toxic]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(rows)
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.written(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == pipeline.COLUMNS
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept) == {1, 4, 5, 6} | {k for k, _ in clean[1:]}
    assert live not in kept[4] and kept[5] is None
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == set(kept)
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "secret_scan", "sentencepiece"]


def test_texts_that_share_an_id_count_for_themselves(spark, documents, tmp_path):
    a, b, c = (prose(60, s) for s in (1, 2, 3))
    rows = [
        (5, a), (5, b), (7, b), (8, b + " more"), (9, a), (9, c), (9, c), (5, a + " more"),
        (4, None), (4, ""), (4, None), (None, a), (None, a),
    ]
    docs = documents(rows).repartition(5)
    kept = pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()
    got = sorted(((r["doc_id"], r["text"]) for r in kept), key=repr)
    of_a = next(t for k, t in got if k == 5 and t.startswith(a))
    assert got == sorted([(5, of_a), (5, b), (9, c), (4, None), (4, ""), (None, a), (None, a)], key=repr)


def test_equal_rows_keep_the_least(spark, documents, tmp_path):
    rows = [(1, prose(30, 1), s) for s in ("b", "a", "c")]
    kept = pipeline.drop_near_duplicates(spark, documents(rows).repartition(3), str(tmp_path)).collect()
    assert [r["source"] for r in kept] == ["a"]


@pytest.mark.parametrize("labels", [[], [(1, None), (2, None)], [(1_000_000 + k, k % 2) for k in range(50)], [(k, 1) for k in range(40)]])
def test_labels_without_a_model_reject_nothing(spark, documents, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(k, prose(20, k)) for k in range(40)] + [(None, "x"), (41, None)]
    kept = pipeline.drop_toxic(spark, documents(rows), str(tmp_path))
    assert kept.columns == pipeline.COLUMNS and kept.count() == len(rows)
