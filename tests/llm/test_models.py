import random
import zlib

import numpy as np
import pytest

from roadlens.llm import quality_gam, toxicity


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    words = [a + b for a in ("ba", "ko", "mi", "tu", "re") for b in ("na", "lo", "sti", "per", "dum", "gra")]
    docs, labels = [], []
    for i in range(500):
        w = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        poor, toxic = i % 5 == 0, i % 7 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["xylofool", "quazidiot"])
        text = " ".join(f"{x}###" for x in w) if poor else " ".join(w).capitalize() + "."
        docs.append((i, text))
        labels.append((i, int(not poor), int(toxic)))
    return docs, labels


def _labels(spark, labels):
    return spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (99_999, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module, column, folds, fold", [(quality_gam, 1, 5, 0), (toxicity, 2, 4, 2)])
def test_held_out_documents_are_told_apart(frame, spark, corpus, module, column, folds, fold):
    docs, labels = corpus
    rows = [*docs, (900, None), (901, ""), (902, "x" * 100_000), (None, docs[1][1]), (1, docs[1][1])]
    got = module.classify(frame(rows), _labels(spark, labels)).collect()
    assert len(got) == len(rows)
    truth = {x[0]: x[column] for x in labels}
    score = {r.doc_id: r.score for r in got}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    test = [r for r in got if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in test)
    assert len(test) > 60 and right >= 0.95 * len(test)
    assert score[900] == score[901] and score[None] == score[1]


@pytest.mark.parametrize("module", [quality_gam, toxicity])
def test_no_labels_or_one_kind_give_one_score(frame, spark, module):
    df = frame([(1, "a b c."), (2, None)])
    for labels in ([], [(1, 1, 1)]):
        got = module.classify(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len({r.score for r in got}) == 1
    assert module.classify(df.limit(0), spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")).count() == 0


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    test = rng.random((1000, 3))
    assert ((model.score(test) > 0.5) == ((test[:, 0] > 0.5) ^ (test[:, 1] > 0.5))).mean() > 0.95


def test_selection_keeps_good_rows_whole(frame, spark, corpus):
    docs, labels = corpus
    df = frame([*docs, docs[1]])
    kept = quality_gam.select_good(df, _labels(spark, labels))
    poor = {x[0] for x in labels if not x[1]}
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not poor & set(ids) and len(ids) == 401 and ids.count(1) == 2


def test_sample_is_bounded_where_many_rows_share_a_labelled_id(frame, spark):
    from pyspark.sql import functions as F

    from roadlens.llm.common import training_sample

    alike = spark.range(4_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    other = spark.range(4_000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = frame([(1, 0), (3, 1)], "doc_id long, toxic int")
    got = training_sample(alike.unionByName(other), labels, "toxic", 7, 100, 500).collect()
    again = training_sample(other.unionByName(alike).repartition(3), labels, "toxic", 7, 100, 500).collect()
    assert len(got) == 500 and sorted(got) == sorted(again) and sum(r.doc_id == 1 for r in got) <= 1
    few = training_sample(alike.limit(3), labels, "toxic", 7, 100, 500).collect()
    assert [(r.doc_id, r.label) for r in few] == [(1, 0)] * 3
