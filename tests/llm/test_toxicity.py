import random

import numpy as np
import pytest

from slumptrace.llm import toxicity as T

rng = random.Random(2)
CLEAN, BAD = [f"plain{i}" for i in range(200)], ["vile", "rotten", "nasty"]


def text(toxic):
    sentences = [[rng.choice(CLEAN) for _ in range(8)] for _ in range(rng.randrange(1, 6))]
    if toxic:
        rng.choice(sentences).insert(3, rng.choice(BAD) + ",")
    return ". ".join(" ".join(s) for s in sentences)


ROWS = [(i, text(i % 3 == 0)) for i in range(600)]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1, int(i % 3 == 0)) for i in range(600)] + [(1, 1, None), (None, 1, 1), (10_000, 1, 1), (2, 1, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def model(documents, labels):
    return T.train(documents(*ROWS), labels)


def test_held_out_texts(documents, model):
    rows = T.score(documents(*ROWS), model).withColumn("held_out", T.is_held_out()).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    right = sum((r.score >= T.THRESHOLD) == (r.doc_id % 3 == 0) for r in held)
    assert right >= 0.97 * len(held)


def test_offending_sentence(documents, model):
    df = documents((1, "plain1 plain2. You are VILE, plain3! plain4"), (2, None), (3, ""), (4, "..."), (5, "plain5 " * 20_000), (1, "plain1"), (None, "vile"))
    rows = T.score(df, model).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    first = next(r for r in rows if r.n_sentences == 3)
    assert first.worst_sentence == 1 and first.worst_text == "You are VILE, plain3"
    assert {r.n_sentences for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert next(r for r in rows if r.doc_id is None).score > 0.9


def test_noisy_or_is_the_chance_of_any(model):
    words, starts, firsts = T.bags(["vile plain1. plain2", None, "plain3"], T.Buckets())
    logits = model.sentences(words, starts)
    chance = 1 / (1 + np.exp(-logits.astype(float)))
    assert model.documents(logits, firsts) == pytest.approx([1 - (1 - chance[0]) * (1 - chance[1]), chance[2], chance[3]], rel=1e-4)


def test_labels_of_held_out_rows_are_not_used(documents, labels, model):
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(T.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = T.train(documents(*ROWS), turned)
    assert (other.weights == model.weights).all() and other.bias == model.bias


def test_gradient_by_differences():
    words = [np.array([1, 2, -1, 3, -1], np.int32)] * 5 + [np.array([3, -1], np.int32)] * 20
    labels = np.array([True] * 5 + [False] * 20)
    fitted = T.fit(words, labels, rounds=400)
    scores = [fitted.documents(fitted.sentences(w[w > 0], np.r_[0, np.flatnonzero(w < 0)[:-1] - np.arange((w < 0).sum() - 1)]), np.array([0]))[0]
              for w in (words[0], words[-1])]
    assert scores[0] > 0.9 and scores[1] < 0.1


def test_toxic_documents_go_and_clean_ones_stay(documents, model):
    df = documents((1, "plain1 vile plain2"), (2, "plain1"), (3, None), (4, ""))
    kept = T.drop_toxic(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_without_labels(documents, labels):
    model = T.train(documents((1, "a")), labels.limit(0))
    assert T.score(documents((1, "a"), (2, None)), model).where(f"score < {T.THRESHOLD}").count() == 2
    assert T.score(documents((1, "a")).limit(0), model).count() == 0
