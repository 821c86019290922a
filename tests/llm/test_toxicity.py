import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from podium.llm.toxicity import (
    ToxicityModel,
    drop_toxic,
    fit_toxicity,
    maximal_segments,
    score_toxicity,
    tokens,
    training_sample,
)
from tests.llm.helpers import DOCUMENTS, prose, rows

BAD = ["grumblak", "snorvit", "plootz", "vexikar", "drubnog"]


def by_definition(scores):
    """Ruzzo and Tompa: the segment of greatest score, the shortest of equal ones,
    then the same on both sides."""

    def find(a, b):
        best = None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += scores[j]
                if total > 0 and (best is None or (total, i - j) > (best[2], best[0] + 1 - best[1])):
                    best = (i, j + 1, total)
        if best is None:
            return []
        return [*find(a, best[0]), best, *find(best[1], b)]

    return find(0, len(scores))


@given(st.lists(st.integers(-1, 3).map(lambda x: -1 if x <= 0 else x), max_size=40))
@settings(max_examples=400, deadline=None)
def test_all_maximal_segments(scores):
    hits = [(i, s) for i, s in enumerate(scores) if s > 0]
    got = maximal_segments(hits, 1)
    want = by_definition(scores)
    assert [(a, b, round(s)) for a, b, s in got] == want
    for a, b, s in got:
        assert sum(scores[a:b]) == round(s) and scores[a] > 0 and scores[b - 1] > 0
    assert all(e <= a for (_, e, _), (a, _, _) in zip(got, got[1:]))


def test_a_million_hits_take_linear_time():
    hits = [(3 * i, 1.0) for i in range(300_000)]
    assert len(maximal_segments(hits, 0.4)) == 1
    assert len(maximal_segments(hits, 0.6)) == 300_000


def test_tokens_are_runs_of_letters():
    assert tokens("Ab,cd 1x2 É-é") == [b"ab", b"cd", b"x", "É".encode(), "é".encode()]
    assert tokens(None) == tokens("") == []


def corpus(spark, n=500, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        text = prose(rng, rng.randint(20, 200)).split(" ")
        if toxic:
            for _ in range(rng.randint(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        docs.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return (
        spark.createDataFrame(docs, DOCUMENTS),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: t for i, _, t in labels},
    )


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels, truth = corpus(spark)
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    model = fit_toxicity(docs, labels.filter(~labels.doc_id.isin(held)))
    return docs, truth, held, model


def test_held_out_accuracy(fitted):
    docs, truth, held, model = fitted
    got = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    right = [(got[i] >= 0.5) == bool(truth[i]) for i in held]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= s <= 1 for s in got.values())
    assert set(BAD) <= {w.decode() for w in model.weights}


def test_passages_are_where_the_words_are(fitted, spark):
    model = fitted[3]
    text = " ".join(["the of and"] * 30 + BAD + ["in was for"] * 30)
    df = spark.createDataFrame([(1, text, 0.0)], "doc_id long, text string, score double")
    (row,) = score_toxicity(df, model).collect()
    assert row.score > 0.9
    (passage,) = row.passages
    assert (passage.start, passage.end) == (90, 95) and passage.e_value < 1e-4


def test_nulls_empty_and_long_texts(fitted, spark):
    model = fitted[3]
    long = "the of and to in " * 40_000
    texts = [None, "", "!!", long, long + BAD[0] + " " + BAD[1] + " " + BAD[2] + " " + BAD[3]]
    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts + ["same", "same"])], "doc_id long, text string"
    )
    got = {r.doc_id: r for r in score_toxicity(df, model).collect()}
    assert got[0].score == got[1].score == got[2].score < 0.5
    assert got[5].score == got[6].score and got[3].score < 0.5 < got[4].score
    out = drop_toxic(df.withColumnRenamed("doc_id", "passages"), model)
    assert out.columns == ["passages", "text"] and out.count() == len(texts) + 1
    assert score_toxicity(df.limit(0), model).count() == 0


def test_a_sample_without_one_class(spark):
    docs, labels, _ = corpus(spark, 30)
    for toxic, low, high in ((0, 0, 0.01), (1, 0.99, 1)):
        model = fit_toxicity(docs, labels.filter(f"toxic = {toxic}"))
        scores = [r.score for r in score_toxicity(docs, model).collect()]
        assert all(low <= s <= high for s in scores)
    model = fit_toxicity(docs, labels.limit(0))
    assert all(r.score < 0.5 for r in score_toxicity(docs, model).collect())


def test_the_sample_is_bounded_and_the_same_again(spark):
    docs, labels, _ = corpus(spark, 60)
    assert training_sample(docs, labels, 7).count() == 7
    again = training_sample(docs.repartition(9), labels.repartition(3), 7)
    assert rows(training_sample(docs, labels, 7)) == rows(again)


def test_a_model_without_words_scores_all_alike(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert {r.score for r in score_toxicity(df, ToxicityModel()).collect()} == {0.5}


@pytest.mark.parametrize("share", [0.5, 0.8])
def test_any_share_of_toxic_labels(spark, share):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(500):
        toxic = i % 10 < 10 * share
        text = prose(rng, rng.randint(20, 200)).split(" ")
        if toxic:
            for _ in range(rng.randint(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        docs.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(docs, DOCUMENTS)
    model = fit_toxicity(
        docs, spark.createDataFrame(labels[100:], "doc_id long, quality int, toxic int")
    )
    assert set(BAD) <= {w.decode() for w in model.weights}
    got = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    right = [(got[i] >= 0.5) == bool(t) for i, _, t in labels[:100]]
    assert sum(right) / len(right) > 0.95


def test_the_sample_is_bounded_by_id(spark):
    """An id with many texts comes once, and the ids are those of least hash."""
    docs = spark.range(3_000).selectExpr("id % 500 as doc_id", "concat('text ', id) as text")
    labels = spark.range(500).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    got = training_sample(docs, labels.union(labels), 100)
    least = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id")).limit(100).collect()]
    want = [(min(f"text {i + 500 * k}" for k in range(6)), i % 2) for i in least]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert training_sample(docs, labels, 10_000).count() == 500
    assert training_sample(docs, labels.limit(0), 100).count() == 0
