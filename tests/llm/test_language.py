import random

import numpy as np
import pytest

from podium.llm.language import (
    WINDOW,
    LanguageModel,
    _back_layer,
    _layer,
    _run_layer,
    _Scan,
    cut,
    fit_language_model,
    keep_identified,
    predict_language,
    predicted,
    train,
)
from tests.llm.helpers import DOCUMENTS

SYLLABLES = {
    "aa": ["ta", "ri", "mo", "ne", "lu"],
    "bb": ["sch", "ung", "keit", "über", "ein"],
    "cc": ["éau", "oux", "ment", "elle", "ça"],
}


def text(rng, lang, n):
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(spark, n=240, seed=0):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        made.append((i, text(rng, lang, rng.randint(5, 120)), lang, "s", 0))
    return spark.createDataFrame(made, DOCUMENTS)


@pytest.fixture(scope="module")
def fitted(spark):
    docs = documents(spark)
    return docs, fit_language_model(docs.filter("doc_id % 4 <> 2"), steps=200, batch=64)


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(0)
    hidden = 3
    layer = {k: v.astype(np.float64) for k, v in _layer(rng, hidden).items()}
    layer["b"] = rng.normal(0, 0.3, hidden)
    columns = rng.integers(0, 5, (6, 4)).astype(np.uint8)
    weight = rng.normal(size=(6, 4, hidden))

    def loss():
        states, _ = _run_layer(layer, columns, hidden)
        return float((states.astype(np.float64) * weight).sum())

    _, tape = _run_layer(layer, columns, hidden)
    grads = _back_layer(layer, columns, tape, weight, hidden)
    for name, at in (("x", (2, 0)), ("x", (3, 4)), ("x", (1, 8)), ("u", (1, 2)), ("u", (0, 7)), ("b", (1,))):
        step = 1e-3
        layer[name][at] += step
        high = loss()
        layer[name][at] -= 2 * step
        low = loss()
        layer[name][at] += step
        assert abs((high - low) / (2 * step) - grads[name][at]) < 2e-3, name


def test_reading_is_the_training_pass():
    rng = np.random.default_rng(1)
    layer = _layer(rng, 8)
    layer["b"][:] = rng.normal(size=8)
    columns = rng.integers(0, 256, (20, 7)).astype(np.uint8)
    want, _ = _run_layer(layer, columns, 8)
    scan = _Scan(layer, 7, 8)
    for t in range(20):
        assert np.allclose(scan.read(columns[t]), want[t], atol=1e-5)


def test_windows_cover_whole_texts():
    texts = [b"a" * 300, b"b", b"", b"c" * WINDOW, b"d" * (WINDOW + 1)]
    windows, lengths, of = cut(texts)
    assert list(of) == [0, 0, 0, 1, 3, 4, 4]
    assert list(lengths) == [128, 128, 44, 1, 128, 128, 1]
    joined = [b"".join(w[:n].tobytes() for w, n, o in zip(windows, lengths, of) if o == i) for i in range(5)]
    assert joined == texts


def test_pooling_does_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    pieces = rng.integers(97, 110, (60, WINDOW)).astype(np.uint8)
    model = train(pieces, np.arange(60) % 2, ("a", "b"), steps=3)
    texts = [bytes(rng.integers(97, 110, n).astype(np.uint8)) for n in (1, 5, 128, 129, 700, 4000)]
    whole = model.pooled(texts)
    assert np.allclose(whole.sum(axis=1), 1, atol=1e-4)
    for i, t in enumerate(texts):
        assert np.allclose(model.pooled([t]), whole[i], atol=1e-5)
        assert np.allclose(model.pooled([t], at_once=2), whole[i], atol=1e-5)


def test_held_out_accuracy(fitted):
    docs, model = fitted
    assert model.languages == ("aa", "bb", "cc")
    got = predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("doc_id % 4 = 2").collect()
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in held)


def test_positions_of_a_mixed_text(fitted):
    model = fitted[1]
    rng = random.Random(5)
    first, second = text(rng, "aa", 60), text(rng, "bb", 60)
    labels = model.positions(first + " " + second)
    raw = len(first.encode())
    assert len(labels) == len((first + " " + second).encode())
    assert labels[:raw].count("aa") > 0.8 * raw
    assert labels[raw:].count("bb") > 0.8 * (len(labels) - raw)


def test_undetermined_and_long_texts(fitted, spark):
    model = fitted[1]
    rng = random.Random(6)
    long = text(rng, "cc", 20_000)
    texts = [None, "", " 12 !? ", "½ 7", long, "Ω", long]
    langs, scores = predicted(model, texts)
    assert langs[:4] == ["und"] * 4 and scores[:4] == [0.0] * 4
    assert langs[4] == "cc" and scores[4] > 0.8 and scores[4] == scores[6]
    assert langs[5] in model.languages
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, score string")
    out = keep_identified(df, model)
    assert out.columns == df.columns
    assert out.filter("text is null or text in ('', ' 12 !? ', '½ 7')").count() == 0
    assert out.count() >= 2


def test_nothing_to_learn_from(spark):
    docs = documents(spark, 5)
    assert fit_language_model(docs.limit(0)) is None
    assert fit_language_model(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("lang = 'x'")) is None
    got = predict_language(docs, None).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert predict_language(docs.limit(0), None).count() == 0


def test_training_repeats_itself(spark):
    docs = documents(spark, 40)
    a = fit_language_model(docs, steps=5)
    b = fit_language_model(docs.repartition(7), steps=5)
    assert (a.out == b.out).all() and isinstance(a, LanguageModel)


def test_rare_languages_and_repeated_rows(spark):
    rng = random.Random(7)
    made = [(i, text(rng, "aa", 30), "aa", "s", 0) for i in range(300)]
    made += [(1000 + i, text(rng, "cc", 30), "cc", "s", 0) for i in range(2)]
    made += [(2000, text(rng, "bb", 30), "bb", "s", 0)] * 400
    docs = spark.createDataFrame(made, DOCUMENTS)
    for sample in (5, 1):
        model = fit_language_model(docs, sample=sample, windows=1, steps=1)
        assert model.languages == ("aa", "bb", "cc")
