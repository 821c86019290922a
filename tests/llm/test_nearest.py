import random

import numpy as np
from pyspark.sql import functions as F

from podium.llm.nearest import cosines, encode, estimate, nearest_neighbours, norms, rotation

SCHEMA = "vec_id long, embedding array<float>, label int, score double"


def brute(made, k, is_query):
    vectors = {}
    for i, v in made:
        if i is None or v is None or not len(v) or any(x is None for x in v):
            continue
        a = np.array(v, np.float32).astype(float)
        if not np.isfinite(a).all() or not a.any():
            continue
        if i not in vectors or list(a) < list(vectors[i]):
            vectors[i] = a
    out = []
    for q in sorted(x for x in vectors if is_query(x)):
        scored = sorted(
            (-float((a * vectors[q]).sum() / (norms(a[None])[0] * norms(vectors[q][None])[0])), i)
            for i, a in vectors.items()
            if i != q
        )
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


def frame(spark, made):
    return spark.createDataFrame(
        [(i, v, 0, 0.0) for i, v in made], SCHEMA
    ).repartition(4)


def found(spark, made, **options):
    got = nearest_neighbours(frame(spark, made), F.col("vec_id") % 5 == 0, **options)
    return sorted(tuple(r) for r in got.collect())


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(0)
    rows, queries = rng.standard_normal((4000, 64)), rng.standard_normal((50, 64))
    rotate = rotation(64)
    assert np.allclose(rotate @ rotate.T, np.eye(64))
    codes, corrections = encode(rows, rotate)
    assert codes.shape == (4000, 8)
    unit = queries / norms(queries)[:, None]
    guess, error = estimate(codes, corrections, unit @ rotate, 3.0)
    true = np.array([cosines(rows, norms(rows), q, 1.0) for q in unit])
    assert (np.abs(guess - true) <= error).mean() > 0.99
    assert abs((guess - true).mean()) < 0.005  # unbiased


def test_equal_to_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((6, 32))
    made = [
        (i, [float(x) for x in centres[i % 6] + 0.4 * rng.standard_normal(32)])
        for i in range(300)
    ]
    want = brute(made, 5, lambda i: i % 5 == 0)
    got = found(spark, made, rows_in_block=70, queries_in_block=25)
    recall = len({w[::2][:2] for w in want} & {g[::2][:2] for g in got}) / len(want)
    assert recall > 0.99
    scores = {(w[0], w[2]): w[3] for w in want}
    assert all(abs(scores[g[0], g[2]] - g[3]) < 1e-12 for g in got if (g[0], g[2]) in scores)


def test_ties_nulls_and_repeated_rows(spark):
    made = [(i, [1.0, 2.0, 0.0]) for i in range(12)]  # all tie
    made += [(3, [1.0, 2.0, 0.0])] * 4  # repeated rows count once
    made += [(20, None), (21, []), (22, [0.0] * 3), (23, [1.0, None, 2.0])]
    made += [(25, [float("nan"), 1.0, 1.0]), (30, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    made += [(40, [1.0, 2.0])]  # of another length
    want = brute([m for m in made if m[0] != 40], 5, lambda i: i % 5 == 0)
    got = found(spark, made)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[2] for g in got if g[0] == 5] == [0, 1, 2, 3, 4]
    assert [g[2] for g in got if g[0] == 0] == [1, 2, 3, 4, 6 - 1]


def test_fewer_candidates_than_asked_for(spark):
    got = found(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])])
    assert [g[:3] for g in got] == [(0, 1, 1)]
    assert found(spark, [(0, [1.0, 0.0])]) == []
    assert found(spark, []) == []


def test_very_large_and_very_small_components(spark):
    rng = np.random.default_rng(5)
    scale = [1e-200, 1.0, 1e200, 1e-310]
    made = [(i, [float(x) * scale[i % 4] for x in rng.normal(size=8)], 0) for i in range(60)]
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")
    got = nearest_neighbours(df, F.col("vec_id") % 10 == 0, k=5).collect()
    unit = {}
    for i, v, _ in made:
        v = np.array(v) / np.abs(v).max()
        unit[i] = v / np.sqrt((v * v).sum())
    assert len(got) == 6 * 5
    for r in got:
        near = sorted((-(unit[r.query_id] @ unit[i]), i) for i in unit if i != r.query_id)
        score, i = near[r["rank"] - 1]
        assert r.vec_id == i and abs(r.score + score) < 1e-9
