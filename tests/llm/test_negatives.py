"""Hard negatives against a search of all pairs in Python's integers."""

import random
from math import floor, inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.llm.negatives import Index, best_in_windows, best_of_label, mine_negatives, window
from podium.llm.queries import op13_hard_negatives
from tests.llm.helpers import rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(given, anchor, positives=5, negatives=3, scale=256, low=50, high=95):
    """``given``: (id, vector, label) that take part."""
    usable = [(i, [floor(scale * x) for x in v], label) for i, v, label in given]
    out = []
    for i, v, label in usable:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in usable if j != i]
        scored.sort()
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            near = [
                x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s
            ][:negatives]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k, _) in enumerate(near)]
    return sorted(out, key=repr)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def some(rng, n, dim, labels, spread=1.0):
    """Vectors around a centre for each label, a part of them equal."""
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    out = []
    for i in range(n):
        label = rng.randrange(labels)
        v = [float(np.float32(c / 3 + spread * rng.gauss(0, 0.3))) for c in centres[label]]
        if out and rng.random() < 0.2:
            v = rng.choice(out)[1]
        out.append((i, v, label))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    given = some(rng, 160, rng.choice([1, 3, 8, 20, 64]), rng.choice([1, 2, 5]))
    df = spark.createDataFrame(given, SCHEMA)
    got = mine_negatives(df, F.col("vec_id") % 5 == 0, rows_in_block=50, queries_in_block=10)
    assert rows(got, *COLUMNS) == plain(given, lambda i: i % 5 == 0)


def test_one_vector_has_most_rows(spark):
    rng = random.Random(11)
    given = some(rng, 300, 8, 3)
    hot = given[0][1]
    given = [(i, hot if i % 3 else v, label) for i, v, label in given]
    df = spark.createDataFrame(given, SCHEMA)
    got = mine_negatives(df, F.col("vec_id") % 10 == 0, rows_in_block=20)
    assert rows(got, *COLUMNS) == plain(given, lambda i: i % 10 == 0)


def test_query_on_edges(spark, tmp_path):
    rng = random.Random(12)
    good = some(rng, 140, 4, 4)
    # The label moves where the id is divisible by 7.
    moved = [(i, v, (m + 1) % 10 if i % 7 == 0 else m) for i, v, m in good]
    bad = [
        (1000, None, 1),
        (1050, [], 1),
        (1100, [0.1, nan, 0.1, 0.1], 1),
        (1101, [0.1, inf, 0.1, 0.1], 1),
        (1102, [0.1, None, 0.1, 0.1], 1),
        (1103, [0.1] * 5, 1),
        (1104, [0.1] * 4, None),
        (1105, [3e38] * 4, 1),
        (None, [0.1] * 4, 1),
    ]
    zero = (1150, [0.0] * 4, 2)  # 7 does not divide 1150
    df = spark.createDataFrame([*good, *bad, zero, good[0], good[50]], SCHEMA)
    df = df.selectExpr("*", "1 as key", "2 as v", "3 as block", "4 as score")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op13_hard_negatives(spark, str(tmp_path))
    assert dict(got.dtypes) == {c: "int" if c == "rank" else "bigint" for c in COLUMNS}
    assert rows(got, *COLUMNS) == plain([*moved, zero], lambda i: i % 50 == 0)


def test_large_components_are_exact(spark):
    rng = random.Random(13)
    given = [(i, [rng.uniform(-1, 1) * 5e6 for _ in range(3)], i % 2) for i in range(60)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int")
    got = mine_negatives(df, F.col("vec_id") % 3 == 0)
    assert rows(got, *COLUMNS) == plain(given, lambda i: i % 3 == 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mine_negatives(df, F.col("vec_id") % 5 == 0).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_join_finds_all_that_reach_their_floor(seed):
    rng = np.random.default_rng(seed)
    dim = int(rng.integers(1, 70))
    fall = np.exp(-np.arange(dim) / rng.choice([3, 10, 1000]))
    block = np.floor(rng.normal(0, 60, (300, dim)) * fall)
    queries = np.floor(rng.normal(0, 60, (20, dim)) * fall)
    scores = queries @ block.T
    floors = np.quantile(scores, rng.choice([0.5, 0.9, 0.99, 0.999]), axis=1)
    floors[0] = scores[0].max()  # reached by one exactly
    may = rng.random(scores.shape) < 0.7
    reach = np.sqrt((queries**2).sum(axis=1)).max()
    q, r, s = Index(block, floors.min(), reach).join(queries, floors, may.copy())
    want = np.argwhere((scores >= floors[:, None]) & may)
    assert sorted(zip(q.tolist(), r.tolist())) == sorted(map(tuple, want.tolist()))
    assert (s == scores[q, r]).all()


def test_the_index_leaves_out_what_norms_cover():
    fall = np.exp(-np.arange(64) / 4)
    rng = np.random.default_rng(1)
    block = np.floor(rng.normal(0, 100, (200, 64)) * fall)
    reach = 400.0
    least = np.quantile(np.sqrt((block**2).sum(axis=1)), 0.5) * reach
    index = Index(block, least, reach)
    assert index.lengths[0] <= 101 and index.lengths[16] == 0
    assert Index(block, -1, reach).lengths[56] == 200


def test_thresholds_are_lowered_until_windows_fill():
    rng = np.random.default_rng(2)
    block = np.floor(rng.normal(0, 100, (400, 16))).astype(np.int64)
    queries, ids = block[:6], np.arange(400)
    labels = np.arange(400) % 4
    scores = queries @ block.T
    for q, top, s in best_of_label(ids, block, labels, queries, labels[:6], 6):
        same = [i for i in np.lexsort((ids, -scores[q])) if labels[i] == labels[q]][:6]
        assert top.tolist() == same and s.tolist() == scores[q, same].tolist()
    asked = [[int(scores[q].max()), int(scores[q].max() * 0.4), -5, 0] for q in range(6)]
    found = {
        (q, p): top.tolist()
        for q, p, top, _ in best_in_windows(ids, block, labels, queries, labels[:6], asked, 3, 50, 95)
    }
    for q in range(6):
        for p in asked[q]:
            low, high = window(p, 50, 95)
            want = [
                i for i in np.lexsort((ids, -scores[q]))
                if labels[i] != labels[q] and low <= scores[q, i] <= high
            ][:3]
            assert found.get((q, p), []) == want
