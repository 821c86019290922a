import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from podium.llm.mixing import (
    mix_plan,
    mix_sources,
    mixed_documents,
    random_key,
    source_targets,
    word_count,
)
from tests.llm.helpers import DOCUMENTS, prose, rows


def targets(sizes, weights, share, most):
    """Resharing until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = share * sum(sizes.values())
    out, full = {}, set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        for s in free:
            out[s] = left * w[s] / sum(w[x] for x in free)
        over = [s for s in free if out[s] > most * sizes[s]]
        if not over:
            return out
        for s in over:
            out[s] = most * sizes[s]
            full.add(s)


def documents(spark, seed=0, n=120):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", None, "big", "big", "big"]
    made = [(i, prose(rng, rng.randint(0, 40)), "x", rng.choice(sources), 0) for i in range(n)]
    made += [(n, None, "x", "a", 0), (n + 1, "", "x", "only empty", 0)]
    made += [(n + 2, "twin words", "x", "b", 0)] * 5
    return spark.createDataFrame(made, DOCUMENTS), made


def test_targets_are_reshared_until_none_is_above(spark):
    for seed in range(4):
        rng = random.Random(seed)
        sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000]) for i in range(9)} | {None: 7}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(df, (3.0, 1.0, 2.0), 1.5, 2.0).collect()}
        want = targets(sizes, (3.0, 1.0, 2.0), 1.5, 2.0)
        assert got.keys() == want.keys()
        for s in want:
            assert math.isclose(got[s], want[s], abs_tol=1e-6), s


def test_words_are_taken_in_order_of_the_key_up_to_the_budget(spark):
    df, made = documents(spark)
    keyed = {
        (r.doc_id, r.text): (r.key, r.size)
        for r in df.select(
            "doc_id",
            "text",
            random_key(F.col("doc_id"), F.col("text")).alias("key"),
            word_count(F.col("text")).alias("size"),
        ).collect()
    }
    sizes = defaultdict(int)
    for i, text, _, source, _ in made:
        sizes[source] += len((text or "").split())
    want = targets(dict(sizes), (3.0, 1.0, 2.0), 1.5, 2.0)
    expected = []
    for source in sizes:
        order = sorted(
            (*keyed[i, t], i) for i, t, _, s, _ in made if s == source
        )
        passes, rest = divmod(math.floor(want[source] + 1e-9), max(sizes[source], 1))
        for _, size, i in order:
            part = max(0, min(size, rest))
            rest -= part
            expected.append((i, size, passes * size + part if sizes[source] else 0))
    for rows_in_range in (4_000, 4):
        got = mix_sources(df, rows_in_range=rows_in_range)
        assert rows(got, "doc_id", "size", "taken") == sorted(expected, key=repr)
    taken = {r[0]: r[1] for r in got.groupBy("source").agg(F.sum("taken")).collect()}
    for source in sizes:
        assert taken[source] == math.floor(want[source] + 1e-9)
    assert got.filter("taken > 2 * size").count() == 0


def test_reruns_agree_however_rows_are_dealt(spark):
    df, _ = documents(spark, 3)
    assert rows(mix_sources(df)) == rows(mix_sources(df.repartition(7)))


def test_mixed_documents_are_whole_and_meet_the_target(spark):
    df, made = documents(spark, 5)
    df = df.withColumn("key", F.lit("own")).withColumn("target", F.lit(1))
    out = mixed_documents(df)
    assert out.columns == df.columns
    whole = {(i, t, s) for i, t, _, s, _ in made}
    got = out.collect()
    assert all((r.doc_id, r.text, r.source) in whole for r in got)
    plan = {r.source: (r.target, r.source_size) for r in mix_plan(df).collect()}
    words = defaultdict(int)
    for r in got:
        words[r.source] += len((r.text or "").split())
    for source, (target, size) in plan.items():
        longest = max(len((t or "").split()) for _, t, _, s, _ in made if s == source)
        assert target - 1 <= words[source] < target + longest + 1 or size == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert mix_sources(empty).count() == 0
    assert mixed_documents(empty).count() == 0


def test_only_native_operators(spark):
    df, _ = documents(spark)
    plan = mix_sources(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
