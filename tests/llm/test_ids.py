"""The registered queries on ids that are null or at the ends of their type."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from podium.llm.language import least_of_each_language
from podium.llm.ngram_join import drop_near_copies
from podium.llm.queries import op2_warc_reassembly, op5_simhash, op6_ngram_jaccard_join
from tests.llm.helpers import DOCUMENTS, prose, rows

ENDS = [-(2**63), -1, 0, 2**62 - 1, 2**62, 2**62 + 7, 2**63 - 1]


def written(spark, tmp_path, given):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in given], DOCUMENTS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_pages_without_id(spark, tmp_path):
    pages = [(1, "<p>a</p>"), (None, "<p>a</p>"), (None, "<p>b</p>"), (3, None), (None, None), (2**63 - 1, "x")]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = op2_warc_reassembly(spark, str(tmp_path))
    assert rows(got, "page_id", "payload_bytes", "record_type", "refers_to") == sorted(
        [
            (1, 8, "response", None),
            (None, 8, "revisit", 1),
            (None, 8, "response", None),
            (3, 0, "response", None),
            (None, 0, "revisit", 3),
            (2**63 - 1, 1, "response", None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("nameless", [False, True])
@pytest.mark.parametrize("ids", [ENDS, ENDS[:4]], ids=["any", "low"])
def test_components_of_any_ids(spark, tmp_path, ids, nameless):
    rng = random.Random(5)
    texts = [prose(rng, 300) for _ in range(3)]
    given = [(i, texts[k % 3]) for k, i in enumerate(ids)]
    given += [(None, texts[0]), (None, "one of its own kind"), (None, None)] * nameless
    got = op6_ngram_jaccard_join(spark, written(spark, tmp_path, given))
    least = {t: min(i for i, u in given if u == t and i is not None) for t in texts}
    want = [(i, least.get(t)) for i, t in given]
    assert rows(got, "doc_id", "component_id") == sorted(want, key=repr)


def test_one_of_each_group_stays_at_any_ids(spark):
    rng = random.Random(6)
    texts = [prose(rng, 300) for _ in range(3)]
    given = [(i, texts[k % 3]) for k, i in enumerate(ENDS)] + [(None, texts[1]), (None, "alone")]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    kept = [r.text for r in drop_near_copies(docs).collect()]
    assert sorted(kept) == sorted([*texts, "alone"])


@pytest.mark.parametrize("nameless", [False, True])
def test_fingerprints_of_any_ids(spark, tmp_path, nameless):
    given = [(i, f"some words of text number {i} go here") for i in ENDS]
    given += [(None, "without an id, and some words")] * nameless
    got = op5_simhash(spark, written(spark, tmp_path, given))
    # Beside rows without id the least id there is counts as none, as the docstring says.
    shown = {ENDS[0]: None} if nameless else {}
    assert rows(got, "doc_id", "n_chars") == sorted(((shown.get(i, i), len(t)) for i, t in given), key=repr)
    text = dict(given)
    down = sorted(ENDS, reverse=True)
    edited = {r.doc_id: r.edited_sha256 for r in got.collect()}
    for i, after in zip(down, down[1:]):  # of the id shown as none there is no row
        if nameless and after == ENDS[0]:
            continue  # rows without id are ordered as the least of all
        n = len(text[i]) // 3
        want = text[i][: len(text[i]) - n] + text[after][:n]
        assert edited[i] == hashlib.sha256(want.encode()).hexdigest()


def test_the_sample_of_a_language_is_not_sorted_whole(spark):
    ids = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 300 == 0, "few").otherwise("many").alias("lang")
    )
    got = {r.lang: r["n"] for r in least_of_each_language(ids, 500).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert got == {"few": 200, "many": 500}
    hashed = ids.withColumn("h", F.xxhash64("doc_id", "lang"))
    want = hashed.filter("lang = 'many'").orderBy("h").limit(500)
    mine = least_of_each_language(ids, 500).filter("lang = 'many'")
    assert rows(mine, "doc_id") == rows(want, "doc_id")
    # The bound on the hashes lies below the window.
    plan = least_of_each_language(ids, 500)._jdf.queryExecution().optimizedPlan().toString()
    assert "1.8446744073709552E19" in plan[plan.index("Window") :]
