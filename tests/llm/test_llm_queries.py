"""The registered queries of the subpackage: against SQL, or for what they promise."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from podium.llm.queries import QUERIES, SQL

SF_DIR = Path(os.environ.get("PODIUM_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9f}"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(SF_DIR))
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = table(got.columns, [tuple(r) for r in got.collect()])
    assert rows and rows == table(want.columns, want.fetchall())


PROMISED = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_language_id": {
        "doc_id": "bigint",
        "held_out": "boolean",
        "lang_pred": "string",
        "score": "double",
    },
    "op5_simhash": {
        "doc_id": "bigint",
        "n_chars": "bigint",
        "edited_sha256": "string",
        "fingerprint": "string",
        "edited_fingerprint": "string",
        "near_edited": "double",
        "near_next": "double",
    },
    "op6_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7_context_tree_weighting": {
        "doc_id": "bigint",
        "held_out": "boolean",
        "n_tokens": "bigint",
        "n_known": "bigint",
        "train_tokens": "bigint",
        "base_score": "double",
        "score": "double",
    },
    "op8_token_counts": {
        "doc_id": "bigint",
        "n_bytes": "bigint",
        "n_tokens": "bigint",
        "over_limit": "boolean",
    },
}


@pytest.mark.parametrize("name", sorted(PROMISED))
def test_a_row_for_each_document(spark, duck, name):
    got = QUERIES[name](spark, str(SF_DIR))
    kinds = dict(got.dtypes)
    assert {c: kinds[c] for c in PROMISED[name]} == PROMISED[name]
    ids = sorted(r.doc_id for r in got.select("doc_id").collect())
    assert ids == [i for i, in duck.sql("select doc_id from documents order by 1").fetchall()]


def test_pieces_of_each_document(spark, duck):
    got = QUERIES["op4_best_fit_packing"](spark, str(SF_DIR))
    kinds = dict(got.dtypes)
    assert {kinds[c] for c in ("doc_id", "start", "length", "ids_crc32", "sequence_id", "offset")} == {
        "bigint"
    }
    assert kinds["piece"] == "int"
    ids = {r.doc_id for r in got.select("doc_id").collect()}
    assert ids == {i for i, in duck.sql("select doc_id from documents").fetchall()}
