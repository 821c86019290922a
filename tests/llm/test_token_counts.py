import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from podium.llm.token_counts import MergeCounter, count_tokens, merge_count
from tests.llm.helpers import prose, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return MergeCounter(PATH)


def test_merges_take_the_least_rank_first_and_the_leftmost_of_equals():
    ranks = {(b"b", b"c"): 0, (b"a", b"b"): 1, (b"a", b"bc"): 2, (b"a", b"a"): 3}
    assert merge_count(b"abc", ranks) == 2  # bc, then a+bc
    assert merge_count(b"aaa", ranks) == 1
    assert merge_count(b"aaaa", ranks) == 2
    assert merge_count(b"a", ranks) == merge_count(b"", ranks) == 0


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts_are_the_library_s(counter, library, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_long_words_and_special_strings(counter, library):
    rng = random.Random(1)
    texts = [
        "ab" * 20_000,
        " " * 5_000,
        "\r\n\t " * 500,
        "x<|endoftext|><|endoftext|> y",
        "<|endoftext",
        "日本語 ½ Ⅷ ² 🎉é",
        prose(rng, 3_000),
    ]
    for text in texts:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_a_full_memory_starts_again(library):
    small = MergeCounter(PATH, most=3)
    text = "one two three four five six one"
    assert small.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(small) <= 3


def test_rows(spark, library):
    texts = [None, "", "a b", "word " * 1500, "a b"]
    df = spark.createDataFrame(
        [(i, t, -1, True) for i, t in enumerate(texts)],
        "doc_id long, text string, n_tokens int, over_limit boolean",
    )
    want = []
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert rows(count_tokens(df, PATH)) == sorted(want, key=repr)
    assert count_tokens(df.limit(0), PATH).count() == 0
