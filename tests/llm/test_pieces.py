"""Prefix-table encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tests.llm.helpers import DOCUMENTS, prose, rows

from podium.llm.pieces import (
    PrefixEncoder,
    Vocabulary,
    decode,
    decode_ids,
    encode_texts,
    prefix_encoder,
)
from podium.llm.queries import op11_piece_encoding

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return prefix_encoder(PATH)


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


LETTERS = list("aabbceeiotnrs   ▁\n\t\x00.,'<>/0123456789éüñ中文漢字ゼ梦𝔘😀́‍\xa0ß")


@pytest.mark.parametrize("letters", [LETTERS, list("ab  "), list("▁ \n"), list("aehnrt")])
def test_random_texts(encoder, library, letters):
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        want = library.encode(text)
        assert ids_of(encoder, text) == want, repr(text)
        assert decode(np.array(want, "<u4"), encoder.vocabulary) == library.decode(want)


def test_any_code_point(encoder, library):
    rng = random.Random(2)
    for _ in range(1500):
        text = "".join(
            chr(rng.choice([rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]))
            for _ in range(rng.randint(1, 30))
        )
        assert ids_of(encoder, text) == library.encode(text), repr(text)


@pytest.mark.parametrize(
    "text",
    [" " * 100_000, "\n" * 100_000, "a" * 100_000, "ab" * 50_000, "漢" * 50_000, "😀" * 30_000, "x " * 50_000],
)
def test_very_long_texts(encoder, library, text):
    assert ids_of(encoder, text) == library.encode(text)


@pytest.mark.parametrize("text", ["<s> a </s><unk>", "<0x41><0x0A>", "▁▁", " lead", "trail ", "  "])
def test_written_out_symbols_are_text(encoder, library, text):
    ids = library.encode(text)
    assert ids_of(encoder, text) == ids
    assert decode(np.array(ids, "<u4"), encoder.vocabulary) == library.decode(ids)


def test_decoding_any_identifiers(library):
    known, rng = Vocabulary.load(PATH), random.Random(3)
    for _ in range(3000):
        ids = [
            rng.choice([rng.randrange(32000), rng.randrange(300), rng.choice(known.byte_ids[128:]), 259, 28705])
            for _ in range(rng.randint(0, 12))
        ]
        assert decode(np.array(ids, "<u4"), known) == library.decode(ids), ids


def test_a_prefix_ends_in_its_last_token(encoder, library):
    """The table's claim: each entry is the last token of the prefix by itself."""
    word = "▁internationalisation"
    for n in range(2, len(word) + 1):
        ids = library.encode(word[1:n])
        assert encoder.tokens(word[:n])[-1] == library.id_to_piece(ids[-1])


def test_small_memory_changes_nothing(library):
    rng, small = random.Random(4), PrefixEncoder(PATH, most=20)
    for _ in range(100):
        text = prose(rng, 30)
        assert ids_of(small, text) == library.encode(text)
    assert len(small) <= 20 and len(small.pairs) <= 20


EDGES = [
    (1, "a plain text"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "no id"),
    (1, "a plain text"),
    (1, "another text of one id"),
    (2**63 - 1, "w" * 70_000 + " end"),
]


def test_query_on_edges(spark, library, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in EDGES], DOCUMENTS)
    clashing = docs.selectExpr("*", "0 as ids", "'x' as n_tokens", "1 as row")
    clashing.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in EDGES:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        packed = np.array(ids, "<u4").tobytes()
        back = library.decode(ids).encode()
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()))
    got = op11_piece_encoding(spark, str(tmp_path))
    assert got.dtypes == [
        ("doc_id", "bigint"),
        ("n_tokens", "bigint"),
        ("ids_sha256", "string"),
        ("decoded_sha256", "string"),
    ]
    assert rows(got) == sorted(want, key=repr)


def test_round_trip_of_the_operators(spark):
    texts = [t for _, t in EDGES if t]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = decode_ids(encode_texts(docs, PATH, begin=False, end=False), PATH)
    assert [t for _, t in rows(back, "doc_id", "text")] == texts


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    assert decode_ids(encode_texts(docs, PATH), PATH).collect() == []


def test_no_shuffle(spark, capsys):
    docs = spark.createDataFrame([], DOCUMENTS)
    decode_ids(encode_texts(docs, PATH), PATH).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_met_pairs_and_pieces_are_looked_up(library, monkeypatch):
    """New words of pairs that were met call nothing for a pair or a piece."""
    encoder = PrefixEncoder(PATH)
    rng = random.Random(8)
    texts = ["".join(rng.choice("aeinrst") for _ in range(9)) for _ in range(3000)]
    for text in texts:
        encoder.encode(text)
    encoder.clear()
    asked = []
    monkeypatch.setattr(encoder, "may_follow", lambda *pair: asked.append(pair))
    monkeypatch.setattr(np, "array", lambda *ids: asked.append(ids))
    assert [encoder.encode(text) for text in texts] and not asked
    monkeypatch.undo()
    assert all(ids_of(encoder, text) == library.encode(text) for text in texts[:300])


def test_characters_of_no_piece_are_not_remembered(encoder, library):
    before = len(encoder.packed)
    for text in ("𝔘a", "a𝔘\U000e0041b", "\U000e0042"):
        assert ids_of(encoder, text) == library.encode(text)
    assert len(encoder.packed) == before
