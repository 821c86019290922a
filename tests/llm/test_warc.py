import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st

from podium.llm.warc import (
    DamagedRecord,
    block_payload,
    chunked,
    joined_segments,
    page_records,
    parse_records,
    read_segments,
    reassemble,
    record,
    record_urn,
    sha1_base32,
    unchunked,
    write_archives,
)

PAGES = "page_id long, url string, html string, digest string"


@given(st.binary(max_size=500), st.integers(1, 40))
def test_chunks_come_back(payload, size):
    assert unchunked(chunked(payload, size)) == payload


def test_chunk_extensions_and_trailers_are_passed_over():
    assert unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"


@pytest.mark.parametrize("body", [b"", b"zz\r\nabc\r\n", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabcd"])
def test_damaged_chunks_raise(body):
    with pytest.raises(DamagedRecord):
        unchunked(body)


@given(st.lists(st.binary(max_size=80), max_size=6))
def test_records_are_read_by_their_length(blocks):
    raw = b"".join(record([("WARC-Type", "x")], b) + b"\r\n\r\n" for b in blocks)
    assert [b for _, b in parse_records(raw)] == blocks


def test_damaged_records_raise():
    good = record([("A", "b")], b"12345") + b"\r\n\r\n"
    for bad in (good[:-1], good[:20], b"junk" + good, good.replace(b"12345", b"1234")):
        with pytest.raises(DamagedRecord):
            list(parse_records(bad))


def test_segments_are_ordered_and_held_against_their_total():
    assert joined_segments([(1, None, b"ab"), (2, None, b"c"), (3, 3, b"")]) == b"abc"
    for bad in ([(1, None, b"a"), (3, 2, b"b")], [(1, None, b"a"), (2, 5, b"b")], [(1, None, b"a")]):
        with pytest.raises(DamagedRecord):
            joined_segments(bad)


@given(st.binary(max_size=2000), st.integers(50, 400))
def test_a_page_in_segments(payload, segment):
    digest = sha1_base32(payload)
    parts = page_records("page:1", record_urn("page:1", digest), payload, digest, None, segment)
    parsed = [next(parse_records(p + b"\r\n\r\n")) for p in parts]
    pieces = [b for _, b in parsed]
    assert all(len(p) <= segment for p in pieces)
    assert block_payload(b"".join(pieces)) == payload
    if len(parsed) > 1:
        origin = parsed[0][0]["warc-record-id"]
        assert {h["warc-segment-origin-id"] for h, _ in parsed[1:]} == {origin}
        assert len({h["warc-record-id"] for h, _ in parsed}) == len(parsed)


def made_pages():
    rng = random.Random(3)
    long = "".join(rng.choice("abé\r\n<>日") for _ in range(9_000))
    return [
        (5, "u", "same page"),
        (3, "u", "same page"),
        (9, "u", "same page"),
        (1, "u", None),
        (2, "u", ""),
        (4, "u", long),
        (4, "u", long),  # a repeated row
        (6, "u", long),
        (7, "u", "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (8, "u", "x" * 3_000),
        (None, "u", "no id"),
        (None, "u", "same page"),
    ]


def read_back(spark, tmp_path, pages, **options):
    df = spark.createDataFrame([(*p, "d") for p in pages], PAGES).repartition(3)
    path = str(tmp_path / "archives")
    write_archives(df, path, **options)
    return path, reassemble(read_segments(spark, path)).collect()


@pytest.mark.parametrize("segment", [64, 1_000, 1 << 20])
def test_pages_come_back(spark, tmp_path, segment):
    pages = made_pages()
    _, got = read_back(spark, tmp_path, pages, segment=segment)
    assert len(got) == len(pages)
    by_uri = {}
    for r in got:
        by_uri.setdefault(r.uri, []).append(r)
    first = {}
    for i, _, html in pages:
        payload = (html or "").encode()
        if i is not None:
            first[payload] = min(first.get(payload, i), i)
    for i, _, html in pages:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        mine = [r for r in by_uri[f"page:{'' if i is None else i}"] if r.digest == digest]
        assert mine
        for r in mine:
            if first.get(payload, i) == i:
                assert r.kind == "response" and r.payload == payload and r.refers_to is None
            else:
                assert r.kind == "revisit" and r.payload is None
                assert r.refers_to == record_urn(f"page:{first[payload]}", digest)


def test_short_payloads_may_stay_responses(spark, tmp_path):
    _, got = read_back(spark, tmp_path, [(1, "u", "ab"), (2, "u", "ab")], least_revisit=3)
    assert [r.kind for r in got] == ["response"] * 2


def test_files_are_gzipped_archives_of_bounded_size(spark, tmp_path):
    path, _ = read_back(spark, tmp_path, [(i, "u", f"page {i}") for i in range(30)], records=4)
    files = list(Path(path).glob("part-*.gz"))
    assert len(files) >= 8
    for f in files:
        assert 0 < len(list(parse_records(gzip.decompress(f.read_bytes())))) <= 4


def test_empty_table(spark, tmp_path):
    _, got = read_back(spark, tmp_path, [])
    assert got == []
