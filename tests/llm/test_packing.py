import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from podium.llm.packing import pack_counts, pack_documents, reduce_by_dominance
from tests.llm.helpers import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def layout(runs):
    """Sequence -> offsets and lengths, from runs."""
    out = {}
    for r in runs:
        for k in range(r.count):
            at = r.offset + k % r.each * r.length
            out.setdefault(r.sequence + k // r.each, []).append((at, r.length))
    return out


def fewest(pieces, capacity):
    """The least number of sequences, by trying all."""
    pieces = sorted(pieces, reverse=True)

    def fits(bins, i):
        if i == len(pieces):
            return True
        tried = set()
        for b in range(len(bins)):
            if bins[b] >= pieces[i] and bins[b] not in tried:
                tried.add(bins[b])
                bins[b] -= pieces[i]
                if fits(bins, i + 1):
                    return True
                bins[b] += pieces[i]
        return False

    n = -(-sum(pieces) // capacity)
    while not fits([capacity] * n, 0):
        n += 1
    return n


@pytest.mark.parametrize("seed", range(60))
def test_every_piece_has_its_place(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 50, 100])
    lengths = rng.sample(range(1, capacity + 1), rng.randint(1, 9))
    counts = {w: rng.randint(1, 30) for w in lengths}
    runs, n = pack_counts(counts, capacity)
    found = layout(runs)
    assert set(found) == set(range(n))
    assert Counter(w for v in found.values() for _, w in v) == counts
    for pieces in found.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("seed", range(150))
def test_fixed_sets_leave_an_optimal_packing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([12, 20, 30])
    pieces = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    fixed, left = reduce_by_dominance(Counter(pieces), capacity)
    sequences = sum(times for _, times in fixed)
    rest = [w for w, n in left.items() for _ in range(n)]
    assert sequences + fewest(rest, capacity) == fewest(pieces, capacity)
    for pieces_, _ in fixed:
        assert sum(pieces_) <= capacity


def test_the_reduction_is_more_than_exact_fits():
    fixed, left = reduce_by_dominance({7: 1, 2: 1, 6: 1}, 10)
    assert sorted(map(sorted, (p for p, _ in fixed))) == [[2, 7], [6]] and not left
    # Three pieces that no exact fit joins.
    assert ([5, 3, 2], 1) in reduce_by_dominance({5: 1, 3: 1, 2: 2}, 11)[0]


def test_best_fit_prefers_the_fullest():
    runs, n = pack_counts({6: 1, 5: 1, 4: 3, 3: 1, 2: 1}, 10)
    assert n == -(-(6 + 5 + 12 + 3 + 2) // 10)
    assert all(sum(w for _, w in v) <= 10 for v in layout(runs).values())


def test_rows(spark):
    rng = random.Random(4)
    texts = [None, "", "", "same", "same", prose(rng, 2_500), prose(rng, 900)]
    texts += [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    df = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, piece string"
    ).repartition(5)
    out = pack_documents(df, PATH, 1024).toPandas()
    library = Tokenizer.from_file(PATH)
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        mine = out[out.doc_id == i].sort_values("piece")
        assert list(mine.piece) == list(range(len(mine)))
        assert list(mine.start) == [0, *np.cumsum(mine.length)[:-1]]
        assert mine.length.sum() == len(ids)
        assert (mine.length[1:] == 1024).all()
        for _, p in mine.iterrows():
            piece = ids[p.start : p.start + p.length]
            assert zlib.crc32(piece.tobytes()) == p.ids_crc32
    for _, group in out.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert list(group.offset) == [0, *np.cumsum(group.length)[:-1]]
        assert group.length.sum() <= 1024
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 1024) + 1
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_repeated_rows_have_places_of_their_own(spark):
    df = spark.createDataFrame([(1, "a b c")] * 6, "doc_id long, text string")
    out = pack_documents(df, PATH, 8).toPandas()
    assert len(out) == 6
    assert len(set(zip(out.sequence_id, out.offset))) == 6


@pytest.mark.parametrize(
    "text", [" " * 2_000_000, "\n" * 2_000_000, "w" * 2_000_000, "!" * 2_000_000], ids=["spaces", "breaks", "word", "marks"]
)
def test_very_long_runs(spark, text):
    """Some of them are more than tiktoken's pattern can take."""
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    out = pack_documents(docs, PATH).filter("doc_id = 1").toPandas().sort_values("piece")
    ids = np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids + [2], "<u4")
    assert out.length.sum() == len(ids)
    assert list(out.ids_crc32) == [
        zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(out.start, out.length)
    ]
