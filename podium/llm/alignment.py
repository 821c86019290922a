"""Alignment of two tokenizers' tokens over the bytes of a text.

A is a byte-level tokenizer and reads a space and the text; B is a piece tokenizer
that puts this space there by itself. The tokens of both tile the same bytes. For each
token's start, ``pandas.merge_asof`` keyed by document finds the other side's token
that covers it; both directions together are all overlaps. Where two overlapping
tokens end at the same byte a group ends, so groups are the finest cuts that both
sides share. All tokens of a group are linked with all of the other side there.

Documents are aligned in their task, a bounded number of bytes at a time. How many
documents link a pair of identifiers is counted over all of them. The counts go back
to the documents in two ways: those of the commonest pairs are broadcast, at most
``hot_pairs`` of them, and the others are joined by a shuffle, in which no pair is
frequent.

Null and empty texts, and texts that either side does not give back byte for byte (B
gives a space for U+2581), have no tokens: zeros and an empty digest. Rows count as
documents, repeated ones and those without id too. An empty table gives an empty one.
Columns besides ``doc_id`` and ``text`` are not looked at. A long text takes memory in
proportion to its tokens; the links of a large group are counted by its distinct
identifiers, not one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import kept
from podium.llm.packing import encoding, text_ids
from podium.llm.pieces import SPACE, prefix_encoder

#: Links of a group up to which they are written out one by one.
SMALL = 256


class Pair:
    """Two tokenizers: the bytes of each side's tokens and the texts of their numbers."""

    def __init__(self, bpe_path: str, piece_path: str):
        self.bpe_path = bpe_path
        self.pieces = prefix_encoder(piece_path)
        bpe = encoding(bpe_path)
        special = set(bpe.special_tokens_set)
        self.raw_a = [
            b"" if bpe.decode([i]) in special else bpe.decode_single_token_bytes(i)
            for i in range(bpe.n_vocab)
        ]
        self.raw_b = self.pieces.vocabulary.raw
        if len(set(self.raw_a) & {bytes([b]) for b in range(256)}) < 256:
            raise ValueError(f"{bpe_path} has no token for some byte")
        self.size_a = np.array([len(r) for r in self.raw_a])
        self.size_b = np.array([len(r) for r in self.raw_b])
        # "7," and "7|" for A, "7," and "7;" for B.
        self.marks = np.array(
            [f"{i}{mark}" for n, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for mark in marks
             for i in range(n)],
            dtype=object,
        )

    @property
    def n_a(self) -> int:
        return len(self.raw_a)

    @property
    def n_b(self) -> int:
        return len(self.raw_b)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of both sides, or none if one does not give the bytes back.

        A has a token for each byte and B's encoder bytes for each character of no piece,
        so both give all bytes back but for a written out U+2581, which B takes for a
        space: looking for that is enough.
        """
        if not text or SPACE in text:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a = text_ids(f" {text}", self.bpe_path, special=False)
        b = np.frombuffer(self.pieces.encode(text), "<u4")
        return a.astype(np.int64), b.astype(np.int64)


@cache
def pair_of(bpe_path: str, piece_path: str) -> Pair:
    """One for each worker process, which serves many tasks."""
    return Pair(bpe_path, piece_path)


def overlaps(
    ends_a: np.ndarray, docs_a: np.ndarray, ends_b: np.ndarray, docs_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of tokens that share a byte, in the order of the text.

    The tokens of each document tile its bytes, which are numbered through over the
    documents; ``ends`` are ascending.
    """
    sides = []
    for ends, docs in ((ends_a, docs_a), (ends_b, docs_b)):
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        sides.append(pd.DataFrame({"start": starts, "doc": docs, "at": np.arange(len(ends))}))
    a, b = sides
    over_b = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    over_a = pd.merge_asof(b, a, on="start", by="doc", suffixes=("_b", "_a"))
    n = max(len(b), 1)
    codes = [d["at_a"].to_numpy(np.int64) * n + d["at_b"].to_numpy(np.int64) for d in (over_b, over_a)]
    both = np.sort(np.concatenate(codes), kind="stable")
    both = both[np.diff(both, prepend=-1) > 0]
    return both // n, both % n


class Aligned:
    """Groups and links of a few documents."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        self.pair, self.n = pair, len(texts)
        tokens = [pair.tokens(t) for t in texts]
        self.a = np.concatenate([np.empty(0, np.int64), *(a for a, _ in tokens)])
        self.b = np.concatenate([np.empty(0, np.int64), *(b for _, b in tokens)])
        self.counts_a = np.array([len(a) for a, _ in tokens], np.int64)
        self.counts_b = np.array([len(b) for _, b in tokens], np.int64)
        docs = np.arange(self.n)
        docs_a, docs_b = np.repeat(docs, self.counts_a), np.repeat(docs, self.counts_b)
        ends_a, ends_b = np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b])
        at_a, at_b = overlaps(ends_a, docs_a, ends_b, docs_b)
        closes = ends_a[at_a] == ends_b[at_b]
        groups = np.cumsum(closes) - closes
        self.group_a, self.group_b = np.empty_like(self.a), np.empty_like(self.b)
        self.group_a[at_a], self.group_b[at_b] = groups, groups
        n_groups = int(closes.sum())
        self.sizes_a = np.bincount(self.group_a, minlength=n_groups)
        self.sizes_b = np.bincount(self.group_b, minlength=n_groups)
        self.doc = np.empty(n_groups, np.int64)
        self.doc[self.group_a] = docs_a
        self.links = self.sizes_a * self.sizes_b

    def per_document(self) -> tuple[np.ndarray, np.ndarray]:
        """Groups and links of each document."""
        links = np.zeros(self.n, np.int64)
        np.add.at(links, self.doc, self.links)
        return np.bincount(self.doc, minlength=self.n), links

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``: the groups' identifiers in order."""
        pair = self.pair
        before_a = np.cumsum(self.sizes_a) - self.sizes_a
        before_b = np.cumsum(self.sizes_b) - self.sizes_b
        nth_a, nth_b = np.arange(len(self.a)), np.arange(len(self.b))
        last_a = nth_a + 1 == (before_a + self.sizes_a)[self.group_a]
        last_b = nth_b + 1 == (before_b + self.sizes_b)[self.group_b]
        marks = np.empty(len(self.a) + len(self.b), np.int64)
        marks[nth_a + before_b[self.group_a]] = self.a + last_a * pair.n_a
        marks[nth_b + (before_a + self.sizes_a)[self.group_b]] = (
            2 * pair.n_a + self.b + last_b * pair.n_b
        )
        parts = pair.marks[marks].tolist()
        out, at = [], 0
        for n in (self.counts_a + self.counts_b).tolist():
            listed = "".join(parts[at : at + n])[:-1]
            out.append(hashlib.sha256(listed.encode()).hexdigest() if n else "")
            at += n
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of each document: document, pair ``a * n_b + b``, how often."""
        first_a = np.cumsum(self.sizes_a) - self.sizes_a
        first_b = np.cumsum(self.sizes_b) - self.sizes_b
        small = np.flatnonzero(self.links <= SMALL)
        group = np.repeat(small, self.links[small])
        nth = np.arange(len(group)) - np.repeat(
            np.cumsum(self.links[small]) - self.links[small], self.links[small]
        )
        wide = self.sizes_b[group]
        found = self.a[first_a[group] + nth // wide] * self.pair.n_b
        found += self.b[first_b[group] + nth % wide]
        docs, codes, times = [self.doc[group]], [found], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(self.links > SMALL):
            a, often_a = np.unique(
                self.a[first_a[g] : first_a[g] + self.sizes_a[g]], return_counts=True
            )
            b, often_b = np.unique(
                self.b[first_b[g] : first_b[g] + self.sizes_b[g]], return_counts=True
            )
            codes.append((a[:, None] * self.pair.n_b + b).ravel())
            times.append((often_a[:, None] * often_b).ravel())
            docs.append(np.full(len(codes[-1]), self.doc[g]))
        most = self.pair.n_a * self.pair.n_b
        keys = np.concatenate(docs) * most + np.concatenate(codes)
        often = np.concatenate(times)
        order = np.argsort(keys, kind="stable")
        keys, often = keys[order], often[order]
        firsts = np.flatnonzero(np.diff(keys, prepend=-1))
        keys = keys[firsts]
        return keys // most, keys % most, np.add.reduceat(often, firsts) if len(firsts) else often


def by_size(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of ``text``, of one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy()
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(sizes[at : at + 512])
            n = max(1, int(np.searchsorted(ends, most, side="right")))
            yield batch.slice(at, n)
            at += n


def align_documents(docs: DataFrame, bpe_path: str, piece_path: str) -> DataFrame:
    """One row per document: its counts, the digest of its groups and its linked pairs.

    ``pairs`` are distinct numbers ``a * n_b + b`` in order and ``times`` says how many
    links each has.
    """
    pair = pair_of(bpe_path, piece_path)
    code = "int" if pair.n_a * pair.n_b < 2**31 else "long"
    lists = pa.int32() if code == "int" else pa.int64()

    def aligned(batches):
        pair = pair_of(bpe_path, piece_path)
        for batch in by_size(batches):
            found = Aligned(pair, batch["text"].to_pylist())
            groups, links = found.per_document()
            of, codes, times = found.pairs()
            ends = np.searchsorted(of, np.arange(found.n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(found.counts_a),
                    pa.array(found.counts_b),
                    pa.array(groups.astype(np.int64)),
                    pa.array(links),
                    pa.array(found.digests(), pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(codes, lists)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times)),
                ],
                names=names,
            )

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        aligned,
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
        f"groups_sha256 string, pairs array<{code}>, times array<long>",
    )


def count_links(aligned: DataFrame, n_b: int) -> DataFrame:
    """``pair``, ``docs`` that link it, and whether that is the most of its A identifier.

    There are at most as many A identifiers as the vocabulary has, so their greatest
    counts are broadcast.
    """
    counts = kept(
        aligned.select(F.explode("pairs").alias("pair"))
        .groupBy("pair")
        .agg(F.count("*").alias("docs")),
        "links",
    ).withColumn("a", F.floor(F.col("pair") / n_b))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(most), "a").select(
        "pair", "docs", (F.col("docs") == F.col("most")).alias("best")
    )


def hot_count(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` rows of ``docs`` reach.

    From a histogram of a few hundred bins, eight to each doubling.
    """
    bins = (
        counts.groupBy(F.floor(F.log2("docs") * 8).alias("bin"))
        .agg(F.count("*").alias("n"), F.min("docs").alias("least"))
        .orderBy(F.desc("bin"))
        .collect()
    )
    least, total = 2**62, 0
    for row in bins:
        total += row["n"]
        if total > most:
            break
        least = row["least"]
    return least


def align_tokenizers(
    docs: DataFrame, bpe_path: str, piece_path: str, *, hot_pairs: int = 1 << 17
) -> DataFrame:
    """Groups and links of each document, weighed by how common the links are.

    ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    count of documents is the highest of their A identifier, ties included),
    ``count_sum`` (over the links) and ``groups_sha256``.
    """
    aligned = kept(
        align_documents(docs, bpe_path, piece_path).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "alignments",
    )
    counts = count_links(aligned, pair_of(bpe_path, piece_path).n_b)
    least = hot_count(counts, hot_pairs)
    hot = F.broadcast(counts.filter(F.col("docs") >= least))
    rare = counts.filter(F.col("docs") < least)
    links = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed(
        "pairs", "pair"
    )
    sums = [
        F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    ]
    parts = [
        links.join(hot, "pair").groupBy("row").agg(*sums),
        links.join(hot, "pair", "left_anti").join(rare, "pair").groupBy("row").agg(*sums),
    ]
    weighed = (
        parts[0]
        .unionByName(parts[1])
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return aligned.join(weighed, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
