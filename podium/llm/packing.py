"""Best-fit packing of documents after Martello and Toth's dominance reduction.

Only lengths matter to a packing, and there are at most ``capacity`` of them. So
the rows are counted by length, the counts alone (at most ``capacity`` numbers)
are packed, and each row then finds its place from its rank among the rows of
its length: one pass of tokenization, one small shuffle, whatever the input.

The reduction fixes sets of pieces that dominate every other set with their
largest piece: an optimal packing with exactly these sets exists, so nothing is
lost by fixing them. What remains is packed by best fit, longest first.

Null and empty texts are one end-of-document id; a text may be of any length. Ties are broken by the order in
which a task reads rows, so repeated rows get places of their own. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import in_parts, kept
from podium.llm.token_counts import WORDS, byte_alphabet

END = 2


@cache
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file, run by tiktoken.

    A symbol's identifier is its rank there, as in all such files whose merges
    are numbered in order; it gives the same identifiers at several times the
    speed. Special tokens written out in a text are taken as such.
    """
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)
    letters = byte_alphabet()
    special = {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in symbol): i
        for symbol, i in vocabulary["model"]["vocab"].items()
        if symbol not in special
    }
    return tiktoken.Encoding(
        "file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special
    )


@cache
def library(path: str, special: bool) -> tokenizers.Tokenizer:
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    return tokenizer


def text_ids(text: str, path: str, special: bool = True) -> np.ndarray:
    """Ids of a text. ``special`` takes special tokens written out in it as such.

    The pattern that cuts words has no room for runs of about a million spaces or
    line breaks in tiktoken, which says so; such texts go to the tokenizers library.
    """
    allowed = {"allowed_special": "all"} if special else {"disallowed_special": ()}
    try:
        return encoding(path).encode_to_numpy(text, **allowed)
    except ValueError:
        ids = library(path, special).encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32)


def token_ids(text: str | None, path: str, end: int = END) -> np.ndarray:
    """Little-endian 32-bit ids of a text and its end."""
    return np.append(text_ids(text or "", path), end).astype("<u4")


# --- packing counts -------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """Pieces ``first`` to ``first + count`` of one length, ``each`` to a sequence.

    The first goes to sequence ``sequence`` at ``offset``; the next ``each - 1``
    follow it there, then comes the next sequence.
    """

    length: int
    first: int
    count: int
    each: int
    sequence: int
    offset: int


class Counts:
    """How many pieces of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = {w: n for w, n in counts.items() if n > 0}
        self.order = sorted(self.left)

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            del self.order[bisect_left(self.order, length)]

    def largest(self, room: int) -> int | None:
        """The greatest length up to ``room``."""
        at = bisect_right(self.order, room)
        return self.order[at - 1] if at else None

    def smallest(self, n: int) -> list[int]:
        """The ``n`` smallest pieces, or all."""
        out: list[int] = []
        for w in self.order:
            out += [w] * min(self.left[w], n - len(out))
            if len(out) == n:
                break
        return out


def dominating_set(counts: Counts, capacity: int, longest: int) -> list[int] | None:
    """The companions with which ``longest`` dominates all sets that hold it.

    One set dominates another if the other's pieces can be dealt to distinct
    pieces of the first, each of which holds what it is dealt. ``longest`` is
    not counted among the pieces left.
    """
    room = capacity - longest
    partner = counts.largest(room)
    if partner is None:
        return []
    least = counts.smallest(3)
    # Alone or with one other: the greatest that fits dominates. An exact fit
    # holds whatever could stand in its place.
    if partner == room or len(least) < 2 or least[0] + least[1] > room:
        return [partner]
    if len(least) == 3 and sum(least) <= room:
        return None
    # At most two others fit. The best pair's sum:
    best = 0
    for a in reversed(counts.order[: bisect_right(counts.order, room)]):
        if 2 * a < best:
            break
        b = counts.largest(min(room - a, a))
        if b == a and counts.left[a] < 2:
            at = bisect_left(counts.order, a)
            b = counts.order[at - 1] if at else None
        if b is not None:
            best = max(best, a + b)
    if partner >= best:
        return [partner]
    # Else the pair of the greatest piece and the greatest beside it, if no pair
    # fits of which both are longer than the second.
    second = counts.largest(min(room - partner, partner))
    if second == partner and counts.left[partner] < 2:
        at = bisect_left(counts.order, partner)
        second = counts.order[at - 1] if at else None
    if second is None:
        return None
    longer = counts.order[bisect_right(counts.order, second) :]
    if longer:
        low = longer[0]
        other = low if counts.left[low] > 1 else (longer[1] if len(longer) > 1 else None)
        if other is not None and low + other <= room:
            return None
    return [partner, second]


def reduce_by_dominance(
    counts: dict[int, int], capacity: int
) -> tuple[list[tuple[list[int], int]], dict[int, int]]:
    """Sets fixed by dominance, each with how often, and the counts that remain.

    Lengths are tried from the longest; a pass is repeated while it fixes
    something, because what is gone can make other sets dominate.
    """
    left = Counts(counts)
    fixed: list[tuple[list[int], int]] = []
    changed = True
    while changed:
        changed = False
        for length in reversed(list(left.order)):
            while left.left.get(length):
                left.take(length, 1)
                others = dominating_set(left, capacity, length)
                if others is None:
                    if length in left.left:
                        left.left[length] += 1
                    else:
                        left.left[length] = 1
                        insort(left.order, length)
                    break
                # The same set dominates as long as its pieces last.
                need: dict[int, int] = defaultdict(int)
                need[length] += 1
                for w in others:
                    need[w] += 1
                have = {w: left.left.get(w, 0) + (w == length) for w in need}
                times = min(have[w] // need[w] for w in need)
                if others == []:
                    times = have[length]
                for w, n in need.items():
                    take = n * times - (w == length)
                    if take:
                        left.take(w, take)
                fixed.append((sorted([length, *others], reverse=True), times))
                changed = True
    return fixed, left.left


def pack_counts(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs that place all pieces, and the number of sequences."""
    fixed, left = reduce_by_dominance(counts, capacity)
    runs: list[Run] = []
    placed: dict[int, int] = defaultdict(int)
    sequences = 0

    def add(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        runs.append(Run(length, placed[length], n, each, sequence, offset))
        placed[length] += n

    for pieces, times in fixed:
        offset, at = 0, 0
        while at < len(pieces):
            each = pieces[at:].count(pieces[at])
            add(pieces[at], each * times, each, sequences, offset)
            offset += each * pieces[at]
            at += each
        sequences += times
    # Open sequences: room left -> list of (first sequence, how many).
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
    order: list[int] = []

    def opened(room: int, first: int, n: int) -> None:
        if n and room:
            if not rooms[room]:
                insort(order, room)
            rooms[room].append((first, n))

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect_left(order, length)
            if at < len(order):
                room = order[at]
                first, many = rooms[room].pop()
                if not rooms[room]:
                    del order[at]
                fresh = 0
            else:
                room, first, many = capacity, sequences, -(-n // (capacity // length))
                sequences += many
                fresh = 1
            each = room // length
            full = min(many, n // each)
            if full:
                add(length, full * each, each, first, capacity - room)
                opened(room - each * length, first, full)
                n -= full * each
            rest = many - full
            if n and rest:
                # Fewer than fill one more sequence.
                add(length, n, n, first + full, capacity - room)
                opened(room - n * length, first + full, 1)
                n, full = 0, full + 1
                rest -= 1
            if rest and not fresh:
                opened(room, first + full, rest)
    return runs, sequences


# --- rows -----------------------------------------------------------------

_MEASURED = (
    "row long, task long, nth long, head long, wholes long, wholes_before long, "
    "crcs array<long>"
)


def measure_pieces(docs: DataFrame, path: str, capacity: int = 1024) -> DataFrame:
    """One row per document: the lengths and checksums of its pieces.

    ``head`` is the length of the first piece and ``wholes`` counts the pieces of
    full length after it; a document of whole pieces only has its first as head.
    ``nth`` is the row's rank among rows of the same ``head`` in its task, and
    ``wholes_before`` the full pieces before it there.
    """

    def measured(batches):
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        before = row = 0
        for batch in in_parts(batches):
            columns: list[list] = [[] for _ in range(7)]
            for text in batch["text"].to_pylist():
                ids = token_ids(text, path)
                head = (len(ids) - 1) % capacity + 1
                wholes = (len(ids) - head) // capacity
                raw = ids.tobytes()
                cuts = [0, *range(4 * head, len(raw) + 1, 4 * capacity)]
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
                values = (row, task, int(seen[head]), head, wholes, before, crcs)
                for c, v in zip(columns, values):
                    c.append(v)
                seen[head] += 1
                before += wholes
                row += 1
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
            arrays.append(pa.array(columns[6], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *arrays],
                names=["doc_id", *(c.split()[0] for c in _MEASURED.split(", "))],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measured, f"doc_id {kind}, {_MEASURED}")


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024) -> DataFrame:
    """A row per piece: where it begins in its document and in which sequence it lies.

    Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``. Full pieces fill sequences of their own, numbered
    below zero; the others are placed by their counts.
    """
    spark = docs.sparkSession
    rows = kept(measure_pieces(docs, path, capacity), "pieces")
    by_task = rows.groupBy("task", "head").agg(
        F.count("*").alias("n"), F.sum("wholes").alias("wholes")
    )
    counts = {
        r["head"]: r["n"]  # at most ``capacity`` numbers
        for r in by_task.groupBy("head").agg(F.sum("n").alias("n")).collect()
    }
    runs, _ = pack_counts(counts, capacity)
    plan: dict[int, tuple[np.ndarray, ...]] = {}
    for length in counts:
        own = sorted((r for r in runs if r.length == length), key=lambda r: r.first)
        plan[length] = tuple(
            np.array([getattr(r, k) for r in own], dtype=np.int64)
            for k in ("first", "each", "sequence", "offset")
        )
    # At most ``4 * capacity`` open groups of sequences exist at a time, so the
    # plan is bounded by the capacity and not by the rows.
    shared = spark.sparkContext.broadcast(plan)

    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = by_task.groupBy("task").agg(F.sum("wholes").alias("w"))
    base_rows = by_task.withColumn(
        "rows_before", F.coalesce(F.sum("n").over(earlier.partitionBy("head")), F.lit(0))
    ).select("task", "head", "rows_before")
    base_wholes = per_task.select(
        "task", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("fulls_before")
    )
    bases = base_rows.join(base_wholes, "task")

    def placed(batches):
        plan = shared.value
        for batch in batches:
            head = batch["head"].to_numpy()
            rank = batch["rows_before"].to_numpy() + batch["nth"].to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for length in np.unique(head):
                first, each, start, at = plan[int(length)]
                rows = head == length
                r = rank[rows]
                run = np.searchsorted(first, r, side="right") - 1
                k = r - first[run]
                sequence[rows] = start[run] + k // each[run]
                offset[rows] = at[run] + k % each[run] * length
            wholes = batch["wholes"].to_numpy()
            fulls = batch["fulls_before"].to_numpy() + batch["wholes_before"].to_numpy()
            of = np.repeat(np.arange(len(head)), wholes + 1)
            firsts = np.cumsum(wholes + 1) - (wholes + 1)
            piece = np.arange(len(of)) - firsts[of]
            whole = piece > 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(of)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(np.where(whole, head[of] + (piece - 1) * capacity, 0)),
                    pa.array(np.where(whole, capacity, head[of])),
                    batch["crcs"].flatten(),
                    pa.array(np.where(whole, -(fulls[of] + piece), sequence[of])),
                    pa.array(np.where(whole, 0, offset[of])),
                ],
                names=names,
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.join(bases, ["task", "head"]).mapInArrow(
        placed,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
