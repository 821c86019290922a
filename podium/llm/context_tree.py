"""Log-probabilities of texts by context-tree weighting, beside a word unigram.

A text is the sequence of its words, A-Z lower-cased, each closed by a space, and
a line end after the last. Every byte is coded in eight binary decisions; a
decision's context is what is decided of the byte and up to ``depth`` bytes before
it in the running text, across spaces, so the order of words counts. Before a text
stands a space. For each decision a tree of contexts holds counts, with a
Krichevsky-Trofimov estimate at each node, and the weighting mixes the estimates of
all depths on a context's path by how well each subtree coded the training texts. What
results is a probability: those of a byte's 256 values sum to one in any context.

Texts lie in blocks of bounded size. A block counts its distinct byte strings, a
byte and those before it, and its distinct words; the counts are added up over all
blocks, weighted, and each block gets the prices of its strings back by a join, so
what moves are the distinct strings of blocks and each text once. All contexts are
kept, in a table in the order of their bytes from the nearest back, where each
context of any depth is a run of neighbours. Ranges of it are weighted where they
lie; what crosses their ends is put together on the driver, a few thousand decisions
for a range.

Words are told apart by 64-bit hashes. Null and empty texts have the end as their only
token. A null id counts as empty text where ids decide what is held out. Repeated rows
get equal results but for the rounding of sums. A text is read in pieces of about half
a megabyte, cut after a space. Without training texts nothing is known: every decision
has probability one half. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import GOLDEN, in_parts, kept, mixed, words

SPACE = 0x20
_BASE = np.uint64(0xB5026F5AA96619E9)
#: Rows of a batch of keys that goes back to Spark.
ROWS = 1 << 16
#: Set in the key of a word; byte strings are below.
_WORD = np.uint64(1 << 63)


# --- byte strings ---------------------------------------------------------


def pieces(
    texts: Iterable[list[bytes]], depth: int, size: int = 1 << 19
) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """Texts, given by their words, as groups of about ``size`` bytes.

    Of each piece: the number of its text, the ``depth`` bytes before, its bytes.
    """
    group, total = [], 0
    for i, tokens in enumerate(texts):
        data = b"".join(t + b" " for t in tokens) + b"\n"
        lead, at = b"\0" * (depth - 1) + b" ", 0
        while at < len(data):
            end = data.find(b" ", at + max(size, depth)) + 1 or len(data)
            group.append((i, lead, data[at:end]))
            total += end - at
            lead, at = data[end - depth : end], end
            if total >= size:
                yield group
                group, total = [], 0
    if group:
        yield group


def byte_strings(
    group: list[tuple[int, bytes, bytes]], depth: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The key of each byte and its text, the key of each word and its text.

    A byte's key is a number of the ``depth`` bytes before, the nearest the highest,
    and the byte itself the lowest.
    """
    sizes = np.array([len(data) for _, _, data in group], dtype=np.int64)
    data = np.frombuffer(b"".join(lead + d for _, lead, d in group), np.uint8).astype(np.int64)
    number = np.arange(sizes.sum())
    at = number + (np.repeat(np.arange(len(group)), sizes) + 1) * depth
    of = np.repeat(np.array([i for i, _, _ in group], dtype=np.int64), sizes)
    keys = np.zeros(len(at), np.int64)
    for back in range(1, depth + 1):
        keys = keys << 8 | data[at - back]
    byte = data[at]
    keys = keys << 8 | byte
    # Sums of a word's bytes times a power for their place, from its begin.
    begin = np.maximum.accumulate(np.where(data[at - 1] == SPACE, number, 0))
    place = number - begin
    powers = np.full(int(place.max(initial=0)) + 1, _BASE, np.uint64)
    powers = np.cumprod(powers, dtype=np.uint64)
    terms = (byte.astype(np.uint64) + np.uint64(1)) * powers[place]
    before = np.cumsum(terms, dtype=np.uint64) - terms
    ends = np.flatnonzero(byte == SPACE)
    hashes = mixed(before[ends] - before[begin[ends]]) | _WORD
    return keys, of, hashes.view(np.int64), of[ends]


# --- model ----------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For arguments of one half and more: Stirling's series from ``x + 8`` on."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    out = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series
    for k in range(8):
        out -= np.log(x + k)
    return out


def _kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the estimator's probability of ``n0`` zeros and ``n1`` ones."""
    return (
        _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)
    )


# --- counts ---------------------------------------------------------------


def in_blocks(docs: DataFrame, size: int) -> DataFrame:
    """Rows with a ``block``: neighbours of about ``size`` bytes of text."""
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields]

    def numbered(batches):
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy()
            blocks = []
            for n in lengths:
                if filled >= size:
                    block, filled = block + 1, 0
                blocks.append(block)
                filled += int(n) + 64
            yield from in_parts([batch.append_column("block", pa.array(blocks, pa.int64()))])

    return docs.mapInArrow(numbered, ", ".join([*fields, "block long"]))


def _added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their numbers."""
    keys = np.concatenate([k for k, _ in found])
    order = np.argsort(keys)
    keys = keys[order]
    numbers = np.concatenate([n for _, n in found])[order]
    del order
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[starts], np.add.reduceat(numbers, starts) if len(starts) else numbers


def block_counts(rows: DataFrame, depth: int) -> DataFrame:
    """``block``, ``key`` and ``n``: each block's distinct strings and words.

    ``n`` counts texts that are not ``held_out`` only; what they lack has 0.
    """

    def made(block: int, found: list) -> Iterator[pa.RecordBatch]:
        keys, sums = _added(found)
        found.clear()
        # A batch is held whole outside of Spark's heap, and a block has millions of keys.
        for at in range(0, len(keys), ROWS):
            k, n = keys[at : at + ROWS], sums[at : at + ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), block)), pa.array(k), pa.array(n)],
                names=["block", "key", "n"],
            )

    def counted(batches):
        now, found, merged = None, [], 0
        for batch in in_parts(batches):
            blocks = batch["block"].to_numpy()
            for block in np.unique(blocks):
                mine = batch.filter(pa.array(blocks == block))
                if block != now:
                    if found:
                        yield from made(now, found)
                    now, found, merged = block, [], 0
                held_out = mine["held_out"].to_numpy(zero_copy_only=False)
                for group in pieces(map(words, mine["text"].to_pylist()), depth):
                    keys, of, hashes, texts = byte_strings(group, depth)
                    for k, out in ((keys, held_out[of]), (hashes, held_out[texts])):
                        found.append(np.unique(k[~out], return_counts=True))
                        unlearned = np.unique(k[out])
                        found.append((unlearned, np.zeros(len(unlearned), np.int64)))
                    if sum(len(k) for k, _ in found) - merged > 1 << 20:
                        found = [_added(found)]
                        merged = len(found[0][0])
        if found:
            yield from made(now, found)

    return rows.select("block", "held_out", "text").mapInArrow(
        counted, "block long, key long, n long"
    )


# --- weighting ------------------------------------------------------------


def _context_ids(level: int, *parts: np.ndarray) -> np.ndarray:
    ids = np.full(len(parts[0]), level + 1, np.uint64)
    for part in parts:
        ids = mixed(ids * _BASE + part.astype(np.uint64))
    return ids


def _node_ids(contexts: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return mixed(contexts + bits.astype(np.uint64) * _BASE).view(np.int64)


def _range_weighted(
    strings: np.ndarray, n: np.ndarray, depth: int
) -> tuple[tuple[np.ndarray, ...], list[tuple[np.ndarray, ...]]]:
    """Weighting of one range of all strings, in order.

    A context is a run of neighbours in that order at every depth, so only those of
    the first and the last string may go on in other ranges: these are open, all
    others are weighted here. The first result has, for each string, its deepest open
    context and by bit the probability of a one below it (NaN where nothing below is
    known); the second the open decisions: depth, id, the parent's id, the counts,
    and the sum over weighted children.
    """
    keys, counts, ups = [strings], [n.astype(np.float64)], []
    for d in range(depth - 1, -1, -1):
        below = keys[0]
        found, at = np.unique((below >> 16) << 8 | below & 255, return_inverse=True)
        counts.insert(0, np.bincount(at, counts[0], len(found)))
        keys.insert(0, found)
        ups.insert(0, at)
    opened, ids = [], []
    for d in range(depth + 1):
        context = keys[d] >> 8
        ends = strings[[0, -1]] >> 8 * (depth - d + 1)
        opened.append((context == ends[0]) | (context == ends[1]))
        ids.append(_context_ids(d, context))
    deepest, at = np.zeros(len(strings), np.uint64), np.arange(len(strings))
    todo = np.ones(len(strings), bool)
    for d in range(depth, -1, -1):
        mine = todo & opened[d][at]
        deepest[mine] = ids[d][at[mine]]
        todo &= ~mine
        if d:
            at = ups[d - 1][at]
    local, found = [], []
    for j in range(8):
        nodes = []
        for d in range(depth + 1):
            names = keys[d] >> (8 - j)
            first = np.concatenate([[True], names[1:] != names[:-1]])
            starts = np.flatnonzero(first)
            n1 = np.add.reduceat(counts[d] * ((keys[d] >> (7 - j)) & 1), starts)
            nodes.append((starts, np.cumsum(first) - 1, np.add.reduceat(counts[d], starts) - n1, n1))
        parents = [None] + [
            nodes[d - 1][1][ups[d - 1][nodes[d][0]]] for d in range(1, depth + 1)
        ]
        is_open = [opened[d][nodes[d][0]] for d in range(depth + 1)]
        shares: list[np.ndarray] = [np.empty(0)] * (depth + 1)
        below = np.empty(0)
        for d in range(depth, -1, -1):
            starts, _, n0, n1 = nodes[d]
            own = _kt_block(n0, n1)
            split = np.zeros(len(own))
            if d == depth:
                weighted, shares[d] = own, np.ones(len(own))
            else:
                split = np.bincount(
                    parents[d + 1], np.where(is_open[d + 1], 0, below), len(own)
                )
                weighted = np.logaddexp(own, split) - np.log(2)
                shares[d] = np.exp(own - np.log(2) - weighted)
            o = is_open[d]
            bits = 1 << j | (keys[d][starts[o]] & 255) >> (8 - j)
            above = np.zeros(o.sum(), np.int64)
            if d:
                above = _node_ids(ids[d - 1][ups[d - 1][starts[o]]], bits)
            found.append(
                (
                    np.full(len(bits), d),
                    _node_ids(ids[d][starts[o]], bits),
                    above,
                    n0[o],
                    n1[o],
                    split[o],
                )
            )
            below = weighted
        sums = left = ones = np.empty(0)
        for d in range(depth + 1):
            _, _, n0, n1 = nodes[d]
            p = (n1 + 0.5) / (n0 + n1 + 1)
            if not d:  # what begins all contexts is always open
                sums, left, ones = np.zeros(len(p)), np.ones(len(p)), np.full(len(p), np.nan)
                continue
            before, rest = sums[parents[d]], left[parents[d]]
            known = n0 + n1 > 0
            ones = np.where(known, before + rest * p, ones[parents[d]])
            sums = np.where(known, before + rest * shares[d] * p, ones)
            left = np.where(known, rest * (1 - shares[d]), 0.0)
            o = is_open[d]
            sums[o], left[o], ones[o] = 0.0, 1.0, np.nan
        local.append(ones[nodes[depth][1]])
    return (deepest.view(np.int64), *local), found


_BITS = [f"p{j}" for j in range(8)]
_WEIGHTED = ["depth int", "context long", "key long", *(f"{c} double" for c in _BITS)]


def weigh_ranges(strings: DataFrame, depth: int, rows: int = 1 << 17) -> DataFrame:
    """Strings (``depth`` -1) and open decisions of ranges of at most about ``rows``."""
    names = [c.split()[0] for c in _WEIGHTED]

    def weighed(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        keys, n = (table[c].to_numpy() for c in ("key", "n"))
        own, found = _range_weighted(keys, n, depth)
        minus = pa.array(np.full(len(keys), -1, np.int32))
        yield pa.RecordBatch.from_arrays(
            [minus, pa.array(own[0]), pa.array(keys), *map(pa.array, own[1:])],
            names=names,
        )
        d, node, above, n0, n1, split = (np.concatenate(c) for c in zip(*found))
        none = pa.nulls(len(d), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(d.astype(np.int32)),
                pa.array(node),
                pa.array(above),
                *(pa.array(c) for c in (n0, n1, split)),
                *[none] * 5,
            ],
            names=names,
        )

    def weighed_all(batches):
        parts, size = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(batch)
                size += batch.num_rows
            if size >= rows:
                yield from weighed(parts)
                parts, size = [], 0
        if parts:
            yield from weighed(parts)

    return (
        strings.repartitionByRange("key")
        .sortWithinPartitions("key")
        .mapInArrow(weighed_all, ", ".join(_WEIGHTED))
    )


def join_ranges(opened: pa.Table, depth: int) -> tuple[np.ndarray, ...]:
    """Open decisions of all ranges put together: ids in order, and by id three numbers.

    These are the mix of all depths down to the decision, what weight is left for
    those below, and the probability of a one where nothing below is known. There are
    a few thousand decisions for a range, whatever the number of contexts in it.
    """
    columns = (opened[c].to_numpy() for c in ("depth", "context", "key", "p0", "p1", "p2"))
    d, node, above, n0, n1, split = columns
    ids, first, at = np.unique(node, return_index=True, return_inverse=True)
    n0, n1, split = (np.bincount(at, c, len(ids)) for c in (n0, n1, split))
    d, up = d[first], np.searchsorted(ids, above[first])
    own, shares = _kt_block(n0, n1), np.ones(len(ids))
    for level in range(depth - 1, -1, -1):
        child = d == level + 1
        below = own if level == depth - 1 else weighted
        split = split + np.bincount(up[child], below[child], len(ids))
        weighted = np.logaddexp(own, split) - np.log(2)
        mine = d == level
        shares[mine] = np.exp(own - np.log(2) - weighted)[mine]
    p, known = (n1 + 0.5) / (n0 + n1 + 1), n0 + n1 > 0
    sums, left, ones = np.zeros(len(ids)), np.ones(len(ids)), np.full(len(ids), 0.5)
    for level in range(depth + 1):
        mine = np.flatnonzero(d == level)
        before, rest, other = np.zeros(len(mine)), np.ones(len(mine)), np.full(len(mine), 0.5)
        if level:
            before, rest, other = sums[up[mine]], left[up[mine]], ones[up[mine]]
        k, q, s = known[mine], p[mine], shares[mine]
        ones[mine] = np.where(k, before + rest * q, other)
        sums[mine] = np.where(k, before + rest * s * q, other)
        left[mine] = np.where(k, rest * (1 - s), 0.0)
    return ids, sums, left, ones


def string_prices(strings: DataFrame, depth: int, rows: int = 1 << 17) -> DataFrame:
    """``key`` and ``price``: the log-probability of each string's byte."""
    weighed = kept(weigh_ranges(strings, depth, rows), "weighed", "zstd")
    opened = weighed.filter("depth >= 0").select("depth", "context", "key", *_BITS[:3]).toArrow()
    shared = strings.sparkSession.sparkContext.broadcast(join_ranges(opened, depth))

    def priced(batches):
        ids, sums, left, ones = shared.value
        for batch in batches:
            context = batch["context"].to_numpy().view(np.uint64)
            byte = batch["key"].to_numpy() & 255
            total = np.zeros(len(byte))
            for j, c in enumerate(_BITS):
                at = np.searchsorted(ids, _node_ids(context, 1 << j | byte >> (8 - j)))
                local = batch[c].to_numpy()
                p = np.where(np.isnan(local), ones[at], sums[at] + left[at] * local)
                p = np.clip(p, 1e-9, 1 - 1e-9)
                total += np.log10(np.where((byte >> (7 - j)) & 1 == 1, p, 1 - p))
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(total)], names=["key", "price"]
            )

    return (
        weighed.filter("depth < 0")
        .drop("depth")
        .mapInArrow(priced, "key long, price double")
    )


# --- scoring --------------------------------------------------------------


class Lookup:
    """Values by key, for many keys at once: a table of slots, probed one after another.

    There are twice as many slots as keys.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.size = max(16, 2 * len(keys))
        if self.size >> 32:
            raise ValueError("too many keys for one table")
        self.keys = np.full(self.size, -1, np.int64)
        self.values = np.zeros(self.size)
        for start in range(0, len(keys), 1 << 20):
            todo = np.arange(start, min(start + (1 << 20), len(keys)))
            at = self._slots(keys[todo])
            while len(todo):
                free = self.keys[at] == -1
                self.keys[at[free]] = keys[todo[free]]
                mine = self.keys[at] == keys[todo]
                self.values[at[mine]] = values[todo[mine]]
                todo, at = todo[~mine], self._next(at[~mine])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        high = (keys.view(np.uint64) * GOLDEN) >> np.uint64(32)
        return ((high * np.uint64(self.size)) >> np.uint64(32)).view(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        at = at + 1
        at[at == self.size] = 0
        return at

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slots(keys)
        missed = np.flatnonzero(self.keys[at] != keys)
        while len(missed):
            at[missed] = self._next(at[missed])
            found = self.keys[at[missed]]
            if (found == -1).any():
                raise KeyError("a string without a price")
            missed = missed[found != keys[missed]]
        return self.values[at]


_SCORED = [
    "held_out boolean",
    "n_tokens long",
    "n_known long",
    "train_tokens long",
    "base_score double",
    "score double",
    "bits_per_byte double",
]


def score_texts(
    docs: DataFrame, held_out: Column, *, depth: int = 5, block_bytes: int = 3 << 24
) -> DataFrame:
    """Log-probabilities of all texts, learned from those that are not ``held_out``.

    Columns: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``, and ``bits_per_byte``, the model's code length over
    the bytes of the words and their ends. ``depth`` is 6 at most. Blocks have about
    ``block_bytes`` bytes of text, or one text.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth is from 1 to 6: a string is one 64-bit number")
    found = docs.select("doc_id", "text", held_out.alias("held_out"))
    size = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Partitions smaller than a block would make small blocks, which share less.
    found = found.coalesce(size // block_bytes + 1)
    rows = kept(in_blocks(found, block_bytes), "blocks", "zstd")
    asked = kept(block_counts(rows, depth), "asked", "zstd")
    counted = kept(asked.groupBy("key").agg(F.sum("n").alias("n")), "counted", "zstd")
    strings, vocabulary = counted.filter("key >= 0"), counted.filter("key < 0")
    ends = rows.filter("not held_out").count()
    totals = vocabulary.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n_tokens = (totals["n"] or 0) + ends
    whole = n_tokens + 0.1 * ((totals["v"] or 0) + (ends > 0) + 1)

    # A word's answer is how often training texts have it, a string's its price.
    answers = vocabulary.select("key", F.col("n").cast("double").alias("price")).unionAll(
        string_prices(strings, depth)
    )
    got = asked.join(answers, "key").select("block", "key", "price")

    def scored(texts: pa.Table, prices: pa.Table) -> pa.Table:
        price = Lookup(prices["key"].to_numpy(), prices["price"].to_numpy())
        out = []
        for batch in texts.to_batches(max_chunksize=512):
            tokens = [words(t) for t in batch["text"].to_pylist()]
            size = len(tokens)
            n_known, score = np.full(size, int(ends > 0)), np.zeros(size)
            base = np.full(size, np.log10((ends + 0.1) / whole))
            for group in pieces(tokens, depth):
                keys, of, hashes, of_words = byte_strings(group, depth)
                score += np.bincount(of, price[keys], size)
                c = price[hashes]
                n_known += np.bincount(of_words, c > 0, size).astype(np.int64)
                base += np.bincount(of_words, np.log10((c + 0.1) / whole), size)
            n = np.array([len(t) for t in tokens], dtype=np.int64) + 1
            coded = np.array([sum(map(len, t)) for t in tokens], dtype=np.int64) + n
            columns = (n, n_known, np.full(size, n_tokens), base, score)
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"],
                        batch["held_out"],
                        *map(pa.array, columns),
                        pa.array(-score / np.log10(2) / coded),
                    ],
                    names=["doc_id", *(c.split()[0] for c in _SCORED)],
                )
            )
        return pa.Table.from_batches(out)

    kind = found.schema["doc_id"].dataType.simpleString()
    return (
        rows.groupBy("block")
        .cogroup(got.groupBy("block"))
        .applyInArrow(scored, ", ".join([f"doc_id {kind}", *_SCORED]))
    )
