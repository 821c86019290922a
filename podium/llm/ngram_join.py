"""Exact Jaccard join of documents on word shingles, with signature trees.

Two texts link when their sets of shingles (runs of ``width`` words, A-Z
lower-cased) have a Jaccard similarity of at least ``percent`` in a hundred. No
link is lost, and no step writes all pairs of a group:

1. Texts with equal sets are one class. Of each set a fixed share of its shingles,
   chosen by hash, is looked up in the whole table. A text that links with another
   misses at most ``n - ceil(t * n)`` of its shingles there, so a class that holds
   more which no other class has can have no partner. Most texts end here.
2. Of the classes that remain, two that link have a neighbouring pair of shingles
   in common among the first ``2 * (1 - t) / t * n + 1`` pairs by hash (``keys_of``).
   Texts that are not alike hardly share one. The classes with a pair meet at the
   least of them: a class goes with its whole set to few meeting points, because
   copies share their pairs and therefore their least member.
3. Where they meet, a signature tree holds them: a node has the size range of the
   sets below it and the union of their bitmaps. Two trees (or a tree and itself)
   are traversed together; a pair of nodes goes on only if sets below them could
   overlap enough. At the leaves the sets themselves decide. Pairs that are already
   connected are passed over, so a group of copies costs one comparison each, and
   only a star of each group's components comes out.
4. Meeting points beyond ``tile`` classes are dealt into tiles; every pair of tiles
   is a task of its own.
5. The stars are joined to components by alternating star contraction.

Null texts, empty texts and texts without words have no shingles and link with
nothing. Texts of fewer than ``width`` words have one shingle: all their words.
Rows of one id count as one document. Rows without id link like others but have no
id to give: equal ones count as one, under a number from 2**62 on, which ids must
not reach. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from podium.llm.common import in_parts, kept, mixed, words

#: Rows without id have numbers from here on.
NAMELESS = 1 << 62
#: Sets below this size are looked up whole and not by a share.
SMALL = 72
LEAF = 16
FANOUT = 8

_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) * 2 + 1


# --- sets -----------------------------------------------------------------


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    # A short text is one shingle; its number of words sets it apart from others.
    n = min(width, len(found))
    runs = len(found) - n + 1
    out = np.full(runs, n, np.uint64)
    for i in range(n):
        out = mixed(out + hashes[i : i + runs] * _MULTIPLIERS[i])
    return np.unique(out)


def slack(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """How many of its ``n`` shingles a set may have that a linked set has not."""
    return n + (-percent * n) // 100


def links(n: int, m: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def share_bound(percent: int) -> int:
    """Hashes below this are looked up: a share a tenth above what a set may miss."""
    return int(2**64 * min(1.0, 1.1 - percent / 100))


def looked_up(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Those a set sends to the table of all shingles.

    Small sets send all, and so do those that could link with a small one.
    """
    bound = share_bound(percent)
    if len(shingles) * percent < 100 * SMALL or bound >= 2**64:
        return shingles
    return shingles[: np.searchsorted(shingles, np.uint64(bound))]


def keys_of(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of which two different linked sets have one in common.

    A set of ``n`` and a linked one differ by at most ``d = n * (1 - t) / t``
    shingles on both sides together. In order of hash, a shingle that only one set
    has takes at most two neighbouring pairs from the other's list, or comes between
    one; it moves later pairs by one place. So of the first ``2 * d + 1`` pairs of
    both, one is the same. Below 80 % that may be more pairs than there are, and
    the first ``n - ceil(t * n) + 1`` shingles themselves are used (prefix filter).
    """
    n = len(shingles)
    if percent < 80:
        return shingles[: slack(n, percent) + 1]
    first = 2 * (n * (100 - percent) // percent) + 1
    head = shingles[: first + 1]
    return mixed(head[:-1] * _MULTIPLIERS[0] + head[1:] * _MULTIPLIERS[1])


# --- signature trees ------------------------------------------------------


class SignatureTree:
    """Sets in an order that brings alike ones together, with nodes over ranges.

    ``levels[0]`` are the leaves. A node has bounds in the order, an or of bitmaps,
    the least and greatest size, and the most shingles beyond its bits that any set
    has (two sets share at most their common bits plus that).
    """

    def __init__(self, sets: list[np.ndarray], members: list[int], bits: int):
        self.members = sorted(
            members, key=lambda i: (int(sets[i][0]), len(sets[i]), int(sets[i][-1]))
        )
        own = [sets[i] for i in self.members]
        sizes = np.array([len(s) for s in own])
        rows = np.repeat(np.arange(len(own)), sizes)
        table = np.zeros((len(own), bits), bool)
        table[rows, (np.concatenate(own) & np.uint64(bits - 1)).astype(np.int64)] = True
        self.bitmaps = np.packbits(table, axis=1).view(np.uint64)
        self.sizes = sizes
        self.extra = sizes - table.sum(axis=1)
        starts = np.arange(0, len(own), LEAF)
        ends = np.minimum(starts + LEAF, len(own))
        level = (
            starts,
            ends,
            np.bitwise_or.reduceat(self.bitmaps, starts, axis=0),
            np.minimum.reduceat(sizes, starts),
            np.maximum.reduceat(sizes, starts),
            np.maximum.reduceat(self.extra, starts),
        )
        self.levels = [level]
        while len(level[0]) > 1:
            starts, ends, bitmaps, least, most, extra = level
            at = np.arange(0, len(starts), FANOUT)
            level = (
                starts[at],
                ends[np.minimum(at + FANOUT, len(starts)) - 1],
                np.bitwise_or.reduceat(bitmaps, at, axis=0),
                np.minimum.reduceat(least, at),
                np.maximum.reduceat(most, at),
                np.maximum.reduceat(extra, at),
            )
            self.levels.append(level)

    def children(self, level: int, node: int) -> range:
        below = len(self.levels[level - 1][0])
        return range(node * FANOUT, min((node + 1) * FANOUT, below))


def _common(sets: list[np.ndarray], x: int, y: int) -> int:
    a, b = sets[x], sets[y]
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def linked_components(
    sets: list[np.ndarray], left: list[int], right: list[int] | None, percent: int
) -> np.ndarray:
    """A label for each set: equal labels are connected by links.

    Links are looked for between ``left`` and ``right``, or within ``left``.
    """
    label = np.arange(len(sets))
    widest = max(len(s) for s in sets)
    bits = 256
    while bits < 2 * widest and bits < 32_768:
        bits *= 2
    one = SignatureTree(sets, left, bits)
    two = one if right is None else SignatureTree(sets, right, bits)
    a_members, b_members = np.array(one.members), np.array(two.members)

    def at_leaves(a: int, b: int) -> None:
        a0, a1 = one.levels[0][0][a], one.levels[0][1][a]
        b0, b1 = two.levels[0][0][b], two.levels[0][1][b]
        shared = np.bitwise_count(
            one.bitmaps[a0:a1, None, :] & two.bitmaps[None, b0:b1, :]
        ).sum(axis=2, dtype=np.int64)
        n, m = one.sizes[a0:a1, None], two.sizes[None, b0:b1]
        bound = shared + np.minimum(one.extra[a0:a1, None], two.extra[None, b0:b1])
        bound = np.minimum(bound, np.minimum(n, m))
        may = (100 + percent) * bound >= percent * (n + m)
        if one is two and a == b:
            may = np.triu(may, 1)
        for i, j in zip(*np.nonzero(may)):
            x, y = a_members[a0 + i], b_members[b0 + j]
            if label[x] != label[y] and links(
                len(sets[x]), len(sets[y]), _common(sets, x, y), percent
            ):
                low, high = sorted((label[x], label[y]))
                label[label == high] = low

    todo = [(len(one.levels) - 1, 0, len(two.levels) - 1, 0)]
    while todo:
        la, a, lb, b = todo.pop()
        sa, ea, bits_a, least_a, most_a, extra_a = (c[a] for c in one.levels[la])
        sb, eb, bits_b, least_b, most_b, extra_b = (c[b] for c in two.levels[lb])
        # Nodes of one tree are either the same or have no set in common.
        same = one is two and la == lb and a == b
        if not same:
            shared = int(np.bitwise_count(bits_a & bits_b).sum()) + min(extra_a, extra_b)
            if (100 + percent) * min(shared, most_a, most_b) < percent * (least_a + least_b):
                continue
        ours, theirs = label[a_members[sa:ea]], label[b_members[sb:eb]]
        if (ours == ours[0]).all() and (theirs == ours[0]).all():
            continue
        if la == 0 and lb == 0:
            at_leaves(a, b)
        elif same:
            below = one.children(la, a)
            todo += [(la - 1, i, la - 1, j) for i in below for j in below if i <= j]
        elif la >= lb:
            todo += [(la - 1, i, lb, b) for i in one.children(la, a)]
        else:
            todo += [(la, a, lb - 1, j) for j in two.children(lb, b)]
    return label


# --- tables ---------------------------------------------------------------


def _number_rows(docs: DataFrame) -> tuple[Column, Column | None]:
    """The id of a row, or a number from its text; and which numbers are ids.

    The numbers follow all ids, unless there are ids from ``NAMELESS`` on beside rows
    without id. Then they are any hashes, and nothing tells them from ids.
    """
    own = F.col("doc_id").cast("long")
    seen = docs.agg(
        F.count_if(own.isNull()).alias("nameless"), F.max(own).alias("last")
    ).first()
    if not seen["nameless"]:
        return own, F.lit(True)
    if seen["last"] is not None and seen["last"] >= NAMELESS:
        return F.coalesce(own, F.xxhash64("text")), None
    nameless = F.xxhash64("text").bitwiseAND(F.lit(NAMELESS - 1)) + F.lit(NAMELESS)
    return F.coalesce(own, nameless), F.col("root") < NAMELESS


def _class_of(shingles: np.ndarray) -> tuple[int | None, int | None]:
    """The class of a set as two numbers; none if it is empty."""
    if not len(shingles):
        return None, None
    high, low = np.frombuffer(xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(high), int(low)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    """A column of lists of hashes, as signed numbers."""
    flat = np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64)
    offsets = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def _classed(texts: DataFrame, width: int) -> DataFrame:
    """``id``, ``named``, the size ``n`` of the set, and its class ``high``, ``low``."""

    def classed(batches):
        for batch in in_parts(batches):
            sets = [shingle_set(t, width) for t in batch["text"].to_pylist()]
            high, low = zip(*map(_class_of, sets)) if sets else ([], [])
            columns = ([len(s) for s in sets], high, low)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["named"], *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "named", "n", "high", "low"],
            )

    return texts.mapInArrow(classed, "id long, named boolean, n long, high long, low long")


def _tokens(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``high`` and ``token``: the shingles that each class looks up."""

    def listed(batches):
        for batch in in_parts(batches):
            sets = [shingle_set(t, width) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_class_of(s)[0] for s in sets], pa.int64()),
                    _lists([looked_up(s, percent) for s in sets]),
                ],
                names=["high", "tokens"],
            )

    listed_sets = texts.select("text").mapInArrow(listed, "high long, tokens array<long>")
    return listed_sets.select("high", F.explode("tokens").alias("token"))


def _survivors(classed: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Classes that may have a partner: ``id`` (their least), ``high`` and ``low``."""
    bound = share_bound(percent)
    # As signed numbers the upper half of the hashes is negative.
    if bound >= 2**64:
        in_share = F.lit(True)
    elif bound >= 2**63:
        in_share = (F.col("token") >= 0) | (F.col("token") < bound - 2**64)
    else:
        in_share = (F.col("token") >= 0) & (F.col("token") < bound)
    alone = (
        tokens.groupBy("token")
        .agg(F.min("high").alias("h"), F.max("high").alias("other"))
        .filter("h = other")
        .groupBy("h")
        .agg(F.count("*").alias("own"), F.count_if(in_share).alias("own_share"))
    )
    classes = (
        classed.filter("n > 0")
        .groupBy("high", "low")
        .agg(F.min("id").alias("id"), F.first("n").alias("n"))
    )
    missed = F.when(F.col("n") < SMALL, F.col("own")).otherwise(F.col("own_share"))
    most = F.col("n") - F.ceil(F.col("n") * percent / 100)
    return (
        classes.join(alone, F.col("high") == F.col("h"), "left")
        .filter(F.coalesce(missed, F.lit(0)) <= most)
        .select("id", "high", "low")
    )


def _bit_table(ids: DataFrame, bits: int) -> np.ndarray:
    """A table of ``bits`` bits, of which those of the hashes of ``id`` are set."""
    words = (
        ids.select(_bit(bits).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return table


def _bit(bits: int) -> Column:
    return F.xxhash64("id").bitwiseAND(F.lit(bits - 1))


def _sets(
    texts: DataFrame, survivors: DataFrame, width: int, percent: int, bits: int
) -> DataFrame:
    """Of each class that remains, its least id, its whole set and its keys.

    A table of ``bits`` bits says whose texts are wanted, so no text is shuffled. The
    few others that it lets through do no harm: their sets are their own.
    """
    shared = survivors.sparkSession.sparkContext.broadcast(_bit_table(survivors, bits))

    def built(batches):
        wanted, seen = shared.value, set()
        for batch in in_parts(batches):
            bit = batch["bit"].to_numpy()
            chosen = wanted[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)
            batch = batch.filter(pa.array(chosen.astype(bool)))
            ids, sets = [], []
            for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                shingles = shingle_set(text, width)
                key = (i, _class_of(shingles))
                if len(shingles) and key not in seen:  # repeated rows
                    seen.add(key)
                    ids.append(i)
                    sets.append(shingles)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    _lists([keys_of(s, percent) for s in sets]),
                ],
                names=["id", "shingles", "keys"],
            )

    return texts.withColumn("bit", _bit(bits)).mapInArrow(
        built, "id long, shingles binary, keys array<long>"
    )


def _meetings(sets: DataFrame, tile: int, tile_shingles: int) -> DataFrame:
    """Who meets where: ``place``, the pair of tiles ``one`` and ``two``, ``tile`` and ``id``."""
    posted = sets.select(
        "id", F.explode("keys").alias("key"), F.octet_length("shingles").alias("size")
    )
    hosts = (
        posted.groupBy("key")
        .agg(F.min("id").alias("place"), F.max("id").alias("last"))
        .filter("place < last")
        .select("key", "place")
    )
    members = posted.join(hosts, "key").groupBy("place", "id").agg(F.first("size").alias("size"))
    by_count, by_size = F.ceil(F.count("*") / tile), F.ceil(F.sum("size") / (8 * tile_shingles))
    tiles = members.groupBy("place").agg(
        F.greatest(by_count, by_size).cast("int").alias("tiles")
    )
    dealt = members.join(tiles, "place").withColumn(
        "tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    return dealt.select("place", "id", "tile", other).select(
        "place",
        F.least("tile", "other").alias("one"),
        F.greatest("tile", "other").alias("two"),
        "tile",
        "id",
    )


def _stars(met: DataFrame, percent: int) -> DataFrame:
    """Edges ``u``, ``v`` from each set to the first of its component, by meeting."""

    def solved(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        ids, sets, tiles = [], [], []
        met = set()
        for i, tile, raw in rows:
            if (i, raw) not in met:
                met.add((i, raw))
                ids.append(i)
                tiles.append(tile)
                sets.append(np.frombuffer(raw, np.uint64))
        _, one, two = key
        left = [k for k, t in enumerate(tiles) if t == one]
        right = [k for k, t in enumerate(tiles) if t == two]
        if len(ids) < 2 or not left or not right:
            return []
        label = linked_components(sets, left, None if one == two else right, percent)
        return [(ids[k], ids[r]) for k, r in enumerate(label) if k != r]

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def emitted(edges):
            u, v = zip(*edges) if edges else ([], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
            )

        for batch in in_parts(batches):
            edges = []
            keys = zip(*(batch[c].to_pylist() for c in ("place", "one", "two")))
            parts = zip(*(batch[c].to_pylist() for c in ("id", "tile", "shingles")))
            for k, part in zip(keys, parts):
                if k != key:
                    if rows:
                        edges += solved(key, rows)
                    key, rows = k, []
                rows.append(part)
            yield emitted(edges)
        if rows:
            yield emitted(solved(key, rows))

    return (
        met.repartition("place", "one", "two")
        .sortWithinPartitions("place", "one", "two", "tile", "id")
        .mapInArrow(stars, "u long, v long")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node connected to it, of each node with edges.

    Large and small stars in turn until nothing changes; each round is written. A
    node's neighbours are never gathered: only their minimum is.
    """
    now = kept(edges.filter("u <> v").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v")).alias("h")).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Every edge now points down.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(lowest.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        now = kept(small, "edges")


def _components_by_row(
    docs: DataFrame,
    number: Column,
    width: int,
    percent: int,
    tile: int,
    tile_shingles: int,
    filter_bits: int,
) -> DataFrame:
    """``id``, ``named``, ``n`` and the ``root`` of its component, of each row."""
    texts = docs.select(
        number.alias("id"), "text", F.col("doc_id").isNotNull().alias("named")
    )
    classed = kept(_classed(texts, width), "classes")
    tokens = _tokens(texts, width, percent)
    survivors = kept(_survivors(classed, tokens, percent), "survivors")
    sets = kept(_sets(texts, survivors, width, percent, filter_bits), "sets")
    met = _meetings(sets, tile, tile_shingles).join(sets.select("id", "shingles"), "id")
    roots = components(_stars(met, percent))
    first = (
        classed.filter("n > 0")
        .groupBy("high", "low")
        .agg(F.min("id").alias("first"))
        .join(roots, F.col("first") == F.col("node"), "left")
        .select("high", "low", F.coalesce("root", "first").alias("root"))
    )
    return classed.join(first, ["high", "low"], "left").select(
        "id", "named", "n", F.coalesce("root", "id").alias("root")
    )


def jaccard_components(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    tile: int = 1_000,
    tile_shingles: int = 2_000_000,
    filter_bits: int = 1 << 26,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs``.

    ``component_id`` is the least id that links lead to, its own included, and null
    where no row of the component has an id. ``tile`` classes, or sets of
    ``tile_shingles`` in all, meet in one task at most; ``filter_bits`` (a power of two)
    is the size of the table that tells which texts are read again.
    """
    number, is_id = _number_rows(docs)
    rows = _components_by_row(docs, number, width, percent, tile, tile_shingles, filter_bits)
    if is_id is None:
        least = rows.filter("named").groupBy("root").agg(F.min("id").alias("component_id"))
        rows = rows.join(least, "root", "left")
    else:
        rows = rows.withColumn("component_id", F.when(is_id, F.col("root")))
    own = F.when(F.col("named"), F.col("id")).alias("doc_id")
    return rows.select(own, F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    tile: int = 1_000,
    tile_shingles: int = 2_000_000,
    filter_bits: int = 1 << 26,
) -> DataFrame:
    """Of each component one row: the least id's, of its rows the one of least text.

    Rows without shingles link with nothing and all stay. Columns are those of
    ``docs``.
    """
    number, _ = _number_rows(docs)
    rows = _components_by_row(docs, number, width, percent, tile, tile_shingles, filter_bits)
    gone = rows.filter("n > 0 and id <> root").select(F.col("id").alias("_podium_gone")).distinct()
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    left = docs.withColumns(
        {"_podium_id": number, "_podium_blank": blank}
    ).join(gone, F.col("_podium_id") == F.col("_podium_gone"), "left_anti")
    # Only repeated ids come to more than one row.
    nth = F.row_number().over(Window.partitionBy("_podium_id", "_podium_blank").orderBy("text"))
    return (
        left.withColumn("_podium_nth", nth)
        .filter(F.col("_podium_blank") | (F.col("_podium_nth") == 1))
        .drop("_podium_nth", "_podium_blank", "_podium_id")
    )
