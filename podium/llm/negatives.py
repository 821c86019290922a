"""Hard negatives by threshold joins after L2AP, lowered until windows are full.

Components are scaled and floored to integers, so inner products are exact. Rows and
queries are dealt into blocks of bounded size and every pair of blocks is one group.
There a join finds all pairs whose inner product reaches a query's threshold: the
inverted index of a block leaves out the last dimensions of a row where the norm of
what follows, times the longest query, is below the least threshold; scores are added
up list by list, and a pair is dropped once its partial score and the product of the
norms that remain stay below the threshold. A threshold starts high and is lowered for
the queries that have not found enough yet: first the rows of the query's own label,
its positives, then, for each positive's score, the best rows of other labels in the
window of scores below it. A block gives a query only as many rows as can be in the
result, so nothing is lost by taking the blocks' best.

Rows of equal vector and label differ in their ids only, and the smaller ids come first
everywhere: all but the first few can never be in a result and are left out of the
search, however many they are, and one search serves all anchors among them.

Rows without id, with a null label, and vectors that are null, empty, of another
length than most or hold a null or non-finite component take no part; nor do vectors
with a component so large (1.4 million for 64 dimensions and a scale of 256) that an
inner product might not fit 64 bits. Zero vectors do. Of rows with one id the least
(vector, label) counts. Ties go to the smaller id. An anchor without positives, or
whose windows are empty, has no rows. An empty table gives an empty result. Columns
besides ``vec_id``, ``embedding`` and ``label`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import kept

#: Dimensions whose lists are gone through together.
SLAB = 8
#: Queries joined at a time: bounds the memory of a task.
AT_ONCE = 256
#: Share of pairs that are left below which each is followed by itself.
SPARSE = 0.125
#: Thresholds of the search for positives, as shares of the greatest possible score.
SHARES = (0.6, 0.4, 0.25, 0.1)
#: Thresholds of the search for negatives, as shares of the highest window's end.
STEPS = (0.85, 0.7, 0.6)
#: Allowance for rounding in bounds; scores themselves are exact.
SLACK = 1e-9


class Index:
    """Inverted lists of rows for scores of ``least`` with queries up to ``reach`` long.

    Rows are sorted by the number of dimensions they are listed under, so the list of
    a dimension is the first so many rows.
    """

    def __init__(self, rows: np.ndarray, least: float, reach: float):
        dim = rows.shape[1]
        norms = suffix_norms(rows)
        if least > 0:
            listed = (norms[:, :-1] * reach * (1 + SLACK) >= least).sum(axis=1)
            listed = np.minimum(-(-listed // SLAB) * SLAB, dim)
        else:
            listed = np.full(len(rows), dim)
        self.order = np.argsort(-listed, kind="stable")
        self.rows, self.norms, self.listed = rows[self.order], norms[self.order], listed[self.order]
        self.lengths = {s: int((listed > s).sum()) for s in range(0, dim, SLAB)}

    def join(
        self, queries: np.ndarray, floors: np.ndarray, may: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of all pairs that reach the query's floor.

        ``may`` (queries by rows) says which pairs count.
        """
        n = self.lengths[0]  # a row in no list can reach no floor
        norms = suffix_norms(queries)
        partial = np.zeros((len(queries), n), queries.dtype)
        alive = may[:, self.order[:n]]
        upto = 0
        for upto in [*self.lengths, None]:
            if upto is None or not alive.any() or alive.mean() < SPARSE:
                break
            size, end = self.lengths[upto], min(upto + SLAB, queries.shape[1])
            partial[:, :size] += queries[:, upto:end] @ self.rows[:size, upto:end].T
            left = norms[:, end, None] * self.norms[:size, end]
            alive[:, :size] &= (partial[:, :size] + left) * (1 + SLACK) + SLACK >= floors[:, None]
        q, r = np.nonzero(alive)
        score = partial[q, r]
        del partial, alive
        if upto is not None:
            for start in range(upto, queries.shape[1], SLAB):
                end = min(start + SLAB, queries.shape[1])
                # What is listed no further is only checked in the end.
                on = np.flatnonzero(self.listed[r] > start)
                score[on] += products(queries, self.rows, q[on], r[on], start, end)
                bound = score[on] + norms[q[on], end] * self.norms[r[on], end]
                good = np.ones(len(q), bool)
                good[on] = bound * (1 + SLACK) + SLACK >= floors[q[on]]
                q, r, score = q[good], r[good], score[good]
        for start in range(0, queries.shape[1], SLAB):
            end = min(start + SLAB, queries.shape[1])
            on = np.flatnonzero(self.listed[r] <= start)
            score[on] += products(queries, self.rows, q[on], r[on], start, end)
        good = score >= floors[q]
        return q[good], self.order[r[good]], score[good]


def products(
    queries: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray, start: int, end: int
) -> np.ndarray:
    """Inner products of pairs over the dimensions from ``start`` to ``end``."""
    out = np.zeros(len(q), queries.dtype)
    for d in range(start, end):
        out += queries[q, d] * rows[r, d]
    return out


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Norms of what follows each dimension, and of nothing."""
    squares = np.square(rows.astype(np.float64))
    sums = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([sums, np.zeros((len(rows), 1))], axis=1))


def exact(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if all sums are whole numbers below 2^53, else as integers."""
    most = [int(np.abs(m).max(initial=0)) for m in (rows, queries)]
    if rows.shape[1] * most[0] * most[1] < 2**53:
        return rows.astype(np.float64), queries.astype(np.float64)
    return rows, queries


def best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:n]


def by_query(q: np.ndarray, n: int) -> list[slice]:
    """Where each query's pairs lie among pairs sorted by query."""
    ends = np.searchsorted(q, np.arange(n + 1))
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def best_of_label(
    ids: np.ndarray, rows: np.ndarray, labels: np.ndarray,
    queries: np.ndarray, query_labels: np.ndarray, n: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query with ids and scores of its ``n`` best rows of its label."""
    rows, queries = exact(rows, queries)
    size = np.sqrt(np.square(queries.astype(np.float64)).sum(axis=1))
    most = size * np.sqrt(np.square(rows.astype(np.float64)).sum(axis=1)).max(initial=0)
    same = query_labels[:, None] == labels
    need = np.minimum(same.sum(axis=1), n)
    open_ = np.flatnonzero(need)
    for share in (*SHARES, None):
        if not len(open_):
            return
        floors = np.full(len(open_), -np.inf) if share is None else most[open_] * share
        index = Index(rows, floors.min(), size[open_].max())
        q, r, score = index.join(queries[open_], floors, same[open_])
        full = []
        for k, of in enumerate(by_query(q, len(open_))):
            if of.stop - of.start >= need[open_[k]]:
                top = best(ids[r[of]], score[of], n)
                yield int(open_[k]), ids[r[of]][top], score[of][top]
                full.append(k)
        open_ = np.delete(open_, full)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and greatest score between two percentages of a positive's."""
    return -(-low * score // 100), high * score // 100


def best_in_windows(
    ids: np.ndarray, rows: np.ndarray, labels: np.ndarray,
    queries: np.ndarray, query_labels: np.ndarray, scores: list[list[int]],
    n: int, low: int, high: int,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Each query and positive's score with the ``n`` best rows of the window below it."""
    rows, queries = exact(rows, queries)
    size = np.sqrt(np.square(queries.astype(np.float64)).sum(axis=1))
    other = query_labels[:, None] != labels
    windows = [{s: window(s, low, high) for s in found} for found in scores]
    windows = [{s: w for s, w in found.items() if w[0] <= w[1]} for found in windows]
    open_ = np.array([k for k, found in enumerate(windows) if found and other[k].any()], int)
    for step in (*STEPS, None):
        if not len(open_):
            return
        ends = np.array([max(b for _, b in windows[k].values()) for k in open_], float)
        floors = np.array([min(a for a, _ in windows[k].values()) for k in open_], float)
        if step is not None:
            floors = np.maximum(floors, ends * step)
        floors *= 1 - SLACK  # large ones may have been rounded up
        index = Index(rows, floors.min(), size[open_].max())
        q, r, score = index.join(queries[open_], floors, other[open_])
        for k, of in enumerate(by_query(q, len(open_))):
            own = windows[open_[k]]
            for s, (a, b) in list(own.items()):
                held = np.flatnonzero((score[of] >= a) & (score[of] <= b))
                if len(held) < n and floors[k] > a:
                    continue  # what is below the floor is not known yet
                near = r[of][held]
                top = best(ids[near], score[of][held], n)
                yield int(open_[k]), s, ids[near][top], score[of][held][top]
                del own[s]
        open_ = np.array([k for k in open_ if windows[k]], int)


# --- tables ---------------------------------------------------------------


def whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column, scale: int) -> Column:
    """Whether a vector's components are finite and their products fit 64 bits."""
    limit = F.floor(F.sqrt(F.lit(float(2**63 - 2**40)) / F.size(vector))) - 1
    fits = F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double") * scale) <= limit),
    )
    return F.coalesce(fits & (F.size(vector) > 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy().astype(np.int64)
    return flat.reshape(len(column), -1)


def in_chunks(queries: pa.Table) -> Iterator[pa.Table]:
    for at in range(0, queries.num_rows, AT_ONCE):
        yield queries.slice(at, AT_ONCE)


def _table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, kinds.items())})


def _top(found: DataFrame, group: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n)


class Blocks:
    """Rows and queries in blocks, and a function over all pairs of blocks."""

    def __init__(self, rows: DataFrame, rows_in_block: int, queries_in_block: int):
        self.rows, self.queries_in_block = rows, queries_in_block
        self.n = max(1, -(-rows.count() // rows_in_block))

    def search(self, queries: DataFrame, function, schema: str) -> DataFrame:
        parts = max(1, -(-queries.count() // self.queries_in_block))
        rows = self.rows.select("vec_id", "label", "v").withColumn(
            "block", F.pmod(F.xxhash64("vec_id"), F.lit(self.n)).cast("int")
        )
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        asked = queries.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(self.n - 1))))
        return (
            rows.groupBy("block", "part")
            .cogroup(asked.groupBy("block", "part"))
            .applyInArrow(function, schema)
        )


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    rows_in_block: int = 8192,
    queries_in_block: int = 8192,
) -> DataFrame:
    """Each anchor's first positives, and for each the first negatives below it.

    ``anchor_id``, ``positive_id``, ``rank`` (from 1, among those returned),
    ``negative_id``, ``positive_score`` and ``negative_score``. ``is_anchor`` is a
    condition on ``vec_id``. A negative's score lies between ``low`` and ``high``
    percent of the positive's.
    """
    given = vectors.select("vec_id", "label", "embedding").filter(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & usable(F.col("embedding"), scale)
    )
    lengths = given.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "dim").first()
    dim = most["dim"] if most else 0
    rows = kept(
        given.filter(F.size("embedding") == dim)
        .select("vec_id", F.struct(whole(F.col("embedding"), scale).alias("v"), "label").alias("r"))
        .groupBy("vec_id")
        .agg(F.min("r").alias("r"))
        .select("vec_id", "r.label", "r.v")
        .withColumn(
            "key",
            F.sha2(F.array_join(F.concat(F.array("label"), "v").cast("array<string>"), ","), 256),
        ),
        "vectors",
    )
    anchors = rows.filter(is_anchor).select("vec_id", "key")

    # The rows of equal vector and label that can be in a result.
    first = Window.partitionBy("key").orderBy("vec_id")
    members = kept(
        rows.withColumn("nth", F.row_number().over(first)).filter(
            F.col("nth") <= max(positives + 1, negatives)
        ),
        "members",
    )
    queries = kept(
        members.filter("nth = 1")
        .join(anchors.select("key").distinct(), "key", "left_semi")
        .select("key", "label", "v"),
        "anchors",
    )
    blocks = Blocks(members, rows_in_block, queries_in_block)
    key_kind = pa.string()
    id_kind, label_kind = pa.int64(), rows.schema["label"].dataType.simpleString()

    def own(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows:
            ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
            matrix = _matrix(block["v"])
            for chunk in in_chunks(asked):
                keys = chunk["key"].to_pylist()
                found = best_of_label(
                    ids, matrix, labels, _matrix(chunk["v"]), chunk["label"].to_numpy(), positives + 1
                )
                out += [
                    (keys[q], i, int(s))
                    for q, near, scores in found
                    for i, s in zip(near.tolist(), scores)
                ]
        return _table(out, {"key": key_kind, "vec_id": id_kind, "score": pa.int64()})

    near = _top(
        blocks.search(queries, own, "key string, vec_id long, score long"), ["key"], positives + 1
    )
    near = kept(near.select("key", "nth", F.col("vec_id").alias("positive_id"), "score"), "positives")

    def others(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows:
            ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
            matrix = _matrix(block["v"])
            for chunk in in_chunks(asked):
                keys = chunk["key"].to_pylist()
                found = best_in_windows(
                    ids, matrix, labels, _matrix(chunk["v"]), chunk["label"].to_numpy(),
                    chunk["scores"].to_pylist(), negatives, low, high,
                )
                out += [
                    (keys[q], p, i, int(s))
                    for q, p, far, scores in found
                    for i, s in zip(far.tolist(), scores)
                ]
        kinds = {"key": key_kind, "positive_score": pa.int64(), "vec_id": id_kind, "score": pa.int64()}
        return _table(out, kinds)

    # At most ``positives + 1`` scores to a query.
    asked = queries.join(near.groupBy("key").agg(F.collect_set("score").alias("scores")), "key")
    far = _top(
        blocks.search(asked, others, "key string, positive_score long, vec_id long, score long"),
        ["key", "positive_score"],
        negatives,
    )
    listed = far.groupBy("key", "positive_score").agg(
        F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("far")
    )
    found = kept(
        near.withColumnRenamed("score", "positive_score")
        .join(listed, ["key", "positive_score"], "left")
        .groupBy("key")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("nth", "positive_id", "positive_score", "far"))
            ).alias("near")
        ),
        "negatives",
    )

    # Results of the few vectors that many anchors share are broadcast, so none of
    # them gathers its anchors in one task: at most a thousand, of bounded size.
    shared = anchors.groupBy("key").agg(F.count("*").alias("n"))
    total = shared.agg(F.sum("n")).scalar()
    hot = F.broadcast(found.join(shared.filter(F.col("n") * 1000 > total), "key").drop("n"))
    each = anchors.join(hot, "key").unionByName(
        anchors.join(hot.select("key"), "key", "left_anti").join(found, "key")
    )
    chosen = F.slice(
        F.filter("near", lambda p: p["positive_id"] != F.col("vec_id")), 1, positives
    )
    return (
        each.select(F.col("vec_id").alias("anchor_id"), F.explode(chosen).alias("p"))
        .select(
            "anchor_id", "p.positive_id", "p.positive_score", F.explode("p.far").alias("far")
        )
        .select(
            "anchor_id",
            "positive_id",
            F.col("far.nth").cast("int").alias("rank"),
            F.col("far.vec_id").alias("negative_id"),
            "positive_score",
            F.col("far.score").alias("negative_score"),
        )
    )
