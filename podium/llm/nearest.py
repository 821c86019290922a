"""Nearest vectors by cosine, found with randomly rotated one-bit codes.

A vector is brought to unit length and rotated at random; the signs of what
results are its code, and the inner product of vector and code its correction.
Code and correction give an unbiased estimate of the vector's inner product with
any other, whose error is bounded with high probability. Vectors whose upper
bound reaches the k-th best lower bound are reranked by exact cosine.

Rows and queries are dealt into blocks of bounded size, and every pair of blocks is
one group: no task holds more than two blocks. A block of rows gives each query at
most ``k`` results.

Components may be of any finite size. Rows without id, and vectors that are null, empty,
zero, of another length than
most, or hold null or non-finite components take no part. Of rows with one id the
least vector counts, so repeated rows count once. Ties go to the smaller id. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import kept


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def cosines(vectors: np.ndarray, lengths: np.ndarray, query: np.ndarray, length: float):
    """Cosines in double precision, each row by itself: equal rows, equal values."""
    return (vectors * query).sum(axis=1) / (lengths * length)


def encode(vectors: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated unit vectors, and the correction of each."""
    turned = (vectors / norms(vectors)[:, None]) @ rotate
    codes = np.packbits(turned > 0, axis=1)
    return codes, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def estimate(
    codes: np.ndarray, corrections: np.ndarray, turned: np.ndarray, epsilon: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries by rows) and each row's bound on the error.

    ``turned`` holds the rotated unit queries. A code stands for the corner of the
    cube ``±1/sqrt(dim)``.
    """
    dim = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32)
    signs = (2 * signs - 1) / np.sqrt(np.float32(dim))
    products = turned.astype(np.float32) @ signs.T
    missing = np.maximum(1 - corrections**2, 0)
    error = epsilon * np.sqrt(missing / max(dim - 1, 1)) / corrections
    return products / corrections.astype(np.float32), error.astype(np.float32)


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite and not all zero."""
    value = lambda x: x.cast("double")
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: value(x) != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors, each brought near one by a power of two.

    That changes no cosine, to the bit, and keeps squares of very large and very small
    components in range.
    """
    flat = column.combine_chunks().flatten().to_numpy().astype(np.float64)
    vectors = flat.reshape(len(column), -1)
    _, exponents = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponents[:, None])


def index_vectors(
    vectors: DataFrame, *, rows_in_block: int = 8192, seed: int = 7
) -> tuple[DataFrame, int, int]:
    """``vec_id``, ``embedding``, ``code``, ``correction`` and ``block`` of each usable row.

    The table is written to the shared folder. Also the number of blocks and the
    length of the vectors.
    """
    rows = (
        vectors.select("vec_id", "embedding")
        .filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )
    lengths = (
        rows.groupBy(F.size("embedding").alias("dim"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "dim")
        .first()
    )
    dim, n = (lengths["dim"], lengths["n"]) if lengths else (0, 0)
    blocks = max(1, -(-n // rows_in_block))

    def coded(batches):
        rotate = rotation(dim, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, corrections = encode(_matrix(pa.chunked_array([batch["embedding"]])), rotate)
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["embedding"], packed, pa.array(corrections)],
                names=["vec_id", "embedding", "code", "correction"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    index = (
        rows.filter(F.size("embedding") == dim)
        .mapInArrow(
            coded,
            f"vec_id {kinds['vec_id']}, embedding {kinds['embedding']}, code binary, "
            "correction double",
        )
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    )
    return kept(index, "codes"), blocks, dim


def nearest_in_block(
    rows: pa.Table, queries: pa.Table, rotate: np.ndarray, k: int, epsilon: float
) -> pa.Table:
    """The ``k`` nearest rows of a block for each query of another."""
    if not rows.num_rows or not queries.num_rows:
        return _found([])
    ids = rows["vec_id"].to_numpy()
    vectors, points = _matrix(rows["embedding"]), _matrix(queries["embedding"])
    codes = np.frombuffer(
        b"".join(rows["code"].to_pylist()), np.uint8
    ).reshape(len(ids), -1)
    lengths, sizes = norms(vectors), norms(points)
    guess, error = estimate(
        codes, rows["correction"].to_numpy(), (points / sizes[:, None]) @ rotate, epsilon
    )
    out: list[tuple] = []
    for q, own in enumerate(queries["vec_id"].to_numpy()):
        least = guess[q] - error
        least[ids == own] = -np.inf
        at = len(ids) - min(k, len(ids))
        bar = np.partition(least, at)[at]
        chosen = np.flatnonzero((guess[q] + error >= bar) & (ids != own))
        score = cosines(vectors[chosen], lengths[chosen], points[q], sizes[q])
        best = np.lexsort((ids[chosen], -score))[:k]
        out += [(own, ids[chosen[b]], score[b]) for b in best]
    return _found(out)


def _found(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], []]
    kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, kinds.items())})


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    epsilon: float = 3.0,
    rows_in_block: int = 8192,
    queries_in_block: int = 4096,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` nearest.

    ``is_query`` is a condition on ``vec_id``. All rows but the query's own are
    searched. ``epsilon`` is how many standard errors the bounds allow for.
    """
    index, blocks, dim = index_vectors(vectors, rows_in_block=rows_in_block)
    queries = index.filter(is_query).select("vec_id", "embedding")
    parts = max(1, -(-queries.count() // queries_in_block))
    by_pair = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = queries.withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def searched(rows: pa.Table, queries: pa.Table) -> pa.Table:
        return nearest_in_block(rows, queries, rotation(dim), k, epsilon)

    found = (
        by_pair.groupBy("block", "part")
        .cogroup(asked.groupBy("block", "part"))
        .applyInArrow(searched, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
