"""Toxic passages as maximum-scoring segments of token log-odds.

A token's score is its log-odds between toxic and clean training texts under an
informative Dirichlet prior; a token too rare for that has the score of all
tokens that begin as it does. Tokens count once in a text and equal texts once,
so neither repetition nor copies make a word look toxic. Ruzzo and Tompa's scan finds every maximal scoring
segment of a text in linear time; extreme-value statistics of the clean training
texts (Karlin and Altschul) say which segments are significant and put texts of
all lengths on one scale, which a logistic curve turns into a probability.

Null and empty texts have no segments and get the score of a text without
passages. Repeated rows get equal results. A training sample without toxic or
without clean texts gives the share of toxic rows (0 for an empty sample) as
every score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import in_parts, kept

#: Bytes of the longest token that a model holds.
LONGEST = 100
#: ASCII punctuation and digits separate tokens.
_APART = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-case runs of letters (and of anything beyond ASCII)."""
    return text.encode().lower().translate(_APART).split() if text else []


def stem(token: bytes) -> bytes:
    """The name under which all tokens with the same beginning are counted."""
    return b"^" + token[:5]


def maximal_segments(hits: list[tuple[int, float]], gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, end exclusive.

    ``hits`` are positions and positive scores in order; every other position
    scores ``-gap``. Segments are kept with the cumulative score before and
    after them; a new one is joined to the last that starts lower and ends
    lower. Each join removes a segment, so the scan is linear but for the walk
    back, which skips along stored links.
    """
    spans: list[list] = []  # start, end, sum before, sum after, link
    total, upto = 0.0, 0
    for at, score in hits:
        total -= gap * (at - upto)
        before, total, upto = total, total + score, at + 1
        start, link = at, len(spans) - 1
        while True:
            while link >= 0 and spans[link][2] >= before:
                link = spans[link][4]
            if link < 0 or spans[link][3] >= total:
                break
            start, before = spans[link][0], spans[link][2]
            del spans[link:]
            link -= 1
        spans.append([start, at + 1, before, total, link])
    return [(s, e, after - before) for s, e, before, after, _ in spans]


@dataclass(frozen=True)
class ToxicityModel:
    """Log-odds of toxic tokens, the cost of any other, and the calibrations."""

    weights: dict[bytes, float] = field(default_factory=dict)
    gap: float = 1.0
    scale: float = 1.0  # lambda of the extreme-value distribution
    rate: float = 1.0  # K of the same
    alpha: float = 0.01  # E-value up to which a segment is significant
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and segments with their E-values."""
        found = tokens(text)
        weights, n = self.weights, len(found)
        hits = []
        for i, token in enumerate(found):
            score = weights.get(token)
            if score is None:
                score = weights.get(b"^" + token[:5])
            if score is not None:
                hits.append((i, score))
        return n, [
            (a, b, self.rate * n * float(np.exp(-self.scale * s)))
            for a, b, s in maximal_segments(hits, self.gap)
        ]

    def evidence(self, segments: list[tuple[int, int, float]]) -> tuple[float, float]:
        """Minus log E of the best segment, and the sum over significant ones."""
        logs = [-float(np.log(max(e, 1e-300))) for _, _, e in segments]
        passed = [x for x, (_, _, e) in zip(logs, segments) if e <= self.alpha]
        return (max(logs) if logs else -5.0), sum(passed)

    def probability(self, best: float, summed: float) -> float:
        bias, w_best, w_sum = self.curve
        x = bias + w_best * np.clip(best, -5, 50) + w_sum * np.log1p(summed)
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton's steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w
        )
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def training_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``text`` and ``toxic`` of at most ``bound`` labelled ids, those of least hash.

    Of rows with one id the least text counts. The sample's ids are few by that bound, so
    they are broadcast to the texts; hashes are spread evenly, so about twice as many as
    are wanted lie below a bound that the number of ids gives, and are sorted.
    """
    hashed = F.xxhash64("doc_id")
    labelled = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = (2.0 * bound + 100) / max(labelled.count(), 1)
    chosen = (
        labelled.filter(hashed.cast("double") <= share * 2.0**64 - 2.0**63)
        .orderBy(hashed, "doc_id")
        .limit(bound)
    )
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .select("text", "toxic")
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def flushed():
        found = list(counts[0] | counts[1])
        columns = [found, [counts[0][t] for t in found], [counts[1][t] for t in found]]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_pydict(
            dict(zip(("token", "clean", "toxic"), columns)),
            schema=pa.schema([("token", pa.binary()), ("clean", pa.int64()), ("toxic", pa.int64())]),
        )

    for batch in in_parts(batches):
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            found = set(tokens(text))
            counts[toxic].update(found)
            counts[toxic].update(set(map(stem, found)))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield flushed()
    yield flushed()


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    sample: int = 20_000,
    prior: float = 0.05,
    least_share: float = 0.73,
    least_z: float = 2.2,
    vocabulary: int = 20_000,
    alpha: float = 0.01,
) -> ToxicityModel:
    """A model from at most ``sample`` labelled rows of ``docs``.

    ``prior`` is the mass of the Dirichlet prior as a share of all tokens, spread
    as the tokens are over both classes. What log-odds a token of toxic texts only can
    reach depends on the prior and on how many tokens are in toxic texts; tokens score
    that reach ``least_share`` of it and lie ``least_z`` standard errors above 0, at
    most ``vocabulary`` of them.
    """
    # Read often, so written once: bounded by the sample.
    rows = kept(
        training_sample(docs, labels, sample).groupBy("text").agg(F.max("toxic").alias("toxic")),
        "labelled",
    )
    counts = (
        rows.mapInArrow(_counted, "token binary, clean long, toxic long")
        .groupBy("token")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ).persist()
    try:
        whole = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).first()
        clean, toxic = whole["clean"] or 0, whole["toxic"] or 0
        if not clean or not toxic:
            share = rows.agg(F.avg("toxic")).first()[0] or 0.0
            odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
            return ToxicityModel(curve=(float(odds), 0.0, 0.0))
        weight = prior * (clean + toxic)
        mass = (F.col("clean") + F.col("toxic")) * prior
        in_toxic, in_clean = F.col("toxic") + mass, F.col("clean") + mass
        odds = F.log(in_toxic / (toxic + weight - in_toxic)) - F.log(
            in_clean / (clean + weight - in_clean)
        )
        # A rare token that is in toxic texts only; above 0 for any two classes.
        highest = np.log((1 + prior) / prior * (clean + weight) / (toxic + weight))
        least_odds = float(least_share * highest)
        z = odds / F.sqrt(1 / in_toxic + 1 / in_clean)
        best = (
            counts.select("token", "clean", "toxic", odds.alias("odds"), z.alias("z"))
            .filter((F.col("odds") >= least_odds) & (F.col("z") >= least_z))
            .filter(F.octet_length("token") <= LONGEST)
            .orderBy(F.desc("z"), "token")
            .limit(vocabulary)
            .collect()
        )
    finally:
        counts.unpersist()
    weights = {bytes(r["token"]): r["odds"] for r in best}
    in_toxic = max(sum(r["toxic"] for r in best), 0.5) / toxic
    in_clean = max(sum(r["clean"] for r in best), 0.5) / clean
    gap = max(float(np.log((1 - in_clean) / max(1 - in_toxic, 1e-9))), 1e-4)
    scale = _scale([(r["odds"], r["clean"] / clean) for r in best], gap, 1 - in_clean)
    draft = ToxicityModel(weights, gap, scale, 1.0, alpha)
    seen = _evidence(rows, draft)
    plain = seen[(seen[:, 0] == 0) & (seen[:, 3] > 0)]
    # E = K n exp(-scale S) is to be near 1 for the best segment of a clean text.
    rate = float(np.exp(np.median(plain[:, 1]))) if len(plain) else 1.0
    model = ToxicityModel(weights, gap, scale, max(rate, 1e-3), alpha)
    seen = _evidence(rows, model)
    x = np.column_stack([np.ones(len(seen)), np.clip(seen[:, 1], -5, 50), np.log1p(seen[:, 2])])
    curve = _logistic(x, seen[:, 0])
    if curve[2] < 0:  # more passages must never make a text less toxic
        curve = np.append(_logistic(x[:, :2], seen[:, 0]), 0.0)
    return ToxicityModel(weights, gap, scale, model.rate, alpha, tuple(map(float, curve)))


def _scale(hits: list[tuple[float, float]], gap: float, rest: float) -> float:
    """The positive root of ``sum(p * exp(x * s)) = 1`` under clean text."""
    s = np.array([h[0] for h in hits] + [-gap])
    p = np.array([h[1] for h in hits] + [rest])
    if not hits or (s * p).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    with np.errstate(over="ignore"):
        while (p * np.exp(high * s)).sum() < 1 and high < 64:
            high *= 2
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if (p * np.exp(mid * s)).sum() < 1 else (low, mid)
    return (low + high) / 2


def _evidence(rows: DataFrame, model: ToxicityModel) -> np.ndarray:
    """Label, best, summed and tokens of each text of the (bounded) sample."""

    def measured(batches):
        for batch in in_parts(batches):
            out = []
            for text in batch["text"].to_pylist():
                n, segments = model.segments(text)
                out.append((*model.evidence(segments), float(n)))
            a = np.array(out, dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"].cast(pa.float64()), *map(pa.array, a.T)],
                names=["y", "best", "summed", "n"],
            )

    got = rows.mapInArrow(measured, "y double, best double, summed double, n double").toPandas()
    return got.to_numpy(dtype=float).reshape(-1, 4)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``score`` and the significant ``passages`` of each row of ``docs``.

    A passage has its first token, the one after its last, and its E-value.
    """

    def scored(batches):
        passage = pa.list_(
            pa.struct([("start", pa.int64()), ("end", pa.int64()), ("e_value", pa.float64())])
        )
        for batch in in_parts(batches):
            scores, passages = [], []
            for text in batch["text"].to_pylist():
                _, segments = model.segments(text)
                scores.append(model.probability(*model.evidence(segments)))
                passages.append(
                    [
                        {"start": a, "end": b, "e_value": e}
                        for a, b, e in segments
                        if e <= model.alpha
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(scores, pa.float64()), pa.array(passages, passage)],
                names=["doc_id", "score", "passages"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scored,
        f"doc_id {kind}, score double, "
        "passages array<struct<start: bigint, end: bigint, e_value: double>>",
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``; all columns stay."""

    def passed(batches):
        for batch in in_parts(batches):
            clean = [
                model.probability(*model.evidence(model.segments(t)[1])) < threshold
                for t in batch["text"].to_pylist()
            ]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
