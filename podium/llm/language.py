"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a window of bytes in both directions; from both
states every position gets probabilities of the languages, and their mean over
all positions of a text is the text's. Trained in numpy by backpropagation through
time, every position against its document's language.

Texts are read whole, in windows of ``WINDOW`` bytes that are states apart, so
thousands of windows go through the network side by side and a long text is no
more than many windows. A null text and one without a letter are ``und`` with
score 0, as is every text if nothing could be learned. Repeated rows get equal
results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import in_parts, kept

WINDOW = 128
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


# --- network --------------------------------------------------------------


def _layer(rng: np.random.Generator, hidden: int) -> dict[str, np.ndarray]:
    """Input table by byte (which is embedding and bias at once) and recurrent weights.

    Columns are the update gate, the reset gate and the candidate.
    """
    return {
        "x": rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
        "u": (rng.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32),
        "b": np.zeros(hidden, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _step(layer: dict, h: np.ndarray, byte: np.ndarray, hidden: int):
    """One step for all windows: new state and what the backward pass needs."""
    x = layer["x"][byte]
    g = h @ layer["u"]
    gates = _sigmoid(x[:, : 2 * hidden] + g[:, : 2 * hidden])
    z, r = gates[:, :hidden], gates[:, hidden:]
    c = g[:, 2 * hidden :] + layer["b"]
    n = np.tanh(x[:, 2 * hidden :] + r * c)
    return n + z * (h - n), (h, z, r, c, n)


class _Scan:
    """``_step`` for reading only: the gates apart, all in buffers made once.

    The sigmoid is a hyperbolic tangent of half its argument; the halves are in the
    weights.
    """

    def __init__(self, layer: dict, n: int, hidden: int):
        parts = [slice(i * hidden, (i + 1) * hidden) for i in range(3)]
        half = (np.float32(0.5), np.float32(0.5), np.float32(1))
        self.x = [np.ascontiguousarray(layer["x"][:, p]) * f for p, f in zip(parts, half)]
        self.u = [np.ascontiguousarray(layer["u"][:, p]) * f for p, f in zip(parts, half)]
        self.b = layer["b"]
        self.h = np.zeros((n, hidden), np.float32)
        self.made = [np.empty((n, hidden), np.float32) for _ in range(4)]

    def read(self, byte: np.ndarray) -> np.ndarray:
        h, (z, r, c, x) = self.h, self.made
        for gate, out in ((0, z), (1, r)):
            np.matmul(h, self.u[gate], out=out)
            out += np.take(self.x[gate], byte, axis=0, out=x, mode="clip")
            np.tanh(out, out=out)
            out += 1
            out *= 0.5
        np.matmul(h, self.u[2], out=c)
        c += self.b
        c *= r
        c += np.take(self.x[2], byte, axis=0, out=x, mode="clip")
        np.tanh(c, out=c)
        h -= c
        h *= z
        h += c
        return h


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    hidden: int
    forward: dict
    backward: dict
    out: np.ndarray  # (2 * hidden + 1, languages), the last row a bias

    def states(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """States of both layers at each position: (positions, windows, 2 * hidden)."""
        n, size = windows.shape
        hidden = self.hidden
        columns = np.ascontiguousarray(windows.T)
        short = np.flatnonzero(lengths < size)
        ends = lengths[short]
        out = np.empty((size, n, 2 * hidden), np.float32)
        scan = _Scan(self.forward, n, hidden)
        for t in range(size):
            out[t, :, :hidden] = scan.read(columns[t])
        scan = _Scan(self.backward, n, hidden)
        for t in range(size - 1, -1, -1):
            h = scan.read(columns[t])
            h[short[ends <= t]] = 0  # a window's padding is not read
            out[t, :, hidden:] = h
        return out

    def probabilities(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each language at each position: (positions, windows, languages)."""
        states = self.states(windows, lengths).reshape(-1, 2 * self.hidden)
        logits = states @ self.out[:-1]
        logits += self.out[-1]
        # States lie between -1 and 1, so exponents are bounded by the weights.
        np.exp(logits, out=logits)
        logits /= (logits @ np.ones(logits.shape[1], np.float32))[:, None]
        return logits.reshape(windows.shape[1], len(windows), -1)

    def positions(self, text: str) -> list[str]:
        """The language at each byte of a text."""
        windows, lengths, _ = cut([text.encode()])
        best = self.probabilities(windows, lengths).argmax(axis=2).T
        return [self.languages[i] for row, n in zip(best, lengths) for i in row[:n]]

    def pooled(self, texts: list[bytes], at_once: int = 2048) -> np.ndarray:
        """Mean probabilities over the positions of each (not empty) text."""
        totals = np.zeros((len(texts), len(self.languages)))
        for windows, lengths, of in cut_in_parts(texts, at_once):
            p = self.probabilities(windows, lengths)
            short = np.flatnonzero(lengths < windows.shape[1])
            for w in short:
                p[lengths[w] :, w] = 0
            np.add.at(totals, of, p.sum(axis=0, dtype=np.float64))
        return totals / np.array([max(len(t), 1) for t in texts])[:, None]


def cut(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, their lengths, and which text each is of."""
    counts = [-(-len(t) // size) for t in texts]
    padded = b"".join(t.ljust(c * size, b"\0") for t, c in zip(texts, counts))
    windows = np.frombuffer(padded, np.uint8).reshape(-1, size)
    of = np.repeat(np.arange(len(texts)), counts)
    lengths = np.full(len(of), size)
    last = np.cumsum(counts)[[c > 0 for c in counts]] - 1
    lengths[last] = [len(t) - (c - 1) * size for t, c in zip(texts, counts) if c]
    return windows, lengths, of


def cut_in_parts(texts: list[bytes], at_once: int) -> Iterator[tuple]:
    """``cut`` for so many windows at a time; a long text spans several parts."""
    windows, lengths, of = cut(texts)
    for at in range(0, len(of), at_once):
        part = slice(at, at + at_once)
        yield windows[part], lengths[part], of[part]


# --- training -------------------------------------------------------------


def _run_layer(layer: dict, columns: np.ndarray, hidden: int):
    h = np.zeros((columns.shape[1], hidden), np.float32)
    states, tape = [], []
    for byte in columns:
        h, saved = _step(layer, h, byte, hidden)
        states.append(h)
        tape.append(saved)
    return np.stack(states), tape


def _back_layer(layer: dict, columns: np.ndarray, tape: list, dstates: np.ndarray, hidden: int):
    """Gradients of a layer, from the last step to the first."""
    grads = {k: np.zeros_like(v) for k, v in layer.items()}
    dh = np.zeros_like(dstates[0])
    for t in range(len(columns) - 1, -1, -1):
        h, z, r, c, n = tape[t]
        dh = dh + dstates[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * c * r * (1 - r)
        dc = dn * r
        dx = np.concatenate([dz, dr, dn], axis=1)
        dg = np.concatenate([dz, dr, dc], axis=1)
        np.add.at(grads["x"], columns[t], dx)
        grads["u"] += h.T @ dg
        grads["b"] += dc.sum(axis=0)
        dh = dh * z + dg @ layer["u"].T
    return grads


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    languages: tuple[str, ...],
    *,
    hidden: int = 8,
    steps: int = 500,
    batch: int = 128,
    rate: float = 0.02,
    seed: int = 3,
) -> LanguageModel:
    """A network from full windows and the number of each one's language.

    Languages are drawn equally often. Adam with a rate that falls to nothing.
    """
    rng = np.random.default_rng(seed)
    forward, backward = _layer(rng, hidden), _layer(rng, hidden)
    out = np.zeros((2 * hidden + 1, len(languages)), np.float32)
    out[:-1] = rng.normal(0, 0.3, out[:-1].shape)
    slots = [*((forward, k) for k in forward), *((backward, k) for k in backward)]
    moments = [(np.zeros_like(d[k]), np.zeros_like(d[k])) for d, k in slots]
    moments.append((np.zeros_like(out), np.zeros_like(out)))
    members = [np.flatnonzero(labels == i) for i in range(len(languages))]
    size = windows.shape[1]
    for step in range(1, steps + 1):
        who = rng.integers(len(languages), size=batch)
        rows = np.array([rng.choice(members[w]) for w in who])
        columns = np.ascontiguousarray(windows[rows].T)
        fs, ftape = _run_layer(forward, columns, hidden)
        bs, btape = _run_layer(backward, columns[::-1], hidden)
        both = np.concatenate([fs, bs[::-1]], axis=2)
        logits = both @ out[:-1] + out[-1]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(batch), who] -= 1
        p /= size * batch
        dout = np.vstack(
            [both.reshape(-1, 2 * hidden).T @ p.reshape(-1, p.shape[2]), p.sum(axis=(0, 1))[None]]
        )
        dboth = p @ out[:-1].T
        gf = _back_layer(forward, columns, ftape, dboth[:, :, :hidden], hidden)
        gb = _back_layer(backward, columns[::-1], btape, dboth[::-1, :, hidden:], hidden)
        grads = [*(gf[k] for k in forward), *(gb[k] for k in backward), dout]
        targets = [*(d[k] for d, k in slots), out]
        whole = np.sqrt(sum(float((g * g).sum()) for g in grads))
        now = rate * (1 - step / (steps + 1)) * min(1.0, 1.0 / max(whole, 1e-9))
        for target, g, (m, v) in zip(targets, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            target -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return LanguageModel(languages, hidden, forward, backward, out)


def least_of_each_language(ids: DataFrame, sample: int) -> DataFrame:
    """The ``sample`` rows of least hash of each language; ``ids`` are distinct.

    Hashes are spread evenly, so those of least hash lie below a bound that the language's
    number of rows gives: about twice the sample is left to be sorted, and not the language.
    The counts are as many as the languages, of which the model holds weights for each.
    """
    hashed = F.xxhash64("doc_id", "lang")
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.lit(2.0 * sample + 100) / F.col("n")
    by_hash = Window.partitionBy("lang").orderBy(hashed, "doc_id")
    return (
        ids.join(F.broadcast(counts), "lang")
        .filter(hashed.cast("double") <= share * 2.0**64 - 2.0**63)
        .withColumn("rank", F.row_number().over(by_hash))
        .filter(F.col("rank") <= sample)
        .select("doc_id", "lang")
    )


def fit_language_model(
    docs: DataFrame, *, sample: int = 4_000, windows: int = 8, **training
) -> LanguageModel | None:
    """A model from at most ``sample`` labelled documents of each language in ``docs``.

    They are those of least hash, each once; of rows with one id and one language it is
    the least text. At most ``windows`` windows are learned from, spread evenly over a
    text, so at most ``sample * windows * WINDOW`` bytes of a language reach the driver.
    ``None`` if there is nothing to learn from.
    """
    labelled = docs.filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("doc_id", "text", "lang")
    ids = kept(
        labelled.filter("doc_id is not null").select("doc_id", "lang").distinct(), "labelled"
    )
    chosen = least_of_each_language(ids, sample)

    def sampled(batches):
        for batch in in_parts(batches):
            langs, pieces = [], []
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                raw = text.encode()
                n = min(windows, max(1, len(raw) // WINDOW))
                for i in range(n):
                    at = (len(raw) - WINDOW) * (2 * i + 1) // (2 * n) if len(raw) > WINDOW else 0
                    # A short text is read over and over to fill its window.
                    piece = raw[at : at + WINDOW]
                    pieces.append((piece * (WINDOW // len(piece) + 1))[:WINDOW])
                    langs.append(lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(pieces, pa.binary())],
                names=["lang", "piece"],
            )

    got = (
        labelled.join(F.broadcast(chosen), ["doc_id", "lang"])
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
        .select("text", "lang")
        .mapInArrow(sampled, "lang string, piece binary")
        .orderBy("lang", "piece")
        .toArrow()
    )
    if not got.num_rows:
        return None
    langs = got["lang"].to_pylist()
    languages = tuple(sorted(set(langs)))
    number = {lang: i for i, lang in enumerate(languages)}
    pieces = np.frombuffer(b"".join(got["piece"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    return train(pieces, np.array([number[x] for x in langs]), languages, **training)


# --- tables ---------------------------------------------------------------


def predicted(model: LanguageModel | None, texts: list[str | None]) -> tuple[list, list]:
    """Language and score of each text."""
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if model is not None:
        rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if rows:
            p = model.pooled([texts[i].encode() for i in rows])
            for i, best, row in zip(rows, p.argmax(axis=1), p):
                langs[i] = model.languages[best]
                scores[i] = min(1.0, float(row[best]))
    return langs, scores


def predict_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of each row of ``docs``."""

    def rows(batches):
        for batch in in_parts(batches):
            langs, scores = predicted(model, batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, lang_pred string, score double"
    )


def keep_identified(
    docs: DataFrame, model: LanguageModel | None, threshold: float = 0.5
) -> DataFrame:
    """Rows whose text has a language of at least ``threshold``; all columns stay."""

    def rows(batches):
        for batch in in_parts(batches):
            langs, scores = predicted(model, batch["text"].to_pylist())
            good = [a != UNDETERMINED and b >= threshold for a, b in zip(langs, scores)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
