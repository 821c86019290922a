"""Token counts by byte-pair merging, without making tokens.

A word starts as its bytes. A heap holds the ranks of adjacent pairs, a linked
list the symbols; the pair of least rank (leftmost among equals) is popped and
merged until none is left. The count is the symbols less the merges: no
identifier is ever looked up.

Null and empty texts have no bytes and no tokens. Repeated rows get equal counts.
A special token written out in a text counts as one, as the tokenizer library
has it by default.
"""

from __future__ import annotations

import json
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from podium.llm.common import in_parts

#: Fixed value: how byte-level BPE cuts a text into words before it merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_count(word: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Merges that byte-pair encoding makes in ``word``."""
    n = len(word)
    if n < 2:
        return 0
    symbols = [word[i : i + 1] for i in range(n)]
    after = list(range(1, n + 1))  # n: none
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i))
    heapify(heap)
    merges = 0
    while heap:
        rank, i = heappop(heap)
        left = symbols[i]
        j = after[i]
        # An entry is stale once either symbol has changed.
        if left is None or j == n or ranks.get((left, symbols[j])) != rank:
            continue
        merges += 1
        symbols[i] = left = left + symbols[j]
        symbols[j] = None
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            rank = ranks.get((left, symbols[j]))
            if rank is not None:
                heappush(heap, (rank, i))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], left))
            if rank is not None:
                heappush(heap, (rank, h))
    return merges


class MergeCounter(dict):
    """Tokens of each word seen, worked out at the first request.

    ``most`` bounds the words remembered, none longer than ``LONGEST``; a full memory
    starts again.
    """

    LONGEST = 64

    def __init__(self, path: str, most: int = 1_500_000):
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        letters = byte_alphabet()

        def spelled(symbol: str) -> bytes:
            return bytes(letters[c] for c in symbol)

        merges = [m.split(" ") if isinstance(m, str) else m for m in vocabulary["model"]["merges"]]
        self.ranks = {(spelled(a), spelled(b)): i for i, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in vocabulary["added_tokens"]]
        apart = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.apart = regex.compile(apart) if apart else None
        self.words = regex.compile(WORDS)
        self.most = most

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        count = len(raw) - merge_count(raw, self.ranks)
        if len(word) <= self.LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[word] = count
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.apart is None or not any(s in text for s in self.special):
            return sum(map(self.__getitem__, self.words.findall(text)))
        parts = self.apart.split(text)
        return len(parts) - 1 + sum(
            sum(map(self.__getitem__, self.words.findall(p))) for p in parts
        )


@cache
def merge_counter(path: str) -> MergeCounter:
    """One for each worker process, which serves many tasks."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row.

    ``path`` is a byte-level BPE file of the tokenizers library, the same on all
    machines. There is no shuffle: a worker keeps the counts of words it has met.
    """

    def counted(batches):
        counter = merge_counter(path)
        for batch in in_parts(batches):
            texts = batch["text"].to_pylist()
            sizes = [len(t.encode()) if t else 0 for t in texts]
            counts = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
