"""SentencePiece encoding by a table of each prefix's last token, and decoding.

Merging any prefix of a text ends with some last token, and that token is unique.
An automaton finds the pieces that end at a position; the one that may follow the
last token of the prefix before it is the last token there. Two tokens may stand
side by side if merging both from their characters never joins them across the
border. Identifiers are then read off from the end backwards.

The automaton holds the pieces that merging their own characters gives; no other
piece is ever in a result. Merges of equal score go from left to right, as in the
library. Texts are cut where no piece can reach across, and a worker remembers the
words it has met. There is no shuffle.

Null and empty texts have the begin and end identifiers only. Repeated rows get equal
identifiers. An empty table gives an empty one. Columns besides those named in the
arguments are not looked at. A text may be of any length: time and memory are in
proportion to it.

Models are of the merge type, with byte fallback and without user-defined symbols or
a normalisation table, and put a space before a text.
"""

from __future__ import annotations

import re
from functools import cache
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from podium.llm.common import in_parts

#: Fixed value: the character that stands for a space in pieces.
SPACE = "▁"
#: Fixed value: how decoding shows the unknown identifier.
UNKNOWN = " ⁇ "


class Vocabulary:
    """Pieces, scores and identifiers of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.encode("", add_bos=True, add_eos=True) != [model.bos_id(), model.eos_id()]:
            raise ValueError(f"{path} has no begin and end identifiers")
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [-1] * 256
        #: What each identifier adds to a text; empty for control identifiers.
        self.raw: list[bytes] = []
        self.is_byte: list[bool] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.is_byte.append(model.is_byte(i))
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i):
                self.raw.append(b"")
            elif model.is_unknown(i):
                self.raw.append(UNKNOWN.encode())
            else:
                self.raw.append(piece.replace(SPACE, " ").encode())
                if not model.is_unused(i):
                    self.ids[piece], self.scores[piece] = i, model.get_score(i)
        self.empty = np.array([not raw for raw in self.raw])
        if -1 in self.byte_ids:
            raise ValueError(f"{path} has no byte fallback")

    @staticmethod
    @cache
    def load(path: str) -> Vocabulary:
        return Vocabulary(path)


class PackedIds(dict):
    """Identifiers of each piece, packed; a character of no piece has those of its bytes.

    Such characters are not remembered: there are many.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.byte_ids = vocabulary.byte_ids
        for piece, i in vocabulary.ids.items():
            self[piece] = i.to_bytes(4, "little")

    def __missing__(self, token: str) -> bytes:
        return np.array([self.byte_ids[b] for b in token.encode()], "<u4").tobytes()


class PrefixEncoder(dict):
    """Identifiers of each word seen, packed, worked out at the first request.

    ``most`` bounds the words and the pairs remembered, and no word longer than
    ``LONGEST`` is; a full memory starts again.
    """

    LONGEST = 64

    def __init__(self, path: str, most: int = 400_000):
        self.vocabulary = Vocabulary.load(path)
        self.scores = self.vocabulary.scores
        self.packed = PackedIds(self.vocabulary)
        self.most = most
        self.histories: dict[str, tuple | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.scores:
            if self.history(piece) is not None:
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.words = self._cutter()

    def _cutter(self) -> re.Pattern | None:
        """Words that no piece reaches out of: spaces and what follows them.

        ASCII characters of no piece are words by themselves. ``None`` if a piece has a
        space after another character, and a text must stay whole.
        """
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.scores):
            return None
        met = set().union(*self.scores)
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c not in met)
        rest = f"[^{SPACE}{alone}]"
        return re.compile(f"{SPACE}+{rest}*|{rest}+" + (f"|[{alone}]" if alone else ""))

    def history(self, token: str) -> tuple[list[float], list[str], list[str]] | None:
        """How merging the characters of ``token`` goes on to its end.

        The score of each merge, ended by minus infinity, and the first and the last
        symbol before it. ``None`` if the end is not ``token``. Of equal scores the
        leftmost comes first.
        """
        if token in self.histories:
            return self.histories[token]
        symbols = list(token)
        scores, firsts, lasts = [], [symbols[0]], [symbols[-1]]
        while len(symbols) > 1:
            found = [self.scores.get(a + b, -inf) for a, b in zip(symbols, symbols[1:])]
            best = max(found)
            if best == -inf:
                break
            at = found.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            scores.append(best)
            firsts.append(symbols[0])
            lasts.append(symbols[-1])
        whole = len(symbols) == 1
        if not whole or token not in self.scores:
            # A character of no piece is forgotten again: there are many.
            if whole:
                return [-inf], firsts, lasts
            self.histories[token] = None
            return None
        self.histories[token] = ([*scores, -inf], firsts, lasts)
        return self.histories[token]

    def may_follow(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives these two tokens."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(left, right)
        return known

    def _apart(self, left: str, right: str) -> bool:
        mine, _, lasts = self.history(left)
        theirs, firsts, _ = self.history(right)
        i = j = 0
        while True:
            across = self.scores.get(lasts[i] + firsts[j], -inf)
            # Of equal scores the left token's merge comes first, the right one's last.
            if across > mine[i] and across >= theirs[j]:
                return False
            if mine[i] >= theirs[j]:
                if mine[i] == -inf:
                    return True
                i += 1
            else:
                j += 1

    def tokens(self, word: str) -> list[str]:
        """The tokens of ``word``; characters of no piece are tokens too."""
        n = len(word)
        # The last token of each prefix; of one that no piece could end, its character.
        last = [""] * (n + 1)
        known = self.pairs.get
        for end, piece in self.automaton.iter(word):
            if last[end + 1]:
                continue
            start = end + 1 - len(piece)
            if start:
                left = last[start] or word[start - 1]
                apart = known((left, piece))
                if not (self.may_follow(left, piece) if apart is None else apart):
                    continue
            last[end + 1] = piece
        out = []
        while n:
            token = last[n] or word[n - 1]
            out.append(token)
            n -= len(token)
        return out[::-1]

    def __missing__(self, word: str) -> bytes:
        packed = b"".join(map(self.packed.__getitem__, self.tokens(word)))
        if len(word) <= self.LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[word] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Identifiers of a text, unsigned 32-bit little-endian, without begin and end."""
        if not text:
            return b""
        spaced = SPACE + text.replace(" ", SPACE)
        if self.words is None:
            return self[spaced]
        return b"".join(map(self.__getitem__, self.words.findall(spaced)))


def shown(raw: bytes) -> str:
    """Bytes as text, each byte that is no part of a character as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of identifiers: control ones add nothing, the first space goes.

    Bytes that are no characters are shown as U+FFFD.
    """
    numbers = ids.tolist()
    at = next((k for k, i in enumerate(numbers) if vocabulary.raw[i]), None)
    if at is None:
        return ""
    first = numbers[at]
    drop = (
        not vocabulary.is_byte[first]
        and first != vocabulary.unknown
        and vocabulary.raw[first].startswith(b" ")
    )
    # Bytes on both sides of a control identifier do not make one character.
    if not vocabulary.empty[ids[1:-1]].any():
        whole = b"".join(map(vocabulary.raw.__getitem__, numbers))[drop:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            pass
    out, run = [], b""
    for i in numbers[at:]:
        if vocabulary.is_byte[i]:
            run += vocabulary.raw[i]
        else:
            out += [shown(run), vocabulary.raw[i].decode()]
            run = b""
    return "".join([*out, shown(run)])[drop:]


@cache
def prefix_encoder(path: str) -> PrefixEncoder:
    """One for each worker process, which serves many tasks."""
    return PrefixEncoder(path)


def encode_texts(
    docs: DataFrame, path: str, *, begin: bool = True, end: bool = True
) -> DataFrame:
    """``doc_id`` and ``ids`` of each row's ``text``.

    ``ids`` is binary: unsigned 32-bit little-endian identifiers, as the sentencepiece
    library gives them for the model at ``path``, the same on all machines.
    """

    def encoded(batches):
        encoder = prefix_encoder(path)
        known = encoder.vocabulary
        head = np.array([known.begin] if begin else [], "<u4").tobytes()
        tail = np.array([known.end] if end else [], "<u4").tobytes()
        for batch in in_parts(batches):
            ids = [head + encoder.encode(t) + tail for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.binary())], names=["doc_id", "ids"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encoded, f"doc_id {kind}, ids binary")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` that they decode to.

    As the library's ``decode``; null ``ids`` give a null text.
    """

    def decoded(batches):
        known = Vocabulary.load(path)
        for batch in in_parts(batches):
            texts = [
                None if ids is None else decode(np.frombuffer(ids, "<u4"), known)
                for ids in batch["ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["ids"], pa.array(texts, pa.string())],
                names=["doc_id", "ids", "text"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        decoded, f"doc_id {kind}, ids binary, text string"
    )
