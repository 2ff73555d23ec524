"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into three transducers: the normaliser (spaces to U+2581, a mark in
front), the lexicon (an arc per piece, from characters to its id) and byte fallback (an arc per
UTF-8 byte for characters without a piece). A text is composed with them into a lattice whose
states are the places between its characters, and the shortest path in the tropical semiring
(weights add along a path, the smallest total wins) is the encoding.

For a unigram model an arc weighs minus the piece's score. A byte-pair model has no such
weights: there a path is the encoding if and only if each pair of neighbouring pieces is what
merging yields for the two together. So an arc weighs nothing after a piece it may follow and
infinitely much after any other; every prefix then has one finite path, and its last piece is
the state's history.

No piece holds the mark after another character, so paths never cross the front of a word, and
the lattice is composed word by word; words met before are looked up.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
MEMO = 400_000  # words of a generation, and pairs, that a worker remembers
_APART = 1 << 32
_PIECE = ""  # marks the end of an arc

# The piece types and model types of the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, data[at:at + size]
            at += size


@dataclass
class Model:
    """A compiled model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    is_bpe: bool
    byte_fallback: bool
    dummy_prefix: bool
    trim: bool
    unknown: int
    name: str = ""
    lexicon: dict[str, int] = field(default_factory=dict)
    bytes_: list[int] = field(default_factory=list)
    output: list[bytes] = field(default_factory=list)
    longest: int = 1

    @classmethod
    def read(cls, data: bytes) -> Model:
        pieces, scores, kinds = [], [], []
        trainer: dict[int, int | bytes] = {}
        rules: dict[int, int | bytes] = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        if rules.get(2):
            raise ValueError("models with a character map are not supported")
        if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models are supported")
        model = cls(
            pieces, scores, kinds, trainer.get(3, UNIGRAM) == BPE, bool(trainer.get(35, 0)),
            bool(rules.get(3, 1)), bool(rules.get(4, 1)), kinds.index(UNKNOWN),
            hashlib.sha256(data).hexdigest())
        model.lexicon = {p: i for i, p in enumerate(pieces) if kinds[i] in (NORMAL, USER)}
        model.output = [
            p.encode() if kind in (NORMAL, USER) else bytes([int(p[3:5], 16)]) if kind == BYTE else b""
            for p, kind in zip(pieces, kinds, strict=True)]
        model.longest = max(map(len, model.lexicon), default=1)
        if model.byte_fallback:
            at = {int(p[3:5], 16): i for i, p in enumerate(pieces) if kinds[i] == BYTE}
            model.bytes_ = [at[b] for b in range(256)]
        if any(MARK in p.lstrip(MARK) for p in model.lexicon):
            raise ValueError("pieces that cross the front of a word are not supported")
        return model

    def normalise(self, text: str) -> str:
        """The first transducer. Nothing is put before an empty text."""
        if self.trim:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)

    def fallback(self, char: str) -> tuple[int, ...]:
        if not self.byte_fallback:
            return (self.unknown,)
        return tuple(self.bytes_[b] for b in char.encode())

    def decode(self, ids: list[int]) -> str:
        """The inverse transducer: pieces to characters, runs of bytes to UTF-8."""
        text = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


class Encoder:
    """Shortest paths through the composition of a model with words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.endings: dict = {}  # the lexicon's arcs, read from the end of a piece
        for piece, at in model.lexicon.items():
            node = self.endings
            for char in reversed(piece):
                node = node.setdefault(char, {})
            node[_PIECE] = at

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        get = self.words.get
        for word in WORD.findall(self.model.normalise(text)):
            out += get(word) or self._look_up(word)
        if len(self.words) > MEMO:  # words of the last generation are kept, those before go
            self.older, self.words = self.words, {}
        return out

    def _look_up(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word) or self.path(word)
        if len(word) <= 64 and len(self.words) <= 2 * MEMO:
            self.words[word] = ids
        return ids

    def path(self, word: str) -> tuple[int, ...]:
        pieces = self._merged(word) if self.model.is_bpe else self._lightest(word)
        out: list[int] = []
        for piece in pieces:
            known = self.model.lexicon.get(piece)
            out += self.model.fallback(piece) if known is None else (known,)
        return tuple(out)

    def _lightest(self, word: str) -> list[str]:
        lexicon, scores, longest = self.model.lexicon, self.model.scores, self.model.longest
        unknown = min(scores, default=0.0) - 10
        best, back = [0.0] + [math.inf] * len(word), [0] * (len(word) + 1)
        for start in range(len(word)):
            for end in range(start + 1, min(len(word), start + longest) + 1):
                at = lexicon.get(word[start:end])
                if at is None and end > start + 1:
                    continue
                weight = best[start] - (unknown if at is None else scores[at])
                if weight < best[end]:
                    best[end], back[end] = weight, start
        return self._trace(word, back)

    def _merged(self, word: str) -> list[str]:
        """One finite path leads to every place; `last` is the piece that ends it, as its id or,
        for a character without a piece, minus its code point."""
        pairs = self.pairs
        back, last = [0] * (len(word) + 1), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            ends, start = [], end
            node = self.endings
            while start:  # pieces that end here, the shortest first
                start -= 1
                node = node.get(word[start])
                if node is None:
                    break
                if _PIECE in node:
                    ends.append((start, node[_PIECE]))
            if not ends or ends[0][0] != end - 1:
                ends.insert(0, (end - 1, -ord(word[end - 1])))
            for start, at in reversed(ends):
                key = last[start] * _APART + at  # nothing is before the first piece: 0
                allowed = pairs.get(key)
                if allowed is None:
                    allowed = self._may_follow(word[back[start]:start], word[start:end])
                    if len(pairs) >= MEMO:
                        pairs.clear()
                    pairs[key] = allowed
                if allowed:
                    back[end], last[end] = start, at
                    break
        return self._trace(word, back)

    @staticmethod
    def _trace(word: str, back: list[int]) -> list[str]:
        out, end = [], len(word)
        while end:
            out.append(word[back[end]:end])
            end = back[end]
        return out[::-1]

    def _may_follow(self, left: str, right: str) -> bool:
        if left and left + right in self.model.lexicon:
            return False
        return self._merge(left + right) == ([left, right] if left else [right])

    def _merge(self, text: str) -> list[str]:
        """What merging yields for one or two pieces: the best pair first, the left one of equals."""
        lexicon, scores = self.model.lexicon, self.model.scores
        parts = list(text)
        while True:
            best, where = -math.inf, -1
            for i in range(len(parts) - 1):
                at = lexicon.get(parts[i] + parts[i + 1])
                if at is not None and scores[at] > best:
                    best, where = scores[at], i
            if where < 0:
                return parts
            parts[where:where + 2] = [parts[where] + parts[where + 1]]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(model: Model) -> Encoder:
    """A worker keeps what it knows of a model's words from task to task."""
    if model.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model.name] = Encoder(model)
    return _ENCODERS[model.name]


def _encode(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            ids, back = [], []
            for text in batch.column("text").to_pylist():
                found = encoder.encode(text or "")
                ids.append(found)
                back.append(model.decode(found) == (text or ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(back)],
                ["doc_id", "n_tokens", "ids", "round_trip"])
    return run


def _decode(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return run


def load(path: str) -> Model:
    """Read on the driver; the compiled model (one vocabulary) travels with the tasks."""
    with open(path, "rb") as file:
        return Model.read(file.read())


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: `doc_id`, `n_tokens`, `ids`, `round_trip` (decoding gives the text
    back). Null and empty texts have no tokens. A text that holds U+2581, which the model reads
    as a space, encodes but does not come back. Rows that repeat, null doc_ids and other
    columns make no difference; an empty table gives no rows."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _encode(model), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `text` of rows with `ids`; null ids give an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(model), "doc_id long, text string")
