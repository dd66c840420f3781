"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding."""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Batches, slices, tidy

SPACE = "▁"
# Kinds of a piece in a model file, fixed values.
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
# Chunks and pairs a worker remembers, and the length of a chunk worth remembering.
REMEMBERED = 150_000
CHUNK = 64


def _one_more_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("piece_codec", _one_more_byte)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and contents of the fields of a protocol buffer message."""
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
        head = number()
        kind = head & 7
        if kind == 0:
            yield head >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield head >> 3, data[at : at + size]
        at += size


class PieceCodec:
    """Encodes and decodes as the model file says.

    For models of kind BPE with byte fallback, the identity normaliser, a
    space put in front and spaces kept; any other raises ``ValueError``.

    The encoding of a text is the chain of its prefixes' last tokens: of the
    tokens that end at a place exactly one also follows the last token of the
    prefix before it, since any two neighbours of an encoding encode to
    themselves. An automaton gives the tokens that end at each place, a pair
    test tells which of them may follow, and the ids are read backwards.
    """

    def __init__(self, model: bytes) -> None:
        import struct

        pieces: list[tuple[str, float, int]] = []
        trainer, normalizer = {}, {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        kinds = {k for _, _, k in pieces}
        plain = normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1) and not normalizer.get(2)
        if trainer.get(3) != 2 or not trainer.get(35) or USER in kinds or not plain or trainer.get(24):
            raise ValueError("only BPE with byte fallback, spaces kept and put in front is supported")
        self.scores = {p: s for p, s, k in pieces if k not in (UNKNOWN, CONTROL, BYTE)}
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k not in (UNKNOWN, CONTROL, BYTE)}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        texts = {NORMAL: lambda p: p.replace(SPACE, " ").encode(), BYTE: lambda p: bytes([int(p[3:5], 16)])}
        unknown = trainer.get(44, b" \xe2\x81\x87 ")
        self.bytes = [
            b"" if k == CONTROL else unknown if k == UNKNOWN else texts.get(k, texts[NORMAL])(p) for p, _, k in pieces
        ]
        self.end = trainer.get(42, 2)
        self.automaton = ahocorasick.Automaton()
        for piece in self.scores:
            if len(piece) > 1:
                self.automaton.add_word(piece, (piece, len(piece), {}))
        self.automaton.make_automaton()
        # No piece goes on with a space after another character, or has a line
        # end among others: then chunks that end there are encoded alone.
        joined = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores)
        lines = any("\n" in p and len(p) > 1 for p in self.scores)
        stop = "" if lines else "\n"
        # Two characters that are neighbours in no piece are never in one token.
        self.joints = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        after = "".join(q for q in ".,;:!?" if not any(j[0].isalpha() and j[1] == q for j in self.joints))
        word = f"{SPACE}*[^\\W\\d_]+(?=[{after}])|" if after else ""
        self.chunk = re.compile(r"(?s).+" if joined else f"{word}{SPACE}*[^{SPACE}{stop}]+|{SPACE}+|\n")
        self.pairs = 0
        self.chunks: dict[str, tuple[list[int], str]] = {}
        self.older: dict[str, tuple[list[int], str]] = {}

    def forget(self) -> None:
        """Drop what was remembered of the texts met so far."""
        self.chunks, self.older, self.pairs = {}, {}, 0
        for _, _, after in self.automaton.values():
            after.clear()

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text by its merges: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, left: str, right: str) -> bool:
        """Whether the two tokens stand when they meet."""
        return self.merged(left + right) == [left, right]

    def tokens(self, text: str) -> list[str]:
        """Tokens of a text whose spaces are already marked."""
        last = list(text)  # of each prefix, at first a lone character
        found = -1
        for end, (piece, size, after) in self.automaton.iter(text):  # the longest of an end comes first
            if end == found:
                continue
            start = end - size
            if start >= 0:
                left = last[start]
                stands = after.get(left)
                if stands is None:
                    stands = after[left] = self.follows(left, piece)
                    self.pairs += 1
                if not stands:
                    continue
            last[end] = piece
            found = end
        if self.pairs > 4 * REMEMBERED:
            for _, _, after in self.automaton.values():
                after.clear()
            self.pairs = 0
        out, end = [], len(text) - 1
        while end >= 0:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _encoded(self, chunk: str) -> tuple[list[int], str]:
        known = self.chunks.get(chunk) or self.older.get(chunk)
        if known is not None:
            self.chunks[chunk] = known
            return known
        ids: list[int] = []
        cuts = [i for i, pair in enumerate(map(add, chunk, chunk[1:]), 1) if pair not in self.joints]
        if cuts:
            for start, end in zip([0, *cuts], [*cuts, len(chunk)]):
                ids += self._encoded(chunk[start:end])[0]
        else:
            for token in self.tokens(chunk):
                if token in self.ids:
                    ids.append(self.ids[token])
                else:
                    ids.extend(self.byte_ids[b] for b in token.encode("utf-8", "surrogatepass"))
        known = ids, " ".join(map(str, ids))
        if len(chunk) <= CHUNK:
            if len(self.chunks) > REMEMBERED:  # what is met again moves on to the new table
                self.older, self.chunks = self.chunks, {}
            self.chunks[chunk] = known
        return known

    def encode(self, text: str | None, end: bool = True) -> tuple[list[int], str]:
        """Ids of a text, and the same as decimal text; null is empty, an empty text has the end id only."""
        ids: list[int] = []
        parts: list[str] = []
        if text:
            known = self.chunks.get
            for chunk in self.chunk.findall(SPACE + text.replace(" ", SPACE)):
                more, written = known(chunk) or self._encoded(chunk)
                ids += more
                parts.append(written)
        if end:
            ids.append(self.end)
            parts.append(str(self.end))
        return ids, " ".join(parts)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that are no UTF-8 become one replacement character each."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        # The space put in front goes with the first piece that is text.
        first = next((i for i in ids if self.bytes[i]), None)
        if first is not None and self.bytes[first][:1] == b" " and first not in self.byte_ids.values():
            data = data[1:]
        return data.decode("utf-8", "piece_codec")


_CODECS: dict[bytes, PieceCodec] = {}


def codec(model: bytes) -> PieceCodec:
    """The codec of a model, built once in each worker."""
    if model not in _CODECS:
        _CODECS.clear()
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


@contextmanager
def for_a_task(model: bytes) -> Iterator[PieceCodec]:
    """The codec, which forgets the task's texts at its end: the worker lives on, also for other stages."""
    own = codec(model)
    try:
        yield own
    finally:
        own.forget()


def _model(docs: DataFrame, path: str):
    """The model file's bytes for all tasks; a file of a vocabulary, not of data."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, source, ids (with the end id), n_tokens, round_trip (whether they decode to the text).

    Only doc_id, source and text are read. A null or empty text gives the end
    id alone; long texts are encoded whole; repeated rows give repeated
    results; an empty table gives an empty result.
    """
    model = _model(docs, path)
    types = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.bool_()]
    names = ["doc_id", "source", "ids", "n_tokens", "round_trip"]

    @tidy
    def run(batches: Batches) -> Batches:
        with for_a_task(model.value) as own:
            for batch in batches:
                for part in slices(batch, 2, 128, 1 << 22):  # ids of a few texts at a time
                    rows = []
                    for doc, source, value in zip(part.column(0), part.column(1), part.column(2)):
                        text = value.as_py() or ""
                        ids = own.encode(text)[0]
                        array = np.array(ids, np.int32)
                        rows.append((doc.as_py(), source.as_py(), array, len(ids), own.decode(ids) == text))
                    arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, source string, ids array<int>, n_tokens long, round_trip boolean"
    return docs.select("doc_id", "source", "text").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256; cases as :func:`encode`."""
    model = _model(docs, path)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    @tidy
    def run(batches: Batches) -> Batches:
        with for_a_task(model.value) as own:
            for batch in batches:
                counts, hashed, decoded = [], [], []
                for value in batch.column(1):
                    ids, text = own.encode(value.as_py())
                    counts.append(len(ids))
                    hashed.append(sha(text))
                    decoded.append(sha(own.decode(ids)))
                arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
