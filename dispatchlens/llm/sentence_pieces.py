"""Encoding and decoding with SentencePiece models, as shortest paths in a composed transducer.

A model file is compiled to a weighted transducer in the tropical semiring:

* the normaliser: a first word mark, blanks as word marks, everything else as it is
* the pieces: one arc for each piece that can be read at a place
* byte fallback: for a character that is no piece, an arc that writes its UTF-8 bytes
* for byte-pair models an acceptor of neighbouring pieces: weight 0 where the two stay apart in
  the model's merging, infinite elsewhere, so that one path alone has a finite weight; for
  unigram models no acceptor, and the negative scores of the pieces as weights

It is composed with each word of the input, which is a chain, and the shortest path is taken place
by place.  Words are composed apart: no piece reads a word mark after another character.  So are the
letters of a word and what stands beside them, as far as no piece reads both.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dispatchlens.llm import words, worker
from dispatchlens.llm.frames import tidy
from dispatchlens.llm.merges import Memo, Merges

MADE = ("n_pieces", "piece_ids", "round_trip", "decoded")
MARK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _OWN, _UNUSED, _BYTE = range(1, 7)
_UNIGRAM, _PAIRS = 1, 2
_WORD = re.compile(" *[^ ]+| +$")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at : at + size]
            at += size


def chains(tokens: Iterable[str]) -> re.Pattern:
    """The parts of a text that are composed apart: blanks with the letters or the other characters after
    them.  Letters that stand beside other characters in a token count as such."""
    others: set[str] = set()
    while True:
        own = re.escape("".join(sorted(others)))
        letter = rf"[^\W\d_{own}]"
        pattern = re.compile(rf" *{letter}+| *(?:[^\w ]|[\d_{own}])+| +$")
        crossed = {c for t in tokens if len(pattern.findall(t)) > 1 for c in re.findall(letter, t)}
        if not crossed:
            return pattern
        others |= crossed


class Transducer:
    """The compiled model; weights are added along a path and the least sum wins."""

    def __init__(
        self,
        pieces: list[tuple[str, float, int]],
        pairs: bool,
        first_mark: bool = True,
        byte_fallback: bool = True,
    ):
        if any(kind in (_OWN, _UNUSED) for *_, kind in pieces):
            raise ValueError("pieces of the user's own and unused pieces are not compiled")
        self.first_mark, self.pieces = first_mark, pieces
        # inside, a blank stands for the word mark: one byte a letter for most words
        plain = [p.replace(MARK, " ") for p, _, _ in pieces]
        self.arcs = {plain[i]: i for i, (_, _, kind) in enumerate(pieces) if kind == _NORMAL}
        if any(" " in p.lstrip(" ") for p in self.arcs):
            raise ValueError("a piece reaches from one word into the next")
        self.scores = {p: pieces[i][1] for p, i in self.arcs.items()}
        self.longest = max(map(len, self.arcs), default=1)
        self.unknown = next((i for i, x in enumerate(pieces) if x[2] == _UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.byte_fallback = byte_fallback and len(self.bytes) == 256
        low = min(self.scores.values(), default=0.0)
        self.unknown_weight = 10.0 - low
        self.acceptor = Merges(self._rank, list, self.arcs, self.longest) if pairs else None
        # runs of unknown characters are one piece, and sums of weights depend on where they begin
        self.chains = chains(self.arcs) if pairs and self.byte_fallback else _WORD
        # what each piece stands for when decoded, also parts of characters
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.surface = pa.array(
            [
                b"" if kind == _CONTROL
                else " ⁇ ".encode() if kind == _UNKNOWN
                else byte_of.get(i) or plain[i].encode()
                for i, (_, _, kind) in enumerate(pieces)
            ],
            pa.binary(),
        )
        self.letter = "H" if len(pieces) <= 1 << 16 else "I"
        self.ids = Memo(self._word)

    def _rank(self, a: str, b: str) -> float | None:
        score = self.scores.get(a + b)
        return None if score is None else -score

    def path(self, word: str) -> list[str]:
        """The shortest path through the composition with one word, in which blanks stand for
        word marks: its pieces, or characters that are none."""
        if self.acceptor:  # one path alone has a finite weight
            return self.acceptor.encode(word)
        weights, before = [0.0], [0]
        for i in range(1, len(word) + 1):
            least, where = float("inf"), -1
            for j in range(max(0, i - self.longest), i):
                score = self.scores.get(word[j:i])
                if score is None and i - j > 1:
                    continue
                weight = weights[j] + (self.unknown_weight if score is None else -score)
                if weight < least:
                    least, where = weight, j
            weights.append(least)
            before.append(where)
        found, i = [], len(word)
        while i:
            found.append(word[before[i] : i])
            i = before[i]
        return found[::-1]

    def _word(self, word: str) -> bytes:
        path = self.path(word)
        found = list(map(self.arcs.get, path))
        if None not in found:
            return array(self.letter, found).tobytes()
        ids = array(self.letter)
        for i, piece in zip(found, path):
            if i is not None:
                ids.append(i)
            elif self.byte_fallback:
                ids.extend(self.bytes[b] for b in piece.encode())
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text's pieces."""
        if not text:
            return np.zeros(0, np.int32)
        marked = (" " if self.first_mark else "") + text.replace(MARK, " ")
        ids = b"".join(map(self.ids.room().__getitem__, self.chains.findall(marked)))
        return np.frombuffer(ids, self.letter).astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of pieces, as ``texts`` gives it."""
        return self.texts(pa.array([ids], pa.list_(pa.int32())))[0].as_py()

    def texts(self, rows: pa.ListArray) -> pa.Array:
        """The texts of rows of pieces: bytes joined to characters, word marks to blanks, the first one
        dropped; bytes that make no character become U+FFFD.  Null rows give the empty text."""
        ids, lengths = rows.flatten(), pa.compute.list_value_length(rows).fill_null(0)
        if ids.null_count:
            raise TypeError("a piece is null")
        ends = np.concatenate([[0], np.cumsum(lengths.to_numpy())]).astype(np.int32)
        joined = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(ends), self.surface.take(ids)), b"")
        try:
            found = joined.cast(pa.string())
        except pa.ArrowInvalid:
            found = pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
        if not self.first_mark:
            return found
        marked = pa.compute.starts_with(found, " ")
        return pa.compute.if_else(marked, pa.compute.utf8_slice_codeunits(found, 1), found)


def compile_model(data: bytes) -> Transducer:
    """The transducer of a SentencePiece model file."""
    pieces, pairs, fallback, rules = [], False, False, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece[1].decode(), score, piece.get(3, _NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            if trainer.get(3, _UNIGRAM) not in (_UNIGRAM, _PAIRS):
                raise ValueError("only unigram and byte-pair models are compiled")
            pairs, fallback = trainer.get(3) == _PAIRS, bool(trainer.get(35, 0))
        elif number == 3:
            rules = dict(_fields(value))
    if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
        raise ValueError("only normalisers that keep characters and mark blanks are compiled")
    return Transducer(pieces, pairs, bool(rules.get(3, 1)), fallback)


def transducer(data: bytes) -> Transducer:
    """The transducer of a file's bytes, kept by each Python worker."""
    return worker.table(("pieces", hash(data)), lambda: compile_model(data))


def encode_pieces(
    docs: DataFrame, model: str, text: str = "text", keep_decoded: bool = False
) -> DataFrame:
    """Piece ids of whole texts, decoded again as a check.

    ``model``: path of the model file, read on the driver and broadcast (under a megabyte).  Adds:

    * ``n_pieces`` long, ``piece_ids`` array of int
    * ``round_trip`` boolean: whether decoding gives the text again; only texts that hold the word
      mark itself (U+2581) come back with a blank in its place
    * with ``keep_decoded``, ``decoded`` string

    Null and empty texts have no pieces and come back as the empty text; for null ``round_trip`` is
    true.  Equal rows are encoded each.  An empty table gives an empty result.  Input columns named
    like the added ones are replaced.
    """
    docs = tidy(docs, [text], MADE)
    shared = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    added = "n_pieces long, piece_ids array<int>, round_trip boolean"
    added += ", decoded string" if keep_decoded else ""
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(added).fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(shared.value)
        for batch in batches:
            for piece in words.pieces(batch, text):
                texts = [t or "" for t in piece[text].to_pylist()]
                ids = [own.encode(t) for t in texts]
                counts = np.array([len(x) for x in ids], np.int64)
                flat = np.concatenate(ids)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                back = own.texts(rows)
                same = pa.compute.equal(back, piece[text].cast(pa.string()).fill_null(""))
                made = {"n_pieces": pa.array(counts), "piece_ids": rows, "round_trip": same}
                if keep_decoded:
                    made["decoded"] = back
                yield pa.RecordBatch.from_pydict({c: piece[c] for c in piece.schema.names} | made)

    return docs.mapInArrow(encode, schema)


def decode_pieces(
    encoded: DataFrame, model: str, piece_ids: str = "piece_ids", into: str = "decoded"
) -> DataFrame:
    """Texts of piece ids, added as column ``into``; null ids give the empty text."""
    encoded = tidy(encoded, [piece_ids], [into])
    shared = encoded.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    schema = T.StructType([*encoded.schema.fields, T.StructField(into, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(shared.value)
        for batch in batches:
            kept = {c: batch[c] for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict(kept | {into: own.texts(batch[piece_ids])})

    return encoded.mapInArrow(decode, schema)
