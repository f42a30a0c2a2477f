"""SentencePiece encoding and decoding with weighted finite-state transducers.

Three machines are compiled from a model file: the normaliser (blanks to the blank mark,
one mark put in front), the pieces (a trie whose paths read characters and write a piece
at the piece's weight) and the byte fallback (a character no piece covers is written as
its UTF-8 bytes). They are composed with an input on the fly, and the path of least
weight in the tropical semiring (weights add along a path, the minimum wins) is the result.

A unigram model weighs a piece by its negative score. A merge model (BPE) accepts a
sequence of pieces only if each neighbouring pair is what merging would leave of the two
together; such a sequence is unique, because the first merge over a border of the sequence
would also happen between the two pieces alone. The acceptor of pairs is one more
machine: its states are the last pieces written, and forbidden arcs weigh infinity (the
semiring's zero).
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.llm.common import freed, map_rows

MARK = "▁"
# Values of the model file's format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
# Characters that often follow a word.
STOPS = ".,;:!?#*$%&"
LATIN = "[A-Za-zÀ-ÖØ-öø-ɏ]"
_SEGMENTS_HELD = 300_000
_PAIRS_HELD = 400_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message; lengths and fixed values as bytes."""
    place = 0

    def number() -> int:
        nonlocal place
        value = shift = 0
        while True:
            byte = data[place]
            place += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while place < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[place : place + size]
            place += size


class Model:
    """Pieces, scores, types and settings of a model file."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.prefix, self.squeeze, self.chars_map = UNIGRAM, True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece, score, kind = "", 0.0, NORMAL
                for inner, part in _fields(value):
                    if inner == 1:
                        piece = part.decode()
                    elif inner == 2:
                        score = struct.unpack("<f", part)[0]
                    elif inner == 3:
                        kind = part
                self.pieces.append(piece)
                self.scores.append(score)
                self.types.append(kind)
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                settings = dict(_fields(value))
                self.prefix, self.squeeze = bool(settings.get(3, 1)), bool(settings.get(4, 1))
                self.chars_map = settings.get(2, b"")
        if self.chars_map:
            raise ValueError("only models that leave characters as they are can be compiled")


class Transducer:
    """The compiled machines of one model; give :meth:`encode` a whole text."""

    def __init__(self, data: bytes) -> None:
        model = self.model = Model(data)
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("unigram and merge models can be compiled, word and character models can't")
        self.ids = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == BYTE}
        self.unknown = next((i for i, t in enumerate(model.types) if t == UNKNOWN), 0)
        self.merging = model.kind == BPE
        self.timelines: dict[str, tuple] = {}
        self.trie: dict = {}
        for piece, i in self.ids.items():
            if self.merging and self.timeline(piece)[2] != [piece]:
                continue  # merging never leaves this piece
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = i
        text = "\0".join(self.ids)
        joined = re.search(f"[^{MARK}\0]{MARK}", text)
        lines = "\n" if "\n" not in text else ""
        # No piece spans a border between segments: before a blank mark, around a line end,
        # and between a letter and a stop that no piece has after a letter.
        stops = "".join(c for c in STOPS if not re.search(rf"{LATIN}{re.escape(c)}", text))
        ends = f"[{MARK}{lines}{re.escape(stops)}]"
        word = rf"{MARK}*{LATIN}+(?={ends}|\Z)"
        self.cut = None if joined else re.compile(f"{word}|{MARK}*[^{MARK}{lines}]+|{MARK}+|{lines or MARK}")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.held: dict[str, bytes] = {}
        self.outputs = [self._output(i) for i in range(len(model.pieces))]
        lowest = min((model.scores[i] for i in self.ids.values()), default=0.0)
        self.unknown_weight = UNKNOWN_PENALTY - lowest

    def _output(self, i: int) -> bytes:
        kind, piece = self.model.types[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(MARK, " ").encode()

    # The pair acceptor.

    def score(self, text: str) -> float | None:
        i = self.ids.get(text)
        return None if i is None else self.model.scores[i]

    def timeline(self, text: str) -> tuple[list, list, list]:
        """Merges inside ``text`` in their order: (score, last symbol), (score, first symbol); what is left."""
        found = self.timelines.get(text)
        if found is None:
            symbols, lasts, firsts = list(text), [(None, text[-1])], [(None, text[0])]
            while True:
                best, at = None, -1
                for i in range(len(symbols) - 1):
                    score = self.score(symbols[i] + symbols[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                lasts.append((best, symbols[-1]))
                firsts.append((best, symbols[0]))
            found = self.timelines[text] = lasts, firsts, symbols
        return found

    def allowed(self, left: str, right: str) -> bool:
        """Whether merging leaves the border between the two pieces."""
        key = left, right
        known = self.pairs.get(key)
        if known is None:
            lasts, firsts = self.timeline(left)[0], self.timeline(right)[1]
            i = j = 0
            known = True
            while True:
                across = self.score(lasts[i][1] + firsts[j][1])
                before = lasts[i + 1][0] if i + 1 < len(lasts) else None
                after = firsts[j + 1][0] if j + 1 < len(firsts) else None
                if across is not None and (before is None or across > before) and (after is None or across >= after):
                    known = False
                    break
                if before is None and after is None:
                    break
                # Equal merges go from left to right.
                if after is None or before is not None and before >= after:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) > _PAIRS_HELD:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    # Composition and shortest path.

    def path(self, text: str) -> list[int]:
        """Ids on the path of least weight through the composition with ``text``, already normalised."""
        pieces = self.accepted(text) if self.merging else self.lightest(text)
        ids: list[int] = []
        for piece in pieces:
            i = self.ids.get(piece)
            if i is not None:
                ids.append(i)
            elif self.bytes:
                ids.extend(self.bytes[byte] for byte in piece.encode())
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def ends(self, text: str, start: int) -> list[int]:
        """Where the arcs that begin at ``start`` end, the shortest first."""
        node, place, found = self.trie, start, []
        size = len(text)
        while place < size:
            node = node.get(text[place])
            if node is None:
                break
            place += 1
            if "" in node:
                found.append(place)
        if text[start] not in self.ids:
            found.insert(0, start + 1)
        return found

    def accepted(self, text: str) -> list[str]:
        """The only path of finite weight, found depth first with long pieces first.

        States are (position, last piece); one that leads nowhere is entered once.
        """
        size, place, allowed = len(text), 0, self.allowed
        pieces: list[str] = []
        choices = [self.ends(text, 0)]
        dead: set[tuple[int, str]] = set()
        while place < size:
            if choices[-1]:
                end = choices[-1].pop()
                piece = text[place:end]
                if pieces and not allowed(pieces[-1], piece) or (end, piece) in dead:
                    continue
                pieces.append(piece)
                place = end
                if place < size:
                    choices.append(self.ends(text, place))
            else:
                choices.pop()
                piece = pieces.pop()
                dead.add((place, piece))
                place -= len(piece)
        return pieces

    def lightest(self, text: str) -> list[str]:
        """The path of least weight of a model without pair states."""
        size, scores = len(text), self.model.scores
        best: list[tuple[float, int]] = [(0.0, 0)] + [(float("inf"), 0)] * size
        for start in range(size):
            for end in self.ends(text, start):
                i = self.ids.get(text[start:end])
                weight = best[start][0] + (self.unknown_weight if i is None else -scores[i])
                if weight < best[end][0]:
                    best[end] = (weight, start)
        pieces, place = [], size
        while place:
            start = best[place][1]
            pieces.append(text[start:place])
            place = start
        return pieces[::-1]

    def normalise(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.model.prefix else "") + text.replace(" ", MARK)

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = self.normalise(text or "")
        if not text:
            return b""
        held = self.held
        segments = self.cut.findall(text) if self.cut else [text]
        try:
            return b"".join([held[segment] for segment in segments])
        except KeyError:
            pass
        if len(held) > _SEGMENTS_HELD:
            held.clear()
        found = []
        for segment in segments:
            ids = held.get(segment)
            if ids is None:
                ids = array("I", self.path(segment)).tobytes()
                if len(segment) < 200:
                    held[segment] = ids
            found.append(ids)
        return b"".join(found)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.uint32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the pieces' outputs, without the mark put in front.

        Bytes that are no UTF-8 become replacement characters.
        """
        text = b"".join(map(self.outputs.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


class Codec:
    """A transducer that each worker compiles once, from the model's bytes."""

    _compiled: dict[int, Transducer] = {}

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.data = file.read()
        self.key = zlib.crc32(self.data)

    def machine(self) -> Transducer:
        if self.key not in Codec._compiled:
            Codec._compiled[self.key] = Transducer(self.data)
        return Codec._compiled[self.key]

    def check(self, doc_id: int | None, text: str | None) -> tuple:
        machine = self.machine()
        packed = machine.encode_bytes(text)
        ids = np.frombuffer(packed, np.uint32).tolist()
        return doc_id, len(ids), zlib.crc32(packed), machine.decode(ids) == (text or "")


def encode_check(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, crc32 of the ids and whether decoding them gives the text back.

    Null and empty texts have no pieces and decode to the empty text. A text that has the
    blank mark itself comes back with a blank, so round_trip is false. No shuffle.
    """
    return map_rows(documents, ["doc_id", "text"], Codec(model).check,
                    "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")


def with_pieces(documents: DataFrame, model: str, text: str = "text", name: str = "piece_ids") -> DataFrame:
    """All columns and the ids of ``text`` as ``name`` (which replaces a column of that name)."""
    codec = Codec(model)
    kept = documents.drop(name) if name != text else documents
    names = kept.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                packed = [codec.machine().encode_bytes(one) for one in piece.column(place).to_pylist()]
                offsets = np.cumsum([0, *(len(one) // 4 for one in packed)]).astype(np.int32)
                values = np.frombuffer(b"".join(packed), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([*piece.columns, ids], names=[*names, name])

    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    return kept.mapInArrow(freed(run), schema)


def decoded(table: DataFrame, model: str, key: str = "doc_id", ids: str = "piece_ids") -> DataFrame:
    """``key`` (long) and the text of the ids; null ids give null."""
    codec = Codec(model)
    return map_rows(table, [key, ids], lambda k, one: (k, None if one is None else codec.machine().decode(one)),
                    f"{key} long, text string")
