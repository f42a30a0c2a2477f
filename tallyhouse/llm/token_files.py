"""Token ids in files: frequency-ranked, byte-aligned codes with separate control bytes.

Ids are replaced by their rank in the corpus, so that frequent ones take one byte. Per
four ids a control byte tells their lengths (two bits each, length less one), and the
bytes of the ranks follow in a stream of their own. A block holds whole documents and is
decoded by itself with numpy: a table of 256 x 4 lengths, running sums for the places,
and a table from rank to id. Blocks are rows of a parquet table (written through Spark's
committer, so a lost task leaves nothing behind), in order of (part, block).
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import freed
from tallyhouse.session import write_through

MAGIC = b"TLB1"
_LENGTHS = np.array([[(control >> 2 * i & 3) + 1 for i in range(4)] for control in range(256)], np.uint8)
# Pieces whose ids a worker remembers, bytes of the longest of them, and bytes of texts encoded at a time.
_PIECES_HELD = 1_500_000
_LONGEST_HELD = 200
_AT_A_TIME = 32_000_000
# Pieces that go to the tokenizer in one text, and rows whose ids are counted at a time.
_JOINED = 100_000
_COUNTED = 256
_LATIN = "[A-Za-zÀ-ÖØ-öø-ɏ]"
_STOPS = ".,;:!?#*$%&"
# The white space of the tokenizer's own pattern.
_BLANK = r" \t-\r\x85\xa0  -     　"
_PIECE = re.compile(
    rf"[{_BLANK}][{_BLANK}]+| ?{_LATIN}+(?=[ \n{_STOPS}]|\Z)|[{_STOPS}]+(?=[ \n]|\Z)| ?[^{_BLANK}]+|[{_BLANK}]"
)


# For Arrow: white space beside white space, and the mark at which chunks are cut into pieces.
_WHOLE = rf"[{_BLANK}\x1c-\x1f][{_BLANK}\x1c-\x1f]|\x00"
_BORDER = rf"({_LATIN})([{_STOPS}])"
# Pieces that are one word after a space, others after a space, and those without any white space.
_WORD = rf"\A {_LATIN}+\z"
_SPACED = rf"\A [^{_BLANK}\x1c-\x1f]+\z"
_SOLID = rf"\A[^{_BLANK}\x1c-\x1f]+\z"


def offsets(array: pa.Array) -> np.ndarray:
    """Where each string of an array starts in its bytes, and the end of the last."""
    return np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, 4 * array.offset) if len(array) else np.zeros(1, np.int32)


def binary(places: np.ndarray, data: pa.Buffer | bytes | None, kind: pa.DataType = pa.binary()) -> pa.Array:
    """The array whose values lie in ``data`` between neighbouring ``places``."""
    data = pa.py_buffer(data or b"") if not isinstance(data, pa.Buffer) else data
    return pa.Array.from_buffers(kind, len(places) - 1, [None, pa.py_buffer(places.astype(np.int32)), data])


def cut_texts(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Chunks of texts, cut before each space and around each line end, and the number of chunks before each text."""
    places = offsets(texts)
    first, last = int(places[0]), int(places[-1])
    data = texts.buffers()[2] if last > first else b""
    seen = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    borders = np.zeros(len(seen) + 1, bool)
    np.equal(seen, 32, out=borders[:-1])
    lines = np.flatnonzero(seen == 10)
    borders[lines] = borders[lines + 1] = True
    borders[places - first] = True
    starts = np.flatnonzero(borders)
    return binary(starts + first, data, pa.string()), np.searchsorted(starts, places - first)


def letters_of_bytes() -> np.ndarray:
    """The code point that a byte-level vocabulary writes each byte as."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.zeros(256, "<u2")
    out[shown] = shown
    hidden = np.flatnonzero(out == 0)
    out[hidden] = 256 + np.arange(len(hidden))
    return out


class Encoder:
    """Ids of whole texts. Pieces that the tokenizer takes apart anyway are encoded once and remembered.

    A byte-level pre-tokenizer starts anew at a single space, around a single line end, and
    between a letter and a stop, so the ids of a text are those of its pieces. Texts are cut
    at spaces and line ends into chunks; the distinct ones are cut into pieces, and only pieces not
    met before go to the tokenizer. All this is done on whole Arrow arrays, without Python
    objects for chunks or for pieces met before. A text with white space beside white space is encoded whole, and so
    is every text if the tokenizer splits in another way.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        self.tokenizer = Tokenizer.from_file(path)
        # For single words already written in the vocabulary's letters: its model without the splitting.
        self.of_words = Tokenizer.from_file(path)
        self.of_words.pre_tokenizer = WhitespaceSplit()
        letters = letters_of_bytes()
        letters[ord("\n")] = ord("\n")
        self.letters = letters
        self.kind = id_kind(self.tokenizer, end_id)
        self.end = np.array([end_id], self.kind).tobytes()
        # Pieces met before and their ids.
        self.pieces = pa.array([], pa.string())
        self.ids = pa.array([], pa.binary())
        self.compressor = zstandard.ZstdCompressor(level=1)
        described = json.loads(self.tokenizer.to_str())
        splits = described["pre_tokenizer"] or {}
        self.cuts = (
            splits.get("type") == "ByteLevel" and splits.get("use_regex", True)
            and not splits.get("add_prefix_space") and not described["normalizer"]
        )
        # Whether an id starts with a space or a line end, which a byte-level vocabulary writes as these letters.
        size = max(self.tokenizer.get_vocab_size(), end_id + 1)
        shown = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.spaced = np.array([one.startswith("\u0120") for one in shown])
        self.ended = np.array([one.startswith("\u010a") for one in shown])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, self.kind).tobytes() for one in found]

    def encode_joined(self, tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def encode_each(self, pieces: pa.StringArray) -> pa.BinaryArray:
        """Ids of each piece; those with white space inside are cut at it."""
        cut = [_PIECE.findall(one) for one in pieces.to_pylist()]
        parts = list(set().union(*cut))
        ids = dict(zip(parts, self.encode_all(parts)))
        return pa.array([b"".join(map(ids.__getitem__, some)) for some in cut], pa.binary())

    def encode_spaced(self, pieces: pa.StringArray, words: bool) -> pa.BinaryArray:
        """Ids of pieces that start with their only space, through the tokenizer in one text."""
        places = offsets(pieces)
        text = pieces.buffers()[2][int(places[0]) : int(places[-1])]
        if words:
            letters = np.insert(self.letters[np.frombuffer(text, np.uint8)], places[1:-1] - places[0], ord("\n"))
            ids = self.encode_joined(self.of_words, letters.tobytes().decode("utf-16-le"))
        else:
            ids = self.encode_joined(self.tokenizer, text.to_pybytes().decode())
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(pieces):
            return self.encode_each(pieces)
        return binary(np.append(starts, len(ids)) * ids.itemsize, ids.tobytes())

    def encode_solid(self, pieces: pa.StringArray) -> pa.BinaryArray:
        """Ids of pieces without white space, through the tokenizer as lines of one text."""
        ids = self.encode_joined(self.tokenizer, "\n".join(pieces.to_pylist()))
        ends = np.flatnonzero(self.ended[ids])
        if len(ends) != len(pieces) - 1:
            return self.encode_each(pieces)
        places = np.concatenate([[0], ends - np.arange(len(ends)), [len(ids) - len(ends)]])
        return binary(places * ids.itemsize, ids[~self.ended[ids]].tobytes())

    def encode_pieces(self, pieces: pa.StringArray) -> pa.BinaryArray:
        """Ids of each piece."""
        words, spaced, solid = (
            pc.match_substring_regex(pieces, kind).to_numpy(zero_copy_only=False) for kind in (_WORD, _SPACED, _SOLID)
        )
        kinds = np.select([words, spaced, solid], [0, 1, 2], 3)
        encode = [lambda some: self.encode_spaced(some, True), lambda some: self.encode_spaced(some, False),
                  self.encode_solid, self.encode_each]
        order = [np.flatnonzero(kinds == kind) for kind in range(4)]
        made = [
            one(pieces.take(pa.array(places[start : start + _JOINED])))
            for one, places in zip(encode, order) for start in range(0, len(places), _JOINED)
        ]
        back = np.empty(len(pieces), np.int64)
        back[np.concatenate(order)] = np.arange(len(pieces))
        return pa.concat_arrays([self.ids[:0], *made]).take(pa.array(back))

    def chunk_ids(self, chunks: pa.StringArray) -> pa.BinaryArray:
        """Ids of each of some distinct chunks."""
        cut = pc.split_pattern(pc.replace_substring_regex(chunks, _BORDER, "\\1\0\\2"), "\0")
        known = len(self.pieces)
        found = pa.concat_arrays([self.pieces, cut.flatten()]).dictionary_encode()
        pieces, places = found.dictionary, found.indices.slice(known)
        ids = pa.concat_arrays([self.ids, self.encode_pieces(pieces.slice(known))])
        made = ids.take(places)
        # Long pieces are met anew each time; if there are too many, only those met now are remembered.
        held = np.diff(offsets(pieces)) <= _LONGEST_HELD
        if len(pieces) > _PIECES_HELD:
            met = np.zeros(len(pieces), bool)
            met[places.to_numpy()] = True
            held &= met
        self.pieces, self.ids = pieces.filter(pa.array(held)), ids.filter(pa.array(held))
        return binary(offsets(made)[cut.offsets.to_numpy()], made.buffers()[2])

    def rows(self, texts: list[str] | pa.StringArray) -> list[bytes]:
        """Ids of each text as bytes, the end id last."""
        array = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.cuts:
            return [one + self.end for one in self.encode_all(array.to_pylist())]
        whole = pc.match_substring_regex(array, _WHOLE)
        encoded_whole = iter(self.encode_all(array.filter(whole).to_pylist()))
        chunks, places = cut_texts(array.filter(pc.invert(whole)))
        found = chunks.dictionary_encode()
        ids = self.chunk_ids(found.dictionary).take(found.indices)
        borders = offsets(ids)[places].tolist()
        del chunks, found
        data = memoryview(ids.buffers()[2] or b"")
        cut = iter(map(data.__getitem__, map(slice, borders, borders[1:])))
        return [b"".join((next(encoded_whole if alone else cut), self.end)) for alone in whole.to_pylist()]


def id_kind(tokenizer, end_id: int) -> type:
    return np.uint16 if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32


def of_size(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, pa.StringArray]]:
    """Columns (doc_id, text) of batches, put together or cut so that ``size`` bytes of text are reached; null texts are empty."""
    parts, total = [], 0

    def done() -> tuple[pa.Array, pa.StringArray]:
        return tuple(pa.concat_arrays([part.column(i) for part in parts]) for i in range(2))

    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
        batch = pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "text"])
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        start, before = 0, 0
        while start < batch.num_rows:
            stop = min(int(np.searchsorted(ends, before + size - total)) + 1, batch.num_rows)
            parts.append(batch.slice(start, stop - start))
            total += int(ends[stop - 1]) - before
            start, before = stop, int(ends[stop - 1])
            if total >= size:
                group = done()
                parts, total = [], 0
                yield group
    if parts:
        yield done()


_encoders: dict[tuple[str, int], Encoder] = {}


def encoded(documents: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """(doc_id, ids, counts): the ids of each whole text, ``end_id`` last, as compressed little-endian bytes.

    Each task adds one row without ``ids`` whose ``counts`` hold how often it met each id,
    compressed 64-bit numbers by rising id. See :func:`id_counts`.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, end_id) not in _encoders:
            _encoders[path, end_id] = Encoder(path, end_id)
        encoder = _encoders[path, end_id]
        compress, counts = encoder.compressor.compress, np.zeros(0, np.int64)
        for names, texts in of_size(batches, _AT_A_TIME):
            rows = encoder.rows(texts)
            for start in range(0, len(rows), _COUNTED):
                met = np.frombuffer(b"".join(rows[start : start + _COUNTED]), encoder.kind)
                more = np.bincount(met, minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
            arrays = [names.cast(pa.int64()), pa.array(map(compress, rows), pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(names), pa.binary())], schema=schema)
        if len(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([compress(counts.tobytes())])], schema=schema
            )

    return documents.select("doc_id", "text").mapInArrow(freed(run), "doc_id long, ids binary, counts binary")


def unzipped(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(value.as_py()), kind)


def id_counts(rows: DataFrame) -> DataFrame:
    """(id, n) from the counts that the tasks of :func:`encoded` left; the ids themselves are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                counts = unzipped(value, np.int64)
                found = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["id", "n"])

    left = rows.where(F.col("counts").isNotNull()).select("counts")
    return left.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of ranks under 2**32."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    quads[: len(ranks)] = length - 1
    control = (quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int, ids_of_ranks: np.ndarray) -> np.ndarray:
    """The ids that :func:`pack` was given the ranks of."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    stream = np.frombuffer(data, np.uint8)
    ranks = stream[starts].astype(np.uint32)
    for i in (1, 2, 3):
        longer = np.flatnonzero(lengths > i)
        ranks[longer] |= stream[starts[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return ids_of_ranks[ranks]


def block(doc_ids: list[int | None], ids: list[np.ndarray], ranks_of_ids: np.ndarray) -> bytes:
    """Magic, number of documents and ids, length of the control bytes; doc ids, null marks, lengths; codes."""
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    control, data = pack(ranks_of_ids[flat])
    names = np.array([0 if one is None else one for one in doc_ids], "<i8")
    nulls = np.array([one is None for one in doc_ids], np.uint8)
    counts = np.array([len(one) for one in ids], "<i8")
    head = MAGIC + struct.pack("<QQQ", len(ids), len(flat), len(control))
    return head + names.tobytes() + nulls.tobytes() + counts.tobytes() + control + data


def read_block(data: bytes, ids_of_ranks: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, number of ids of each, all ids) of one block."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n_docs, n_ids, n_control = struct.unpack_from("<QQQ", data, 4)
    place = 28
    names = np.frombuffer(data, "<i8", n_docs, place)
    nulls = np.frombuffer(data, np.uint8, n_docs, place + 8 * n_docs)
    counts = np.frombuffer(data, "<i8", n_docs, place + 9 * n_docs)
    place += 17 * n_docs
    ids = unpack(data[place : place + n_control], data[place + n_control :], n_ids, ids_of_ranks)
    return [None if null else int(name) for name, null in zip(names, nulls)], counts, ids


def write_token_files(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_ids: int = 500_000) -> None:
    """Encode every text and write the ids under ``path`` in ascending doc_id order.

    Null ids come first, rows of one id in the order of a hash of their tokens. A null or
    empty text is the end id alone. ``path/ranks`` has the id of each rank,
    ``path/blocks`` (part, block, n_ids, payload) blocks of about ``block_ids`` ids.
    The rank table has at most as many rows as the vocabulary; it alone passes the driver.
    """
    from tokenizers import Tokenizer

    spark = documents.sparkSession
    opened = Tokenizer.from_file(tokenizer)
    size, kind = max(opened.get_vocab_size(), end_id + 1), id_kind(opened, end_id)
    made = write_through(encoded(documents, tokenizer, end_id))
    ids = made.where(F.col("ids").isNotNull()).select("doc_id", "ids")
    order = [row["id"] for row in id_counts(made).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(list(enumerate(order)), "rank long, id long").coalesce(1).write.mode("overwrite").parquet(f"{path}/ranks")
    ranks_of_ids = np.zeros(size, np.uint32)
    ranks_of_ids[order] = np.arange(len(order), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        names, held, total = [], [], 0

        def done() -> pa.RecordBatch:
            arrays = [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([total], pa.int64()),
                      pa.array([block(names, held, ranks_of_ids)], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "block", "n_ids", "payload"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                names.append(name)
                held.append(unzipped(value, kind))
                total += len(held[-1])
                if total >= block_ids:
                    yield done()
                    names, held, total, number = [], [], 0, number + 1
        if names:
            yield done()

    # The hash splits rows that share an id over parts.
    ordered = ids.withColumn("tie", F.xxhash64("ids")).repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), F.asc_nulls_first("doc_id"), "tie"
    ).sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie").select("doc_id", "ids")
    ordered.mapInArrow(run, "part int, block long, n_ids long, payload binary").write.mode("overwrite").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and place (part, block, in_block) of each written document."""
    order = [row["id"] for row in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    ids_of_ranks = np.array(order, np.uint32)
    schema = "part int, block long, in_block long, doc_id long, before long, n_tokens long, ids_crc32 long"
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    fields = pa.schema(list(zip([part.split()[0] for part in schema.split(", ")], kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, payload in zip(*(batch.column(i) for i in range(3))):
                names, counts, ids = read_block(payload.as_py(), ids_of_ranks)
                ends = np.cumsum(counts)
                data = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                sums = [zlib.crc32(data[4 * (end - count) : 4 * end]) for end, count in zip(ends.tolist(), counts.tolist())]
                n = len(names)
                columns = [[part.as_py()] * n, [number.as_py()] * n, range(n), names, ends - counts, counts, sums]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.select("part", "block", "n_ids")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, then the blocks of each part: only counts pass these windows.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        F.col("part"), F.coalesce(F.sum("n").over(earlier.orderBy("part")), F.lit(0)).alias("of_part")
    )
    inside = F.coalesce(F.sum("n_ids").over(earlier.partitionBy("part").orderBy("block")), F.lit(0))
    offsets = sizes.withColumn("inside", inside).join(parts, "part").select(
        "part", "block", (F.col("of_part") + F.col("inside")).alias("of_block")
    )
    read = blocks.select("part", "block", "payload").mapInArrow(run, schema)
    return read.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("of_block") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "part", "block", "in_block"
    )
