"""Lines that many documents share, found in range-partitioned hashes and kept as bitmaps.

Each line becomes a 128-bit hash of its key with its document and position. The hashes are
range-partitioned together with the documents, so that a line of very many documents is
spread over partitions, and sorted by hash, document and position; the first occurrence in
each document is marked as the sorted rows stream by. What comes back is no text but, per
document, the words of 64 keep bits that are not all ones.

A document is a distinct pair of id and text: repeated rows are one document and get the
same bitmap; rows that share only the id, or have none, are documents of their own.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import write_through

# Stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
# Lines that hold more than this share of all lines are matched apart. There are fewer of
# them than this number, so their table may go to every executor.
_HOT_LINES = 10_000
_BITS = 64
_DOCUMENT = ["_id", "_text"]
_HASH = ["_h1", "_h2"]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    """All lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _document(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_text")]


def _sorted_lines(documents: DataFrame, doc_id: str, text: str, min_length: int) -> DataFrame:
    """Hash, document and position of every line with a key, with ``_new`` at the first one in its document."""
    keyed = (
        documents.select(*_document(doc_id, text), F.posexplode(lines_of(F.col(text))).alias("_line", "_value"))
        .select(*_DOCUMENT, "_line", line_key(F.col("_value")).alias("_key"))
        .where((F.col("_key") != "") & (F.length("_key") >= min_length))
        .select(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), F.col("_key")).alias("_h2"), *_DOCUMENT, "_line")
    )
    # Written first: the range bounds are sampled from the hashes, not from the texts again.
    laid_out = write_through(keyed).repartitionByRange(*_HASH, *_DOCUMENT)
    # The range partitions hold each (hash, document) whole: this sorts, but moves nothing.
    inside = Window.partitionBy(*_HASH, *_DOCUMENT).orderBy("_line")
    return laid_out.withColumn("_new", F.row_number().over(inside) == 1)


def keep_bitmaps(
    documents: DataFrame,
    min_docs: int = 10,
    keep_first: bool = False,
    min_length: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(_id, _text, keep) for each document that loses a line; a written table.

    ``_text`` is the hash of the text. ``keep`` maps word number w to 64 bits: bit b tells
    whether line 64 * w + b stays; words that are missing keep all their lines. A line leaves
    if its key, of at least ``min_length`` code points, is in at least ``min_docs`` documents;
    with ``keep_first`` its first occurrence, by id (null first), text hash and position,
    stays. Lines without a key always stay. An empty table gives no rows.
    """
    lines = write_through(_sorted_lines(documents, doc_id, text, min_length))
    # Neighbours in the sorted files are combined before this shuffle.
    frequent = write_through(
        lines.groupBy(*_HASH).agg(
            F.count_if("_new").alias("_docs"),
            F.count(F.lit(1)).alias("_rows"),
            F.min(F.struct(*_DOCUMENT, "_line")).alias("_first"),
        ).where(F.col("_docs") >= min_docs).drop("_docs")
    )
    bound = lines.count() / _HOT_LINES
    hot = F.broadcast(frequent.where(F.col("_rows") > bound))
    others = frequent.where(F.col("_rows") <= bound)
    found = lines.join(hot, _HASH).union(lines.join(hot.select(*_HASH), _HASH, "left_anti").join(others, _HASH))
    if keep_first:
        found = found.where(~F.struct(*_DOCUMENT, "_line").eqNullSafe(F.col("_first")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_line") % _BITS)
    words = found.groupBy(*_DOCUMENT, F.floor(F.col("_line") / _BITS).cast("int").alias("_word")).agg(
        F.bitwise_not(F.bit_or(bit)).alias("_keep")
    )
    # One entry per 64 lines of one document.
    maps = words.groupBy(*_DOCUMENT).agg(F.map_from_entries(F.collect_list(F.struct("_word", "_keep"))).alias("keep"))
    return write_through(maps)


def with_bitmaps(documents: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, lines, keep) for every row of ``documents``: the row as a struct, its lines, its bitmap or null.

    The lines are a column of their own, so that expressions over them split a text once.
    """
    rows = documents.select(F.struct("*").alias("row"), *_document(doc_id, text))
    same = rows["_id"].eqNullSafe(bitmaps["_id"]) & (rows["_text"] == bitmaps["_text"])
    return rows.join(bitmaps, same, "left").select("row", lines_of(F.col("row")[text]).alias("lines"), "keep")


def dropped_lines(keep: Column) -> Column:
    """Number of lines that a bitmap drops."""
    zeros = F.aggregate(F.map_values(keep), F.lit(0).cast("long"), lambda n, word: n + F.bit_count(F.bitwise_not(word)))
    return F.coalesce(zeros, F.lit(0).cast("long"))


def kept_text(lines: Column, keep: Column) -> Column:
    """The lines that a bitmap does not drop, joined."""

    def kept_of(word: Column) -> Column:
        part = F.slice(lines, word * _BITS + 1, F.lit(_BITS))
        bits = F.try_element_at(keep, word)
        return F.when(bits.isNull(), part).otherwise(F.filter(part, lambda line, i: F.getbit(bits, i) == 1))

    words = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / _BITS).cast("int"))
    kept = F.when(keep.isNull(), lines).otherwise(F.flatten(F.transform(words, kept_of)))
    return F.array_join(kept, "\n")


def without_shared_lines(
    documents: DataFrame,
    min_docs: int = 10,
    keep_first: bool = False,
    min_length: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``documents`` with shared lines taken out of their texts, see :func:`keep_bitmaps`.

    Other columns stay, whatever their names; null texts stay null.
    """
    marked = with_bitmaps(documents, keep_bitmaps(documents, min_docs, keep_first, min_length, doc_id, text), doc_id, text)
    cut = kept_text(F.col("lines"), F.col("keep"))
    return marked.select(*[
        F.when(F.col("row")[text].isNotNull(), cut).alias(name) if name == text else F.col("row")[name].alias(name)
        for name in documents.columns
    ])


def line_digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row, lines of ten or more documents dropped."""
    slim = documents.select(doc_id, text)
    marked = with_bitmaps(slim, keep_bitmaps(slim, doc_id=doc_id, text=text), doc_id, text)
    return marked.select(
        F.col("row")[doc_id].alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        dropped_lines(F.col("keep")).alias("n_dropped"),
        F.sha2(kept_text(F.col("lines"), F.col("keep")), 256).alias("kept_sha256"),
    )
