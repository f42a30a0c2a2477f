"""Spelling variants by one-edit neighbourhoods over a reduced alphabet.

Letters are dealt into a few symbols, so that a word has few different one-edit
neighbours: one per deleted position, and per position one for every other symbol, instead
of one for every other letter. The neighbours of the reduced words are joined with the
reduced vocabulary, and the words behind a match are compared themselves.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.line_dedup import ascii_lower
from tallyhouse.session import write_through

# Letters of a word, and the rule by which letters get lost.
RUN = r"[A-Za-zÀ-ÿ]+"
LOSS = 97
SYMBOLS = "01234567"
_ROWS = 20_000


def _damaged(run: Column, doc_id: str, loss: int) -> Column:
    """``run``, without one letter where ``loss`` divides the checksum of id and run."""
    owner = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    checksum = F.crc32(F.concat(owner, F.lit(":"), run).cast("binary"))
    place = F.pmod(checksum, F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(checksum % loss == 0, shorter).otherwise(run)


def counted_words(
    documents: DataFrame,
    min_length: int = 5,
    min_count: int = 3,
    loss: int = LOSS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n): the words of all texts with their occurrences, those with few left out.

    Runs of letters are lower-cased (A-Z only) and lose a letter where ``loss`` divides the
    checksum of ``<doc_id>:<run>``, a null id counting as an empty one. Null and empty texts
    have no words; every row counts, repeated rows as well.
    """
    # Occurrences are counted in the input tasks first, so a word in every text is no hot key.
    runs = documents.select(doc_id, F.explode(F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    lowered = runs.select(doc_id, ascii_lower(F.col("run")).alias("run"))
    words = lowered.select(_damaged(F.col("run"), doc_id, loss).alias("word"))
    counts = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def symbol_table(words: DataFrame, symbols: str = SYMBOLS) -> tuple[str, str]:
    """(letters, their symbols): letters by falling frequency, dealt to and fro over the symbols.

    Gathers one row per letter; words of :func:`counted_words` have 90 letters at most.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    order = [row["letter"] for row in letters.orderBy(F.desc("count"), "letter").collect()]
    turns = symbols + symbols[::-1]
    return "".join(order), "".join(turns[i % len(turns)] for i in range(len(order)))


def neighbours(reduced: str, symbols: str = SYMBOLS) -> set[str]:
    """The reduced word, all with one symbol deleted, all with one replaced by a later symbol.

    This is one half of the neighbourhood. The other half is its mirror image: an insertion
    is a deletion from the longer word, a replacement by an earlier symbol is one by a later
    symbol from the other word. So every pair of reduced words meets, and meets once.
    """
    found = {reduced}
    for i, symbol in enumerate(reduced):
        head, tail = reduced[:i], reduced[i + 1 :]
        found.add(head + tail)
        found.update(head + other + tail for other in symbols[symbols.index(symbol) + 1 :])
    return found


def _with_neighbours(words: DataFrame, symbols: str) -> DataFrame:
    """(key, word, n, own) for every key that ``neighbours`` makes of a word's reduced form."""
    schema = pa.schema([("key", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("own", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, from_words, counts, own = [], [], [], []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip((keys, from_words, counts, own), schema.types)],
                schema=schema,
            )

        for batch in batches:
            for reduced, word, n in zip(*(column.to_pylist() for column in batch.columns)):
                near = neighbours(reduced, symbols)
                keys += near
                from_words += [word] * len(near)
                counts += [n] * len(near)
                own += [key == reduced for key in near]
                if len(keys) >= _ROWS:
                    yield made()
                    keys, from_words, counts, own = [], [], [], []
        if keys:
            yield made()

    return words.select("reduced", "word", "n").mapInArrow(run, "key string, word string, n long, own boolean")


def near_pairs(words: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words that differ by one letter, once."""
    letters, dealt = symbol_table(words, symbols)
    reduced = words.withColumn("reduced", F.translate("word", letters, dealt) if letters else F.col("word"))
    edits = _with_neighbours(reduced, symbols).select(
        "key", F.col("word").alias("a"), F.col("n").alias("a_n"), "own"
    )
    others = reduced.select(F.col("reduced").alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    # Words of one reduced form meet both ways: one way is enough. The words themselves are
    # compared while they are matched, so that only true pairs become rows.
    true_pair = (F.levenshtein("a", "b", 1) == 1) & (~F.col("own") | (F.col("a") < F.col("b")))
    met = edits.alias("e").join(others.alias("o"), (F.col("e.key") == F.col("o.key")) & true_pair)
    return met.select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last word. Chains must not be circular.

    Each round doubles the steps taken, so rounds grow with the logarithm of the longest chain.
    """
    reached = write_through(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        made = write_through(
            reached.join(ahead, F.col("root") == F.col("_from"), "left")
            .select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved"))
        )
        reached = made.drop("moved")
        if made.where("moved").isEmpty():
            return reached


def variants(words: DataFrame, ratio: int = 2, symbols: str = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table (word, n) of distinct words.

    A word's form is the most frequent word one letter away (ties: the first in code-point
    order) if that has at least ``ratio`` (over 1) times its occurrences, else null. ``root``
    follows forms to the last. Words without a near one have n_near 0 and are their own root.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1, or forms may be circular")
    pairs = near_pairs(words, symbols)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )).alias("side")).select("side.*")
    best = sides.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best")
    )
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.rank") >= F.lit(ratio) * F.col("n")
    judged = write_through(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.rank")).alias("form_n"),
    ))
    ends = roots(judged.where(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`variants` of the words of all texts; an empty table gives no rows."""
    return variants(write_through(counted_words(documents, doc_id=doc_id, text=text)))
