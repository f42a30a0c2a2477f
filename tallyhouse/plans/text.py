"""Word jobs over text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.text import lines_of, split_trimmed

# Shortest word left out, number of top words, and the stop lists
# of the two jobs (the first name is spelled differently in each).
LONGEST_SHORT_WORD = 3
TOP_WORDS = 10
TOP_WORDS_STOP_LIST = ("Quijote", "Sancho")
WORD_LENGTH_STOP_LIST = ("Quixote", "Sancho")


def text_lines(texts: DataFrame, text: str = "text", keys: Sequence[str] = ()) -> DataFrame:
    """(keys, line_no, value): the lines of whole texts, numbered from 0."""
    return texts.select(*keys, F.posexplode(lines_of(text)).alias("line_no", "value"))


def words(lines: DataFrame, line: str = "value") -> DataFrame:
    """One ``word`` per blank-separated part of each line."""
    return lines.select(F.explode(split_trimmed(line, " ")).alias("word"))


def kept_words(lines: DataFrame, stop_list: Sequence[str], line: str = "value") -> DataFrame:
    """Words longer than three characters that are not in the stop list."""
    return words(lines, line).where((F.length("word") > LONGEST_SHORT_WORD) & ~F.col("word").isin(*stop_list))


def word_count(lines: DataFrame, line: str = "value") -> DataFrame:
    return words(lines, line).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(
    lines: DataFrame, n: int = TOP_WORDS, stop_list: Sequence[str] = TOP_WORDS_STOP_LIST, line: str = "value"
) -> DataFrame:
    """The most used kept words, ties by word."""
    counts = kept_words(lines, stop_list, line).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(n)


def word_lengths(lines: DataFrame, stop_list: Sequence[str] = WORD_LENGTH_STOP_LIST, line: str = "value") -> DataFrame:
    """The length of every kept word."""
    return kept_words(lines, stop_list, line).select(F.length("word").alias("length"))


def mean_word_length(
    lines: DataFrame, stop_list: Sequence[str] = WORD_LENGTH_STOP_LIST, line: str = "value"
) -> DataFrame:
    return word_lengths(lines, stop_list, line).agg(F.avg("length").alias("mean_length"))
