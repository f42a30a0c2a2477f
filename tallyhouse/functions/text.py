"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.columns import ColumnLike, as_column

# Characters with a meaning in regular expressions.
_REGEX_META = set("\\^$.|?*+()[]{}")

_CONTROLS = "".join(map(chr, range(0x21)))


def _literal_pattern(text: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def split_trimmed(text: ColumnLike, separator: str = " ") -> Column:
    """Split, dropping trailing empty parts and keeping leading ones.

    An empty text gives one empty part; a text of separators only gives none.
    """
    text = as_column(text)
    if len(separator) == 1:
        kept = F.rtrim(text, F.lit(separator))
    else:
        kept = F.regexp_replace(text, f"(?:{_literal_pattern(separator)})+\\z", "")
    only_separators = (kept == "") & (text != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(
        F.split(kept, _literal_pattern(separator))
    )


def field_at(text: ColumnLike, position: int, separator: str = ",") -> Column:
    """The field at ``position`` (from 0), null when the text has fewer fields."""
    return F.get(split_trimmed(text, separator), position)


def lines_of(text: ColumnLike) -> Column:
    """Lines of a whole text, as a text-file reader would give them.

    A line break at the very end does not open another line, and an empty text
    has no lines.
    """
    text = as_column(text)
    ends_line = text.endswith("\n") | text.endswith("\r")
    body = F.when(ends_line, F.regexp_replace(text, "(?:\r\n|\r|\n)\\z", "")).otherwise(text)
    # Splitting at one plain character is much faster than at a pattern.
    pieces = F.when(text.contains("\r"), F.split(body, "\r\n|\r|\n")).otherwise(F.split(body, "\n"))
    return F.when(text != "", pieces)


def trim_controls(text: ColumnLike) -> Column:
    """Strip blanks and control characters (up to U+0020) from both ends."""
    return F.btrim(as_column(text), F.lit(_CONTROLS))


def drop_first(text: ColumnLike) -> Column:
    text = as_column(text)
    return F.substring(text, F.lit(2), F.length(text))


def drop_last(text: ColumnLike) -> Column:
    """All but the last character; empty and null stay as they are."""
    text = as_column(text)
    return F.left(text, F.greatest(F.length(text) - 1, F.lit(0)))


def before_blank(text: ColumnLike) -> Column:
    return F.substring_index(as_column(text), " ", 1)


def label(prefix: str, text: ColumnLike) -> Column:
    """``prefix`` followed by the text, a null text shown as ``null``."""
    return F.concat(F.lit(prefix), F.coalesce(as_column(text).cast("string"), F.lit("null")))


def row_text(*values: ColumnLike) -> Column:
    """One text per row, ``[v1,v2,...]``, nulls shown as ``null``."""
    shown = [F.coalesce(as_column(value).cast("string"), F.lit("null")) for value in values]
    return F.concat(F.lit("["), F.concat_ws(",", *shown), F.lit("]"))
