"""Quality rules: compression bands over documents and chunks.

Base rules reject texts of few words and texts made of repeated five-word windows.
The bands then compare how far zstandard shrinks the whole text and each fixed chunk of
it with limits that depend on the length: short texts shrink less because the compressor
has nothing to refer to. A ratio under its band marks repetition, one above marks noise
such as random bytes or keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame

from tallyhouse.llm.common import byte_words, filter_rows, map_rows

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 5
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_chunks double"
)


@dataclass(frozen=True)
class Bands:
    """Limits on compressed size / size.

    ``document`` holds (largest length in bytes, lower limit, upper limit) by rising length,
    ``chunk`` the limits of one full chunk of ``chunk_bytes``, ``tail`` those of the shorter last
    one by its length. A document is rejected when its ratio leaves its band, or when chunks
    with more than ``bad_share`` of its bytes leave theirs.
    """

    document: Sequence[tuple[float, float, float]] = (
        (256, 0.25, 1.30),
        (1024, 0.16, 0.92),
        (4096, 0.12, 0.80),
        (16384, 0.09, 0.75),
        (65536, 0.07, 0.72),
        (float("inf"), 0.05, 0.70),
    )
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (0.10, 0.85)
    # As texts of that length; a few dozen bytes say nothing, the frame alone makes them longer.
    tail: Sequence[tuple[float, float, float]] = (
        (64, 0.0, float("inf")),
        (256, 0.25, 1.30),
        (1024, 0.16, 0.92),
        (float("inf"), 0.12, 0.80),
    )
    bad_share: float = 0.5
    level: int = 3


def base_features(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = byte_words(text)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            repeated_lines += line in seen
            seen.add(line)
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), repeated_lines, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of five found at least twice in the text."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    repeated = set()
    for window in windows:
        if first.setdefault(window, True) is False:
            repeated.add(window)
        first[window] = False
    covered = reach = 0
    for place, window in enumerate(windows):
        if window in repeated:
            covered += place + WINDOW - max(place, reach)
            reach = place + WINDOW
    return covered


def compression(text: str, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its bytes in bad chunks, and whether both are accepted."""
    data = text.encode()
    if not data:
        return 0.0, 0.0, False
    ratio = len(compressor.compress(data)) / len(data)
    low, high = band(bands.document, len(data))
    bad = 0
    for start in range(0, len(data), bands.chunk_bytes):
        chunk = data[start : start + bands.chunk_bytes]
        least, most = bands.chunk if len(chunk) == bands.chunk_bytes else band(bands.tail, len(chunk))
        if not least <= len(compressor.compress(chunk)) / len(chunk) <= most:
            bad += len(chunk)
    share = bad / len(data)
    return ratio, share, low <= ratio <= high and share <= bands.bad_share


def band(bands: Sequence[tuple[float, float, float]], length: int) -> tuple[float, float]:
    """The limits for a length."""
    return next((low, high) for most, low, high in bands if length <= most)


class Judge:
    """Features and verdict of one text; the compressor is made once in each worker."""

    def __init__(self, bands: Bands) -> None:
        self.bands = bands
        self.compressor = None

    def __getstate__(self) -> dict:
        return {"bands": self.bands, "compressor": None}

    def __call__(self, text: str | None) -> tuple:
        self.compressor = self.compressor or zstandard.ZstdCompressor(level=self.bands.level)
        features = base_features(text)
        n_words, repeated = features[0], features[-1]
        failed = n_words < 10 or 100 * repeated > 20 * n_words
        ratio, share, accepted = compression(text or "", self.bands, self.compressor)
        return (*features, failed, not failed and accepted, ratio, share)

    def row(self, doc_id: int | None, text: str | None) -> tuple:
        return (doc_id, *self(text))

    def keeps(self, text: str | None) -> bool:
        """The verdict only; compression is skipped for texts the base rules reject."""
        words = byte_words(text)
        if len(words) < 10 or 100 * repeat_words(words) > 20 * len(words):
            return False
        self.compressor = self.compressor or zstandard.ZstdCompressor(level=self.bands.level)
        return compression(text, self.bands, self.compressor)[2]


def quality(documents: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: features, base verdict, ratio, share of bad chunks, verdict.

    Null and empty texts have no words and are rejected; a null doc_id stays null; repeated
    rows are judged each; columns other than doc_id and text are not read. No shuffle.
    """
    return map_rows(documents, ["doc_id", "text"], Judge(bands).row, SCHEMA)


def keep_good(documents: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that pass, with all their columns."""
    return filter_rows(documents, Judge(bands).keeps, ["text"])
