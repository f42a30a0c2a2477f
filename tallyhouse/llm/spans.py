"""Spans of a text as ``kind:start:end`` strings, in code points, end exclusive."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

Span = tuple[int, int, int]  # start, number of the kind, end


def written(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    """Spans by start, then kind, then end, joined by commas."""
    return ",".join(f"{kinds[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def digest(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    return hashlib.sha256(written(spans, kinds).encode()).hexdigest()


def replaced(text: str, spans: Iterable[Span], marks: Sequence[str]) -> str:
    """``text`` with each span replaced by the mark of its kind; what overlaps an earlier span goes with it."""
    out, place = [], 0
    for start, kind, end in sorted(spans):
        if start >= place:
            out += [text[place:start], marks[kind]]
            place = end
        elif end > place:
            place = end
    return "".join([*out, text[place:]])
