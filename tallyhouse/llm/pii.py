"""Personal data: patterns, and terms that disclose a protected entity.

The patterns find mail addresses, network addresses, card and phone numbers: the
protected entities. A term standing near an entity can give it away even where the entity
itself is masked. How strongly is estimated from the corpus: with p(e) the share of
documents that hold the entity, p(t) that hold the term and p(t, e) that hold the term
near the entity, PMI = log2 p(t, e) / (p(t) p(e)) is what the term tells about the entity,
and -log2 p(e) is all there is to tell. Terms with PMI of at least ``disclosure`` times that are
replaced near the entity. Counts are over distinct surroundings, so that copies of one
passage count once and prove nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import arrow_schema, freed, map_rows
from tallyhouse.llm.spans import Span, digest, replaced, written
from tallyhouse.session import write_through

KINDS = ("email", "ip", "card", "phone", "term")
MARKS = ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "<TERM>")
# Words looked at on either side of an entity, and the shortest word that counts as a term.
AROUND, SHORTEST = 4, 4

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_LONG_NUMBER = re.compile(r"[0-9][0-9\x20-]{12}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]+")


def emails(text: str) -> list[tuple[int, int]]:
    found, end, behind_at = [], 0, 0
    for match in _DOMAIN.finditer(text):
        # The last place before which no part of this address can lie.
        at = match.start()
        behind_at = max(behind_at, end, text.rfind("@", behind_at, at) + 1)
        head = text[behind_at:at]
        local = len(head) - len(head.rstrip(_LOCAL))
        if local:
            found.append((at - local, match.end()))
            end = match.end()
        behind_at = max(behind_at, at + 1)
    return found


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted numbers each; a longer chain is cut into fours from the left."""
    found = []
    for chain in _CHAIN.finditer(text):
        numbers = list(_NUMBER.finditer(text, chain.start(), chain.end()))
        for i in range(0, len(numbers) - 3, 4):
            if all(len(n[0].lstrip("0")) <= 3 and int(n[0].lstrip("0") or 0) <= 255 for n in numbers[i : i + 4]):
                found.append((numbers[i].start(), numbers[i + 3].end()))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(match.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]


def base_spans(text: str | None) -> list[Span]:
    """All pattern spans of a text, by start and kind."""
    if not text:
        return []
    found: list[Span] = []
    if "@" in text:
        found += [(start, 0, end) for start, end in emails(text)]
    if _LONG_NUMBER.search(text):
        found += [(start, 2, end) for start, end in cards(text)]
    if "." in text:
        found += [(start, 1, end) for start, end in ips(text)]
    if "+" in text:
        found += [(start, 3, end) for start, end in phones(text)]
    return sorted(found)


def surroundings(text: str, spans: list[Span]) -> list[tuple[int, str, int, int, int]]:
    """(entity, term, start, end, surrounding) for the terms near each span.

    Entity and surrounding are hashes. Words next to the entity on both sides make the
    surrounding, however far away they stand; those that lie in a span themselves are no terms.
    """
    out = []
    words = [m.span() for m in _TERM.finditer(text)]
    firsts, lasts = [a for a, _ in words], [b for _, b in words]
    # The furthest end of the spans up to each tells whether one of them reaches into a word.
    begins = sorted(start for start, _, _ in spans)
    reached = list(accumulate((end for _, _, end in sorted(spans)), max))
    for start, kind, end in spans:
        entity = xxhash.xxh3_64_intdigest(f"{kind}:{text[start:end]}") - (1 << 63)
        before, behind = bisect_left(firsts, start), bisect_right(lasts, end)
        # A word that the entity borders on counts with its part outside.
        left = [(a, min(b, start)) for a, b in words[max(0, before - AROUND) : before]]
        right = [(max(a, end), b) for a, b in words[behind : behind + AROUND]]
        places = [(bisect_left(begins, b), a, b) for a, b in left + right]
        near = [(text[a:b].lower(), a, b) for i, a, b in places if not i or reached[i - 1] <= a]
        where = xxhash.xxh3_64_intdigest("\0".join(word for word, _, _ in near)) - (1 << 63)
        out += [(entity, word, a, b, where) for word, a, b in near if len(word) >= SHORTEST]
    return out


_FOUND = (
    "doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "base string, starts array<long>, kinds array<long>, ends array<long>"
)


def text_hash(text: str | None) -> int | None:
    """The number that ``F.xxhash64`` gives for a text, null for none."""
    if text is None:
        return None
    number = xxhash.xxh64_intdigest(text, seed=42)
    return number - (1 << 64) if number >> 63 else number


def find_base(documents: DataFrame) -> DataFrame:
    """Per row: counts and digest of the pattern spans, and the terms near each as an array."""
    base = arrow_schema(_FOUND)
    near = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string()), ("start", pa.int64()),
                               ("end", pa.int64()), ("place", pa.int64())]))
    schema = base.append(pa.field("near", near))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                piece = batch.slice(first, 512)
                rows = []
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    spans = base_spans(text)
                    counts = [sum(kind == k for _, kind, _ in spans) for k in range(4)]
                    terms = [dict(zip(("entity", "term", "start", "end", "place"), one)) for one in surroundings(text, spans)] if spans else []
                    rows.append((doc_id, text_hash(text), *counts, digest(spans, KINDS), written(spans, KINDS),
                                 [s[0] for s in spans], [s[1] for s in spans], [s[2] for s in spans], terms))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(schema)], schema=schema
                )

    return documents.select("doc_id", "text").mapInArrow(
        run, _FOUND + ", near array<struct<entity: long, term: string, start: long, end: long, place: long>>"
    )


def term_counts(documents: DataFrame) -> DataFrame:
    """(term, n): in how many documents each word stands; summed up in the tasks as far as memory allows."""
    limit = 400_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                for word in set(_TERM.findall((text.as_py() or "").lower())):
                    if len(word) >= SHORTEST:
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) > limit:
                    yield done()
                    counts.clear()
        yield done()

    return documents.select("text").mapInArrow(run, "term string, n long")


def disclosing_terms(found: DataFrame, documents: DataFrame, disclosure: float, support: int) -> DataFrame:
    """(entity, term) pairs whose PMI reaches ``disclosure`` of the entity's information.

    ``support`` distinct surroundings are needed at least.
    """
    near = found.select(F.explode("near").alias("near")).select("near.*")
    seen = near.select("entity", "term", "place").distinct()
    # An entity's own number of surroundings, combined in the tasks.
    entities = seen.select("entity", "place").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    together = write_through(
        seen.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te")).where(F.col("n_te") >= support)
        .join(entities, "entity")
    )
    # Only words that stand near some entity often enough are counted on.
    wanted = together.select("term").distinct()
    counts = term_counts(documents).join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n_t"))
    total = F.lit(float(documents.count()))
    pmi = F.log2(F.col("n_te") * total / (F.greatest("n_t", "n_te") * F.col("n_e")))
    information = F.log2(total / F.col("n_e"))
    joined = together.join(counts, "term")
    return joined.where((information > 0) & (pmi >= F.lit(disclosure) * information)).select("entity", "term")


def disclosed(found: DataFrame, terms: DataFrame) -> DataFrame:
    """Per (doc_id, text_hash): the spans (start, end) of disclosing terms near their entity."""
    near = found.where(F.size("near") > 0).select("doc_id", "text_hash", F.explode("near").alias("near"))
    flat = near.select("doc_id", "text_hash", "near.entity", "near.term", "near.start", "near.end")
    return flat.join(terms, ["entity", "term"], "left_semi").groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("terms")
    )


def found_and_terms(documents: DataFrame, disclosure: float, support: int) -> DataFrame:
    """The table of :func:`find_base` with ``terms``, the spans of disclosing terms (null if none)."""
    found = write_through(find_base(documents))
    terms = write_through(disclosing_terms(found, documents, disclosure, support))
    added = disclosed(found, terms).toDF("_doc_id", "_text_hash", "terms")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("text_hash").eqNullSafe(F.col("_text_hash"))
    return found.join(added, same, "left").drop("_doc_id", "_text_hash")


def personal_data(documents: DataFrame, disclosure: float = 0.9, support: int = 3) -> DataFrame:
    """doc_id, counts and digest of the pattern spans, and ``spans``, disclosing terms included.

    Null and empty texts have no spans. A document without any entity never gets a span. Rows
    that repeat a document get equal results; a null doc_id stays null; columns other than doc_id and
    text are not read. Texts are read twice and never moved: what is shuffled are terms
    near entities and word counts.
    """
    joined = found_and_terms(documents, disclosure, support)

    def spans_of(starts: list, kinds: list, ends: list, terms: list | None) -> str:
        more = [(one["start"], 4, one["end"]) for one in terms or []]
        return written([*zip(starts, kinds, ends), *more], KINDS)

    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    return map_rows(
        joined, [*names, "starts", "kinds", "ends", "terms"], lambda *row: (*row[:6], spans_of(*row[6:])),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )


def sanitised(documents: DataFrame, disclosure: float = 0.9, support: int = 3) -> DataFrame:
    """The documents with every span replaced by the mark of its kind; ``n_chars`` follows if there is one.

    All columns stay, whatever their names; ``n_chars`` follows only if it holds whole numbers.
    Texts without a span are not changed, null texts stay null. Patterns are found where the text
    is; rows meet their disclosing terms by id and text, so no id is a hot key by itself.
    """
    joined = found_and_terms(documents, disclosure, support)
    terms = write_through(
        joined.where(F.col("terms").isNotNull()).select("doc_id", "text_hash", "terms").dropDuplicates(["doc_id", "text_hash"])
    )
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    same = rows["id"].eqNullSafe(terms["doc_id"]) & (rows["hash"] == terms["text_hash"])
    both = rows.join(terms, same, "left").select("row", "terms")
    place = {name: i for i, name in enumerate(documents.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                piece = batch.slice(first, 512)
                columns = piece.column(0).flatten()
                text, chars = place["text"], place.get("n_chars")
                texts = columns[text].to_pylist()
                for i, found in enumerate(piece.column(1).to_pylist()):
                    spans = base_spans(texts[i])
                    if spans:
                        spans += [(one["start"], 4, one["end"]) for one in found or []]
                        texts[i] = replaced(texts[i], spans, MARKS)
                columns[text] = pa.array(texts, columns[text].type)
                if chars is not None and pa.types.is_integer(columns[chars].type):
                    columns[chars] = pa.array([None if t is None else len(t) for t in texts], columns[chars].type)
                yield pa.RecordBatch.from_arrays(columns, names=list(place))

    return both.mapInArrow(freed(run), documents.schema)
