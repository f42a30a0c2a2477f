"""Language identification in two levels: families first, then pairs of close languages.

A linear support vector machine per family (one against the rest) picks the family; inside
it one machine per pair of languages (one against one) votes. Features are the hashed
character pairs and triples of the whole text, letters only, words set apart by blanks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRIPLES, PAIRS = 1 << 13, 1 << 11
SIZE = TRIPLES + PAIRS
UNKNOWN = "und"
# Families of ISO 639 codes. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "indic": "hi bn ur mr gu pa ne".split(),
    "semitic": "ar he am mt".split(),
}
_FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages}
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of root counts, or None if the text has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    # One blank between words, one at each end.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate([[np.uint32(32)], codes[keep], [np.uint32(32)]]).astype(np.uint32)
    pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]
    triples = (pairs[:-1] * np.uint32(0x85EBCA77) + codes[2:]) * np.uint32(0xC2B2AE3D)
    counts = np.empty(SIZE, np.float32)
    counts[:TRIPLES] = np.bincount(triples >> np.uint32(19), minlength=TRIPLES)
    counts[TRIPLES:] = np.bincount(pairs * np.uint32(0x27D4EB2F) >> np.uint32(21), minlength=PAIRS)
    np.sqrt(counts, out=counts)
    return counts / np.sqrt((counts * counts).sum())


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Weights (last one the bias) of a linear machine, by dual coordinate descent on hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    squares = (x * x).sum(axis=1)
    weights, alpha, draws = np.zeros(x.shape[1], np.float32), np.zeros(len(x)), np.random.default_rng(seed)
    for _ in range(rounds):
        for i in draws.permutation(len(x)):
            gradient = y[i] * float(x[i] @ weights) - 1
            moved = min(max(alpha[i] - gradient / squares[i], 0.0), cost)
            if moved != alpha[i]:
                weights += np.float32((moved - alpha[i]) * y[i]) * x[i]
                alpha[i] = moved
    return weights


@dataclass
class LanguageModel:
    """Machines of both levels; ``weights`` has one column each, the bias in the last row."""

    families: dict[str, list[str]] = field(default_factory=dict)
    names: list[tuple] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((SIZE + 1, 0), np.float32))

    @staticmethod
    def train(languages: list[str], x: np.ndarray) -> LanguageModel:
        labels = np.array(languages)
        families: dict[str, list[str]] = {}
        for language in sorted(set(languages)):
            families.setdefault(_FAMILY_OF.get(language, f"only {language}"), []).append(language)
        of = np.array([_FAMILY_OF.get(language, f"only {language}") for language in languages])
        names, columns = [], []
        if len(families) > 1:
            for family in families:
                names.append((family,))
                columns.append(train_svm(x, np.where(of == family, 1.0, -1.0)))
        for members in families.values():
            for a, b in combinations(members, 2):
                chosen = (labels == a) | (labels == b)
                names.append((a, b))
                columns.append(train_svm(x[chosen], np.where(labels[chosen] == a, 1.0, -1.0)))
        weights = np.stack(columns, axis=1) if columns else np.zeros((SIZE + 1, 0), np.float32)
        return LanguageModel(families, names, weights.astype(np.float32))

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        """(language, score) of each row of ``x``; the score is the product of both levels' certainty."""
        if not self.families:
            return [(UNKNOWN, 0.0)] * len(x)
        margins = x @ self.weights[:-1] + self.weights[-1]
        sure = 1 / (1 + np.exp(-4 * margins.astype(np.float64).clip(-50, 50)))
        at = {name: i for i, name in enumerate(self.names)}
        found = []
        for row, p in zip(margins, sure):
            family = max(self.families, key=lambda one: row[at[one,]] if (one,) in at else 0.0)
            score = p[at[family,]] if (family,) in at else 1.0
            members = self.families[family]
            votes = dict.fromkeys(members, 0.0)
            for a, b in combinations(members, 2):
                # A whole vote for the winner; margins break ties.
                votes[a if p[at[a, b]] >= 0.5 else b] += 1
                votes[a] += p[at[a, b]] / 1e3
                votes[b] += (1 - p[at[a, b]]) / 1e3
            best = max(members, key=votes.get)
            for a, b in combinations(members, 2):
                if best in (a, b):
                    score = score * (p[at[a, b]] if best == a else 1 - p[at[a, b]])
            found.append((best, float(score)))
        return found


def held_out(doc_id: str = "doc_id") -> Column:
    """True for a third of the ids; false for a null id (which is not learned from either)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(documents: DataFrame, per_language: int = 400, most: int = 4000) -> LanguageModel:
    """A model from at most ``per_language`` documents of each language and ``most`` in all.

    Taken are the documents of the smallest draws among those with an id, a text and a
    language that are not held out. The ids are chosen first, so only chosen texts are
    looked at; their features come back as sparse vectors of bounded length.
    """
    named = documents.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    draw = F.xxhash64("doc_id", F.lit(11))
    # The draws are spread evenly, so this share of them has the wanted number of each language.
    counts = {row["lang"]: row["count"] for row in named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect()}
    if not counts:
        return LanguageModel()
    wanted = max(2, min(per_language, most // len(counts)))
    rest = {lang: min(1.0, 1.5 * wanted / n + 30 / n) for lang, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for lang, share in rest.items() for x in (lang, min(int((2 * share - 1) * 2**63), 2**63 - 1))])
    likely = named.where(draw <= limits[F.col("lang")]).select("lang", "text", draw.alias("draw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, drawn in zip(*(column.to_pylist() for column in batch.columns)):
                x = features(text)
                if x is not None:
                    places = np.flatnonzero(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([drawn]), pa.array([places.tolist()], pa.list_(pa.int32())),
                         pa.array([x[places].tolist()], pa.list_(pa.float32()))],
                        names=["lang", "draw", "places", "numbers"],
                    )

    # Many rows of one id share a draw, so the number of each language is cut here, not on the driver.
    order = Window.partitionBy("lang").orderBy("draw", "places", "numbers")
    found = likely.mapInArrow(run, "lang string, draw long, places array<int>, numbers array<float>")
    chosen = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)
    languages, vectors = [], []
    for row in sorted(chosen.collect(), key=lambda row: (row["lang"], row["rank"])):  # at most ``most`` rows
        x = np.zeros(SIZE, np.float32)
        x[row["places"]] = row["numbers"]
        languages.append(row["lang"])
        vectors.append(x)
    return LanguageModel.train(languages, np.stack(vectors)) if vectors else LanguageModel()


def predicted(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; only the id and the text are read.

    A text that is null or has no letter is ``und`` with score 0, and so is any text if
    there was nothing to learn from. Repeated rows are predicted each. No shuffle.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                vectors = [features(text.as_py()) for text in piece.column(2)]
                known = [x for x in vectors if x is not None]
                found = iter(model.predict(np.stack(known)) if known else [])
                pairs = [(UNKNOWN, 0.0) if x is None else next(found) for x in vectors]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array([p[0] for p in pairs], pa.string()),
                     pa.array([p[1] for p in pairs], pa.float64())],
                    schema=schema,
                )

    inputs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return inputs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(documents: DataFrame, per_language: int = 400, most: int = 4000) -> DataFrame:
    """:func:`predicted` by a model that :func:`learn` makes of the same documents.

    Rows without an id are predicted, but not learned from.
    """
    return predicted(documents, learn(documents, per_language, most))
