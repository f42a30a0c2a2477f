"""The pipeline's stages on rows that real tables hold: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, draw string, _row int, "
    "hash string, component string, kept string, _plan int, whole double, bands string"
)
GOOD = "the quick river ran over {0} old stones and nobody in the small town of {1} ever knew where it would end"
NAMES = "amber birch cedar delta ember fjord grove haven inlet jetty knoll ledge marsh north ocean".split()


def line(i):
    return GOOD.format(NAMES[i % 15] + str(i), NAMES[(i * 7 + 3) % 15]) + f" number {i} of chapter {i * 31 % 97}"


def long_text():
    draws = np.random.default_rng(3)
    words = [a + b for a in NAMES for b in ("", "s", "ed", "ing", "er", "ly", "ful", "less", "ish", "ward")]
    return "\n".join(" ".join(draws.choice(words, 14)) for _ in range(2000))


def row(doc_id, text, source="a"):
    return doc_id, text, "en", source, None if text is None else len(text), 7, "x", 1, "h", "c", "k", 2, 0.5, "b"


ROWS = [
    *[row(i, line(i), "a" if i % 3 else None) for i in range(40)],
    row(40, line(5)), row(41, line(5)), row(41, line(5)),  # copies of a kept text, one row twice
    row(50, line(60) + " write to someone@example.org or call +34 600 123 456 now", "b"),
    row(51, None), row(52, ""), row(53, " \n\t "), row(None, None, None),
    row(54, long_text(), "b"),
    row(None, line(70)), row(None, line(70)), row(None, line(71), None),
]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage gives, read again from Parquet."""
    folder = tmp_path_factory.mktemp("odd_rows")
    docs, made = spark.createDataFrame(ROWS, COLUMNS).repartition(4), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{folder}/{name}")
        docs = made[name] = spark.read.parquet(f"{folder}/{name}")
    return made


def test_columns_stay(kept):
    names = [part.split()[0] for part in COLUMNS.split(", ")]
    assert all(made.columns == names for made in list(kept.values())[:-1])
    assert kept["tokenize"].columns == [*names, "piece_ids"]
    assert all(r["size"] == 7 and r["draw"] == "x" and r["_plan"] == 2 for r in kept["tokenize"].collect())


def test_each_stage_takes_only_its_own(kept):
    texts = {name: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in made.collect()) for name, made in kept.items()}
    ids = {name: [doc_id for null, doc_id, _ in rows if not null] for name, rows in texts.items()}
    assert sorted({*ids["quality"]}) == [*range(42), 50, 54], "texts without ten words go, all others stay"
    assert ids["near_dedup"] == [*range(40), 50, 54], "one of the copies stays, the one of the smallest id"
    assert sum(null for null, _, _ in texts["near_dedup"]) == 3, "rows without an id can't be linked and stay"
    masked = dict((doc_id, text) for null, doc_id, text in texts["personal_data"] if not null)[50]
    assert "<EMAIL>" in masked and "<PHONE>" in masked and "someone@example.org" not in masked
    assert ids["personal_data"] == ids["near_dedup"]
    clean = {doc_id: text for null, doc_id, text in texts["near_dedup"] if not null and doc_id < 40}
    assert clean.items() <= {doc_id: text for null, doc_id, text in texts["personal_data"] if not null}.items()
    taken = [doc_id for null, doc_id, _ in texts["mix"] if not null]
    assert {*taken} <= {*ids["personal_data"]} and max(map(taken.count, taken)) <= 2
    assert texts["tokenize"] == texts["mix"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0, name
