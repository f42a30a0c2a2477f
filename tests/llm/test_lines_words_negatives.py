"""Line dedup, spelling variants and hard negatives against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import math

import brute
import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import hard_negatives as hn
from tallyhouse.llm import line_dedup, spelling
from tallyhouse.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NOTICE = "  All Rights RESERVED\t"
# Nulls in every column, empty and blank texts, a repeated row, rows that share an id, clashing names.
SCHEMA = "doc_id long, text string, _id string, _text long, lines int, row string, keep double"
EXTRA = ("x", None, 3, "r", 1.5)


def digests(found):
    return sorted(
        ((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in found.collect()), key=str
    )


def expected_digests(rows, **options):
    plain = brute.shared_lines(rows, **options)
    return sorted(((i, n, d, hashlib.sha256(text.encode()).hexdigest()) for i, n, d, text in plain), key=str)


@pytest.fixture(scope="module")
def lined(spark):
    rows = [(i, f"own {i}\n{NOTICE.upper() if i % 2 else NOTICE}\nlast {i % 3}") for i in range(12)]
    rows += [(20, None), (21, ""), (None, f"lost\n{NOTICE}"), (None, "lost too\n \nx"), (22, NOTICE), (22, NOTICE), (22, "other")]
    rows += [(30, "\n".join(f"line {j // 2}" if j % 7 else NOTICE for j in range(100_000))), (31, "\n\n")]
    return rows, spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA).repartition(3)


def test_lines_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = digests(QUERIES["op12_line_dedup"](spark, SF_DIR))
    assert found == expected_digests(rows) and any(row[2] for row in found)


def test_odd_lines(spark, lined):
    rows, table = lined
    assert digests(line_dedup.line_digests(table)) == expected_digests(rows)
    kept = line_dedup.without_shared_lines(table)
    assert kept.columns == table.columns and kept.schema == table.schema
    texts = sorted(((r["doc_id"], r["text"] or "", r["_id"], r["lines"]) for r in kept.collect()), key=str)
    assert texts == sorted(((i, text, "x", 3) for i, _, _, text in brute.shared_lines(rows)), key=str)
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.line_digests(none).count() == line_dedup.without_shared_lines(none).count() == 0


def test_first_occurrence_stays(spark):
    rows = [(i, f"a {i}\nshared\nshared") for i in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = line_dedup.without_shared_lines(table, min_docs=3, keep_first=True)
    assert sorted(tuple(r) for r in kept.collect()) == [(0, "a 0\nshared")] + [(i, f"a {i}") for i in range(1, 5)]
    assert sorted(tuple(r) for r in kept.collect()) == [(i, t) for i, _, _, t in brute.shared_lines(rows, 3, True)]


def test_bitmaps_hold_only_words_that_lose_a_line(spark):
    text = "\n".join("shared" if j == 500 else f"own {j}" for j in range(1000))
    table = spark.createDataFrame([(i, text.replace("own", f"own {i}")) for i in range(10)], "doc_id long, text string")
    for row in line_dedup.keep_bitmaps(table).collect():
        assert list(row["keep"]) == [500 // 64] and bin(row["keep"][7] & (2**64 - 1)).count("0") == 2


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 4), st.text("aA \t\n\x0bé", max_size=12)), max_size=15))
def test_lines_of_any_text(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    options = {"min_docs": 2}
    slim = line_dedup.without_shared_lines(table, **options).collect()
    assert sorted(map(tuple, slim)) == sorted((i, text) for i, _, _, text in brute.shared_lines(rows, **options))


WORDS = ("doc_id", "text")
COLUMNS = ("form", "root", "n", "n_near", "form_n")


def by_word(found):
    return {r["word"]: tuple(r[c] for c in COLUMNS) for r in found.collect()}


def test_words_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*WORDS).collect()]
    found = by_word(QUERIES["op13_spelling_variants"](spark, SF_DIR))
    assert found == brute.spelling_variants(rows) and any(row[0] for row in found.values())


def test_odd_words(spark):
    rows = [
        (1, "wonder " * 40 + "wonde " * 20 + "wonden " * 9 + "wondens " * 4), (2, "Wonder ÉTUDE étude Étude étudé étudé étudé"),
        (2, "aabbb aabbb aabbb abbb aabb aabbbb aabbbb aabbbb"), (None, "wonder wonder wonders"), (3, None), (4, ""),
        (5, "tie-a tieaa tieaa tieaa tieab tieab tieab tieac tieac tieac " * 3), (5, "tieaa"), (5, "tieaa"),
        (6, "x" * 50_000 + " " + "longword " * 30_000), (7, "cafés×÷ÿ " * 3), (8, "wonder" * 2 + " "), (9, "1 2 3"),
    ]
    table = spark.createDataFrame([(*row, 1, "c") for row in rows], "doc_id long, text string, word int, n string").repartition(3)
    found = by_word(spelling.spelling_variants(table))
    assert found == brute.spelling_variants(rows)
    assert found["wondens"][:2] == ("wonden", "wonder") and found["wonden"][1] == "wonder"
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(none).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(none, ratio=1)


def test_half_neighbourhoods_meet_once():
    draws = np.random.default_rng(3)
    words = {"".join(draws.choice(list("0123"), draws.integers(1, 6))) for _ in range(300)}

    def one_edit(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    for a in words:
        for b in words:
            if a < b:
                meets = (b in spelling.neighbours(a, "0123")) + (a in spelling.neighbours(b, "0123"))
                assert meets == one_edit(a, b)


def scaled(rows):
    return [(i, label, [math.floor(256 * x) for x in vector]) for i, label, vector in rows]


def result(found):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in names) for r in found.collect())


VECTORS = "vec_id long, label int, embedding array<float>"


@pytest.fixture(scope="module")
def clustered():
    draws = np.random.default_rng(5)
    centres = draws.normal(size=(6, 12))
    kinds = draws.integers(0, 6, 900)
    vectors = (centres[kinds] + 0.4 * draws.normal(size=(900, 12))).astype(np.float32)
    return [(i, int(kind), [float(x) for x in vector]) for i, (kind, vector) in enumerate(zip(kinds, vectors))]


def test_negatives_in_many_cells(spark, clustered):
    table = spark.createDataFrame(clustered, VECTORS).repartition(4)
    expected = brute.hard_negatives(scaled(clustered), every=10)
    assert expected and result(hn.hard_negatives(table, every=10)) == expected
    assert result(hn.hard_negatives(table, every=10, tile_anchors=20, shard_rows=100)) == expected


def test_negatives_of_odd_rows(spark, clustered):
    rows = [*clustered[:200], (200, None, [1.0] * 12), (201, 1, None), (None, 1, [1.0] * 12), (202, 1, [math.nan] * 12),
            (203, 1, [math.inf] * 12), (204, 2, [None] * 12), (205, 1, [0.5, 0.25]), (206, 3, []), (300, 77, [1.0] * 12)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(8)]  # ties
    good = scaled(r for r in rows if None not in r and r[0] not in (202, 203, 204))
    extra = spark.createDataFrame([(*row, 1, 2, "s") for row in rows], VECTORS + ", tile int, shard int, score string")
    found = result(hn.hard_negatives(extra.repartition(3)))
    assert found == brute.hard_negatives(good) and found
    twice = extra.union(extra.where("vec_id = 0"))
    assert {row[:2] for row in result(hn.hard_negatives(twice))} == {row[:2] for row in found}
    assert hn.hard_negatives(extra.limit(0)).count() == 0


def test_negatives_of_large_components(spark):
    draws = np.random.default_rng(7)
    rows = [(i, i % 3, [float(x) for x in draws.integers(-(2**17), 2**17, 8) * 16.0]) for i in range(60)]
    table = spark.createDataFrame(rows, VECTORS)
    assert result(hn.hard_negatives(table, every=6)) == brute.hard_negatives(scaled(rows), every=6)


def test_bounds_hold_and_spare_products(clustered):
    ids, labels = np.array([r[0] for r in clustered]), np.array([r[1] for r in clustered])
    matrix = np.floor(256 * np.array([r[2] for r in clustered]))
    order, parent, edge = hn.spanning_tree(matrix[::10], labels[::10])
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order))
    anchors, owners = matrix[::10][order], ids[::10][order]
    above = np.where(parent[order] < 0, -1, place[parent[order]])
    assert (above < np.arange(len(order))).all()
    shard, seen = hn.Shard(ids, labels, matrix), 0
    for node, bounds in hn.walk(shard, anchors, above, edge[order]):
        truth = matrix @ anchors[node]
        assert (bounds.low <= truth).all() and (truth <= bounds.high).all()
        found, scores = hn.nearest_of_label(shard, owners[node], bounds, 5)
        assert list(scores) == sorted(truth[ids != owners[node]])[: -6 : -1] and owners[node] not in found
        seen += 1
    assert seen == len(order) and shard.scored < 0.9 * len(ids) * len(order)


def test_queries_are_whole(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert QUERIES["op12_line_dedup"](spark, SF_DIR).count() == documents.count()
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r[0], (r[1] + 1) % 10 if r[0] % 7 == 0 else r[1], r[2])
            for r in vectors.select("vec_id", "label", "embedding").collect()]
    assert result(QUERIES["op11_hard_negatives"](spark, SF_DIR)) == brute.hard_negatives(scaled(rows))
    assert vectors.where(F.col("vec_id") % 100 == 0).count() > 0
