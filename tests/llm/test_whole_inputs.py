"""Operators look at all of their input: words around entities, windows learned, chunks of texts."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest

from tallyhouse.llm import pii, secrets, token_files


def words_around(text, spans):
    """(term, start, end) near each span by plain search in the text on either side."""
    found = []
    for start, _, end in spans:
        left = [m.span() for m in pii._TERM.finditer(text[:start])][-pii.AROUND :]
        right = [(end + m.start(), end + m.end()) for m in pii._TERM.finditer(text[end:])][: pii.AROUND]
        for a, b in left + right:
            if not any(x < b and a < y for x, _, y in spans) and b - a >= pii.SHORTEST:
                found.append((text[a:b].lower(), a, b))
    return found


def test_words_around_an_entity_however_far():
    far = "informant " + "." * 700 + " 10.0.0.1 " + "- " * 395 + "whistleblower " + "x" * 900
    found = [(word, a, b) for _, word, a, b, _ in pii.surroundings(far, pii.base_spans(far))]
    assert [word for word, _, _ in found] == ["informant", "whistleblower", "x" * 900]
    assert found == words_around(far, pii.base_spans(far))
    draws = random.Random(7)
    parts = ["anna", "berta", "of", "Ünal", "a@b.cd", "10.0.0.1", "naïvea@b.cd", "1.2.3.4seven", "+49 30 1234567", " ", ", ", "." * 450]
    for _ in range(300):
        text = " ".join(draws.choices(parts, k=draws.randrange(1, 30)))
        spans = pii.base_spans(text)
        assert [(word, a, b) for _, word, a, b, _ in pii.surroundings(text, spans)] == words_around(text, spans)


def test_secret_network_counts_all_windows(spark, monkeypatch):
    """Threshold, recall and false alarms are those of all windows, however small the sample to start from."""
    draws = np.random.default_rng(12)
    hexes = ["".join(draws.choice(list("0123456789abcdef"), draws.integers(16, 40))) for _ in range(300)]
    rows = [(i, f"set token = {h} and go on") for i, h in enumerate(hexes)]
    rows += [(1000 + i, "the " + "".join(draws.choice(["ing", "her", "4ab", "ent"], 5)) + " of it") for i in range(900)]
    monkeypatch.setattr(secrets, "_SHARD", 200)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    network = secrets.learn(secrets.find_base(table.repartition(5)), findings=30, others=30)
    again = secrets.learn(secrets.find_base(table.coalesce(1)), findings=30, others=30)
    windows = [tuple(row) for row in secrets.distinct_windows(secrets.find_base(table)).collect()]
    assert len(windows) == len(set(windows)) > 800

    def part(number):
        chosen = [row for row in windows if row[1] % 4 == number]
        return secrets.encode([row[2] for row in chosen]), np.array([row[0] for row in chosen])

    codes, labels = secrets.forms(*part(0))
    sure = network.probability(codes)[labels == 1]
    assert (sure >= network.threshold).mean() >= 0.95 > (sure >= network.threshold + 0.01).mean() - 0.04
    codes, labels = part(1)
    fired = network.probability(secrets.masked(codes)) >= network.threshold
    assert network.recall == fired[labels == 1].mean() and network.alarms == fired[labels == 0].mean()
    assert network.parameters().tolist() == again.parameters().tolist() and network.threshold == again.threshold


def test_only_new_chunks_are_cut_and_encoded(monkeypatch):
    """Chunks met before are looked up as they stand; words go through the model without being split again."""
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    texts = ["Ünal saß, und las.\nDas Öl", " a b\tc  d", "one\0two three", "", "\n", "x \n y", "end ", "日本 wörter ­ x"] * 2
    whole = [encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2] for text in texts]
    assert [np.frombuffer(row, encoder.kind).tolist() for row in encoder.rows(texts)] == whole
    monkeypatch.setattr(token_files, "_PIECE", SimpleNamespace(findall=lambda chunk: pytest.fail(f"cut again: {chunk}")))
    again = [text for text in texts if len(text) > 9]
    assert [np.frombuffer(row, encoder.kind).tolist() for row in encoder.rows(again)] == [w for w, t in zip(whole, texts) if len(t) > 9]
