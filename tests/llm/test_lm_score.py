from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from textdata import docs  # noqa: F401

from meterline.llm import lm_score
from meterline.llm.lm_score import (
    EDGE, MEMBERS, OFFSETS, TOKENS, Vocabulary, averaged, document_score, first_weights, log_probabilities, score_text, tokens_of,
)

GRAMMAR = {"the": ["cat", "dog"], "cat": ["sat", "ran"], "dog": ["sat", "ran"], "sat": ["on"], "ran": ["on"], "on": ["the"]}


def sentence(rng, count):
    words = ["the"]
    while len(words) < count:
        words.append(rng.choice(GRAMMAR[words[-1]]))
    return " ".join(words)


def slow_score(weights, vocabulary, text):
    """Every word by itself, from the definition."""
    tokens, total = list(tokens_of(text, vocabulary)), 0.0
    w = {name: value.astype(np.float64) for name, value in weights.items()}
    for i, token in enumerate(tokens):
        inside = w["hidden"].copy()
        for j, offset in enumerate(OFFSETS):
            at = i + offset
            inside += w["embed"][j][tokens[at] if 0 <= at < len(tokens) else EDGE]
        hidden = np.tanh(inside)
        c = token // MEMBERS
        for logits, place in (
            (hidden @ w["class_w"] + w["class_b"], c),
            (hidden @ w["member_w"][c] + w["member_b"][c], token % MEMBERS),
        ):
            total += logits[place] - np.log(np.exp(logits).sum())
    return total


def test_scores_by_definition():
    weights = {name: value * 5 for name, value in first_weights(3).items()}
    vocabulary = Vocabulary({b"the": 0, b"cat": 1, b"on": 2})
    for text in ["", "the", "the cat sat on the THE mat", "x y " * 40]:
        count, total = document_score(weights, vocabulary, text)
        assert count == len(text.split())
        assert np.isclose(total, slow_score(weights, vocabulary, text), rtol=1e-4, atol=1e-4)


def test_probabilities_of_all_tokens_sum_to_one():
    weights = {name: value * 5 for name, value in first_weights(4).items()}
    context = np.tile(np.array([[1, 2, 3, EDGE]]), (TOKENS, 1))
    assert np.isclose(np.exp(log_probabilities(weights, context, np.arange(TOKENS))).sum(), 1, atol=1e-3)


def test_training_learns_what_follows_what(docs, monkeypatch):
    monkeypatch.setattr(lm_score, "STEP", 64)
    rng = random.Random(17)
    rows = [(i, sentence(rng, 60)) for i in range(400)]
    words = " ".join(GRAMMAR).split()
    rows += [(1000 + i, " ".join(rng.choices(words, k=60))) for i in range(20)]
    found = {row["doc_id"]: row for row in score_text(docs(*rows).coalesce(2)).collect()}
    good = np.mean([found[i]["mean_log_probability"] for i in range(400)])
    shuffled = np.mean([found[1000 + i]["mean_log_probability"] for i in range(20)])
    assert good > -np.log(TOKENS) / 2 and good > shuffled + 0.3


def test_averages_by_tokens():
    rows = [(np.full(6, value, np.float32).tobytes(), n) for value, n in ((1.0, 1), (4.0, 3), (2.0, 4))]
    batch = pa.RecordBatch.from_pydict({"weights": [row[0] for row in rows], "seen": [row[1] for row in rows]})
    (merged,) = averaged(iter([batch.slice(0, 2), batch.slice(2)]))
    assert np.allclose(np.frombuffer(merged["weights"][0].as_py(), np.float32), (1 + 12 + 8) / 8)
    assert merged["seen"][0].as_py() == 8 and list(averaged(iter([]))) == []


def test_cases_by_definition(docs, monkeypatch):
    monkeypatch.setattr(lm_score, "BATCH", 50)
    frame = docs((1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "a b c"), (4, "w " * 30_000))
    rows = score_text(frame.withColumns({"id": F.lit(1), "n_words": F.lit("x")})).collect()
    found = {}
    for row in rows:
        found.setdefault(row["doc_id"], []).append((row["n_words"], row["log_probability"], row["mean_log_probability"]))
    assert found[1] == found[2] == [(0, 0.0, None)]
    assert np.allclose(found[3][0], found[3][1]) and np.allclose(found[3][0], found[None][0])
    assert found[4][0][0] == 30_000 and np.isfinite(found[4][0][1])
    assert score_text(docs()).collect() == []
