from __future__ import annotations

import random

import numpy as np
import pytest
from textdata import docs, prose  # noqa: F401
from pyspark.sql import functions as F

from meterline.llm import cotrain
from meterline.llm.cotrain import co_train, meta_view, quality_scores, sigmoid, surest, text_view

LABELS = "doc_id long, quality int, toxic int"


def bad(rng):
    kind = rng.randrange(3)
    text = prose(rng, rng.randrange(20, 200))
    if kind == 0:
        return text.upper().replace(" ", "!! ")
    if kind == 1:
        return " | ".join(text.split())
    return f"{text.split()[0]} " * 80


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(15)
    return [(i, bad(rng) if i % 4 == 0 else prose(rng, rng.randrange(20, 200)), f"h{i % 9}") for i in range(1200)]


def test_held_out_accuracy(spark, docs, rows):
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 600)], LABELS)
    found = quality_scores(docs(*rows), labels).collect()
    held = [row for row in found if row["doc_id"] >= 600]
    right = sum(row["kept"] == (row["doc_id"] % 4 > 0) for row in held)
    lost = sum(not row["kept"] for row in held if row["doc_id"] % 4)
    assert len(found) == 1200 and right / len(held) >= 0.96 and lost <= 3


def test_each_view_alone_on_held_out_rows():
    """The text view reads texts only, the other one all but the text; each finds what its own side shows."""
    rng = random.Random(17)
    rows = []
    for i in range(1600):
        good = i % 3 > 0
        source = f"https://{'abc'[i % 3 if rng.random() < 0.9 else rng.randrange(3)]}.org/p{rng.randrange(3)}/x"
        rows.append(((prose(rng, rng.randrange(30, 90)) if good else bad(rng)).encode(), source, "en", float(good)))
    y = np.array([row[3] for row in rows])
    views = [np.array([text_view(row[0]) for row in rows]), np.array([meta_view(300, row[1], row[2]) for row in rows])]
    none = [np.zeros((0, x.shape[1] + 1), np.float32) for x in views]
    model = co_train([x[:800] for x in views], y[:800], none)
    right = [((sigmoid(v.calibrated(x[800:])) > 0.5) == (y[800:] > 0.5)).mean() for v, x in zip(model.views, views)]
    both = ((model.score([x[800:] for x in views]) > 0.5) == (y[800:] > 0.5)).mean()
    assert right[0] >= 0.96 and right[1] >= 0.85 and both >= 0.96


def test_the_metadata_view_tells_host_path_language_and_length():
    base = meta_view(10, "https://a.org/x/y", "en")
    assert (base == meta_view(10, "http://a.org/x/y", "en")).all()
    for other in ((10, "https://b.org/x/y", "en"), (10, "https://a.org/z", "en"), (10, "https://a.org/x/y", "fr"), (99, "https://a.org/x/y", "en")):
        assert (base != meta_view(*other)).any()
    assert meta_view(0, None, None).shape == meta_view(0, "", "").shape == base.shape
    assert (meta_view(0, None, None) != meta_view(0, "", "")).any()


def test_the_views_of_the_sample_are_bounded(spark, docs, rows, monkeypatch):
    seen = {}
    real = cotrain.co_train
    monkeypatch.setattr(cotrain, "co_train", lambda x, y, pool: seen.update(n=len(y), pool=len(pool[0])) or real(x, y, pool))
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(600)], LABELS)
    repeated = docs(*rows, *[rows[0]] * 50)
    assert quality_scores(repeated, labels, labelled=200, pool=100).count() == 1250
    assert seen["n"] + seen["pool"] <= 300


@pytest.mark.parametrize("times, hot", [(3, 0), (1, 900)])
def test_repeated_rows_push_no_labels_out(spark, docs, rows, monkeypatch, times, hot):
    seen = {}
    real = cotrain.co_train
    monkeypatch.setattr(cotrain, "co_train", lambda x, y, pool: seen.update(y=y) or real(x, y, pool))
    few = rows[:400]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], LABELS)
    repeated = docs(*few * times, *[few[399]] * hot)
    found = quality_scores(repeated, labels, labelled=200, pool=200).collect()
    assert len(seen["y"]) == 200 and seen["y"].mean() == 0.75
    clean = [row["kept"] for row in found if row["doc_id"] % 4]
    assert len(found) == 400 * times + hot and sum(clean) / len(clean) > 0.95


def test_all_unlabelled_documents_take_part(spark, docs, rows, monkeypatch):
    seen = []
    real = cotrain.hand_over
    monkeypatch.setattr(cotrain, "SURE", 0.5)
    monkeypatch.setattr(
        cotrain, "hand_over", lambda model, every, marks, given, count: seen.append((model, every)) or real(model, every, marks, given, count)
    )
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(300)], LABELS)
    frame = docs(*rows, *[(5000 + i, rows[500][1], rows[500][2]) for i in range(50)])
    assert quality_scores(frame, labels, pool=60).count() == 1250 and len(seen) == cotrain.ROUNDS
    model, every = seen[0]
    given = [set(), set()]
    marks = labels.select(F.col("doc_id").alias("id"), "quality")
    handed = real(model, every, marks, given, 10)
    everything = {r["h"]: r for r in every.filter("id >= 300").collect()}
    logits = {
        h: view.calibrated(text_view(r["text"].encode())[None]).item() for view in model.views[:1] for h, r in everything.items()
    }
    # The surest of all 900 texts of the corpus, each once, whatever the number of its copies.
    for kind in (1, -1):
        theirs = sorted((abs(x) for h, x in logits.items() if h in given[1] and x * kind > 0), reverse=True)
        best = sorted((abs(x) for x in logits.values() if x * kind > 0), reverse=True)
        assert theirs and np.allclose(theirs, best[: len(theirs)])
    assert [len(x) for x in handed] == [len(x) for x in given] and all(9 <= len(x) <= 11 for x in given)
    again = real(model, every, marks, [set(x) for x in given], 10)
    assert not {x.tobytes() for x in handed[0]} & {x.tobytes() for x in again[0]}


def test_labels_and_columns_by_definition(spark, docs, rows):
    labels = [(i, int(i % 4 > 0), 0) for i in range(600)] + [(None, 0, 0), (1, None, None), (9999, 0, 0), (5, 1, 0), (5, 0, 0)]
    extra = docs(*rows[:700], (None, None), (None, ""), (5000, "x" * 300_000)).withColumns({"score": F.lit("s"), "quality": F.lit(3)})
    found = quality_scores(extra, spark.createDataFrame(labels, LABELS))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "quality", "score", "kept"]
    assert found.filter("score BETWEEN 0 AND 1").count() == 703
    nowhere = extra.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    assert quality_scores(nowhere, spark.createDataFrame(labels, LABELS)).count() == 703


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, 0)]])
def test_nothing_to_learn_from(spark, docs, labels):
    found = quality_scores(docs((1, "a"), (2, "b"), (3, None)), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == 3 and all(row["kept"] and row["score"] == 1 for row in found)
    assert quality_scores(docs(), spark.createDataFrame(labels, LABELS)).collect() == []


def test_surest_hands_over_what_a_view_is_sure_of():
    logits = np.array([5.0, 6.0, 0.1, -7.0, -0.2, 4.9])
    places, marks = surest(logits, np.array([True, True, True, True, True, False]), 6)
    assert dict(zip(places.tolist(), marks.tolist())) == {0: 1, 1: 1, 3: 0}


def test_pieces_of_a_long_text_make_one_view(monkeypatch):
    data = prose(random.Random(16), 500).encode()
    whole = text_view(data)
    monkeypatch.setattr(cotrain, "PIECE", 64)
    assert np.allclose(text_view(data), whole)
    assert text_view(b"").shape == text_view(b"ab").shape == whole.shape
