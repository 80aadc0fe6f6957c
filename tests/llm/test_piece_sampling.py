from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from meterline.llm import piece_sampling
from meterline.llm.piece_sampling import (
    MODEL,
    SPACE,
    Decoder,
    Lattices,
    decode_pieces,
    encode_pieces,
    groups,
    load,
    sample_pieces,
    sampled,
)

PATH = public_tokenizers.path(MODEL)
TEXTS = ["", " ", "a", "  two  spaces ", "naïve 日本 \n line\ttab", "hello world", "x​y", "ﬁ ＡＢＣ é 🙂", "thing " * 300, "a" * 3000]


@pytest.fixture(scope="module")
def lattices():
    return Lattices(PATH, 1.0)


def draw(lattices, texts, samples, seeds=None):
    """(ids, log-probability, inclusion) of each text's samples, in order."""
    found = [[] for _ in texts]
    seeds = np.arange(1, len(texts) + 1) if seeds is None else np.array(seeds)
    for some, ids, logs, inclusion in sampled(lattices, texts, seeds.astype(np.uint64), samples):
        for i, *row in zip(some.tolist(), ids.to_pylist(), logs.tolist(), inclusion.tolist()):
            found[i].append((tuple(row[0]), *row[1:]))
    return found


@lru_cache(maxsize=1)
def weights():
    model = load(PATH)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
    return {model.id_to_piece(i): (i, 1 / (1 + rank)) for rank, i in enumerate(plain, 1)}, byte, 1 / size


def every_path(text):
    """All segmentations with their probabilities, by listing them."""
    pieces, byte, byte_weight = weights()
    seen = SPACE + text.replace(" ", SPACE) if text else ""

    def onward(start):
        if start == len(seen):
            yield (), 1.0
            return
        for end in range(start + 1, len(seen) + 1):
            if seen[start:end] in pieces:
                i, weight = pieces[seen[start:end]]
                ways = [((i,), weight)]
            elif end == start + 1:
                raw = seen[start].encode()
                ways = [(tuple(byte[b] for b in raw), byte_weight ** len(raw))]
            else:
                continue
            for ids, weight in ways:
                for rest, more in onward(end):
                    yield ids + rest, weight * more

    found = dict(onward(0))
    total = sum(found.values())
    return {ids: weight / total for ids, weight in found.items()}


def test_samples_are_distinct_and_decode_to_the_text(lattices):
    model = load(PATH)
    for text, found in zip(TEXTS, draw(lattices, TEXTS, 4)):
        ways = len(every_path(text)) if len(text) < 10 else 4
        assert len({ids for ids, _, _ in found}) == len(found) == min(4, ways)
        assert all(model.decode(list(ids)) == text for ids, _, _ in found)


def test_probabilities_are_those_of_all_paths(lattices):
    for text in ["", " ", "a", "  b ", "thing on", "x​y", "é🙂 日"]:
        whole = every_path(text)
        for ids, logp, _ in draw(lattices, [text], 6)[0]:
            assert math.isclose(math.exp(logp), whole[ids], rel_tol=1e-9)


@pytest.mark.parametrize("text", ["thing on", "things", "é of"])
def test_distribution_is_that_of_drawing_without_replacement(lattices, text):
    whole, count = every_path(text), 6000
    first, second, third, inclusion = Counter(), Counter(), Counter(), Counter()
    for found in draw(lattices, [text] * count, 3):
        for seen, (ids, _, _) in zip((first, second, third), found):
            seen[ids] += 1
    for found in draw(lattices, [text] * count, 2):
        # Each path drawn, over its inclusion score, counts itself once on average.
        for ids, _, score in found:
            inclusion[ids] += 1 / score
    top = sorted(whole.items(), key=lambda x: -x[1])[:30]
    for ids, p in top[:4]:
        p2 = sum(q * p / (1 - q) for other, q in whole.items() if other != ids)
        assert abs(first[ids] / count - p) < 0.03 and abs(second[ids] / count - p2) < 0.03
        assert p < 0.02 or abs(inclusion[ids] / count - 1) < 0.1
        if len(whole) <= 200:
            p3 = sum(
                q / 1 * r / (1 - q) * p / (1 - q - r)
                for one, q in whole.items()
                for two, r in whole.items()
                if len({one, two, ids}) == 3
            )
            assert abs(third[ids] / count - p3) < 0.03


def test_all_segmentations_when_there_are_few(lattices):
    for text in ["ab", "a b", "the"]:
        whole = every_path(text)
        found = draw(lattices, [text], len(whole) + 5)[0]
        assert {ids for ids, _, _ in found} == set(whole) and len(found) == len(whole)
        assert all(score == 1 for _, _, score in found)
        most = draw(lattices, [text], len(whole) - 1)[0]
        assert len(most) == len(whole) - 1 and all(score <= 1 for _, _, score in most)


def test_samples_do_not_depend_on_the_batch(lattices):
    alone = [draw(Lattices(PATH, 1.0), [text], 3, [i])[0] for i, text in enumerate(TEXTS[:4])]
    together = draw(lattices, [*TEXTS[:4], *TEXTS[4:]], 3, range(len(TEXTS)))
    assert together[:4] == alone
    turned = draw(lattices, TEXTS[::-1], 3, range(len(TEXTS))[::-1])
    assert turned[::-1] == together


def test_lattices_are_made_anew_past_their_bound(lattices, monkeypatch):
    whole = draw(lattices, TEXTS, 2)
    monkeypatch.setattr(piece_sampling, "PLACES_KEPT", 10)
    small = Lattices(PATH, 1.0)
    assert draw(small, TEXTS, 2) == draw(small, TEXTS, 2) == whole
    assert [(first, len(run)) for first, run in groups(pa.array(["ab", "abc", "", "a" * 9, "b"]), 5)] == [(0, 3), (3, 1), (4, 1)]


@pytest.mark.parametrize("at_once", [1, 40, 500_000])
def test_decoder_equals_the_library(monkeypatch, at_once):
    monkeypatch.setattr(piece_sampling, "DECODED", at_once)
    model = load(PATH)
    rng = np.random.default_rng(5)
    decoder = Decoder(model)
    assert decoder.joins
    size = model.get_piece_size()
    lists = [rng.integers(0, limit, n).tolist() for n in (0, 1, 2, 9) for limit in (size, 300) for _ in range(100)]
    lists += [model.encode(text) for text in TEXTS]
    expected = [model.decode(ids) if ids else "" for ids in lists]
    assert decoder(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == expected
    assert decoder(pa.array([None, [264]], pa.list_(pa.int32()))).to_pylist() == ["", model.decode([264])]


def test_rows(spark):
    schema = "conv_id long, turn int, text string"
    rows = [(1, 0, "hello there world"), (1, 1, None), (None, None, "some words"), (2, 0, "again again"), (2, 0, "again again")]
    frame = spark.createDataFrame(rows, schema).withColumns({"sample": F.lit("x"), "ids": F.lit(1)})
    found = sample_pieces(frame, ["conv_id", "turn"], samples=3)
    assert found.columns == ["conv_id", "turn", "sample", "ids", "log_probability", "inclusion"]
    seen = Counter((row["conv_id"], row["turn"]) for row in found.collect())
    assert seen == {(1, 0): 3, (1, 1): 1, (None, None): 3, (2, 0): 6}
    alike = [tuple(row["ids"]) for row in found.filter("conv_id = 2 AND sample = 0").collect()]
    assert alike[0] == alike[1]
    assert sorted(map(str, found.collect())) == sorted(map(str, found.collect()))
    texts = {row["text"] for row in decode_pieces(found).collect()}
    assert texts == {"hello there world", "", "some words", "again again"}
    both = sample_pieces(frame, ["conv_id", "turn"], samples=3, decoded="decoded")
    assert sorted(map(str, both.collect())) == sorted(map(str, decode_pieces(found, to="decoded").collect()))
    assert sample_pieces(spark.createDataFrame([], schema), ["conv_id"]).collect() == []


def test_encode_and_decode(spark):
    frame = spark.createDataFrame([*enumerate(TEXTS), (99, None)], "doc_id long, text string")
    back = decode_pieces(encode_pieces(frame), to="back")
    assert back.columns == ["doc_id", "text", "ids", "back"]
    model = load(PATH)
    for row in back.collect():
        assert row["ids"] == model.encode(row["text"] or "") and row["back"] == (row["text"] or "")


def test_registered_over_all_documents(spark, tmp_path):
    from meterline.llm.queries import op6_sample_pieces

    spark.createDataFrame([(1, "a text"), (2, None), (None, "words " * 200)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert {row["doc_id"] for row in op6_sample_pieces(spark, str(tmp_path)).collect()} == {1, 2, None}


def test_further_columns_of_any_name(spark):
    names = ["_value", "_made", "value", "_ids", "seed", "_seed", "_text", "made"]
    frame = spark.createDataFrame([(1, "some text")], "doc_id long, text string").withColumns({name: F.lit("x") for name in names})
    back = decode_pieces(encode_pieces(frame), to="back")
    assert back.columns == ["doc_id", "text", *names, "ids", "back"]
    row = back.first()
    assert row["back"] == "some text" and all(row[name] == "x" for name in names)
    found = sample_pieces(frame, ["doc_id", "seed", "_text"]).collect()
    assert [(row["doc_id"], row["seed"], row["_text"], row["sample"]) for row in found] == [(1, "x", "x", 0), (1, "x", "x", 1)]
