"""Winnowing next to a plain version of it, and its guarantee."""

from __future__ import annotations

import base64
import hashlib
import random
from functools import cache

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.llm import winnowing
from meterline.llm.queries import op11_winnow
from meterline.llm.winnowing import BASE, GRAM, WINDOW, choices, code_points, fingerprint_pairs, winnow, written
from textdata import SCHEMA, prose

MASK = (1 << 64) - 1


def mix(value: int) -> int:
    value = ((value ^ (value >> 32)) * 0xD6E8FEB86659FD93) & MASK
    return (value ^ (value >> 32)) & 0xFFFFFFFF


def gram_hash(gram: str) -> int:
    value = 0
    for char in gram:
        value = (value * BASE + ord(char) + 1) & MASK
    return mix(value)


@cache
def plain_choices(text: str) -> list[tuple[int, int]]:
    if len(text) < GRAM:
        return [(0, gram_hash(text))] if text else []
    known = cache(gram_hash)
    ranked = [(known(text[i : i + GRAM]), -i) for i in range(len(text) - GRAM + 1)]
    chosen = {min(ranked[start : start + WINDOW]) for start in range(max(1, len(ranked) - WINDOW + 1))}
    return sorted((-place, value) for value, place in chosen)


def plain_text(text: str) -> str:
    out, before = b"", 0
    for place, value in plain_choices(text):
        out += bytes([place - before]) + value.to_bytes(4, "big")
        before = place
    return base64.b64encode(out).decode()


def plain_likeness(one: str, other: str) -> float:
    a, b = ({value for _, value in plain_choices(text)} for text in (one, other))
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_pairs(rows) -> list[tuple]:
    def key(row):
        h = xxhash.xxh64_intdigest((row[1] or "").encode(), seed=42)
        return (row[0] is not None, row[0] or 0, h - (1 << 64) if h >> 63 else h)

    rows = sorted(rows, key=key)
    out = []
    for (doc_id, text), (_, following) in zip(rows, [*rows[1:], *rows[:1]]):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        out.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                plain_text(text),
                plain_text(edited),
                plain_likeness(text, edited),
                plain_likeness(text, following),
            )
        )
    return out


def compare(ours, theirs):
    key = lambda row: tuple(str(value) for value in row)
    ours, theirs = sorted(map(tuple, ours), key=key), sorted(theirs, key=key)
    assert len(ours) == len(theirs)
    for one, other in zip(ours, theirs):
        assert one == pytest.approx(other) if one[0] is not None else one[1:] == pytest.approx(other[1:])


SOME = st.text(alphabet="ab é語", max_size=120)


@settings(max_examples=200, deadline=None)
@given(SOME)
def test_choices_equal_the_plain_version(text):
    found = written(*winnow(code_points(text)))
    assert choices(found) == plain_choices(text)
    assert found == plain_text(text)


@settings(max_examples=100, deadline=None)
@given(SOME, SOME, st.text(alphabet="abc d", min_size=GRAM + WINDOW - 1, max_size=60), SOME)
def test_shared_passages_are_found(before, other, passage, after):
    """Each shared passage long enough has a common hash, at the same place within it."""
    found = [dict() for _ in range(2)]
    for side, start in zip(found, (before, other)):
        for place, value in choices(written(*winnow(code_points(start + passage + after)))):
            if len(start) <= place <= len(start) + len(passage) - GRAM:
                side[place - len(start)] = value
    common = found[0].keys() & found[1].keys()
    assert common and all(found[0][place] == found[1][place] for place in common)


def test_long_texts_are_stitched(monkeypatch):
    monkeypatch.setattr(winnowing, "STRETCH", 64)
    rng = random.Random(3)
    for length in (63, 64, 65, 89, 90, 91, 128, 500, 777):
        text = "".join(rng.choice("ab") for _ in range(length))
        assert choices(written(*winnow(code_points(text)))) == plain_choices(text)


ROWS = [(9, "tail"), (2, None), (None, "no id"), (None, None), (4, ""), (5, "Straße 語" * 9), (5, "same id"), (5, "same id")]


@pytest.mark.parametrize("range_rows", [1, 7, 4096])
def test_pairs_equal_the_plain_version(spark, monkeypatch, tmp_path, range_rows):
    """However many ranges the rows are cut into, each one meets its next one."""
    monkeypatch.setattr(winnowing, "RANGE_ROWS", range_rows)
    rng = random.Random(7)
    rows = ROWS + [(100 + 3 * i, prose(rng, rng.randrange(0, 60))) for i in range(80)] + [(-4, "x" * 100_000)]
    rows += [(50, "hot " * 20)] * 60
    rng.shuffle(rows)
    table = [(doc_id, text, "en", "s", 0) for doc_id, text in rows]
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_winnow(spark, str(tmp_path))
    names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"
    assert found.columns == names.split()
    compare(found.collect(), plain_pairs(rows))


@pytest.mark.parametrize("rows", [[], [(3, "alone in the table")], [(None, None)]])
def test_small_tables(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    compare(fingerprint_pairs(frame).collect(), plain_pairs(rows))


def test_clashing_names(spark):
    names = ["span", "guest", "key", "hash", "number", "present", "place", "id", "n_chars", "fingerprint"]
    rows = [(i, f"text number {i} of some length", *([i] * len(names))) for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{name} long" for name in names))
    compare(fingerprint_pairs(frame).collect(), plain_pairs([row[:2] for row in rows]))


def test_registered_query_equals_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(row) for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    compare(op11_winnow(spark, sf).collect(), plain_pairs(rows))
