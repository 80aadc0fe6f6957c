from __future__ import annotations

import random
import re
from collections import defaultdict

from textdata import docs, prose  # noqa: F401
from pyspark.sql import functions as F

from meterline.llm import line_dedup
from meterline.llm.line_dedup import dedup_lines


def key(line):
    bare = re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), bare)


def expected(texts, min_docs):
    seen = defaultdict(set)
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            seen[key(line)].add(i)
    gone = {k for k, where in seen.items() if k and len(where) >= min_docs}
    found = []
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        kept = [line for line in lines if key(line) not in gone]
        found.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return found


def cleaned(frame, **settings):
    rows = dedup_lines(frame, **settings).select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted(map(tuple, rows))


def test_equals_brute_force(docs):
    rng = random.Random(5)
    texts = []
    for i in range(120):
        lines = [prose(rng, rng.randrange(1, 12)) for _ in range(rng.randrange(6))]
        lines += [" \tSHARED line\x0b"] * rng.randrange(3) + [f"group {i % 11}"] + rng.choices(["", " ", "Été", "ÉTÉ"], k=2)
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    texts += [None, "", "\n", "shared LINE", "x" * 200_000 + "\nshared line\n" + "y" * 200_000]
    assert cleaned(docs(*enumerate(texts))) == expected(texts, 10)
    assert cleaned(docs(*enumerate(texts)), min_docs=3) == expected(texts, 3)


def test_filters_too_small_let_more_through_and_change_nothing(docs, monkeypatch):
    rng = random.Random(6)
    texts = ["\n".join([prose(rng, 3), f"line {i % 9}"]) for i in range(90)]
    monkeypatch.setattr(line_dedup, "TWICE_BITS", 8)
    monkeypatch.setattr(line_dedup, "SEGMENT_HASHES", 30)
    assert cleaned(docs(*enumerate(texts))) == expected(texts, 10)


def test_keep_first_keeps_one_line(docs):
    rows = dedup_lines(docs(*((i, f"same\nown {i}\nSame") for i in range(12))), keep_first=True).collect()
    assert sorted(row["text"] for row in rows)[0].startswith("own")
    first = next(row for row in rows if row["doc_id"] == 0)
    assert first["text"] == "same\nown 0" and first["n_dropped"] == 1
    assert sum("same" in row["text"].lower() for row in rows) == 1


def test_repeated_rows_null_ids_and_other_columns(docs):
    frame = docs(*[(1, "dup\nown")] * 6, *[(None, "DUP\nother")] * 4).withColumns({"n_lines": F.lit("x"), "h": F.lit(1), "key": F.lit("k")})
    rows = dedup_lines(frame).collect()
    assert sorted(row["text"] for row in rows) == ["other"] * 4 + ["own"] * 6
    assert {row["n_lines"] for row in rows} == {2} and {row["key"] for row in rows} == {"k"}
    assert dedup_lines(docs()).collect() == []


def test_short_keys_stay(docs):
    frame = docs(*((i, "éé\nlong enough") for i in range(10)))
    assert {row["text"] for row in dedup_lines(frame, min_chars=3).collect()} == {"éé"}
