from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from textdata import docs  # noqa: F401
from pyspark.sql import functions as F

from meterline.llm.exact_dedup import exact_duplicates, grow_directory


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    found = []
    for doc_id, text in rows:
        ids = groups[lowered(text)]
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(lowered(text).encode()).hexdigest()
        found.append((doc_id, keep, len(ids), doc_id == keep, sha))
    return sorted(found, key=str)


def check(docs, rows, **settings):
    found = exact_duplicates(docs(*rows), **settings)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(row) for row in found.collect()), key=str) == expected(rows)


def test_equals_brute_force_with_many_splits(docs):
    rng = random.Random(1)
    texts = [f"Text {rng.randrange(150)}" for _ in range(300)] + ["HOT copy", "hot COPY"] * 60
    check(docs, list(enumerate(texts)), capacity=4)


def test_cases_by_definition(docs):
    rows = [
        (1, None), (2, ""), (3, "É"), (4, "é"), (5, "Ab"), (5, "Ab"), (None, "ab"), (None, "lone"), (6, "x" * 300_000),
        (7, "X" * 300_000), (8, " ab"), (9, "İ"), (10, "i̇"),
    ]
    check(docs, rows)


def test_empty_table_and_other_columns(docs, spark):
    check(docs, [])
    frame = docs((1, "a"), (2, "A")).withColumns({"id": F.lit(7), "h": F.lit("x"), "keep_id": F.lit(0), "n": F.lit(1)})
    assert {(row["doc_id"], row["keep_id"]) for row in exact_duplicates(frame).collect()} == {(1, 2), (2, 2)}


def test_directory_covers_all_hashes_once_and_no_bucket_is_overfull(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    slots, depth = grow_directory(keys, 40)
    assert [row["slot"] for row in slots.orderBy("slot").collect()] == list(range(2**depth))
    top = F.shiftrightunsigned("h", 64 - depth).alias("slot")
    sizes = keys.select(top).join(slots, "slot").groupBy("bucket").count()
    assert sizes.agg(F.max("count")).first()[0] <= 40


def test_no_python_on_the_main_path(docs):
    plan = exact_duplicates(docs((1, "a"), (2, "b")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
