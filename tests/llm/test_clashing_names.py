"""Operators that keep the columns of their input, on columns named like their own inner ones."""

from __future__ import annotations

import pytest
from textdata import docs  # noqa: F401
from pyspark.sql import functions as F

from meterline.llm.common import apart, named_back
from meterline.llm.cotrain import quality_scores
from meterline.llm.line_dedup import dedup_lines
from meterline.llm.quality_rules import OWN_NAMES, quality_rules
from meterline.llm.simhash import one_of_each

INNER = [*OWN_NAMES, "_id", "_text_hash", "_drop", "_first", "_DROP_", "_n", "_copy", "_size", "_by", "_by_hash"]
INNER += ["id", "text_hash", "key", "h", "n", "size", "line", "first", "fp", "root", "none", "group", "host", "rows", "one", "other_0_0"]
INNER += ["a.b", "with `tick`", "two words", "_ID2", "page"]
ROWS = [(i, f"one two three {i // 2}\nshared line of all\nlast {i} of so many words here to count", f"h{i % 3}") for i in range(12)]
OPERATORS = {
    "lines": lambda frame: dedup_lines(frame),
    "lines, first kept": lambda frame: dedup_lines(frame, keep_first=True),
    "lines, copies kept": lambda frame: dedup_lines(frame, keep_copy=True),
    "near duplicates": lambda frame: one_of_each(frame),
    "rules": lambda frame: quality_rules(frame),
    "classifier": lambda frame: quality_scores(frame, frame.selectExpr("doc_id", "doc_id % 2 AS quality")),
}


def quoted(name):
    return "`" + name.replace("`", "``") + "`"


@pytest.mark.parametrize("name", OPERATORS)
def test_all_inner_names_at_once(docs, name):
    frame = docs(*ROWS, ROWS[0], (None, None, None))
    plain = OPERATORS[name](frame)
    extra = frame.select("*", *(F.lit(i).alias(x) for i, x in enumerate(INNER)))
    found = OPERATORS[name](extra)
    made = [x for x in plain.columns if x not in frame.columns]
    assert found.columns == [*frame.columns, *INNER, *made]
    first = found.first()
    assert [first[x] for x in INNER] == list(range(len(INNER)))
    same = found.select(*plain.columns).collect()
    assert sorted(map(str, same)) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("name", ["lines", "near duplicates", "rules"])
def test_results_columns_are_replaced(docs, name):
    made = {"lines": ["N_lines", "n_dropped"], "rules": ["n_words", "KEPT", "base_failed"], "near duplicates": []}[name]
    frame = docs(*ROWS)
    found = OPERATORS[name](frame.withColumns({x: F.lit("old") for x in made}))
    assert found.columns == OPERATORS[name](frame).columns
    assert sorted(map(str, found.collect())) == sorted(map(str, OPERATORS[name](frame).collect()))


def test_id_and_text_may_have_inner_names(docs):
    frame = docs(*ROWS, ROWS[0]).withColumnsRenamed({"doc_id": "_id", "text": "_drop", "source": "_host"})
    assert sorted(dedup_lines(frame, "_id", "_drop").columns[:2]) == ["_drop", "_id"]
    assert one_of_each(frame, "_id", "_drop").filter("_id IS NOT NULL").count() == len(one_of_each(docs(*ROWS, ROWS[0])).collect())
    assert quality_rules(frame, "_drop", "_host", id_col="_id").columns[:2] == ["_id", "_drop"]


def test_apart_and_back(spark):
    frame = spark.createDataFrame([(1, 2, 3)], ["A", "b.c", "other_0_0"])
    moved, others = apart(frame, ["a"])
    assert set(others) == {"A", "b.c"} and len(set(moved.columns)) == 3 and "a" not in map(str.lower, moved.columns)
    assert named_back(moved, others).columns == frame.columns
    assert apart(frame.select("other_0_0"), ["a"])[1] == {}
