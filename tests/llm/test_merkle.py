"""The Merkle manifest next to trees built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from meterline.llm.merkle import COLUMNS, folded, leaf, merkle_manifest
from meterline.llm.queries import op13_merkle_manifest
from textdata import SCHEMA, prose


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    texts = [None if value is None else str(value) for value in row]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and the siblings left and right of each leaf's path."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, below = [], []
        for start in range(0, len(nodes), 16):
            run = nodes[start : start + 16]
            for slot in range(len(run)):
                for i in owners[start + slot]:
                    paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            above.append(sha("".join(run)))
            below.append([i for slot in range(len(run)) for i in owners[start + slot]])
        nodes, owners = above, below
    return nodes[0], paths


def expected(rows) -> list[tuple]:
    """(doc_id, source, lang, n_chars, text) rows to the query's rows."""
    first = lambda value: (value is not None, value if value is not None else 0)
    rows = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), first(r[0]), leaf_of(r)))
    groups = [list(group) for _, group in groupby(rows, key=lambda r: r[1])]
    trees = [tree([leaf_of(row) for row in group]) for group in groups]
    root, upper = tree([subroot for subroot, _ in trees])
    out = []
    for group, (subroot, paths), rest in zip(groups, trees, upper):
        for row, path in zip(group, paths):
            altered = leaf_of(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                altered = leaf_of((*row[:4], lowered))
            for left, right in path + rest:
                altered = sha(left + altered + right)
            proof = sha("".join(left + right for left, right in path + rest))
            out.append((row[0], leaf_of(row), subroot, root, proof, altered, altered == root))
    return out


def found(spark, tmp_path, rows):
    table = [(row[0], row[4], row[2], row[1], row[3]) for row in rows]
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(row) for row in op13_merkle_manifest(spark, str(tmp_path)).collect()]


def compare(ours, theirs):
    key = lambda row: tuple(str(value) for value in row)
    assert sorted(ours, key=key) == sorted(theirs, key=key)


def test_nulls_ties_and_uneven_runs(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for source, count in (("hot", 300), ("b", 17), (None, 16), ("", 1), ("a", 2), ("é", 33), ("B", 1)):
        rows += [
            (i * 3 + count, source, rng.choice(["en", None]), rng.choice([None, i]), prose(rng, i % 4).title())
            for i in range(count)
        ]
    rows += [(None, "b", None, None, None), (None, "b", "en", 1, ""), (7, "hot", "de", 2, "Straße"), (7, "hot", "de", 2, "Straße")]
    rows += [(7, "hot", "de", 3, "X" * 200_000)]
    ours = found(spark, tmp_path, rows)
    compare(ours, expected(rows))
    assert {row[-1] for row in ours} == {True, False}


def test_many_sources(spark, tmp_path):
    rows = [(i, f"host{i % 290}", "en", i, f"Text {i}") for i in range(700)]
    compare(found(spark, tmp_path, rows), expected(rows))


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 1, "A")]])
def test_small_tables(spark, tmp_path, rows):
    compare(found(spark, tmp_path, rows), expected(rows) if rows else [])


def test_other_columns_and_carried_names(spark):
    """Inner names may be those of the table, and any column may be the tree's."""
    rows = [(i, f"t{i % 3}", float(i), "x") for i in range(40)]
    frame = spark.createDataFrame(rows, "pos long, tree string, node double, steps string")
    made = merkle_manifest(frame, ("tree", "node"), "pos", "tree", {"up": F.col("steps"), "n": F.col("pos") + 1})
    assert made.columns == ["pos", "leaf", "subroot", "root", "steps", "up", "n"]
    checked = made.select("n", (folded(F.col("leaf"), F.col("steps")) == F.col("root")).alias("ok"), "up").collect()
    assert sorted(row["n"] for row in checked) == list(range(1, 41))
    assert all(row["ok"] and row["up"] == "x" for row in checked)


def test_values_and_nulls_make_different_leaves(spark):
    rows = [("1", "1"), ("11", ""), ("", "11"), (None, "11"), ("-", "11"), ("2:11", None)]
    leaves = spark.createDataFrame(rows, "a string, b string").select(leaf([F.col("a"), F.col("b")]).alias("leaf"))
    assert leaves.distinct().count() == len(rows)
    assert set(COLUMNS) == {"doc_id", "source", "lang", "n_chars", "text"}


def test_runs_stay_apart(spark):
    """The windows are those of a run, so that no task holds a whole source."""
    frame = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"))
    plan = merkle_manifest(frame, ("doc_id",))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line or "Window(" in line]
    assert windows and all("up#" in line for line in windows)
