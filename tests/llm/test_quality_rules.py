from __future__ import annotations

import random
import re

from textdata import by_id, docs, prose  # noqa: F401
from pyspark.sql import functions as F

from meterline.llm.quality_rules import MEASURES, quality_rules


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
    }


def test_measures_equal_brute_force(docs):
    rng = random.Random(2)
    texts = [
        None, "", " \t\n", "one", "a b c d e", "a b c d e a b c d e", "x " * 12, "l1\nl1\n\n \nl1 \nl2", "é ü\x0bß\x0cñ #*$%&|<>",
        "a b c", " lead and trail ", "very " * 3000 + prose(rng, 2000), "🙂 🙂\x1fx",
    ]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(40)]
    found = by_id(quality_rules(docs(*enumerate(texts))))
    for i, text in enumerate(texts):
        want = measures(text)
        assert {name: found[i][name] for name in MEASURES} == want, text
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert found[i]["base_failed"] == failed


def test_hosts_with_mostly_failures_lose_all_documents(docs):
    rng = random.Random(3)
    rows = [(i, "short", "bad") for i in range(95)] + [(i, prose(rng, 30), "bad") for i in range(95, 100)]
    rows += [(i, prose(rng, 30), f"good{i % 7}") for i in range(100, 300)]
    rows += [(300, "short", "small"), (301, prose(rng, 30), None), (302, prose(rng, 30), ""), (303, "short", None)]
    found = by_id(quality_rules(docs(*rows)))
    assert not any(found[i]["kept"] for i in range(100))
    assert all(found[i]["kept"] for i in range(100, 300))
    assert not found[300]["kept"] and found[301]["kept"] and found[302]["kept"] and not found[303]["kept"]


def test_a_single_failure_is_shrunk_towards_the_other_hosts(docs):
    rng = random.Random(4)
    rows = [(i, prose(rng, 30), f"h{i % 20}") for i in range(400)]
    rows += [(400, "short", "h0"), (401, "short", "new"), (402, "short", "h1"), (403, "short", "h1")]
    found = by_id(quality_rules(docs(*rows)))
    assert all(found[i]["kept"] for i in range(400))


def test_empty_table_repeated_rows_and_other_columns(docs):
    assert quality_rules(docs()).collect() == []
    frame = docs((1, "a b"), (1, "a b"), (None, None)).withColumns({"n_words": F.lit("x"), "host": F.lit(1), "rows": F.lit(2)})
    rows = quality_rules(frame).collect()
    assert sorted(row["n_words"] for row in rows) == [0, 2, 2]
    assert {row["rows"] for row in rows} == {2}


def test_no_python_on_the_main_path(docs):
    plan = quality_rules(docs((1, "a"), (2, "b")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
