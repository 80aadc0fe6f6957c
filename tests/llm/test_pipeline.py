from __future__ import annotations

import random
import sys

from textdata import SCHEMA, prose

import corpus_pipeline
from meterline.llm.queries import QUERIES


def written(spark, folder, rows, labels):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def row(doc_id, text, source="h0"):
    return doc_id, text, "en", source, None if text is None else len(text)


def test_stages_take_out_what_they_should(spark, tmp_path):
    rng = random.Random(18)
    clean = [prose(rng, rng.randrange(40, 120)) for _ in range(300)]
    rows = [row(i, f"Shared line of all\n{text}" if i < 50 else text) for i, text in enumerate(clean)]
    shouting = [prose(rng, 60).upper().replace(" ", "!! ") for _ in range(100)]
    rows += [row(1000 + i, text) for i, text in enumerate(shouting)]
    rows += [row(2000 + i, "too short") for i in range(20)] + [row(3000, None), row(3001, "")]
    rows += [row(4000 + i, clean[100].replace(" ", "  ")) for i in range(6)]
    rows += [row(None, clean[200]), row(None, clean[201] + " tail of the text"), row(5, rows[5][1])]
    labels = [(i, 1, 0) for i in range(300)] + [(1000 + i, 0, 0) for i in range(70)]
    folder = written(spark, tmp_path, rows, labels)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "stage")
        kept[name] = docs.collect()
        if name != "best-fit packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = {name: {r["doc_id"] for r in found} for name, found in kept.items()}
    assert not any(i is not None and (2000 <= i < 3002) for i in ids["quality rules"]) and len(kept["quality rules"]) == 409
    assert set(range(300)) <= ids["quality classifier"] and not ids["quality classifier"] & set(range(1000, 2000))
    lines = {r["doc_id"]: r for r in kept["line dedup"]}
    assert all(lines[i]["text"] == clean[i] and lines[i]["n_chars"] == len(clean[i]) for i in range(300))
    last = kept["simhash near-dedup"]
    assert set(range(300)) <= {r["doc_id"] for r in last} and not {4000 + i for i in range(6)} & {r["doc_id"] for r in last}
    assert sum(r["doc_id"] == 5 for r in last) == 1
    assert {r["doc_id"] for r in kept["best-fit packing"]} == {r["doc_id"] for r in last}
    whole = corpus_pipeline.run(spark, folder)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, whole.select(names).collect())) == sorted(map(str, docs.select(names).collect()))


def test_a_whole_copy_of_a_large_group_is_packed(spark, tmp_path):
    rng = random.Random(19)
    clean = [prose(rng, rng.randrange(40, 120)) for _ in range(120)]
    many = "\n".join([prose(rng, 40), "", "A refrain of the poem", prose(rng, 40), "A refrain of the poem"])
    rows = [row(i, text) for i, text in enumerate(clean)]
    rows += [row(4000 + i, clean[100].replace(" ", "  ")) for i in range(30)]
    rows += [row(5000 + i, many) for i in range(30)]
    rows += [row(6000 + i, f"{many}\nown {prose(rng, 3)}") for i in range(12)]
    folder = written(spark, tmp_path, rows, [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cleaned = corpus_pipeline.stored(corpus_pipeline.lines_stage(spark, docs, folder), "stage")
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert len(texts) == len(rows) and texts[4000] == clean[100].replace(" ", "  ") and texts[5000] == many
    assert not any(texts[4000 + i].strip() or texts[5000 + i].strip() for i in range(1, 30))
    assert all(texts[6000 + i].strip().startswith("own ") for i in range(12))
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert 5000 in packed and packed & {100, 4000}


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [])).collect() == []


def test_registered_and_used_by_nothing_else():
    import __spark_entry__

    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 11)]
    others = [m for name, m in sys.modules.items() if name.startswith(("meterline", "catalog")) and ".llm" not in name]
    assert not any("llm" in str(getattr(m, "__dict__", {}).get(k)) for m in others for k in getattr(m, "__all__", []))
