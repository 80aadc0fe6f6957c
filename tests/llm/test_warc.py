from __future__ import annotations

import hashlib

import zstandard
from pyspark.sql import functions as F

from meterline.llm import warc
from meterline.llm.warc import fetch_records, parse_records, read_bundles, read_frame, seek_table, write_bundles

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    found = []
    for page, _, html in rows:
        data = (html or "").encode()
        alike = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        revisit = len(data) >= 1000 and alike and page != max(alike)
        found.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(alike) if revisit else None))
    return sorted(found, key=str)


def round_trip(spark, tmp_path, rows, **other):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit(value) for name, value in other.items()})
    index = write_bundles(frame, f"{tmp_path}/bundles")
    records = read_bundles(spark, index)
    names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in records.select(names).collect()), key=str) == expected(rows)
    return index, records


def test_round_trip(spark, tmp_path, monkeypatch):
    big = "<p>" + "é" * 600
    rows = [(i, f"http://x/{i}?a=b c\r\nd", f"<p>page {i}" + "z" * (i * 40)) for i in range(40)]
    rows += [(100 + i, None, big) for i in range(20)] + [(200, "u", "short"), (201, "u", "short"), (202, "u", None), (203, "u", "")]
    rows += [(None, "u", big), (None, None, "w" * 1000), (None, None, "w" * 1000), (300, "u", "y" * 300_000)]
    rows += [(7, "u", "v" * 2000), (7, "u", "v" * 2000), (400, "u", "WARC/1.1\r\n\r\n" * 200)]
    index, records = round_trip(spark, tmp_path, rows, id=1, digest="x", n=2, keep=3)
    payloads = {r["id"]: bytes(r["payload"]).decode() for r in records.filter("record_type = 'response' AND id IS NOT NULL").collect()}
    assert payloads[300] == "y" * 300_000 and payloads[119] == big and payloads[400].startswith("WARC")
    assert records.filter("record_type = 'revisit' AND payload IS NOT NULL").count() == 0


def test_one_record_by_one_seek(spark, tmp_path):
    rows = [(i, f"u{i}", f"html {i} " * 500) for i in range(50)]
    index, _ = round_trip(spark, tmp_path, rows)
    wanted = warc.record_id(31, hashlib.sha1(rows[31][2].encode()).hexdigest())
    (found,) = fetch_records(index.filter(F.col("record_id") == wanted)).collect()
    assert bytes(found["payload"]).decode() == rows[31][2] and found["headers"]["WARC-Target-URI"] == "u31"
    entry = index.filter(F.col("record_id") == wanted).first()
    frame = read_frame(entry["bundle"], entry["frame_start"], entry["frame_bytes"])
    part = frame[entry["record_start"] : entry["record_start"] + entry["record_bytes"]]
    assert part.startswith(b"WARC/1.1\r\n") and part.endswith(b"\r\n\r\n")


def test_bundles_are_frames_and_a_seek_table(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    bundle = warc.Bundle(str(tmp_path), "b")
    for i in range(30):
        payload = f"payload {i} ".encode() * 30
        bundle.add(f"r{i}", warc.record_bytes(i, None, payload, hashlib.sha1(payload).hexdigest(), "response", None))
    bundle.close()
    table = seek_table(bundle.path)
    assert len(table) > 5
    heads = [head["Page-Id"] for start, size in table for head, _ in parse_records(read_frame(bundle.path, start, size))]
    assert heads == [str(i) for i in range(30)]
    data = (tmp_path / "b.warc.zst").read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 30


def test_empty_table(spark, tmp_path):
    index = write_bundles(spark.createDataFrame([], SCHEMA), f"{tmp_path}/none")
    assert index.collect() == [] and read_bundles(spark, index).collect() == []
