"""Lines that many documents share, found by a pair of Bloom filters.

1. Each task hashes its documents' lines and sends every hash on once, marked when
   it met it in two documents (8 bytes a line, and one row per task for a hot line).
2. Hashes are dealt out by segment. A segment's owner keeps two Bloom filters, one
   of hashes seen once and one of hashes seen again, and hands out the second.
3. The second filters are broadcast; lines they do not hold are in one document.
   Only the suspected repeats are shuffled, by their text, for an exact count of
   documents and the choice of the first one.
4. The lines to drop come back to their document, which is put together again.

With ``keep_copy`` a document of which shared lines are at least COPY_SHARE is taken for
a copy rather than a text with boilerplate: each of its shared lines stays, wherever it
stands, in the copy of the smallest id that has it. All other shared lines go.

The broadcast is never over FILTER_BYTES: past some 400 million lines the second
filters of the segments get fewer bits each. Filters that hold more let more lines
through to the exact count, and change no result.

Defined results: a null or empty text is one empty line. Keys under ``min_chars``
code points are never dropped. Each row is a document, also when its id repeats or
is null. An empty table gives an empty result. Columns named like the result's are
replaced, others kept, whatever their names. Lines and texts of any length are handled whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import apart, named_back, stored, text_or_empty, with_lookup

MIN_DOCS = 10
MIN_CHARS = 1
BLANK_BYTES = b" \t\n\x0b\x0c\r"
#: Hashes of a segment, and bits of its two filters.
SEGMENT_HASHES = 100_000
ONCE_BITS = 1 << 20
TWICE_BITS = 1 << 17
PROBES = 4
FILTER_BYTES = 64 << 20
#: Share of shared lines, by bytes of distinct keys, from which a document is a copy.
COPY_SHARE = 0.5
#: Hashes a task gathers before it sends them on.
HELD_HASHES = 1_000_000


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK_BYTES).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def keys_of(text: str, min_chars: int) -> set[bytes]:
    keys = {line_key(line) for line in text.encode().split(b"\n")}
    return {key for key in keys if long_enough(key, min_chars)}


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of each hash, a row per probe."""
    low = hashes & np.uint64(0xFFFFFFFF)
    high = (hashes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((low + steps * high) & np.uint64(bits - 1)).astype(np.int64)


def hashed_lines(min_chars: int):
    """Rows (h, again) of a task: its distinct line hashes, and whether two documents had one."""

    def flush(held: list[int]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.array(held, dtype=np.uint64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts > 1)], ["h", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        for batch in batches:
            for text in batch.column(0):
                held.extend(xxhash.xxh64_intdigest(key) for key in keys_of(text.as_py(), min_chars))
                if len(held) >= HELD_HASHES:
                    yield flush(held)
                    held = []
        if held:
            yield flush(held)

    return run


def seen_again(twice_bits: int):
    """Rows (segment, bits): the second filter of each segment; input sorted by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([np.packbits(twice).tobytes()], pa.binary())],
                ["segment", "bits"],
            )

        current, once, twice = None, np.zeros(0, bool), np.zeros(0, bool)
        for batch in batches:
            segments = batch.column(0).to_numpy()
            hashes = batch.column(1).to_numpy().view(np.uint64)
            again = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(segments)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(segments)]):
                if start == end:
                    continue
                if segments[start] != current:
                    if current is not None and twice.any():
                        yield row()
                    current = int(segments[start])
                    once, twice = np.zeros(ONCE_BITS, bool), np.zeros(twice_bits, bool)
                unique, place, counts = np.unique(hashes[start:end], return_inverse=True, return_counts=True)
                marked = np.bincount(place, weights=again[start:end]) > 0
                places = probes(unique, ONCE_BITS)
                repeated = unique[marked | (counts > 1) | once[places].all(axis=0)]
                once[places] = True
                twice[probes(repeated, twice_bits)] = True
        if current is not None and twice.any():
            yield row()

    return run


def suspected(filters, segments: int, twice_bits: int, min_chars: int, sizes: bool):
    """Rows (id, text hash, key): the lines whose hashes the second filters hold.

    With ``sizes`` also the bytes of all keys of the document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {segment: np.unpackbits(np.frombuffer(raw, np.uint8)) for segment, raw in filters.value.items()}
        for batch in batches:
            rows, found, total = [], [], []
            for i, text in enumerate(batch.column(2)):
                keys = list(keys_of(text.as_py(), min_chars))
                if not keys:
                    continue
                hashes = np.array([xxhash.xxh64_intdigest(key) for key in keys], dtype=np.uint64)
                places = probes(hashes, twice_bits)
                size = sum(map(len, keys))
                for j, segment in enumerate((hashes % np.uint64(segments)).tolist()):
                    if segment in bits and bits[segment][places[:, j]].all():
                        rows.append(i)
                        found.append(keys[j].decode())
                        total.append(size)
            take = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(found, pa.string())]
            names = ["id", "text_hash", "key"]
            if sizes:
                columns.append(pa.array(total, pa.int64()))
                names.append("size")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def without_lines(position: int, keep_first: bool, keep_copy: bool):
    """Texts without the lines listed in the last two columns, and what was there before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, dropped = [], [], []
            drops, firsts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            for text, drop, first in zip(batch.column(position), drops, firsts):
                lines = (text.as_py() or "").split("\n")
                gone = {key.encode() for key in drop.as_py() or ()}
                left = {key.encode() for key in first.as_py() or ()} if keep_first or keep_copy else set()
                kept = []
                for line in lines if gone else ():
                    key = line_key(line.encode())
                    if key not in gone or key in left:
                        if not keep_copy:
                            left.discard(key)
                        kept.append(line)
                texts.append("\n".join(kept) if gone else "\n".join(lines))
                before.append(len(lines))
                dropped.append(len(lines) - len(kept) if gone else 0)
            columns = [batch.column(i) for i in range(batch.num_columns - 2)]
            columns[position] = pa.array(texts, pa.string())
            names = batch.schema.names[:-2]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                [*names, "n_lines", "n_dropped"],
            )

    return run


def repeated_lines(
    docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int, sizes: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(suspects, confirmed): a row per document and suspected line; a row per line to drop."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    hashes = stored(
        texts.select("text").mapInArrow(hashed_lines(min_chars), "h long, again boolean"), "line-hashes"
    )
    segments = max(1, math.ceil(hashes.count() / SEGMENT_HASHES))
    twice_bits = TWICE_BITS
    while segments * twice_bits // 8 > FILTER_BYTES and twice_bits > 8:
        twice_bits //= 2
    # The unsigned hash modulo the number of segments: twice the half, and the last bit.
    half = F.pmod(F.shiftrightunsigned("h", 1), F.lit(segments)) * 2 + F.col("h").bitwiseAND(1)
    dealt = hashes.select(F.pmod(half, F.lit(segments)).cast("long").alias("segment"), "h", "again")
    parts = max(1, segments // 4)
    filters = (
        dealt.repartition(parts, "segment")
        .sortWithinPartitions("segment")
        .mapInArrow(seen_again(twice_bits), "segment long, bits binary")
    )
    known = spark.sparkContext.broadcast({row["segment"]: bytes(row["bits"]) for row in filters.collect()})
    id_type = texts.schema["id"].dataType.simpleString()
    suspects = stored(
        texts.select("id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
            suspected(known, segments, twice_bits, min_chars, sizes),
            f"id {id_type}, text_hash long, key string" + ", size long" * sizes,
        ),
        "suspects",
    )
    confirmed = (
        suspects.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "text_hash")).alias("first"))
        .filter(F.col("n") >= min_docs)
    )
    return suspects, stored(confirmed, "repeated-lines")


def lines_of_copies(hits: DataFrame) -> DataFrame:
    """(id, text_hash, _drop, _first): the lines to drop, and of them those that a copy keeps."""
    gone = F.aggregate("_drop", F.lit(0), lambda total, key: total + F.octet_length(key))
    rows = hits.groupBy("id", "text_hash").agg(F.collect_set("key").alias("_drop"), F.max("size").alias("_size"))
    rows = stored(rows.select("id", "text_hash", "_drop", (gone >= COPY_SHARE * F.col("_size")).alias("_copy")), "shared-lines")
    firsts = (
        rows.filter("_copy")
        .select("id", "text_hash", F.explode("_drop").alias("key"))
        .groupBy("key")
        .agg(F.min(F.struct("id", "text_hash")).alias("first"))
        .groupBy("first")
        .agg(F.collect_set("key").alias("_first"))
        .select(F.col("first.id").alias("_by"), F.col("first.text_hash").alias("_by_hash"), "_first")
    )
    same = F.col("id").eqNullSafe(F.col("_by")) & (F.col("text_hash") == F.col("_by_hash"))
    return rows.join(firsts, same, "left").select("id", "text_hash", "_drop", "_first")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep_first: bool = False,
    keep_copy: bool = False,
) -> DataFrame:
    """All columns with the text cleaned, and ``n_lines`` before and ``n_dropped``.

    With ``keep_first`` the first line of the smallest id that has it stays, with
    ``keep_copy`` the shared lines of copies in one of them.
    """
    docs, others = apart(docs, ["_id", "_text_hash", "_drop", "_first"])
    id_col, text_col = others.get(id_col, id_col), others.get(text_col, text_col)
    suspects, confirmed = repeated_lines(docs, id_col, text_col, min_docs, min_chars, sizes=keep_copy)
    confirmed = confirmed.withColumn("h", F.xxhash64("key")).withColumnRenamed("key", "line")
    rows = suspects.withColumn("h", F.xxhash64("key"))
    hits = with_lookup(rows, confirmed, "h", "n", F.xxhash64("id", "text_hash"), suspects.count())
    mine = F.col("first").eqNullSafe(F.struct("id", "text_hash"))
    hits = hits.filter(F.col("line") == F.col("key"))
    if keep_copy:
        hits = lines_of_copies(hits)
    else:
        hits = hits.groupBy("id", "text_hash").agg(
            F.collect_set("key").alias("_drop"), F.collect_set(F.when(mine, F.col("key"))).alias("_first")
        )
    hits = hits.withColumnsRenamed({"id": "_id", "text_hash": "_text_hash"})
    columns = [name for name in docs.columns if name.lower() not in ("n_lines", "n_dropped")]
    plain = docs.select(columns)
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("_text_hash"))
    joined = plain.join(hits, same, "left").select(*columns, "_drop", "_first")
    fields = [
        T.StructField(name, T.StringType() if name == text_col else plain.schema[name].dataType) for name in columns
    ]
    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    cleaned = joined.mapInArrow(without_lines(columns.index(text_col), keep_first, keep_copy), schema)
    return named_back(cleaned, others)
