"""Winnowed fingerprints of documents, of edited texts, and how alike they are.

A fingerprint is chosen from the rolling hashes of all GRAM-grams of code points: the
least hash of every WINDOW hashes in a row, the rightmost one where several are least.
Its place is kept, so a passage of GRAM + WINDOW - 1 code points that two texts share
gives at least one common hash, whose places tell where it stands in each.

The fingerprint column is the base64 text of five bytes per choice, in order: the step
from the place before (the first place itself, and never over WINDOW) and the hash,
big-endian. ``choices`` reads it back.

Likeness is the share of common hashes among all distinct hashes of two fingerprints.

``fingerprint_pairs`` sets each document beside the next one by ascending id:

1. A sample of keys (id, text hash, row number) gives the bounds of key ranges. Each bound
   is a row, and the first one is the least row of all.
2. The rows of a range go to one task, sorted. The row at a bound goes to the range before
   as well, where it comes last: the next document of that range's last one. The first row of all
   follows the last one the same way.
3. The tasks stream their ranges; a document is held until the next one has come. Whole
   texts cross one shuffle.

The bounds are SAMPLED rows a range, all that reaches the driver. As row numbers are part of
the key, a third of all rows under one id, or of one text, is cut like any other rows.

Defined results: ids are integers. A null text is empty; a text without any GRAM-gram has the hash of the whole
text as its only choice, an empty one none. Texts with fewer than WINDOW hashes are one
window. Two empty fingerprints have likeness 1, an empty and another one 0. Rows of equal
id stand in order of their texts' hashes; null ids come first. A single document is its
own next one. Long texts are cut into overlapping stretches that give the same choices.
An empty table gives an empty result. Other columns are left out and may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import text_or_empty

GRAM = 12
WINDOW = 16
#: Multiplier of the rolling hash; odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
#: Code points fingerprinted at one time, and code points of a batch of results.
STRETCH = 1 << 16
RESULT_CHARS = 1 << 20
#: Rows, and bytes of text, that a range is to have about; sampled rows per range.
RANGE_ROWS = 4096
RANGE_BYTES = 16 << 20
SAMPLED = 16
#: No more ranges than this, so that their bounds stay small; ranges grow beyond it.
RANGES = 20_000

_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = powers(BASE, STRETCH + 2 * (GRAM + WINDOW))
_DOWN = powers(_INVERSE, STRETCH + 2 * (GRAM + WINDOW))


def mixed(values: np.ndarray) -> np.ndarray:
    """The 32 bits of each hash that are compared and kept."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (values ^ (values >> np.uint64(32))) & np.uint64(0xFFFFFFFF)


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The hash of every gram, from running sums: sum of code * BASE^(gram - 1 - place) modulo 2^64."""
    count = len(codes)
    sums = np.zeros(count + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _DOWN[:count], out=sums[1:])
    return mixed((sums[gram:] - sums[:-gram]) * _UP[gram - 1 : count])


def least_places(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The place of the rightmost least hash of every window, each place once.

    A hash and its place, counted down, make one number; the least of a window comes
    from the least of halves of twice the length.
    """
    count = len(hashes)
    ranked = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(count, dtype=np.uint64))
    width, least = 1, ranked
    while width * 2 <= min(window, count):
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = min(window, count) - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    places = np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))
    return places[np.flatnonzero(np.diff(places, prepend=np.uint64(0xFFFFFFFF)))]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def winnow(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of one text's choices."""
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(codes) < GRAM:
        return np.zeros(1, np.int64), gram_hashes(codes, len(codes))
    places, hashes = [], []
    reach = GRAM + WINDOW - 2
    for start in range(0, max(1, len(codes) - reach), STRETCH):
        found = gram_hashes(codes[start : start + STRETCH + reach])
        chosen = least_places(found)
        places.append(chosen.astype(np.int64) + start)
        hashes.append(found[chosen.astype(np.int64)])
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    new = np.diff(places, prepend=-1) > 0
    return places[new], hashes[new]


def written(places: np.ndarray, hashes: np.ndarray) -> str:
    """The choices as the text of the fingerprint column."""
    rows = np.empty((len(places), 5), dtype=np.uint8)
    rows[:, 0] = np.diff(places, prepend=0)
    rows[:, 1:] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    return base64.b64encode(rows.tobytes()).decode()


def choices(fingerprint: str) -> list[tuple[int, int]]:
    """(place, hash) of every choice of a fingerprint."""
    rows = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 5)
    places = np.cumsum(rows[:, 0].astype(np.int64))
    hashes = np.ascontiguousarray(rows[:, 1:]).view(">u4").ravel()
    return list(zip(places.tolist(), hashes.tolist()))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Common hashes among all of two sorted sets of distinct ones."""
    if not len(one) and not len(other):
        return 1.0
    common = len(np.intersect1d(one, other, assume_unique=True))
    return common / (len(one) + len(other) - common)


class Fingerprint:
    """One text's fingerprint: its text form and its distinct hashes."""

    def __init__(self, text: str) -> None:
        places, hashes = winnow(code_points(text))
        self.text = written(places, hashes)
        self.hashes = np.unique(hashes)


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the next one's beginning, or all of it."""
    replaced = len(text) // 4
    return text[: len(text) - replaced] + following[:replaced]


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def pair_row(text: str, own: Fingerprint, following: str, other: Fingerprint) -> tuple:
    changed = edited(text, following)
    after = own if changed == text else Fingerprint(changed)
    return (
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        own.text,
        after.text,
        likeness(own.hashes, after.hashes),
        likeness(own.hashes, other.hashes),
    )


def streamed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (span, guest, id, text), sorted, to a result row per row that is no guest."""
    held, rows, size = None, [], 0
    names = ["id", *(part.split(" ")[0] for part in RESULT.split(", "))]

    def made() -> pa.RecordBatch:
        columns = [pa.array(column) for column in zip(*rows)]
        columns[0] = columns[0].cast(pa.int64())
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for span, guest, key, text in zip(*(batch.column(i) for i in range(4))):
            span, text = span.as_py(), text.as_py()
            print_of = Fingerprint(text)
            if held is not None:
                if held[0] != span:
                    raise RuntimeError(f"no row follows the last one of range {held[0]}")
                rows.append((held[1], *pair_row(held[2], held[3], text, print_of)))
                size += len(text)
            held = None if guest.as_py() else (span, key.as_py(), text, print_of)
            if size >= RESULT_CHARS or len(rows) >= 1000:
                yield made()
                rows, size = [], 0
    if held is not None:
        raise RuntimeError(f"no row follows the last one of range {held[0]}")
    if rows:
        yield made()


def packed_keys(present: pd.Series, ids: pd.Series, hashes: pd.Series, numbers: pd.Series) -> np.ndarray:
    """Keys as bytes that compare like (id, nulls first, then hash, then row number)."""
    parts = np.empty((len(ids), 25), dtype=np.uint8)
    parts[:, 0] = present.to_numpy(dtype=bool)
    for at, column in enumerate((ids, hashes, numbers)):
        unsigned = column.to_numpy(dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        parts[:, 1 + 8 * at : 9 + 8 * at] = unsigned.astype(">u8").view(np.uint8).reshape(-1, 8)
    # A last byte that is not zero, as numpy strips zeros off the end.
    return np.concatenate([parts, np.ones((len(ids), 1), np.uint8)], axis=1).view("S26").ravel()


KEY = ["present", "key", "hash", "number"]


def key_bounds(rows: DataFrame) -> np.ndarray:
    """The least key of all rows, and those of sampled rows that cut them into ranges; sorted."""
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min(F.struct(*KEY)).alias("least")).first()
    if not size["n"]:
        return np.zeros(0, "S26")
    ranges = min(RANGES, max(size["n"] // RANGE_ROWS, size["bytes"] // RANGE_BYTES, 1))
    sample = rows.select(KEY).sample(min(1.0, SAMPLED * ranges / size["n"]), seed=11).toPandas()
    least = pd.DataFrame([size["least"].asDict()])
    first, keys = (np.sort(packed_keys(*(frame[name] for name in KEY))) for frame in (least, sample))
    return np.unique(np.concatenate([first, keys[SAMPLED // 2 :: SAMPLED]]))


def span_of(bounds: np.ndarray) -> Column:
    """The range of a row, and -1 or the range it is a guest of."""

    @F.pandas_udf("span int, guest_of int")
    def found(present: pd.Series, ids: pd.Series, hashes: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        keys = packed_keys(present, ids, hashes, numbers)
        spans = np.searchsorted(bounds, keys, side="right") - 1
        guests = np.where(bounds[spans] == keys, (spans - 1) % len(bounds), -1)
        return pd.DataFrame({"span": spans.astype(np.int32), "guest_of": guests.astype(np.int32)})

    return found(*KEY)


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and the likenesses to that and to the next."""
    rows = docs.select(
        F.col(id_col).isNotNull().alias("present"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("key"),
        F.xxhash64(text_or_empty(text_col)).alias("hash"),
        F.monotonically_increasing_id().alias("number"),
        F.col(id_col).cast("long").alias("id"),
        text_or_empty(text_col).alias("text"),
    )
    bounds = key_bounds(rows)
    if not len(bounds):
        bounds = np.zeros(1, "S26")
    placed = rows.withColumn("place", span_of(bounds))
    copies = F.filter(
        F.array(
            F.struct(F.col("place.span").alias("span"), F.lit(False).alias("guest")),
            F.struct(F.col("place.guest_of").alias("span"), F.lit(True).alias("guest")),
        ),
        lambda copy: copy["span"] >= 0,
    )
    dealt = placed.select(*KEY, "id", "text", F.inline(copies)).repartition("span")
    ordered = dealt.sortWithinPartitions("span", "guest", *KEY).select("span", "guest", "id", "text")
    return ordered.mapInArrow(streamed_pairs, f"id long, {RESULT}").withColumnRenamed("id", id_col)
