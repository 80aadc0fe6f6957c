"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has 64 bits. Every bit position gets a non-zero vector of r + 1 bits,
and every non-zero vector v of r + 1 bits a mask: the positions whose vector has an
odd inner product with v. The positions in which two fingerprints at distance r or
less differ span at most r dimensions, so some v is orthogonal to all of them: under
its mask the two are equal. The 2^(r+1) - 1 tables thus miss no pair within r
(Pagh, 2016).

Only distinct fingerprints are compared, so groups of copies cost one row. A bucket
of up to BUCKET fingerprints gives a spanning forest of its links, not all pairs. The
rows of a larger bucket go on to the covering masks of the bits that are still free,
which again miss no pair; after a few levels so few bits are free that a bucket
cannot be larger.

Defined results: a null or empty text has fingerprint zero. A null id is never the
smallest of its component; a component of null ids only has a null one. Repeated
rows are returned as often as they come; of equal ids the smallest hash of the text
is first. Texts of any length are read whole, in pieces. Further columns, whatever their
names, are ignored or, by ``one_of_each``, kept. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import apart, named_back, stored, text_or_empty, with_lookup
from meterline.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
BUCKET = 1024
#: With so few free bits a bucket has at most 1,024 fingerprints.
FEW_FREE = 10
#: A text is cut into words in pieces of so many bytes.
PIECE_BYTES = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a list per piece; pieces end at white space."""
    start = 0
    while start < len(text):
        blank = BLANK.search(text, start + PIECE_BYTES)
        end = blank.start() if blank else len(text)
        yield text[start:end].split()
        start = end


def fingerprint(text: str, shingle: int) -> int:
    """Bits set in over half of the shingles' hashes."""
    counts, total, carry = np.zeros(64, np.int64), 0, []
    for words in word_pieces(text.encode().lower()):
        words = carry + words
        hashes = [
            xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(len(words) - shingle + 1)
        ]
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        carry = words[-(shingle - 1) :] if shingle > 1 else []
    if not total and carry:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist()))


def fingerprint_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["id", "text_hash", "fp"]
            )

    return run


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def covering_masks(radius: int, fixed: int = 0, width: int = 64) -> list[int]:
    """Masks that contain ``fixed``, such that two values equal under it and within the radius agree under one."""
    vectors = (1 << (radius + 1)) - 1
    free = [i for i in range(width) if not fixed >> i & 1]
    masks = []
    for v in range(1, vectors + 1):
        chosen = sum(1 << i for at, i in enumerate(free) if ((1 + at % vectors) & v).bit_count() % 2)
        masks.append(fixed | chosen)
    return sorted(set(masks))


def forest(radius: int):
    """Links (a, b) that span what is linked within each list of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for members in batch.column(0):
                values = np.array(members.as_py(), np.int64).view(np.uint64)
                left = np.ones(len(values), bool)
                for seed in range(len(values)):
                    queue = [seed] if left[seed] else []
                    left[seed] = False
                    while queue:
                        at = queue.pop()
                        near = np.flatnonzero(left)
                        near = near[np.bitwise_count(values[near] ^ values[at]) <= radius]
                        left[near] = False
                        queue.extend(near.tolist())
                        links.extend((values[at], values[i]) for i in near)
            ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return run


def near_links(distinct: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the radius; ``distinct`` has ``fp``."""
    rows, links, parents = distinct.select("fp", F.lit(0).cast("long").alias("mask")), [], [0]
    while parents:
        children = {parent: covering_masks(radius, parent) for parent in parents}
        below = F.create_map(
            *(x for p, masks in children.items() for x in (F.lit(signed(p)), F.array(*(F.lit(signed(m)) for m in masks))))
        )
        rows = rows.select("fp", F.explode(below[F.col("mask")]).alias("mask"))
        rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        rows = rows.withColumn("bucket", F.xxhash64("mask", "key"))
        sizes = rows.groupBy("bucket", F.col("mask").alias("of_mask"), F.col("key").alias("of_key")).agg(
            F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
        )
        sizes = stored(sizes.filter("n > 1"), "buckets")
        pairs = sizes.filter("n = 2").select("a", "b")
        links.append(pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        total = sizes.agg(F.sum("n")).first()[0] or 0
        met = with_lookup(rows, sizes.filter("n > 2").drop("a", "b").withColumn("weight", F.col("n")), "bucket", "weight", F.xxhash64("fp"), total)
        met = stored(met.filter("mask = of_mask AND key = of_key").select("fp", "mask", "key", "n"), "met")
        small = (F.col("n") <= bucket) | (F.bit_count("mask") >= 64 - FEW_FREE)
        lists = met.filter(small).groupBy("mask", "key").agg(F.collect_list("fp").alias("members"))
        links.append(lists.select("members").mapInArrow(forest(radius), "a long, b long"))
        rows = met.filter(~small).select("fp", "mask").distinct()
        parents = [row[0] % (1 << 64) for row in rows.select("mask").distinct().collect()]
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(prints, groups): a row per document (id, text_hash, fp); a row per fingerprint (fp, n, root, component_id)."""
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    prints = texts.select("id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        fingerprint_rows(shingle), f"id {id_type}, text_hash long, fp long"
    )
    prints = stored(prints, "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("least")), "distinct")
    roots = components(near_links(distinct, radius))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    placed = stored(placed.select("fp", "n", "least", F.coalesce("root", "fp").alias("root")), "placed")
    whole = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    named = with_lookup(placed, whole, "root", "members", F.xxhash64("fp"), distinct.count())
    return prints, named.select("fp", "n", "root", "component_id")


def simhash_neighbours(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """Every row with its fingerprint and the smallest id reachable over links within the radius."""
    prints, groups = grouped(docs, id_col, text_col, shingle, radius)
    rows = with_lookup(prints, groups.drop("root"), "fp", "n", F.xxhash64("id", "text_hash"), prints.count())
    return rows.select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """The row of each group of near-duplicates with the smallest id, all its columns."""
    docs, others = apart(docs, ["_id", "_text_hash"])
    id_col, text_col = others.get(id_col, id_col), others.get(text_col, text_col)
    prints, groups = grouped(docs, id_col, text_col, shingle, radius)
    rows = with_lookup(prints, groups.drop("component_id"), "fp", "n", F.xxhash64("id", "text_hash"), prints.count())
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    winners = stored(rows.groupBy("root").agg(first).select("first.id", "first.text_hash"), "winners")
    winners = winners.withColumnsRenamed({"id": "_id", "text_hash": "_text_hash"})
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("_text_hash"))
    kept = docs.join(winners, same, "left_semi")
    if prints.groupBy("id", "text_hash").count().filter("count > 1").isEmpty():
        return named_back(kept, others)
    return named_back(kept.dropDuplicates([id_col, text_col]), others)  # rows that repeat id and text
