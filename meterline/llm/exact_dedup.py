"""Exact duplicates by an extendible-hash index on shared files.

Built-in DataFrame functions only. Every text gets a 64-bit hash. The top bits of
the hash select a slot of a directory; a slot points to a bucket. A bucket with
more keys than its capacity is split on the next bit, and the directory doubles
when the bucket already used all its bits. Buckets hold contiguous hash ranges;
the owner of a range compares the texts of each repeated hash byte by byte and
chains the different ones. Only texts whose hash repeats travel to the owners,
one per text and salt however many copies there are.

Defined results: a null text counts as empty. Of equal texts the largest doc_id
stays; null ids count as smaller than any other. Rows repeating both id and text
are all marked alike. An empty table gives an empty result. Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.llm.common import ascii_lower, stored, text_or_empty, with_lookup

BUCKET_KEYS = 50_000
#: A directory up to this many slots (16 bytes each) is broadcast, a larger one joined by a shuffle.
BROADCAST_SLOTS = 1 << 18
#: Bits below the first depth that the histogram of hashes resolves.
SPARE_BITS = 8
#: Partial groups per text that reach its owner.
SALTS = 16


def slot(key: Column, depth: int) -> Column:
    """The top ``depth`` bits of a hash."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def grow_directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """Slots with their buckets, and the number of bits that select a slot.

    ``keys`` has a row per distinct hash ``h``. A bucket is named by its first slot,
    so buckets in order are hash ranges in order.
    """
    total = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, total / capacity))))
    finest = depth + SPARE_BITS
    histogram = stored(
        keys.groupBy(slot(F.col("h"), finest).alias("leaf")).agg(F.count("*").alias("n")), "histogram"
    )

    def at(bits: int) -> DataFrame:
        prefix = F.shiftright("leaf", finest - bits).alias("prefix")
        return histogram.groupBy(prefix).agg(F.sum("n").alias("n")).withColumn("bits", F.lit(bits))

    buckets = at(depth)
    while depth < finest:
        overfull = (F.col("n") > capacity) & (F.col("bits") == depth)
        parents = buckets.filter(overfull).select(F.col("prefix").alias("parent"))
        if parents.isEmpty():
            break
        depth += 1
        halves = at(depth).withColumn("parent", F.shiftright("prefix", 1))
        halves = halves.join(parents, "parent", "left_semi").drop("parent")
        buckets = stored(buckets.filter(~overfull).unionByName(halves), "buckets")
    shift = F.lit(depth) - F.col("bits")
    first = F.call_function("shiftleft", F.col("prefix"), shift)
    last = first + F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1
    slots = buckets.select(first.alias("bucket"), F.explode(F.sequence(first, last)).alias("slot"))
    return slots, depth


def build_index(docs: DataFrame, id_col: str, text_col: str, capacity: int) -> tuple[DataFrame, DataFrame]:
    """(entries, index) as tables in the shared folder.

    entries: a row per document (id, h, sha). index: a row per text whose hash
    repeats (bucket, h, chain, sha, keep_id, group_size, n), n being the rows of its hash.
    """
    text = ascii_lower(text_or_empty(text_col))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    entries = stored(texts.select("id", "h", F.sha2("text", 256).alias("sha")), "entries")
    keys = stored(entries.groupBy("h").agg(F.count("*").alias("n")), "keys")
    slots, depth = grow_directory(keys, capacity)
    if 2**depth <= BROADCAST_SLOTS:
        slots = F.broadcast(slots)
    repeated = keys.filter("n > 1").withColumn("slot", slot(F.col("h"), depth)).join(slots, "slot")
    repeated = stored(repeated.select("h", "n", "bucket"), "repeated")
    total = entries.count()
    spread = F.xxhash64("id", "text")
    suspects = with_lookup(texts, repeated.withColumn("rows", F.col("n")), "h", "rows", spread, total)
    partial = (
        suspects.filter(F.col("bucket").isNotNull())
        .groupBy("bucket", "h", "n", "text", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
        .agg(F.max("id").alias("id"), F.count("*").alias("rows"))
    )
    owned = (
        partial.repartitionByRange("bucket", "h")
        .groupBy("bucket", "h", "n", "text")
        .agg(F.max("id").alias("keep_id"), F.sum("rows").alias("group_size"))
        .withColumn("sha", F.sha2("text", 256))
    )
    chain = Window.partitionBy("bucket", "h").orderBy(F.col("keep_id").desc_nulls_last(), "sha")
    alike = F.count("*").over(Window.partitionBy("bucket", "h", "sha"))
    index = owned.withColumns({"chain": F.row_number().over(chain), "alike": alike}).select(
        "bucket",
        "h",
        "chain",
        F.when(F.col("alike") == 1, F.col("sha"))
        .otherwise(F.raise_error(F.lit("different texts share both hashes")))
        .alias("sha"),
        "keep_id",
        "group_size",
        "n",
    )
    return entries, stored(index.sortWithinPartitions("bucket", "h", "chain"), "index")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_KEYS
) -> DataFrame:
    """Every row with the id that stays of its group, the group's size and the text's SHA-256."""
    entries, index = build_index(docs, id_col, text_col, capacity)
    groups = index.groupBy("h", "n").agg(
        F.collect_list(F.struct("sha", "keep_id", "group_size")).alias("chains")
    )
    rows = with_lookup(entries, groups, "h", "n", F.xxhash64("id", "sha"), entries.count())
    match = F.filter("chains", lambda x: x["sha"] == F.col("sha"))
    group = F.get(match, F.lit(0))
    rows = rows.withColumn("group", F.when(F.col("chains").isNotNull(), group))
    keep = F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("group.keep_id"))
    return rows.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group.group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
