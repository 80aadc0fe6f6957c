"""What several operators share: tables, scratch tables, text helpers, joins safe on hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The white space of the contracts: \x20 and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: A key with more than this share of all rows is hot, so there are fewer hot keys than this.
HOT_KEYS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared scratch folder, which lost executors do not take away."""
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does that for text of single bytes."""
    single = F.octet_length(text) == F.char_length(text)
    return F.when(single, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def apart(frame: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The frame with other names for columns called like one of ``names`` (in any case) or with dots, and these by the old."""
    own = {name.lower() for name in names}
    taken = own | {name.lower() for name in frame.columns}
    others: dict[str, str] = {}
    for name in frame.columns:
        if name.lower() in own or "." in name or "`" in name:
            others[name] = next(x for i in range(len(taken) + 1) if (x := f"other_{len(others)}_{i}") not in taken)
            taken.add(others[name])
    return (frame.withColumnsRenamed(others) if others else frame), others


def named_back(frame: DataFrame, others: dict[str, str]) -> DataFrame:
    return frame.withColumnsRenamed({new: old for old, new in others.items()}) if others else frame


#: The names that ``with_lookup`` adds to the columns of its rows.
LOOKUP_NAMES = ["_found", "_hot", "_cold", "_key", "_is_hot"]


def with_lookup(
    rows: DataFrame, found: DataFrame, key: str, weight: str, spread: Column, total: int
) -> DataFrame:
    """Left join of ``found``, which has a row per long ``key``, by a way that no hot key slows.

    ``weight`` is the number of ``rows`` a key has and ``total`` an upper bound of
    their sum. Keys over ``total / HOT_KEYS`` are fewer than HOT_KEYS and are
    broadcast; all other rows meet in a shuffle. Rows that have met a hot key go
    through that shuffle spread by ``spread`` and match nothing there.
    """
    limit = total // HOT_KEYS
    payload = [name for name in found.columns if name not in (key, weight)]
    packed = found.select(key, F.col(weight).alias("_n"), F.struct(*payload).alias("_found"))
    hot = packed.filter(F.col("_n") > limit).select(key, F.col("_found").alias("_hot"))
    cold = packed.filter(F.col("_n") <= limit).select(
        F.col(key).alias("_key"), F.lit(False).alias("_is_hot"), F.col("_found").alias("_cold")
    )
    is_hot = F.col("_hot").isNotNull()
    marked = rows.join(F.broadcast(hot), key, "left").withColumns(
        {"_is_hot": is_hot, "_key": F.when(is_hot, spread).otherwise(F.col(key))}
    )
    joined = marked.join(cold, ["_key", "_is_hot"], "left").withColumn(
        "_found", F.coalesce("_hot", "_cold")
    )
    return joined.select(*rows.columns, "_found.*")
