"""Quality rules on documents, and verdicts on the hosts they come from.

Built-in DataFrame functions only. Each document is measured in its own row. The
failures of each rule are summed up by host; the rates of the hosts give a beta
prior by the method of moments, every host's rate is shrunk towards it, and a host
whose shrunk rate of a rule is over ``host_limit`` loses all its documents.

Windows of words are compared by their 64-bit hashes within one document.

Defined results: a null text has no words and fails. Null and empty hosts are no
hosts: their documents have the base verdict only, and do not enter the prior. An
empty table gives an empty result. Repeated rows are measured alike. Texts of any length
are measured whole, in one row's memory. A host whose shrunk rate equals the limit is
kept. Columns named like the result's are replaced, others kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import BLANKS, LOOKUP_NAMES, apart, named_back, stored, text_or_empty, with_lookup

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host is rejected when more than this share of its documents, after shrinking, fails a rule.
HOST_LIMIT = 0.5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["short", "repeated"]
VERDICTS = ["base_failed", "kept"]
OWN_NAMES = [
    "_words", "_lines", "_windows", "_sorted", "_starts", "_short", "_repeated", "_host", "_host_key", "_rejected",
    "_rows", *LOOKUP_NAMES,
]


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def with_measures(docs: DataFrame, text_col: str) -> DataFrame:
    """The five measures of each row, in steps so that no array is made twice."""
    text = text_or_empty(text_col)
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    last = F.size("_words") - WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*(F.get("_words", i + j) for j in range(WINDOW))),
    )
    windows = F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))
    frame = docs.drop(*MEASURES).withColumns({"_words": words_of(text), "_lines": lines})
    frame = frame.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": windows,
        }
    ).drop("_words", "_lines")
    same = F.size(F.array_distinct("_windows")) == F.size("_windows")
    frame = frame.withColumn(
        "_sorted",
        F.when(
            ~same, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ),
    ).drop("_windows")
    repeats = F.filter(
        "_sorted",
        lambda x, j: x["h"].eqNullSafe(F.get("_sorted", j - 1)["h"])
        | x["h"].eqNullSafe(F.get("_sorted", j + 1)["h"]),
    )
    frame = frame.withColumn("_starts", F.sort_array(F.transform(repeats, lambda x: x["i"]))).drop("_sorted")
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", j + 1) - i, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    return frame.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_starts")


def host_verdicts(measured: DataFrame, host_col: str, host_limit: float) -> DataFrame:
    """Per host: rows, failures and shrunk rate of each rule, and whether it is rejected.

    With rates of mean m and variance v over the hosts, a beta distribution of
    strength s = m (1 - m) / v - 1 fits them; the shrunk rate of a host with f
    failures in n documents is (f + m s) / (n + s). Without variance, s is infinite
    and every host has the mean rate.
    """
    hosts = (
        measured.filter(F.col(host_col) != "")
        .groupBy(F.col(host_col).alias("host"))
        .agg(
            F.count("*").alias("rows"),
            *(F.sum(F.col(f"_{rule}").cast("long")).alias(f"{rule}_failures") for rule in RULES),
        )
    )
    hosts = stored(hosts, "hosts")
    rate = {rule: F.col(f"{rule}_failures") / F.col("rows") for rule in RULES}
    prior = hosts.agg(
        *(F.avg(rate[rule]).alias(f"{rule}_mean") for rule in RULES),
        *(F.var_pop(rate[rule]).alias(f"{rule}_var") for rule in RULES),
    ).first()
    for rule in RULES:
        mean, var = prior[f"{rule}_mean"] or 0.0, prior[f"{rule}_var"] or 0.0
        shrunk = F.lit(mean)
        if var > 0:
            strength = max(mean * (1 - mean) / var - 1, 0.0)
            shrunk = (F.col(f"{rule}_failures") + mean * strength) / (F.col("rows") + strength)
        hosts = hosts.withColumn(f"{rule}_rate", shrunk)
    rejected = F.greatest(*(F.col(f"{rule}_rate") for rule in RULES)) > host_limit
    return hosts.withColumn("host_rejected", rejected)


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    host_limit: float = HOST_LIMIT,
    id_col: str = "doc_id",
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of each row (all by default) with its measures, ``base_failed`` and ``kept``.

    The table is measured once; of the measured rows only ``columns`` are stored.
    """
    docs, others = apart(docs, OWN_NAMES)
    text_col, host_col = others.get(text_col, text_col), others.get(host_col, host_col)
    measured = with_measures(docs, text_col)
    measured = measured.withColumns(
        {
            "_short": F.col("n_words") < MIN_WORDS,
            "_repeated": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
            "_host": F.col(host_col),
        }
    )
    wanted = [others.get(name, name) for name in columns or ()] or docs.columns
    keep = [name for name in wanted if name.lower() not in MEASURES + VERDICTS]
    measured = stored(measured.select(*keep, "_short", "_repeated", "_host", *MEASURES), "measures")
    verdicts = host_verdicts(measured, "_host", host_limit).filter("host_rejected")
    verdicts = verdicts.groupBy(F.xxhash64("host").alias("_host_key")).agg(
        F.collect_list("host").alias("_rejected"), F.sum("rows").alias("_rows")
    )
    measured = measured.withColumn("_host_key", F.xxhash64("_host"))
    spread = F.xxhash64(*keep[:1], *MEASURES)
    judged = with_lookup(measured, verdicts, "_host_key", "_rows", spread, measured.count())
    judged = judged.withColumn("base_failed", F.col("_short") | F.col("_repeated"))
    rejected = F.coalesce(F.array_contains("_rejected", F.col("_host")), F.lit(False))
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~rejected).select(*keep, *MEASURES, *VERDICTS)
    return named_back(judged, others)
