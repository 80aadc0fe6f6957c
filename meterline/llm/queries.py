"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.blocked_search import ranked_search
from meterline.llm.common import ascii_lower, read_table
from meterline.llm.cotrain import quality_scores
from meterline.llm.exact_dedup import exact_duplicates
from meterline.llm.html_text import extract_article
from meterline.llm.line_dedup import dedup_lines
from meterline.llm.lm_score import score_text
from meterline.llm.merkle import COLUMNS, folded, leaf, merkle_manifest, proof_digest
from meterline.llm.packing import pack
from meterline.llm.piece_sampling import sample_pieces
from meterline.llm.quality_rules import quality_rules
from meterline.llm.simhash import simhash_neighbours
from meterline.llm.warc import read_bundles, write_bundles
from meterline.llm.winnowing import fingerprint_pairs
from meterline.session import scratch_dir


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op2_extract_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_article(read_table(spark, sf_dir, "pages"))


def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_bundles(read_table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    records = read_bundles(spark, index, with_payload=False)
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_text(read_table(spark, sf_dir, "documents"))


def op5_simhash_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_neighbours(read_table(spark, sf_dir, "documents"))


def op6_sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    samples = sample_pieces(docs, ["doc_id"], decoded="decoded")
    return samples.select(
        "doc_id",
        "sample",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        "log_probability",
        "inclusion",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_scores(docs, labels).select("doc_id", "score", "kept")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), columns=["doc_id"])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(read_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the documents; every fifth one, by its id's checksum, is then altered and checked."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    altered = [ascii_lower(F.col(name)) if name == "text" else F.col(name) for name in COLUMNS]
    manifest = merkle_manifest(
        read_table(spark, sf_dir, "documents"), carry={"altered": F.when(chosen, leaf(altered))}
    )
    found = folded(F.coalesce("altered", "leaf"), F.col("steps"))
    return manifest.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        found.alias("folded_root"),
        (found == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_pack_sequences": op1_pack_sequences,
    "op2_extract_article": op2_extract_article,
    "op3_warc_bundles": op3_warc_bundles,
    "op4_score_text": op4_score_text,
    "op5_simhash_neighbours": op5_simhash_neighbours,
    "op6_sample_pieces": op6_sample_pieces,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_winnow": op11_winnow,
    "op12_ranked_search": op12_ranked_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}
