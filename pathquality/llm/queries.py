"""The registered queries of this package, each with its SQL where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    covertree, divergence, exact, fst, html, licenses, lines, mixing, negatives, simhash, substrings, toxicity, warc,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

# Where the public tokenizers lie; read on the driver only.
PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst.encode(table(spark, sf_dir, "documents"), fst.load(PIECES))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("found")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_left"),
        F.sha2("text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_html_text": op2_html_text,
    "op3_toxicity": op3_toxicity,
    "op4_license_scan": op4_license_scan,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_simhash": op6_simhash,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_top_k": op8_top_k,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_warc": op12_warc,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": exact.EXACT_SQL.strip(),
    "op8_top_k": covertree.TOP_SQL.strip(),
    "op10_mixing": mixing.MIX_SQL.strip(),
    "op11_hard_negatives": negatives.NEGATIVES_SQL.strip(),
    "op12_warc": warc.ARCHIVE_SQL.strip(),
    "op13_source_divergence": divergence.DIVERGENCE_SQL.strip(),
}
