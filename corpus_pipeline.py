"""A corpus made ready for training, stage by stage.

toxicity           documents that the classifier rejects go
line dedup         blocks of lines that an earlier document has are cut from the later one
simhash dedup      one row of each group of near duplicates stays, the smallest doc_id
mixing             sources are brought to their target weights, documents repeated or left out
sentencepiece      texts become token ids

Every stage works on all rows the one before kept, and all but the last return the columns of
`documents`, whatever others the caller added and however these are named. Each result is written below the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathquality.llm import fst, lines, mixing, simhash, toxicity
from pathquality.llm.common import put_back, ready, set_aside, stored, table
from pathquality.llm.queries import PIECES

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def used(docs: DataFrame, *names: str) -> list[str]:
    return [c for c in docs.columns if c in names]


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    own = used(docs, "doc_id", "text", "n_chars")
    out = lines.line_dedup(set_aside(docs, *own))
    if "n_chars" in own:
        left = F.coalesce(F.length("text").cast("long"), F.lit(0))
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, left).otherwise(F.col("n_chars")))
    return put_back(out, docs, *own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return simhash.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    own = used(docs, "doc_id", "text", "source", "n_chars")
    held = set_aside(docs, *own)
    return put_back(mixing.repeated(mixing.mix(held), held.columns), docs, *own)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return fst.encode(docs, fst.load(PIECES))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# Learned scores, alignments and subword paths are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
