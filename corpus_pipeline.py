"""The corpus pipeline: stages applied to `documents` in order, each written and read again.

Toxic documents go; repeated lines go; one document of each group of near copies
stays; sources are mixed to their weights, a row for each copy taken; what is left
is encoded, and decoded again as a check.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import jaccard, lines, mixing, pieces, toxicity
from gaugeworks.llm.queries import SENTENCEPIECE
from gaugeworks.llm.store import written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labelled ones of `docs`; every document is scored."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.toxicity(docs, labels)
    return scored.filter(~F.col(f"`{scored.columns[-1]}`")).select(*(F.col(f"`{c}`") for c in docs.columns))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.deduplicated(docs, lines.ANY)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents but the text, and the ids, their number and whether they decode to the text."""
    both = pieces.both_ways(docs, public_tokenizers.path(SENTENCEPIECE))
    text = F.translate(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    return both.select(*(c for c in docs.columns if c != "text"), F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == text).alias("round_trip"))


STAGES = [("toxicity", without_toxic), ("line_dedup", without_repeated_lines), ("near_copies", without_near_copies),
          ("mixing", mixed), ("sentencepiece", encoded)]
#: A fitted model, an edit join and a tokenizer are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
