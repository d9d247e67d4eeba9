"""The registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (
    interaction, jaccard, language, lines, mixing, neighbours, pages, personal, pieces, quality as quality_rules, ranked,
    tokencount, toxicity as toxic)

SENTENCEPIECE = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"
TOKEN_LIMIT = 512

QUERIES = {}
ORACLES = {}


def _query(oracle: str | None = None):
    def keep(make):
        QUERIES[make.__name__] = make
        if oracle:
            ORACLES[make.__name__] = oracle
        return make
    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(mixing.ORACLE)
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(documents).drop("source", "text")


@_query(quality_rules.ORACLE)
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_table(spark, sf_dir, "documents")).drop("failed")


@_query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxic.toxicity(documents, _table(spark, sf_dir, "labels")).drop("text")


@_query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of pieces, a digest of their ids, and whether decoding gives the text back."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(SENTENCEPIECE)
    both = pieces.both_ways(documents, path)
    # The format writes a blank and its own marker alike.
    text = F.translate(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
                       (F.col("decoded") == text).alias("round_trip"))


@_query()
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(_table(spark, sf_dir, "documents"))


@_query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(BYTE_BPE)
    return tokencount.counted(documents, path, TOKEN_LIMIT).drop("text")


@_query()
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@_query()
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(_table(spark, sf_dir, "pages"))


@_query()
def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.counted(_table(spark, sf_dir, "documents"), lines.ANY)


@_query()
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.scored(_table(spark, sf_dir, "documents"))


@_query(interaction.ORACLE)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query()
def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal(_table(spark, sf_dir, "documents"))


@_query(ranked.ORACLE)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
