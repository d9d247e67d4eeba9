"""Rules that tie label answers to each other, to the criteria and to the prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx


def markdown_kinds(text: Column) -> Column:
    body = tx.strip_comments(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(body.rlike(p), F.lit(n))
                                     for n, p in fixed.MARKDOWN_MARKS]))


def cross_field_problems(labels: DataFrame) -> DataFrame:
    """Codes of the rules a label row breaks; `cannot_know` says whether that section is written."""
    under, level = F.col("underspecified_task"), F.col("underspecification_level")
    chosen = F.coalesce("model_failure_category", F.array().cast("array<string>"))
    prose = F.col("model_failure_justification")
    early = F.array_contains(chosen, "grounding") | F.array_contains(chosen, "exploration")
    codes = F.array_compact(F.array(
        F.when((under == "yes") & level.isNotNull() & (level != fixed.FULL_LEVEL), "level not full"),
        F.when((under == "no") & (level == fixed.FULL_LEVEL), "level full"),
        F.when((under == "yes") & ~F.col("cannot_know"), "nothing unknowable written"),
        F.when((under == "no") & F.col("cannot_know"), "unknowable written"),
        F.when(F.array_contains(chosen, "correctness_reasoning") & early, "reasoning beside earlier failure"),
        F.when(F.size(markdown_kinds(prose)) > 0, "failure prose has markdown"),
        F.when(tx.sentence_count(prose) > fixed.MAX_FAILURE_SENTENCES, "failure prose too long")))
    return labels.withColumn("problems", codes)


def clarification_agreement(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """Whether the clarification lines agree with the first label; null where they do."""
    total = F.coalesce("clarification_total", F.lit(0))
    positive = F.coalesce("clarification_positive", F.lit(0))
    under = F.col("underspecified_task")
    return labels.join(counts, "run_id", "left").select(
        "run_id", F.when((under == "no") & (total > 0), "lines on a task that is not underspecified")
        .when((under == "yes") & (positive == 0), "no line says the gap was raised").alias("problem"))


def length_check(texts: DataFrame) -> DataFrame:
    """Words and paragraphs of a justification against the hard limit and its level's guide."""
    return length_finding(texts.select("*", tx.word_count(tx.prose(F.col("text"))).alias("words"),
                                       tx.paragraph_count(F.col("text")).alias("paragraphs")))


def length_finding(sized: DataFrame) -> DataFrame:
    """The same of counted texts (level, words, paragraphs)."""
    long = (F.col("words") > fixed.MAX_JUSTIFICATION_WORDS) | (
        F.col("paragraphs") > fixed.MAX_JUSTIFICATION_PARAGRAPHS)
    over = F.lit(False)
    for level, (most_paragraphs, most_words) in fixed.LENGTH_GUIDE.items():
        over = over | ((F.col("level") == level) & (
            (F.col("paragraphs") > most_paragraphs) | (F.col("words") > most_words)))
    return sized.withColumn("finding", F.when(long, "too_long").when(over, "longer_than_needed"))
