"""Verdicts on one criterion, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gaugeworks import fixed


def status_of(value: Column) -> Column:
    text = F.upper(F.trim(value))
    return F.when(text.isin(*fixed.YES_SPELLINGS), "YES").when(
        text.isin(*fixed.NO_SPELLINGS), "NO")


def score_of(value: Column) -> Column:
    text = F.trim(value)
    low = F.lower(text)
    return (F.when(text.isin(*fixed.ONE_SPELLINGS) | low.isin("yes", "true"), "1")
            .when(text.isin(*fixed.ZERO_SPELLINGS) | low.isin("no", "false"), "0"))


def canonical_verdict(status: Column, score: Column) -> Column:
    """Struct(status, score, mismatch): the status decides, the score is the fallback."""
    by_status = F.when(status_of(status) == "YES", "1").when(status_of(status) == "NO", "0")
    chosen = F.coalesce(by_status, score_of(score))
    mismatch = F.coalesce(by_status != score_of(score), F.lit(False))
    shown = F.when(chosen == "1", "YES").when(chosen == "0", "NO").otherwise(status_of(status))
    return F.struct(shown.alias("status"), chosen.alias("score"), mismatch.alias("mismatch"))


def weight_or_default(weight: Column) -> Column:
    return F.coalesce(weight, F.lit(fixed.DEFAULT_CRITERION_WEIGHT))


def verdict(score: Column, weight: Column) -> Column:
    """PASS, FAIL or UNSCORED: a true statement passes a positive and fails a negative."""
    said_true, negative = score == "1", weight_or_default(weight) < 0
    return (F.when(score.isNull() | ~score.isin("0", "1"), "UNSCORED")
            .when(said_true != negative, "PASS").otherwise("FAIL"))


def kind(first_label: Column, weight: Column) -> Column:
    """The section a line belongs to: its first label, else the sign of its weight."""
    out = None
    for label, name in fixed.KIND_OF_LABEL.items():
        out = (F if out is None else out).when(first_label == label, F.lit(name))
    return out.otherwise(F.when(weight_or_default(weight) < 0, "non-hallucination")
                         .otherwise("completion"))


def unmeasured(score: Column, refused: Column) -> Column:
    """Why a line carries no verdict: refused, no usable score, or null where it has one."""
    return (F.when(refused, "judge_refused")
            .when(score.isNull() | ~score.isin("0", "1"), "judge_no_score"))
