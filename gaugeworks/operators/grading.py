"""Scores of graded runs.

A line of a graded run is (run_id, line_no, title, weight, type, status, score,
refused). Everything per run is one aggregate of conditional sums, so a run that
holds a third of all lines is combined on the map side like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx, verdicts as vd


def graded(lines: DataFrame) -> DataFrame:
    """Canonical status and score, verdict, kind and the reason a line has no verdict."""
    found = lines.select("*", vd.canonical_verdict(F.col("status"), F.col("score"))
                         .alias("_canon"))
    score = F.when(F.coalesce(F.col("refused"), F.lit(False)), F.lit(None)).otherwise(
        F.col("_canon.score"))
    return found.select(
        *[c for c in lines.columns if c not in ("status", "score", "weight")],
        vd.weight_or_default(F.col("weight")).alias("weight"),
        F.col("_canon.status").alias("status"), score.alias("score"),
        F.col("_canon.mismatch").alias("status_score_mismatch")).select(
        "*", vd.verdict(F.col("score"), F.col("weight")).alias("verdict"),
        vd.kind(F.get("type", 0), F.col("weight")).alias("kind"),
        vd.unmeasured(F.col("score"), F.coalesce("refused", F.lit(False))).alias("unmeasured"))


def score_sums() -> dict[str, Column]:
    """The conditional sums a score is made of, over graded lines."""
    w, v = F.col("weight"), F.col("verdict")
    scored, passed = v != "UNSCORED", v == "PASS"
    zero = F.lit(0).cast("bigint")
    total = lambda c: F.coalesce(F.sum(c), zero)
    return {
        "total": F.count("*"), "scored": F.count_if(scored),
        "refused": F.count_if(F.col("unmeasured") == "judge_refused"),
        "passed": F.count_if(passed),
        "max_reward": total(F.when(scored & (w > 0), w)),
        "earned": total(F.when(passed & (w > 0), w)),
        "lost": total(F.when((v == "FAIL") & (w < 0), -w)),
        "weight_all": total(F.abs(w)), "weight_unscored": total(F.when(~scored, F.abs(w))),
    }


def run_scores(lines: DataFrame, keys: list[str] | None = None, digits: int = 4) -> DataFrame:
    """The score of each run and the counts it came from.

    Positive lines put up the marks; a negative line only takes its weight off
    when its statement is true. The rate is floored at 0, the score is not. Lost
    coverage weighs every unscored line by its absolute weight.
    """
    keys = keys or ["run_id"]
    sums = lines.groupBy(*keys).agg(*[c.alias(n) for n, c in score_sums().items()])
    score = F.col("earned") - F.col("lost")
    return sums.select(
        *keys, "total", "scored", (F.col("total") - F.col("scored")).alias("unscored"),
        "refused",
        F.round(F.coalesce(F.try_divide("weight_unscored", "weight_all"), F.lit(0.0)), digits)
        .alias("coverage_lost"),
        "passed", "max_reward", "earned", "lost", score.alias("agent_score"),
        F.greatest(F.lit(0.0), F.coalesce(F.try_divide(score, F.col("max_reward")), F.lit(0.0)))
        .alias("rate"),
        F.coalesce(F.try_divide("passed", "scored"), F.lit(0.0)).alias("count_rate"))


def with_test_weights(tests: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Each unit test with its recorded weight, or the default one."""
    if weights is not None:
        tests = tests.drop("weight").join(weights, ["run_id", "name"], "left")
    return tests.withColumn("weight", F.coalesce("weight", F.lit(fixed.DEFAULT_TEST_WEIGHT)))


def unit_points(tests: DataFrame) -> DataFrame:
    """Points a run's unit tests put up and earned, and how they fell out."""
    passed = F.col("status") == "passed"
    return tests.groupBy("run_id").agg(
        F.count("*").alias("unit_total"), F.count_if(passed).alias("unit_passed"),
        F.coalesce(F.sum(F.when(passed, F.col("weight"))), F.lit(0).cast("bigint"))
        .alias("unit_score"), F.sum("weight").alias("unit_max"))


def is_crash(message: Column) -> Column:
    """A failure that is no assertion: what its first line opens with decides."""
    head = tx.strip(F.get(F.split(tx.strip(F.coalesce(message, F.lit(""))), "\n"), 0))
    return ~(head.startswith("AssertionError") | head.startswith("assert"))


def combined_reward(scores: DataFrame, tests: DataFrame, states: DataFrame,
                    digits: int = 4) -> DataFrame:
    """Rubric and unit points on one total, by the state either half ended in.

    `states` carries (run_id, judge_state, unit_state): judge_state is graded,
    unreachable or error; unit_state is ran, skipped or error.
    """
    joined = (states.join(scores, "run_id", "left").join(tests, "run_id", "left"))
    graded_, ran = F.col("judge_state") == "graded", F.col("unit_state") == "ran"
    broken = F.col("unit_state") == "error"
    rubric = F.when(graded_, F.round("rate", digits)).otherwise(F.lit(0.0))
    unit = F.when(ran, F.round(F.coalesce(F.try_divide("unit_score", "unit_max"), F.lit(0.0)),
                               digits)).when(broken, F.lit(0.0))
    of = F.col("max_reward") + F.coalesce("unit_max", F.lit(0))
    score = F.col("agent_score") + F.coalesce("unit_score", F.lit(0))
    both = F.greatest(F.lit(0.0), F.coalesce(F.try_divide(score, of), F.lit(0.0)))
    reward = (F.when(broken, F.lit(0.0)).when(graded_ & ran, F.round(both, digits))
              .otherwise(rubric))
    status = (F.when(broken, "error").when(F.col("judge_state") == "unreachable", "error")
              .when(F.col("judge_state") == "error", "incomplete").otherwise("graded"))
    return joined.select(
        "run_id", rubric.alias("rubrics"), unit.alias("unit_tests"), reward.alias("reward"),
        status.alias("status"), F.when(graded_ & ran, score).alias("combined_score"),
        F.when(graded_ & ran, of).alias("combined_of"))


def report_rows(lines: DataFrame, tests: DataFrame) -> DataFrame:
    """Both halves as flat test-report rows (name, status, message)."""
    outcome = (F.when(F.col("verdict") == "PASS", "passed")
               .when(F.col("verdict") == "FAIL", "failed").otherwise("other"))
    judged = lines.select("run_id", F.col("title").alias("name"), outcome.alias("status"),
                          F.substring(F.coalesce("justification", F.lit("")), 1, 2000)
                          .alias("message"))
    tested = tests.select(
        "run_id", F.concat(F.col("name"), F.lit(" ["), F.col("weight").cast("string"), F.lit("]"))
        .alias("name"),
        F.when(F.col("status") == "passed", "passed").otherwise("failed").alias("status"),
        F.substring(F.coalesce("message", F.lit("")), 1, 2000).alias("message"))
    return judged.unionByName(tested)


def report_counts(report: DataFrame) -> DataFrame:
    known = F.when(F.col("status").isin("passed", "failed"), F.col("status")).otherwise("other")
    return report.groupBy("run_id").agg(
        F.count("*").alias("tests"), *[F.count_if(known == s).alias(s)
                                       for s in ("passed", "failed", "other")])


def kind_counts(lines: DataFrame) -> DataFrame:
    """Lines per first label; negatives a delivery counts; clarification lines."""
    first = F.get("type", 0)
    negative = (F.col("weight") < 0) & F.coalesce(first, F.lit("")).isin("", "hallucination")
    asks = F.coalesce(first == "clarification", F.lit(False))
    return lines.groupBy("run_id").agg(
        *[F.count_if(F.coalesce(first == label, F.lit(False))).alias(name.replace("-", "_"))
          for label, name in fixed.KIND_OF_LABEL.items()],
        F.count_if(first.isNull()).alias("unlabelled"),
        F.count_if(negative).alias("negatives"),
        F.count_if(asks & (F.col("weight") > 0)).alias("clarification_positive"),
        F.count_if(asks).alias("clarification_total"))


def fired_negatives(lines: DataFrame) -> DataFrame:
    """Negative non-hallucination lines with whether they fired; unscored in neither."""
    return (lines.where((F.col("weight") < 0) & (F.col("kind") == "non-hallucination")
                        & (F.col("verdict") != "UNSCORED"))
            .withColumn("fired", F.col("verdict") == "FAIL"))


def fired_counts(lines: DataFrame) -> DataFrame:
    """Negatives written, fired and quiet per run, and whether too many stayed quiet."""
    split = fired_negatives(lines).groupBy("run_id").agg(
        F.count("*").alias("negatives"), F.count_if("fired").alias("fired"),
        F.count_if(~F.col("fired")).alias("quiet"))
    return split.withColumn("over_quiet_cap", F.col("quiet") > fixed.QUIET_CAP)


def duplicate_lines(lines: DataFrame) -> DataFrame:
    """Lines of one run with the same text, by its digest."""
    return (lines.groupBy("run_id", F.md5("title").alias("criterion_id"))
            .agg(F.count("*").alias("copies"), F.min("line_no").alias("first_line"))
            .where("copies > 1"))


def criterion_id(title: Column) -> Column:
    """Digest of a line's text without its leading numbering."""
    return F.md5(F.trim(F.regexp_replace(title, fixed.NUMBERING, "")))


def coverage_over_limit(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("coverage_lost") >= fixed.COVERAGE_LIMIT).select(
        "run_id", "coverage_lost", "unscored", "refused")


def without_dropped(lines: DataFrame, dropped: DataFrame) -> DataFrame:
    """The lines left when the refused texts go; copies of the rest all stay."""
    gone = dropped.select("run_id", F.trim("title").alias("_text")).distinct()
    return (lines.withColumn("_text", F.trim("title"))
            .join(gone, ["run_id", "_text"], "left_anti").drop("_text"))


def graded_against_shipped(graded_lines: DataFrame, shipped: DataFrame) -> DataFrame:
    """Texts that were graded and not shipped, or shipped and not graded."""
    a = graded_lines.select("run_id", F.trim("title").alias("text")).distinct().withColumn(
        "_graded", F.lit(True))
    b = shipped.select("run_id", F.trim("title").alias("text")).distinct().withColumn(
        "_shipped", F.lit(True))
    both = a.join(b, ["run_id", "text"], "full_outer")
    return both.where("_graded IS NULL OR _shipped IS NULL").select(
        "run_id", "text", F.when(F.col("_graded").isNull(), "only_shipped")
        .otherwise("only_graded").alias("side"))


def carried_over(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Confirmed lines whose text and verdict have not moved."""
    held = previous.where("confirmed").select("run_id", "title", "verdict").distinct()
    return current.join(held, ["run_id", "title", "verdict"], "left_semi")


def distinct_checks(counts: DataFrame, repeats: DataFrame) -> DataFrame:
    """Checks less the lines that only repeat another, against the floor."""
    gone = repeats.groupBy("run_id").agg(F.count("*").alias("repeats"))
    out = counts.join(gone, "run_id", "left").withColumn(
        "repeats", F.coalesce("repeats", F.lit(0).cast("bigint")))
    left = F.col("checks") - F.col("repeats")
    return out.withColumn("distinct_checks", left).withColumn(
        "distinct_enough", left >= fixed.CHECK_FLOOR)


def unit_rows_or_recovered(units: DataFrame, report: DataFrame, titles: DataFrame) -> DataFrame:
    """A run's own unit rows; where it has none, report rows that name no criterion."""
    missing = report.join(units.select("run_id").distinct(), "run_id", "left_anti")
    names = titles.select("run_id", F.trim("title").alias("_name")).distinct()
    recovered = (missing.where("name <> 'rubrics'").withColumn("_name", F.trim("name"))
                 .join(names, ["run_id", "_name"], "left_anti")
                 .select("run_id", "name", "status").withColumn("origin", F.lit("report")))
    own = units.select("run_id", "name", "status").withColumn("origin", F.lit("results"))
    return own.unionByName(recovered)


def delivery_gates(scores: DataFrame, kinds: DataFrame, fired: DataFrame, context: DataFrame,
                   rewards: DataFrame) -> DataFrame:
    """The acceptance gates of a run, each its own column; null where not measured."""
    no_score = F.col("unscored") - F.col("refused") == 0
    joined = (scores.join(kinds, "run_id", "left").join(fired, "run_id", "left")
              .join(context, "run_id", "left").join(rewards, "run_id", "left"))
    gates = {
        "gate_all_judged": no_score,
        "gate_coverage": F.col("coverage_lost") < fixed.COVERAGE_LIMIT,
        "gate_negatives": F.coalesce("negatives", F.lit(0)) >= fixed.NEGATIVE_FLOOR,
        "gate_quiet": F.coalesce("quiet", F.lit(0)) <= fixed.QUIET_CAP,
        "gate_context": F.col("context_added") >= fixed.ADDED_CONTEXT_FLOOR,
        "gate_reward": F.coalesce("reward", F.lit(1.0)) < fixed.REWARD_BAR,
    }
    out = joined.select("run_id", *[c.alias(n) for n, c in gates.items()])
    held = None
    for n in gates:
        held = F.col(n) if held is None else held & F.col(n)
    return out.withColumn("deliverable", held)


def proposed_weights(findings: DataFrame) -> DataFrame:
    """Every weight a finding named for a line, by the line's text."""
    return (findings.where("proposed_weight IS NOT NULL")
            .groupBy("run_id", tx.squeeze(F.col("title")).alias("text"))
            .agg(F.collect_set("proposed_weight").alias("weights")))
