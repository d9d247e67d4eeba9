"""What a run's score would be under other verdicts or weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions.text import squeeze
from gaugeworks.operators.series import (MAX_ROWS, longest_series, number_rows,
                                         over_positions, running_sum)
from gaugeworks.session import cut_lineage


def tally(lines: DataFrame) -> DataFrame:
    """Signed points earned and marks available per run, over the scored lines."""
    w, v = F.col("weight"), F.col("verdict")
    zero = F.lit(0).cast("bigint")
    earned = F.when((w > 0) & (v == "PASS"), w).when((w < 0) & (v == "FAIL"), w)
    return lines.groupBy("run_id").agg(
        F.coalesce(F.sum(earned), zero).alias("earned"),
        F.coalesce(F.sum(F.when((w > 0) & (v != "UNSCORED"), w)), zero).alias("of"))


def sensitivity(lines: DataFrame, combined: DataFrame | None = None,
                bar: float = fixed.REWARD_BAR) -> DataFrame:
    """The single penalties whose reversal would put a run at the bar or over it.

    `combined` carries (run_id, score, of) where unit tests share the total.
    """
    totals = tally(lines)
    if combined is not None:
        totals = totals.join(combined.where("of > 0").select(
            "run_id", F.col("score").alias("_score"), F.col("of").alias("_of")), "run_id", "left")
        totals = totals.select("run_id", F.coalesce("_score", "earned").alias("earned"),
                               F.coalesce("_of", "of").alias("of"))
    penalised = lines.where("verdict = 'FAIL'")
    gained = F.greatest(F.lit(0), F.col("earned") + F.abs("weight")) / F.col("of")
    return (penalised.join(totals.where("of > 0"), "run_id").withColumn("_gained", gained)
            .where(F.col("_gained") >= bar)
            .select("run_id", "line_no", F.trim("title").alias("criterion"), "weight",
                    F.round("_gained", 4).alias("reward_if_reversed")))


def flips_in_order(flips: DataFrame) -> DataFrame:
    return flips.orderBy(F.desc("reward_if_reversed"), "run_id", "line_no")


def with_fixes(lines: DataFrame, weights: DataFrame, dropped: DataFrame,
               combined: DataFrame | None = None) -> DataFrame:
    """The reward with some lines reweighted and some taken out, matched by text.

    The unit tests' share of `combined` (run_id, score, of) is carried unchanged.
    """
    keyed = lines.withColumn("_text", squeeze(F.col("title")))
    new = weights.select("run_id", squeeze(F.col("title")).alias("_text"),
                         F.col("weight").alias("_new")).distinct()
    gone = dropped.select("run_id", squeeze(F.col("title")).alias("_text")).distinct()
    changed = (keyed.join(gone, ["run_id", "_text"], "left_anti")
               .join(new, ["run_id", "_text"], "left")
               .withColumn("weight", F.coalesce("_new", "weight")))
    before = tally(lines).select("run_id", F.col("earned").alias("_b_earned"),
                                 F.col("of").alias("_b_of"))
    after = before.join(tally(changed), "run_id", "left").fillna(0, ["earned", "of"])
    if combined is not None:
        after = after.join(combined.select("run_id", F.col("score").alias("_score"),
                                           F.col("of").alias("_of")), "run_id", "left")
        after = (after.withColumn("earned", F.col("earned") + F.coalesce(
            F.col("_score") - F.col("_b_earned"), F.lit(0)))
            .withColumn("of", F.col("of") + F.coalesce(
                F.col("_of") - F.col("_b_of"), F.lit(0))))
    return after.select("run_id", F.when(F.col("of") > 0, F.round(
        F.greatest(F.lit(0), F.col("earned")) / F.col("of"), 4)).alias("reward"))


def below_bar(rewards: DataFrame, bar: float = fixed.REWARD_BAR) -> DataFrame:
    return rewards.where(F.col("reward") < bar)


def latest_earlier(grades: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The grade just before each grade of the same job (an as-of self join)."""
    longest = longest_series(grades, ["job"])
    placed = number_rows(grades, ["job"], "at", "grade_id", max_rows, longest)
    return over_positions(placed, ["job"], {
        "earlier_at": lambda w: F.lag("at").over(w),
        "earlier_reward": lambda w: F.lag("reward").over(w)}, before=1, max_rows=max_rows,
        longest=longest).drop("pos")


def line_digest(lines: DataFrame) -> DataFrame:
    """How many lines a grade has and a digest of their set of texts.

    The digest adds up hashes of distinct texts, so it is combined on the map
    side and no list of lines is ever held in one place.
    """
    texts = lines.select("job", "grade_id", "text").distinct()
    parts = [F.sum(F.conv(F.substring(F.md5("text"), at, 12), 16, 10).cast("decimal(20,0)"))
             for at in (1, 13)]
    return texts.groupBy("job", "grade_id").agg(F.concat_ws(
        "|", F.count("*"), *parts).alias("line_set"))


def weights_only_drops(grades: DataFrame, lines: DataFrame, proposed: DataFrame,
                       bar: float = fixed.REWARD_BAR, max_rows: int = MAX_ROWS) -> DataFrame:
    """Grades that fell under the bar with nothing changed but weights.

    `grades` is (job, grade_id, at, reward), `lines` (job, grade_id, text, weight),
    `proposed` (job, text, weights). An earlier grade of the job at or over the bar
    fits when its lines are the same set and one was weighted differently; a move
    to a proposed weight is none. The latest that fits is given, one row a moved line.

    Grades at or over the bar are ranked within their job and line set. A line's
    weights over those ranks fall into runs, so the last rank that weighs it
    otherwise than a grade does is the grade's own rank, or the one before the run
    that rank is in: one equi join, whatever lies between. The latest over a
    grade's lines is a maximum.
    """
    keyed = grades.join(line_digest(lines), ["job", "grade_id"])
    keys = ["job", "line_set"]
    high = F.col("reward") >= bar
    ranked = cut_lineage(running_sum(keyed, keys, "at", "grade_id", F.when(high, 1).otherwise(0), "_rank", max_rows)
                         .select(*keys, "grade_id", "reward", "_rank"))
    highs = ranked.where(high).select(*keys, "_rank", F.col("grade_id").alias("earlier_id"))
    # A text may stand in a grade more than once; its weights count together.
    weighed = lines.groupBy("job", "grade_id", "text").agg(F.array_sort(F.collect_set("weight")).alias("w"))
    placed = (highs.withColumnRenamed("earlier_id", "grade_id").join(weighed, ["job", "grade_id"])
              .select(*keys, "text", (F.col("_rank") - 1).alias("pos"), "w"))
    placed = cut_lineage(placed)
    line = [*keys, "text"]
    longest = longest_series(placed, line)
    turns = over_positions(placed, line, {"_was": lambda w: F.lag("w").over(w)}, before=1, max_rows=max_rows, longest=longest)
    runs = cut_lineage(running_sum(turns, line, "pos", "pos", F.when(F.col("_was") == F.col("w"), 0).otherwise(1), "_run",
                                   max_rows, longest).select(*line, "pos", "w", "_run"))
    starts = runs.groupBy(*line, "_run").agg(F.min("pos").alias("_start"))
    at_rank = runs.join(starts, [*line, "_run"]).select(
        *line, (F.col("pos") + 1).alias("_rank"), F.col("w").alias("_before"), F.col("_start"))
    unproposed = (lines.select("job", "grade_id", "text", F.col("weight").alias("after")).join(proposed, ["job", "text"], "left")
                  .where(~F.coalesce(F.array_contains("weights", F.col("after")), F.lit(False)))
                  .select("job", "grade_id", "text", "after"))
    asked = ranked.where((F.col("reward") < bar) & (F.col("_rank") > 0)).select(*keys, "grade_id", "_rank").join(
        unproposed, ["job", "grade_id"])
    same = F.col("_before") == F.array("after")
    last = asked.join(at_rank, [*line, "_rank"]).select(
        *keys, "grade_id", F.when(same, F.col("_start")).otherwise(F.col("_rank")).alias("_rank"))
    latest = cut_lineage(last.where("_rank > 0").groupBy(*keys, "grade_id").agg(F.max("_rank").alias("_rank")).join(highs, [*keys, "_rank"]))
    before = lines.select("job", F.col("grade_id").alias("earlier_id"), "text", F.col("weight").alias("before"))
    return (latest.join(unproposed, ["job", "grade_id"]).join(before, ["job", "earlier_id", "text"]).where("before <> after")
            .select("job", "grade_id", "earlier_id", "text", "before", "after"))
