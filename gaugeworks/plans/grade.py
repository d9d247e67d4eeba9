"""Grading end to end: judge replies and unit results in, scores and rewards out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.functions.udfs import last_rating
from gaugeworks.operators import grading


def grade(lines: DataFrame, replies: DataFrame, tests: DataFrame, states: DataFrame) -> dict[str, DataFrame]:
    """`lines` (run_id, line_no, title, weight, type), `replies` (run_id, line_no, reply, refused),
    `tests` (run_id, name, status, message, weight), `states` (run_id, judge_state, unit_state)."""
    rated = replies.select("run_id", "line_no", "refused", last_rating("reply").alias("r")).select(
        "run_id", "line_no", "refused", "r.status", "r.score", "r.justification")
    graded = grading.graded(lines.join(rated, ["run_id", "line_no"], "left"))
    weighted = grading.with_test_weights(tests)
    scores, points = grading.run_scores(graded), grading.unit_points(weighted)
    return {"lines": graded, "scores": scores, "points": points,
            "rewards": grading.combined_reward(scores, points, states),
            "report": grading.report_counts(grading.report_rows(graded, weighted)),
            "kinds": grading.kind_counts(graded), "fired": grading.fired_counts(graded)}
