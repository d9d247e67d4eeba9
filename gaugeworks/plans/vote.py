"""A blind vote end to end: checked statements and cast votes in, what it comes to out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeworks.operators import votes as vo


def decide(statements: DataFrame, cast: DataFrame, slots: list[str], tasks: DataFrame,
           seed: str = "") -> dict[str, DataFrame]:
    merged = vo.merged_statements(statements)
    ballot = vo.ballots(merged, seed)
    outcome = vo.vote_outcome(vo.filled_votes(ballot, slots, cast), cast, slots)
    held = merged.join(outcome.select("task_id", "statement_id", "confirmed"), ["task_id", "statement_id"], "left")
    return {"statements": held, "outcome": outcome, "decoys": vo.decoys_called(outcome),
            "consistency": vo.consistency(held, tasks)}
