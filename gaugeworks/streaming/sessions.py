"""Token use of running sessions, followed as their logs grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.operators.transcripts import prompt_size
from gaugeworks.sources.transcripts import SESSION_SCHEMA, session_rows

KINDS = ("input_tokens", "cache_creation_input_tokens", "cache_read_input_tokens", "output_tokens")


def session_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Session log lines as they arrive, parsed; a run is the folder its log is in."""
    lines = (spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
             .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").text(folder))
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return session_rows(lines.select(run.alias("run_id"), F.col("value").alias("line")))


def running_totals(sessions: DataFrame, late: str = "1 hour") -> DataFrame:
    """Tokens by kind and the largest prompt of each run so far, a message counted once.

    A message's records share its usage, so later ones within the watermark are
    dropped; records without an id are told apart by their own content.
    """
    used = sessions.where("has_usage").withColumn("at", F.to_timestamp("timestamp"))
    ident = F.when(F.col("message_id") == "", F.sha2(F.concat_ws(
        "|", "timestamp", *[F.col(k).cast("string") for k in KINDS], F.to_json("content")), 256)).otherwise(
        F.col("message_id"))
    once = (used.withColumn("ident", ident).withWatermark("at", late)
            .dropDuplicatesWithinWatermark(["run_id", "ident"]))
    return once.groupBy("run_id").agg(*[F.sum(k).alias(k) for k in KINDS], F.max(prompt_size()).alias("context_peak"))


__all__ = ["SESSION_SCHEMA", "running_totals", "session_stream"]
