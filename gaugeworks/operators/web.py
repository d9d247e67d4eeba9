"""Web requests of runs and blocked hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx


def web_requests(calls: DataFrame) -> DataFrame:
    """Calls that went to the web: by tool name, or a shell command with a host."""
    hosts = tx.hosts_in(F.col("argument"))
    by_name = F.col("tool").rlike(fixed.WEB_TOOL)
    shell = F.col("argument").rlike(fixed.WEB_COMMAND) | F.col("tool").rlike(fixed.WEB_COMMAND)
    return (calls.withColumn("hosts", F.array_sort(hosts))
            .where(by_name | (shell & (F.size("hosts") > 0))))


def hosts_reached(requests: DataFrame) -> DataFrame:
    """Hosts per run, and whether anything came back from them."""
    return (requests.select("run_id", F.explode("hosts").alias("host"),
                            (F.coalesce("result", F.lit("")) != "").alias("_back"))
            .groupBy("run_id", "host").agg(F.bool_or("_back").alias("answered")))


def blocked_hosts_reached(reached: DataFrame, blocked: DataFrame) -> DataFrame:
    """Reached hosts that are on the run's block list, themselves or by a parent domain.

    A host has a handful of parents; they are listed and joined by equality.
    """
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    listed = blocked.select("run_id", F.lower("domain").alias("domain")).distinct()
    return (reached.withColumn("domain", F.explode(parents)).join(listed, ["run_id", "domain"])
            .groupBy("run_id", "host", "answered").agg(F.count("*").alias("rules_hit")))


def request_counts(requests: DataFrame) -> DataFrame:
    return requests.groupBy("run_id").agg(F.count("*").alias("requests"))


def browsing_label(labels: DataFrame, counts: DataFrame, measured: DataFrame) -> DataFrame:
    """The browsing label held against what the run did; null where it is not known.

    `measured` lists the runs whose requests could be read at all.
    """
    joined = (labels.join(measured.select("run_id", F.lit(True).alias("_read")), "run_id", "left")
              .join(counts, "run_id", "left"))
    made = F.coalesce("requests", F.lit(0)) > 0
    said = F.col("browsing_required")
    note = (F.when(F.col("_read").isNull() | ~said.isin("yes", "no"), F.lit(None))
            .when((said == "no") & made, "label says no and the run made requests")
            .when((said == "yes") & ~made, "label says yes and the run made no request"))
    return joined.select("run_id", "browsing_required",
                         F.coalesce("requests", F.lit(0).cast("bigint")).alias("requests"),
                         note.alias("note"))
