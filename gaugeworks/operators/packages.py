"""Installs and dead ends in what runs executed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx


def package_base(spec: Column) -> Column:
    """A package's name without its version."""
    return F.lower(F.trim(F.get(F.split(spec, "[=<>!~]", 2), 0)))


def _names(args: Column) -> Column:
    """Package names of an argument list: flags, their values, paths and files dropped."""
    tokens = F.transform(F.filter(F.split(F.trim(args), r"\s+"), lambda t: t != ""),
                         lambda t: F.regexp_replace(t, "^[\"']+|[\"']+$", ""))
    empty = F.struct(F.array().cast("array<string>").alias("names"), F.lit(False).alias("skip"))

    def step(acc: Column, token: Column) -> Column:
        takes = token.isin(*fixed.FLAGS_WITH_VALUES)
        drop = (acc["skip"] | takes | token.startswith("-") | token.rlike(r"^[./]")
                | token.rlike(r"\.(?:txt|whl|tar\.gz)$") | ~token.rlike(fixed.PACKAGE_NAME))
        return F.struct(
            F.when(drop, acc["names"]).otherwise(F.concat(acc["names"], F.array(token))).alias("names"),
            (~acc["skip"] & takes).alias("skip"))

    return F.aggregate(tokens, empty, step, lambda acc: acc["names"])


def installs(commands: DataFrame, column: str = "text") -> DataFrame:
    """(run_id, ecosystem, spec) of every package a run installed, each once."""
    found = F.flatten(F.array(*[
        F.transform(
            F.flatten(F.transform(F.regexp_extract_all(
                column, F.lit(fixed.COMMAND_START + verb + "(" + fixed.COMMAND_STOP + ")"), F.lit(1)),
                _names)),
            lambda n: F.struct(F.lit(eco).alias("ecosystem"), n.alias("spec")))
        for eco, verb in fixed.INSTALL_VERBS]))
    return commands.select("run_id", F.inline(found)).distinct()


def refused_packages(rows: DataFrame) -> DataFrame:
    """Packages a manager said it does not have, lower-cased."""
    found = F.flatten(F.array(*[F.regexp_extract_all("text", F.lit(p), F.lit(1))
                                for p, _, names in fixed.HARD_DEAD_ENDS if names]))
    return rows.select("run_id", F.explode(F.transform(found, F.lower)).alias("package")).distinct()


def dead_ends(rows: DataFrame, installed: DataFrame) -> DataFrame:
    """What a run reached for and never got, as notes.

    A missing module or command only counts while nothing of that name was
    installed, or while a manager also refused it.
    """
    def notes(pattern: str, head: str, tail: str, named: bool) -> Column:
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(1))
        return F.transform(hits, lambda h: F.struct(
            F.lower(h).alias("name"),
            (F.concat(F.lit(head), h, F.lit(tail)) if named else F.lit(head)).alias("note")))

    hard = F.flatten(F.array(*[notes(p, said, "", said.endswith(" "))
                               for p, said, _ in fixed.HARD_DEAD_ENDS]))
    soft = F.flatten(F.array(*[notes(p, head, tail, True) for p, head, tail in fixed.SOFT_DEAD_ENDS]))
    refused = rows.select("run_id", F.inline(hard)).distinct()
    missing = rows.select("run_id", F.inline(soft)).distinct().withColumn(
        "name", F.get(F.split("name", r"\."), 0))
    got = installed.select("run_id", package_base(F.col("spec")).alias("name")).distinct().join(
        refused.select("run_id", "name"), ["run_id", "name"], "left_anti")
    still = missing.join(got, ["run_id", "name"], "left_anti")
    return refused.select("run_id", "note").unionByName(still.select("run_id", "note")).distinct()


def undeclared(installed: DataFrame, recorded: DataFrame, refused: DataFrame) -> DataFrame:
    """Installed packages that are not declared and were not proved missing."""
    mine = installed.withColumn("package", package_base(F.col("spec")))
    known = recorded.select("run_id", "ecosystem", package_base(F.col("spec")).alias("package")).distinct()
    return (mine.join(known, ["run_id", "ecosystem", "package"], "left_anti")
            .join(refused, ["run_id", "package"], "left_anti"))


def environment_digest(packages: DataFrame, blocked: DataFrame) -> DataFrame:
    """One digest of the sorted packages and blocked names of each task.

    A task declares packages by hand, so its sorted list is small; the digest
    is taken over JSON so that neither list can run into the other.
    """
    pk = packages.groupBy("run_id").agg(F.array_sort(F.collect_list(
        F.concat_ws(" ", "ecosystem", "spec"))).alias("packages"))
    bl = blocked.groupBy("run_id").agg(F.array_sort(F.collect_list("domain")).alias("blocked"))
    none = F.array().cast("array<string>")
    return pk.join(bl, "run_id", "full_outer").select("run_id", F.sha2(F.to_json(F.struct(
        F.coalesce("blocked", none).alias("blocked"),
        F.coalesce("packages", none).alias("packages"))), 256).alias("environment_sha256"))
