"""File manifests: what changed, what drifted, and what fits a budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gaugeworks import fixed
from gaugeworks.operators.series import number_rows
from gaugeworks.session import cut_lineage


def diff(given: DataFrame, finished: DataFrame) -> DataFrame:
    """unchanged, changed, new or gone for every path of a run, by digest.

    A path listed without a digest was given and cannot be called changed.
    """
    a = given.select("run_id", "path", F.col("sha256").alias("given_sha"), F.lit(True).alias("_g"))
    b = finished.select("run_id", "path", "sha256")
    state = (F.when(F.col("_g").isNull(), "new").when(F.col("sha256").isNull(), "gone")
             .when(F.coalesce("given_sha", F.lit("")).isin("") | (F.col("given_sha") == F.col("sha256")),
                   "unchanged").otherwise("changed"))
    return a.join(b, ["run_id", "path"], "full_outer").select("run_id", "path", state.alias("state"))


def produced(given: DataFrame, finished: DataFrame) -> DataFrame:
    return diff(given, finished).where("state IN ('new', 'changed')")


def scan(manifest: DataFrame, actual: DataFrame, blocking: DataFrame) -> DataFrame:
    """Manifest entries that are missing or modified, with the tier of each."""
    have = actual.select("run_id", "path", F.col("sha256").alias("actual"))
    held = blocking.select("path").distinct().withColumn("_b", F.lit(True))
    joined = manifest.join(have, ["run_id", "path"], "left").where(
        ~F.col("sha256").eqNullSafe(F.col("actual"))).join(held, "path", "left")
    return joined.select("run_id", "path", F.when(F.coalesce("actual", F.lit("")) == "", "missing")
                         .otherwise("modified").alias("state"),
                         F.when(F.col("_b").isNull(), "recorded").otherwise("blocking").alias("tier"))


def drift(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Keys whose digest moved. Never recorded counts as moved; recorded as absent does not."""
    was = recorded.select("run_id", "key", F.col("sha256").alias("was"), F.lit(True).alias("_r"))
    joined = current.join(was, ["run_id", "key"], "left")
    return joined.where(F.col("_r").isNull() | ~F.col("was").eqNullSafe(F.col("sha256"))).select(
        "run_id", "key")


def exploded(documents: DataFrame, column: str = "manifest") -> DataFrame:
    """(path, sha256) rows of manifests held as a JSON map, bare or under `files`."""
    bare = F.from_json(F.col(column), "map<string,string>")
    nested = F.from_json(F.get_json_object(column, "$.files"), "map<string,string>")
    return documents.select(*[c for c in documents.columns if c != column],
                            F.explode(F.coalesce(nested, bare)).alias("path", "sha256"))


# Files of one run that a single fold takes in their order.
FOLD_FILES = 100_000


def _greedy(sizes, rest: int) -> tuple[list[bool], int]:
    """Which sizes are taken in turn while they fit, and what is left."""
    taken = []
    for size in sizes:
        taken.append(size <= rest)
        rest -= size if taken[-1] else 0
    return taken, rest


def _taken_in_rounds(files: DataFrame, max_total: int, fold_files: int) -> DataFrame:
    """(run_id, path) of the files taken, of (run_id, path, bytes) of runs of any size.

    A run's files lie in chunks of their order. What is larger than the rest of the budget can never be
    taken and goes. Chunks whose running sum fits are taken whole; the first that does not is folded file by
    file, and the next round goes on behind it with what is left. So a task holds one chunk, and there are
    as many rounds as chunks that overflow.
    """
    keys = ["run_id"]
    numbered = number_rows(files, keys, "path", "path", fold_files)
    left = cut_lineage(numbered.select("run_id", "path", "bytes", F.floor(F.col("pos") / fold_files).alias("chunk"),
                                       F.lit(max_total).cast("bigint").alias("rest")))
    kinds = dict(left.dtypes)
    taken = None

    def fold(chunk):
        chunk = chunk.sort_values("path")
        mine, rest = _greedy(chunk["bytes"].tolist(), int(chunk["entry"].iloc[0]))
        out = chunk.loc[mine, ["run_id", "path"]].assign(rest=rest)
        # A chunk nothing of which fits still says what is left.
        return out if len(out) else chunk.head(1)[["run_id"]].assign(path=None, rest=rest)[["run_id", "path", "rest"]]
    while not left.isEmpty():
        fit = left.where("bytes <= rest")
        sums = fit.groupBy("run_id", "chunk", "rest").agg(F.sum("bytes").alias("sum"))
        # One row a chunk.
        upto = sums.withColumn("upto", F.sum("sum").over(Window.partitionBy("run_id").orderBy("chunk")))
        over = cut_lineage(upto.where("upto > rest").groupBy("run_id").agg(
            F.min(F.struct("chunk", (F.col("rest") - F.col("upto") + F.col("sum")).alias("entry"))).alias("x"))
            .select("run_id", F.col("x.chunk").alias("stop"), "x.entry"))
        placed = fit.join(over, "run_id", "left")
        whole = placed.where("stop IS NULL OR chunk < stop").select("run_id", "path")
        folded = cut_lineage(placed.where("chunk = stop").select("run_id", "path", "bytes", "entry").groupBy("run_id").applyInPandas(
            fold, f"run_id {kinds['run_id']}, path string, rest bigint"))
        now = whole.unionByName(folded.where("path IS NOT NULL").select("run_id", "path"))
        taken = now if taken is None else taken.unionByName(now)
        after = folded.groupBy("run_id").agg(F.min("rest").alias("rest"))
        left = cut_lineage(placed.where("chunk > stop").drop("rest", "stop", "entry").join(after, "run_id"))
    return taken


def snapshot(files: DataFrame, max_file: int = fixed.MAX_FILE_BYTES,
             max_total: int = fixed.MAX_TOTAL_BYTES, fold_files: int = FOLD_FILES) -> DataFrame:
    """Which produced files of a run fit its budget, taken greedily in path order.

    A file over its own cap never fits; one that would overflow the total is skipped and later, smaller ones
    may still fit. Runs up to `fold_files` files are folded a run a group, larger ones chunk by chunk; the
    rows are the same. Paths are distinct within a run.
    """
    import pandas as pd

    kind = dict(files.dtypes)["run_id"]
    within = files.where(F.col("bytes") <= max_file).select("run_id", "path", "bytes")
    sizes = within.groupBy("run_id").count()
    small = within.join(sizes.where(F.col("count") <= fold_files), "run_id", "left_semi")

    def fold(run):
        run = run.sort_values("path")
        return run.loc[pd.Series(_greedy(run["bytes"].tolist(), max_total)[0], index=run.index), ["run_id", "path"]]
    taken = small.groupBy("run_id").applyInPandas(fold, f"run_id {kind}, path string")
    large = sizes.where(F.col("count") > fold_files)
    if not large.isEmpty():
        taken = taken.unionByName(_taken_in_rounds(within.join(large, "run_id", "left_semi"), max_total, fold_files))
    marked = files.select("run_id", "path", "bytes").join(taken.withColumn("_kept", F.lit(True)), ["run_id", "path"], "left")
    return marked.select("run_id", "path", F.col("bytes").cast("bigint").alias("bytes"), F.when(F.col("_kept"), "kept").when(
        F.col("bytes") > max_file, "over_file_cap").otherwise("over_total").alias("state"))
