"""Bootstrap intervals of a WMAPE difference between two forecasts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from gaugeworks.operators.series import MAX_ROWS, over_positions

SUMS = ("err_base", "err_cand", "volume")


def error_rows(df: DataFrame) -> DataFrame:
    """(series_id, pos, absolute errors of both forecasts, absolute price)."""
    y = F.col("actual_price")
    return df.select("series_id", "pos", F.abs(y - F.col("baseline_price")).alias("err_base"),
                     F.abs(y - F.col("candidate_price")).alias("err_cand"),
                     F.abs(y).alias("volume"))


def block_replicates(rows: DataFrame, n: int, block_length: int = 24, n_boot: int = 400,
                     seed: int = 42, max_rows: int = MAX_ROWS,
                     window_block: int = 65_536) -> DataFrame:
    """Sums per replicate of the moving-block bootstrap, each series drawn to its own length.

    The sum of a block is a forward frame computed once for every start, so a
    replicate is n / L lookups by start rather than n rows. The last block of a
    series is cut to its n rows; only its rows are looked up one by one. `n` is the
    row count of the longest series or more. What a sequence grows to no plan knows in
    advance, so draws are shuffled before they are joined: else, as so many replicates,
    they pass for small and are sent whole to the driver.
    """
    size = F.least(F.lit(block_length).cast("bigint"), F.col("_n"))
    sizes = (rows.groupBy("series_id").agg(F.count("*").alias("_n"))
             .withColumn("_size", size).withColumn("_blocks", F.ceil(F.col("_n") / F.col("_size")))
             .withColumn("_tail", F.col("_n") - (F.col("_blocks") - 1) * F.col("_size")))
    frames = {f"{c}_full": lambda w, c=c: F.sum(c).over(w.rowsBetween(0, block_length - 1)) for c in SUMS}
    summed = over_positions(rows, ["series_id"], frames, after=block_length - 1,
                            block=window_block, max_rows=max_rows, longest=n)
    spread = (sizes.withColumn("replicate", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_boot - 1).cast("bigint"))))
              .repartition("series_id", "replicate")
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))))
    basis = F.concat_ws("|", F.lit(seed), F.col("replicate"), F.col("block"))
    draws = spread.withColumn("pos", F.conv(F.substring(F.md5(basis), 1, 12), 16, 10).cast("bigint")
                              % (F.col("_n") - F.col("_size") + 1))
    last = F.col("block") == F.col("_blocks") - 1
    whole = draws.where(~last).repartition("series_id", "pos").join(summed, ["series_id", "pos"]).select(
        "replicate", *[F.col(f"{c}_full").alias(c) for c in SUMS])
    ends = draws.where(last).withColumn("pos", F.explode(F.sequence("pos", F.col("pos") + F.col("_tail") - 1)))
    tail = ends.repartition("series_id", "pos").join(rows, ["series_id", "pos"]).select("replicate", *SUMS)
    return whole.unionByName(tail).groupBy("replicate").agg(*[F.sum(c).alias(c) for c in SUMS])


def iid_replicates(rows: DataFrame, n: int, n_boot: int = 400, seed: int = 42,
                   block: int = 16_384) -> DataFrame:
    """Sums per replicate of n independent draws with replacement.

    How many draws fall in each position block is drawn first, one multinomial
    per replicate; each block then draws that many of its own rows. The counts
    are the ones a single multinomial over all rows has, exactly n a replicate,
    and no draw is ever shuffled.
    """
    blocks = -(-n // block)
    spark = rows.sparkSession

    def split_draws(batches):
        for batch in batches:
            out = []
            for r in batch["id"]:
                sizes = np.full(blocks, block, dtype="float64")
                sizes[-1] = n - block * (blocks - 1)
                counts = np.random.default_rng([seed, int(r)]).multinomial(n, sizes / n)
                out.append(pd.DataFrame({"_block": np.arange(blocks), "replicate": r,
                                         "draws": counts}))
            yield pd.concat(out) if out else pd.DataFrame(
                {"_block": [], "replicate": [], "draws": []})

    plan = spark.range(n_boot).mapInPandas(
        split_draws, "_block bigint, replicate bigint, draws bigint")
    # One running place over all series, so that every row can be drawn.
    before = rows.groupBy("series_id").agg(F.count("*").alias("_n")).withColumn("_ahead", F.coalesce(F.sum("_n").over(
        Window.orderBy("series_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = (rows.join(before.select("series_id", "_ahead"), "series_id")
              .withColumn("pos", F.col("pos") + F.col("_ahead")).drop("_ahead")
              .withColumn("_block", F.floor(F.col("pos") / block)))

    def resample(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        values = left.sort_values("pos")[list(SUMS)].to_numpy()
        out = np.zeros((len(right), len(SUMS)))
        for i, (r, k) in enumerate(zip(right["replicate"], right["draws"])):
            rng = np.random.default_rng([seed, int(r), int(key[0]) + 1])
            picks = np.bincount(rng.integers(0, len(values), int(k)), minlength=len(values))
            out[i] = picks @ values
        result = pd.DataFrame(out, columns=list(SUMS))
        result.insert(0, "draws", right["draws"].to_numpy())
        result.insert(0, "replicate", right["replicate"].to_numpy())
        return result

    partial = (placed.groupBy("_block").cogroup(plan.groupBy("_block")).applyInPandas(
        resample, "replicate bigint, draws bigint, err_base double, err_cand double, "
                  "volume double"))
    return partial.groupBy("replicate").agg(
        F.sum("draws").alias("draws"), *[F.sum(c).alias(c) for c in SUMS])


def interval(replicates: DataFrame, point: DataFrame, method: str, block_length: int,
             n_boot: int) -> DataFrame:
    """Point estimates and 95 % percentile intervals of the absolute and relative gain."""

    def gains(df: DataFrame) -> DataFrame:
        base, cand = (F.when(F.col("volume") > 0, F.col(c) / F.col("volume")).otherwise(0.0)
                      for c in ("err_base", "err_cand"))
        return df.select(base.alias("base"), cand.alias("cand"), (base - cand).alias("diff"),
                         F.when(base > 0, (base - cand) / base * 100).otherwise(0.0).alias("rel"))

    ci = gains(replicates).agg(*[
        F.round(F.percentile(c, F.lit(q)), 6).alias(n) for c, q, n in (
            ("diff", 0.025, "ci_abs_lower_95"), ("diff", 0.975, "ci_abs_upper_95"),
            ("rel", 0.025, "ci_rel_lower_95_pct"), ("rel", 0.975, "ci_rel_upper_95_pct"))])
    at = gains(point.agg(*[F.sum(c).alias(c) for c in SUMS])).select(
        F.round("cand", 6).alias("candidate_wmape"), F.round("base", 6).alias("baseline_wmape"),
        F.round("diff", 6).alias("abs_diff_point"), F.round("rel", 6).alias("rel_imp_point_pct"))
    # Both sides are single aggregate rows.
    one = F.lit(1).alias("_one")
    return at.select("*", one).join(ci.select("*", one), "_one").drop("_one").select(
        "*", F.lit(method).alias("method"), F.lit(block_length).alias("block_length"),
        F.lit(n_boot).alias("n_replicates"))
