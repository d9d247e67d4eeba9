"""Chronological splits, regimes, eligibility and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.operators.series import exact_quantiles

# Shares of a series: the reference year layout 8760/8760/4380/4380 of 26,280 rows.
SPLITS = (("TRAIN", 0, 8760), ("VALIDATION", 8760, 17520),
          ("TEST_PRE_SHIFT", 17520, 21900), ("TEST_SHIFTED", 21900, 26280))
SPLIT_BASE = 26280


def split_of(pos: Column, rows: Column) -> Column:
    """The split of a row position, the boundaries scaled to the series' length."""
    out, rows = F, rows.cast("bigint")
    for name, _, end in SPLITS[:-1]:
        out = out.when(pos * SPLIT_BASE < rows * end, F.lit(name))
    return out.otherwise(F.lit(SPLITS[-1][0]))


def with_split(df: DataFrame, by: str = "series_id") -> DataFrame:
    rows = df.groupBy(by).agg(F.count("*").alias("_rows"))
    return (df.join(rows, by).withColumn("split", split_of(F.col("pos"), F.col("_rows")))
            .drop("_rows"))


def phase_of(split: Column) -> Column:
    return F.when(split == "TEST_PRE_SHIFT", "PRE_SHIFT").when(
        split == "TEST_SHIFTED", "SHIFTED")


def eligible() -> Column:
    """Firm delivery under normal telemetry."""
    return ((F.col("product_type") == "FIRM_DAY_AHEAD")
            & (F.col("telemetry_status") == "NORMAL"))


def regime(price: Column, std: Column, spike: float | Column, volatile: float | Column) -> Column:
    spike = spike if isinstance(spike, Column) else F.lit(float(spike))
    volatile = volatile if isinstance(volatile, Column) else F.lit(float(volatile))
    return (F.when(price >= spike, "SPIKE").when(std >= volatile, "VOLATILE")
            .otherwise("NORMAL"))


def thresholds(df: DataFrame, rows: int, limit: int = 1_000_000) -> dict[str, tuple[float, float]]:
    """(P95 price, P80 deviation) frozen on TRAIN, and the leaked pair off TEST_SHIFTED.

    Four scalars: what a threshold table records and every later step applies.
    `rows` is the size of the table, which decides how they are found.
    """
    if rows <= limit:
        return {r["threshold_id"]: (r["spike_threshold"], r["volatile_threshold"])
                for r in threshold_table(df).collect()}
    out = {}
    for name, part in (("FROZEN_PRE_SHIFT", "TRAIN"), ("LEAKED_POST_SHIFT", "TEST_SHIFTED")):
        rows = df.where(F.col("split") == part)
        out[name] = (exact_quantiles(rows, "price_usd_mwh", [0.95])[0],
                     exact_quantiles(rows, "roll_price_std_24", [0.80])[0])
    return out


def threshold_table(df: DataFrame) -> DataFrame:
    """The threshold record as one aggregate, for inputs an exact percentile can hold."""
    part = F.when(F.col("split") == "TRAIN", "FROZEN_PRE_SHIFT").when(
        F.col("split") == "TEST_SHIFTED", "LEAKED_POST_SHIFT")
    return (df.withColumn("threshold_id", part).where("threshold_id IS NOT NULL")
            .groupBy("threshold_id")
            .agg(F.percentile("price_usd_mwh", F.lit(0.95)).alias("spike_threshold"),
                 F.percentile("roll_price_std_24", F.lit(0.80)).alias("volatile_threshold"))
            .withColumn("is_governing_standard", F.col("threshold_id") == "FROZEN_PRE_SHIFT"))


def split_manifest(df: DataFrame) -> DataFrame:
    """Bounds and rows of each split, and of the two test halves together."""
    named = F.when(F.col("split").startswith("TEST"), F.array("split", F.lit("TEST_FULL"))
                   ).otherwise(F.array("split"))
    return (df.withColumn("split", F.explode(named)).groupBy("series_id", "split")
            .agg(F.min("pos").alias("start_hour"), F.max("pos").alias("end_hour"),
                 F.count("*").alias("count"), F.min("ts").alias("start_ts"),
                 F.max("ts").alias("end_ts")))


def dataset_manifest(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), F.min("ts").alias("start_timestamp"),
        F.max("ts").alias("end_timestamp"),
        F.array_join(F.array_sort(F.collect_set("zone")), ",").alias("zones"),
        F.array_join(F.array_sort(F.collect_set("product_type")), ",").alias("products"),
        F.round(F.avg("price_usd_mwh"), 2).alias("price_mean_usd"),
        F.round(F.stddev_samp("price_usd_mwh"), 2).alias("price_std_usd"),
        F.min("price_usd_mwh").alias("price_min_usd"),
        F.max("price_usd_mwh").alias("price_max_usd"))
