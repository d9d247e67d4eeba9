"""Forecast error metrics by segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

REGIME_ORDER = ("NORMAL", "VOLATILE", "SPIKE")


def wmape(actual: Column, predicted: Column) -> Column:
    scale = F.sum(F.abs(actual))
    return F.when(scale > 0, F.sum(F.abs(actual - predicted)) / scale).otherwise(F.lit(0.0))


def r_squared(actual: Column, predicted: Column) -> Column:
    """One minus the share of variance left; a constant target gives 1 or 0."""
    err = actual - predicted
    left, spread = F.sum(err * err), F.var_pop(actual) * F.count(actual)
    return (F.when(F.count(actual) < 2, F.lit(None).cast("double"))
            .when(spread > 0, 1 - left / spread)
            .when(left == 0, 1.0).otherwise(0.0))


def error_metrics(actual: str = "actual_price", predicted: str = "predicted_price",
                  digits: int | None = 4) -> list[Column]:
    y, p = F.col(actual), F.col(predicted)
    err = y - p
    found = {"MAE": F.avg(F.abs(err)), "RMSE": F.sqrt(F.avg(err * err)),
             "WMAPE": wmape(y, p), "R2": r_squared(y, p)}
    cut = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return [cut(c).alias(n) for n, c in found.items()] + [F.count(y).alias("count")]


def by_segment(df: DataFrame, keys: list[str], digits: int | None = 4, **columns) -> DataFrame:
    return df.groupBy(*keys).agg(*error_metrics(digits=digits, **columns))


def by_segment_sets(df: DataFrame, fixed: list[str], segments: list[str],
                    digits: int | None = 4, **columns) -> DataFrame:
    """Overall, per segment and per combination in one pass, as grouping sets."""
    sets = [[]]
    for s in segments:
        sets = sets + [had + [s] for had in sets]
    keys = [*fixed, *segments]
    sets = [[F.col(c) for c in [*fixed, *s]] for s in sets]
    return (df.groupingSets(sets, *[F.col(k) for k in keys])
            .agg(*error_metrics(digits=digits, **columns), F.grouping_id().alias("level")))


def composition_effect(df: DataFrame, zone: str = "zone", phase: str = "split_phase",
                       digits: int = 6) -> DataFrame:
    """How far a change of WMAPE between phases is mix and how far it is within zones.

    A zone's weight is its share of the phase's absolute price volume. The mix
    term moves the weight at the earlier error, the within term moves the error
    at the later weight; the two sum to the change of the overall WMAPE.
    """
    y, p = F.col("actual_price"), F.col("predicted_price")
    parts = df.groupBy("model_name", zone, phase).agg(
        F.sum(F.abs(y)).alias("volume"), F.sum(F.abs(y - p)).alias("error"))
    wide = parts.groupBy("model_name", zone).pivot(phase, ["PRE_SHIFT", "SHIFTED"]).agg(
        F.first("volume").alias("volume"), F.first("error").alias("error")).fillna(0.0)
    totals = wide.groupBy("model_name").agg(F.sum("PRE_SHIFT_volume").alias("v0"),
                                            F.sum("SHIFTED_volume").alias("v1"))
    joined = wide.join(totals, "model_name")
    w0 = F.col("PRE_SHIFT_volume") / F.col("v0")
    w1 = F.col("SHIFTED_volume") / F.col("v1")
    m0 = F.try_divide("PRE_SHIFT_error", "PRE_SHIFT_volume")
    m1 = F.try_divide("SHIFTED_error", "SHIFTED_volume")
    m0, m1 = F.coalesce(m0, m1), F.coalesce(m1, m0)
    return joined.select(
        "model_name", zone, F.round(w0, digits).alias("share_before"),
        F.round(w1, digits).alias("share_after"), F.round(m0, digits).alias("wmape_before"),
        F.round(m1, digits).alias("wmape_after"),
        F.round((w1 - w0) * m0, digits).alias("mix_effect"),
        F.round(w1 * (m1 - m0), digits).alias("within_effect"))
