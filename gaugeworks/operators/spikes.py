"""Spike detection metrics over threshold and population variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def spike_metrics(threshold: Column, digits: int = 4) -> list[Column]:
    """Confusion-based metrics and errors on actual spikes; 0 where undefined."""
    y, p = F.col("actual_price"), F.col("predicted_price")
    is_spike, said = y >= threshold, p >= threshold
    actual, predicted = F.count_if(is_spike), F.count_if(said)
    hit = F.count_if(is_spike & said)
    err = F.when(is_spike, F.abs(y - p))
    return [
        actual.alias("actual_spikes"), predicted.alias("predicted_spikes"),
        F.round(_ratio(hit, predicted), digits).alias("spike_precision"),
        F.round(_ratio(hit, actual), digits).alias("spike_recall"),
        F.round(_ratio(2 * hit, actual + predicted), digits).alias("spike_f1"),
        F.round(F.coalesce(F.avg(err), F.lit(0.0)), digits).alias("spike_mae"),
        F.round(_ratio(F.sum(err), F.sum(F.when(is_spike, F.abs(y)))), digits)
        .alias("spike_wmape"),
    ]


def spike_variants(df: DataFrame, thresholds: dict[str, float], keys: list[str],
                   digits: int = 4) -> DataFrame:
    """One row per key and variant: eligible and pooled rows under the frozen
    threshold, eligible rows under the leaked one. One scan, one shuffle."""
    frozen, leaked = thresholds["FROZEN_PRE_SHIFT"], thresholds["LEAKED_POST_SHIFT"]
    variants = F.array(*[
        F.struct(F.lit(population).alias("population"), F.lit(source).alias("threshold_type"),
                 F.lit(float(limit)).alias("spike_threshold"))
        for population, source, limit in (("ELIGIBLE", "FROZEN_PRE_SHIFT", frozen),
                                          ("POOLED", "FROZEN_PRE_SHIFT", frozen),
                                          ("ELIGIBLE", "LEAKED_POST_SHIFT", leaked))])
    rows = (df.select("*", F.inline(variants))
            .where((F.col("population") == "POOLED") | F.col("is_eligible_eval")))
    return (rows.groupBy(*keys, "population", "threshold_type", "spike_threshold")
            .agg(*spike_metrics(F.col("spike_threshold"), digits)))


def macro_spikes(df: DataFrame, threshold: float, keys: list[str], zone: str = "zone",
                 digits: int = 4) -> DataFrame:
    """Zone metrics averaged as rounded, with the zone recalls in zone order."""
    zones = df.groupBy(*keys, zone).agg(*spike_metrics(F.lit(threshold), digits))
    ordered = F.array_sort(F.collect_list(F.struct(zone, "spike_recall")))
    return zones.groupBy(*keys).agg(
        F.round(F.avg("spike_recall"), digits).alias("macro_spike_recall"),
        F.round(F.avg("spike_precision"), digits).alias("macro_spike_precision"),
        F.transform(ordered, lambda s: s["spike_recall"]).alias("zonal_recalls"))
