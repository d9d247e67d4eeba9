"""Model selection rules and deployment gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gaugeworks import fixed
from gaugeworks.operators.metrics import error_metrics, wmape
from gaugeworks.operators.spikes import spike_metrics


def relative_improvement(df: DataFrame, baseline: str, metric: str = "WMAPE",
                         keys: list[str] | None = None) -> DataFrame:
    """Percent gain over the baseline model's row of the same segment."""
    window = Window.partitionBy(*(keys or [F.lit(0)]))
    base = F.max(F.when(F.col("model_name") == baseline, F.col(metric))).over(window)
    return df.withColumn("rel_improvement_pct", F.when(
        base > 0, (base - F.col(metric)) / base * 100).otherwise(F.lit(0.0)))


def validation_table(df: DataFrame, spike_threshold: float, baseline: str,
                     digits: int = 4) -> DataFrame:
    """One row per model: errors, spike recall, volatile degradation and the rules."""
    y, p = F.col("actual_price"), F.col("predicted_price")
    volatile = F.col("regime") == "VOLATILE"
    spikes = {c: e for c, e in zip(
        ("actual_spikes", "predicted_spikes", "spike_precision", "spike_recall", "spike_f1",
         "spike_mae", "spike_wmape"), spike_metrics(F.lit(spike_threshold), digits))}
    table = df.groupBy("model_name").agg(
        *error_metrics(digits=digits), spikes["spike_recall"], spikes["spike_f1"],
        F.round(wmape(F.when(volatile, y), F.when(volatile, p)), digits)
        .alias("volatile_wmape"))
    table = relative_improvement(table, baseline)
    ratio = F.when(F.col("WMAPE") > 0, (F.col("volatile_wmape") - F.col("WMAPE"))
                   / F.col("WMAPE")).otherwise(F.lit(0.0))
    return rules(table.withColumn("volatile_degradation_ratio", ratio))


def rules(table: DataFrame) -> DataFrame:
    """The three selection rules as columns, and whether a model meets all of them."""
    out = table.select(
        "*",
        (F.col("rel_improvement_pct") >= fixed.RULE_IMPROVEMENT_PCT).alias("rule1_improvement_passed"),
        (F.col("spike_recall") >= fixed.RULE_SPIKE_RECALL).alias("rule2_spike_recall_passed"),
        (F.col("volatile_degradation_ratio") <= fixed.RULE_VOLATILE_RATIO)
        .alias("rule3_volatility_stability_passed"))
    return out.withColumn("is_eligible_for_selection", F.col("rule1_improvement_passed")
                          & F.col("rule2_spike_recall_passed")
                          & F.col("rule3_volatility_stability_passed"))


def select_model(table: DataFrame) -> DataFrame:
    """The eligible model with the lowest WMAPE, ties by name; no row where none is."""
    return (table.where("is_eligible_for_selection")
            .agg(F.min_by("model_name", F.struct("WMAPE", "model_name")).alias("selected_model"),
                 F.min("WMAPE").alias("validation_WMAPE"))
            .where("selected_model IS NOT NULL"))


def deployment_gates(df: DataFrame) -> DataFrame:
    """The four gates over (improvement, recall, worst zone WMAPE, interval floor)."""
    out = df.select(
        "*",
        (F.col("rel_improvement_pct") >= fixed.GATE_IMPROVEMENT_PCT).alias("gate_1"),
        (F.col("spike_recall") >= fixed.GATE_SPIKE_RECALL).alias("gate_2"),
        (F.col("worst_zone_wmape") <= fixed.GATE_ZONE_WMAPE).alias("gate_3"),
        (F.col("ci_lower_pct") >= fixed.GATE_CI_LOWER_PCT).alias("gate_4"))
    held = F.col("gate_1") & F.col("gate_2") & F.col("gate_3") & F.col("gate_4")
    return out.withColumn("decision", F.when(held, "APPROVED").otherwise("REJECT"))
