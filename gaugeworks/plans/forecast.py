"""Forecast evaluation end to end: observations in, every result table out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from gaugeworks.operators import bootstrap, features, metrics, regression, selection, spikes, splits
from gaugeworks.operators.series import MAX_ROWS, longest_series, number_rows
from gaugeworks.session import cut_lineage


@dataclass
class Evaluation:
    thresholds: dict[str, tuple[float, float]]
    tables: dict[str, DataFrame] = field(default_factory=dict)


def evaluate(observations: DataFrame, zones: list[str], candidate: str = "Ridge",
             baseline: str = "Persistence", models: tuple[str, ...] = tuple(regression.RUN_IDS),
             max_rows: int = MAX_ROWS, seed: int = 42) -> Evaluation:
    """Features, frozen thresholds, fitted models, and metrics by every segment.

    Validation figures use predictions as they are; test figures use them rounded
    to two decimals. The feature table and the predictions are each written once
    to the shared folder, since every table below reads them.
    """
    rows = longest_series(observations, ["series_id"])
    table = features.feature_matrix(observations, zones, max_rows=max_rows)
    table = splits.with_split(table).withColumn("is_eligible_eval", splits.eligible())
    table = cut_lineage(table)
    found = splits.thresholds(table, rows)
    spike, volatile = found["FROZEN_PRE_SHIFT"]
    names = [c for c in features.feature_columns(table) if c != "split"]
    table = table.withColumn("regime", splits.regime(
        F.col("price_usd_mwh"), F.col("roll_price_std_24"), spike, volatile))
    train = table.where("split = 'TRAIN'")
    later = table.where("split <> 'TRAIN'")
    parts = [regression.predict(m, regression.fit(m, train, names), later) for m in models]
    keep = ["series_id", "event_id", "ts", "pos", "zone", "split", "regime", "is_eligible_eval", "model_name",
            "run_id", F.col("price_usd_mwh").alias("actual_price"), "predicted_price"]
    long = parts[0].select(*keep)
    for p in parts[1:]:
        long = long.unionByName(p.select(*keep))
    long = cut_lineage(long.withColumn("split_phase", splits.phase_of(F.col("split"))).withColumn(
        "predicted_price", F.when(F.col("split") == "VALIDATION", F.col("predicted_price"))
        .otherwise(F.bround("predicted_price", 2))))

    test = long.where("split <> 'VALIDATION'")
    firm = test.where("is_eligible_eval")
    shifted = firm.where("split_phase = 'SHIFTED'")
    keys = ["model_name", "run_id"]
    out = Evaluation(found)
    out.tables["validation"] = selection.validation_table(long.where("split = 'VALIDATION'"), spike, baseline)
    out.tables["selected"] = selection.select_model(out.tables["validation"])
    out.tables["phase_eligible"] = metrics.by_segment(firm, [*keys, "split_phase"])
    out.tables["phase_pooled"] = metrics.by_segment(test, [*keys, "split_phase"])
    out.tables["shifted_segments"] = metrics.by_segment_sets(shifted, keys, ["zone", "regime"])
    out.tables["spikes"] = spikes.spike_variants(test.where("split_phase = 'SHIFTED'"),
                                                 {k: v[0] for k, v in found.items()}, keys)
    out.tables["macro_spikes"] = spikes.macro_spikes(shifted, spike, keys)
    out.tables["composition"] = metrics.composition_effect(firm)
    both = (shifted.where(F.col("model_name") == candidate).withColumnRenamed("predicted_price", "candidate_price")
            .join(shifted.where(F.col("model_name") == baseline).select(
                "series_id", "pos", F.col("predicted_price").alias("baseline_price")), ["series_id", "pos"]))
    n = both.count()
    placed = number_rows(both.drop("pos"), ["series_id"], "ts", "event_id", max_rows, n)
    errors = cut_lineage(bootstrap.error_rows(placed))
    out.tables["block_bootstrap"] = bootstrap.interval(
        bootstrap.block_replicates(errors, n, seed=seed, max_rows=max_rows), errors, "moving_block_bootstrap", 24, 400)
    out.tables["iid_bootstrap"] = bootstrap.interval(
        bootstrap.iid_replicates(errors, n, seed=seed), errors, "naive_iid_resampling", 1, 400)
    out.tables["split_manifest"] = splits.split_manifest(table)
    return out
