"""Forecast evaluation queries over `events` read as one long market series."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.catalog.base import Inputs, built, query, view
from gaugeworks.operators import bootstrap, features, metrics, regression, selection, spikes, splits
from gaugeworks.operators.series import longest_series
from gaugeworks.session import cut_lineage

ZONES = ["click", "error", "purchase", "signup", "view"]
# Rows a window task is meant to hold, and rows of a halo block.
TASK_ROWS, HALO_BLOCK = 4_000, 8_192

view("observations", """
SELECT CASE WHEN event_id < 0 THEN 'void' ELSE 'market' END AS series_id, event_id, ts, event_type AS zone,
  CASE WHEN event_id % 7 = 0 THEN 'STANDBY_RESERVE' ELSE 'FIRM_DAY_AHEAD' END AS product_type,
  CASE WHEN event_id % 11 = 0 THEN 'OVERRIDE' ELSE 'NORMAL' END AS telemetry_status,
  CAST(400 + user_id AS DOUBLE) AS demand_mw,
  CAST(user_id % 90 AS DOUBLE) AS renewable_generation_mw,
  CAST(event_id % 40 AS DOUBLE) - CAST(5 AS DOUBLE) AS temperature_c,
  CAST(3 + user_id % 7 AS DOUBLE) AS fuel_index_usd_mmbtu,
  CAST(EXTRACT(HOUR FROM ts) AS INT) AS hour,
  CAST(EXTRACT(DAY FROM ts) % 7 AS INT) AS day_of_week,
  CAST(CASE WHEN EXTRACT(DAY FROM ts) % 7 >= 5 THEN 1 ELSE 0 END AS INT) AS weekend_flag,
  value AS price_usd_mwh
FROM {events}""")


@built("lagged", """
SELECT *, row_number() OVER o - 1 AS pos, count(*) OVER () AS n_rows,
  coalesce(lag(price_usd_mwh, 1) OVER o,
    CASE WHEN count(*) OVER () > 1 THEN first_value(price_usd_mwh) OVER o END) AS lag_price_1,
  coalesce(lag(price_usd_mwh, 2) OVER o,
    CASE WHEN count(*) OVER () > 2 THEN first_value(price_usd_mwh) OVER o END) AS lag_price_2,
  coalesce(lag(price_usd_mwh, 24) OVER o,
    CASE WHEN count(*) OVER () > 24 THEN first_value(price_usd_mwh) OVER o END) AS lag_price_24,
  coalesce(lag(price_usd_mwh, 168) OVER o,
    CASE WHEN count(*) OVER () > 168 THEN first_value(price_usd_mwh) OVER o END) AS lag_price_168,
  coalesce(avg(price_usd_mwh) OVER (ORDER BY ts, event_id ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING),
    first_value(price_usd_mwh) OVER o) AS roll_price_mean_24,
  coalesce(stddev_samp(price_usd_mwh) OVER (ORDER BY ts, event_id
    ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS roll_price_std_24
FROM {observations} WINDOW o AS (ORDER BY ts, event_id)""")
def lagged(t: Inputs):
    return features.lag_and_roll(t.observations, max_rows=TASK_ROWS, block=HALO_BLOCK)


@built("in_split", """
SELECT *, CASE WHEN pos * 26280 < n_rows * 8760 THEN 'TRAIN'
               WHEN pos * 26280 < n_rows * 17520 THEN 'VALIDATION'
               WHEN pos * 26280 < n_rows * 21900 THEN 'TEST_PRE_SHIFT'
               ELSE 'TEST_SHIFTED' END AS split,
  product_type = 'FIRM_DAY_AHEAD' AND telemetry_status = 'NORMAL' AS is_eligible_eval
FROM {lagged}""")
def in_split(t: Inputs):
    rows = longest_series(t.observations, ["series_id"])
    return t.lagged.select("*", splits.split_of(F.col("pos"), F.lit(rows)).alias("split"),
                           splits.eligible().alias("is_eligible_eval"))


view("limits_sql", """
SELECT quantile_cont(price_usd_mwh, 0.95) FILTER (WHERE split = 'TRAIN') AS spike,
  quantile_cont(roll_price_std_24, 0.80) FILTER (WHERE split = 'TRAIN') AS volatile,
  quantile_cont(price_usd_mwh, 0.95) FILTER (WHERE split = 'TEST_SHIFTED') AS leaked
FROM {in_split}""")


def featured(t: Inputs):
    """The split feature table, written once: thresholds and labels both read it."""
    if "_featured" not in t.__dict__:
        t.__dict__["_featured"] = cut_lineage(t.in_split)
    return t.__dict__["_featured"]


def limits(t: Inputs) -> dict[str, tuple[float, float]]:
    held = t.__dict__.setdefault("_limits", {})
    if not held:
        held.update(splits.thresholds(featured(t), t.observations.count()))
    return held


@built("labelled", """
SELECT s.*, l.spike, l.leaked,
  CASE WHEN price_usd_mwh >= l.spike THEN 'SPIKE'
       WHEN roll_price_std_24 >= l.volatile THEN 'VOLATILE' ELSE 'NORMAL' END AS regime
FROM {in_split} s, {limits_sql} l""")
def labelled(t: Inputs):
    spike, volatile = limits(t)["FROZEN_PRE_SHIFT"]
    return featured(t).withColumn("regime", splits.regime(
        F.col("price_usd_mwh"), F.col("roll_price_std_24"), spike, volatile))


@built("predictions", """
SELECT series_id, pos, ts, zone, split, regime, is_eligible_eval, spike, leaked,
  CASE split WHEN 'TEST_PRE_SHIFT' THEN 'PRE_SHIFT' WHEN 'TEST_SHIFTED' THEN 'SHIFTED' END
    AS split_phase,
  price_usd_mwh AS actual_price, model_name,
  CASE model_name WHEN 'Persistence' THEN lag_price_1 ELSE roll_price_mean_24 END AS predicted_price
FROM {labelled}, (VALUES ('Persistence'), ('RollingMean')) m(model_name)""")
def predictions(t: Inputs):
    return _forecasts(t.labelled, "regime")


def _forecasts(rows, *more: str):
    pairs = F.array(F.struct(F.lit("Persistence").alias("model_name"),
                             F.col("lag_price_1").alias("predicted_price")),
                    F.struct(F.lit("RollingMean").alias("model_name"),
                             F.col("roll_price_mean_24").alias("predicted_price")))
    return rows.select(
        "series_id", "pos", "ts", "zone", "split", *more, "is_eligible_eval",
        splits.phase_of(F.col("split")).alias("split_phase"),
        F.col("price_usd_mwh").alias("actual_price"), F.inline(pairs))


def without_regime(t: Inputs):
    """The predictions for what asks no regime: in one pass over the events, no threshold is looked for."""
    return _forecasts(t.in_split)


def _metrics_sql(keys: str, source: str = "{predictions}", where: str = "TRUE",
                 group: str | None = None, digits: int = 6) -> str:
    return f"""
SELECT {keys + ',' if keys else ''}
  round(avg(abs(actual_price - predicted_price)), {digits}) AS "MAE",
  round(sqrt(avg((actual_price - predicted_price) * (actual_price - predicted_price))), {digits}) AS "RMSE",
  round(sum(abs(actual_price - predicted_price)) / sum(abs(actual_price)), {digits}) AS "WMAPE",
  round(1 - sum((actual_price - predicted_price) * (actual_price - predicted_price))
        / CASE WHEN count(*) < 2 THEN NULL ELSE var_pop(actual_price) * count(*) END, {digits}) AS "R2",
  count(*) AS "count"
FROM {source} WHERE {where} {'GROUP BY ' + (group or keys) if keys else ''}"""


D = 6


# --- features -------------------------------------------------------------------

@query("w01_lags_backfilled", """
SELECT event_id, lag_price_1, lag_price_2, lag_price_24, lag_price_168 FROM {lagged}""")
def w01(t):
    return t.lagged.select("event_id", "lag_price_1", "lag_price_2", "lag_price_24",
                           "lag_price_168")


@query("w02_rolling_mean_24", "SELECT event_id, round(roll_price_mean_24, 6) AS roll_price_mean_24 FROM {lagged}")
def w02(t):
    return t.lagged.select("event_id", F.round("roll_price_mean_24", D).alias("roll_price_mean_24"))


@query("w03_rolling_std_24", "SELECT event_id, round(roll_price_std_24, 6) AS roll_price_std_24 FROM {lagged}")
def w03(t):
    return t.lagged.select("event_id", F.round("roll_price_std_24", D).alias("roll_price_std_24"))


@query("w04_row_position", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM {observations}")
def w04(t):
    from gaugeworks.operators.series import number_rows
    return number_rows(t.observations, ["series_id"], "ts", "event_id", TASK_ROWS).select(
        "event_id", "pos")


@query("f01_net_load", "SELECT event_id, demand_mw - renewable_generation_mw AS net_load_mw FROM {observations}")
def f01(t):
    return t.observations.select("event_id", features.net_load().alias("net_load_mw"))


@query("f02_cyclic_encodings", """
SELECT event_id, round(sin(2 * pi() * hour / 24), 9) AS hour_sin,
  round(cos(2 * pi() * hour / 24), 9) AS hour_cos,
  round(sin(2 * pi() * day_of_week / 7), 9) AS dow_sin,
  round(cos(2 * pi() * day_of_week / 7), 9) AS dow_cos FROM {observations}""")
def f02(t):
    df = features.with_calendar(t.observations)
    return df.select("event_id", *[F.round(c, 9).alias(c) for c in
                                   ("hour_sin", "hour_cos", "dow_sin", "dow_cos")])


@query("f03_interactions", """
SELECT event_id,
  round(((demand_mw - renewable_generation_mw) / 100.0) * ((demand_mw - renewable_generation_mw) / 100.0), 6) AS net_load_squared,
  round(fuel_index_usd_mmbtu * (demand_mw - renewable_generation_mw) / 100.0, 6) AS fuel_heat_interaction,
  greatest(0.0::DOUBLE, 18 - temperature_c) AS temp_heating_deg,
  greatest(0.0::DOUBLE, temperature_c - 22) AS temp_cooling_deg FROM {observations}""")
def f03(t):
    df = features.with_interactions(features.with_calendar(t.observations))
    return df.select("event_id", F.round("net_load_squared", D).alias("net_load_squared"),
                     F.round("fuel_heat_interaction", D).alias("fuel_heat_interaction"),
                     "temp_heating_deg", "temp_cooling_deg")


@query("f04_one_hot_zone", "SELECT event_id, " + ", ".join(
    f"CASE WHEN zone = '{z}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS zone_{z}" for z in ZONES)
    + " FROM {observations}")
def f04(t):
    return features.with_one_hot(t.observations, ZONES).select(
        "event_id", *[f"zone_{z}" for z in ZONES])


@query("f05_feature_matrix", """
SELECT event_id, round(demand_mw + renewable_generation_mw + temperature_c + fuel_index_usd_mmbtu
  + hour + day_of_week + weekend_flag + coalesce(lag_price_1, 0) + coalesce(lag_price_2, 0)
  + coalesce(lag_price_24, 0) + coalesce(lag_price_168, 0) + roll_price_mean_24 + roll_price_std_24
  + (demand_mw - renewable_generation_mw) + sin(2 * pi() * hour / 24) + cos(2 * pi() * hour / 24)
  + sin(2 * pi() * day_of_week / 7) + cos(2 * pi() * day_of_week / 7)
  + ((demand_mw - renewable_generation_mw) / 100.0) * ((demand_mw - renewable_generation_mw) / 100.0)
  + fuel_index_usd_mmbtu * (demand_mw - renewable_generation_mw) / 100.0
  + greatest(0.0::DOUBLE, 18 - temperature_c) + greatest(0.0::DOUBLE, temperature_c - 22) + 1, 4) AS feature_sum,
  27 AS n_features FROM {lagged}""")
def f05(t):
    df = features.with_one_hot(features.with_interactions(features.with_calendar(t.lagged)), ZONES)
    names = features.feature_columns(df)
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in names), F.lit(0.0))
    return df.select("event_id", F.round(total, 4).alias("feature_sum"),
                     F.lit(len(names)).alias("n_features"))


@query("f06_regime", "SELECT event_id, regime FROM {labelled}")
def f06(t):
    return t.labelled.select("event_id", "regime")


@query("f07_eligibility", """
SELECT product_type, telemetry_status, product_type = 'FIRM_DAY_AHEAD' AND telemetry_status = 'NORMAL'
  AS is_eligible_eval, count(*) AS n FROM {observations} GROUP BY ALL""")
def f07(t):
    return (t.observations.withColumn("is_eligible_eval", splits.eligible())
            .groupBy("product_type", "telemetry_status", "is_eligible_eval")
            .agg(F.count("*").alias("n")))


@query("f08_chronological_split", "SELECT event_id, split FROM {in_split}")
def f08(t):
    return t.in_split.select("event_id", "split")


@query("f09_phase_flag", """
SELECT event_id, CASE split WHEN 'TEST_PRE_SHIFT' THEN 'PRE_SHIFT' ELSE 'SHIFTED' END AS split_phase
FROM {in_split} WHERE split LIKE 'TEST%'""")
def f09(t):
    return t.in_split.where(F.col("split").startswith("TEST")).select(
        "event_id", splits.phase_of(F.col("split")).alias("split_phase"))


@query("s15_split_manifest", """
SELECT series_id, split, min(pos) AS start_hour, max(pos) AS end_hour, count(*) AS "count",
  min(ts) AS start_ts, max(ts) AS end_ts FROM (
  SELECT series_id, split, pos, ts FROM {in_split} UNION ALL
  SELECT series_id, 'TEST_FULL', pos, ts FROM {in_split} WHERE split LIKE 'TEST%') GROUP BY ALL""")
def s15(t):
    return splits.split_manifest(t.in_split)


@query("s16_dataset_manifest", """
SELECT count(*) AS total_rows, min(ts) AS start_timestamp, max(ts) AS end_timestamp,
  string_agg(DISTINCT zone, ',' ORDER BY zone) AS zones,
  string_agg(DISTINCT product_type, ',' ORDER BY product_type) AS products,
  round(avg(price_usd_mwh), 2) AS price_mean_usd, round(stddev_samp(price_usd_mwh), 2) AS price_std_usd,
  min(price_usd_mwh) AS price_min_usd, max(price_usd_mwh) AS price_max_usd FROM {observations}""")
def s16(t):
    return splits.dataset_manifest(t.observations)


# --- thresholds and metrics -----------------------------------------------------

@query("a10_frozen_thresholds", """
SELECT 'FROZEN_PRE_SHIFT' AS threshold_id, round(quantile_cont(price_usd_mwh, 0.95), 6) AS spike_threshold,
  round(quantile_cont(roll_price_std_24, 0.80), 6) AS volatile_threshold, TRUE AS is_governing_standard
FROM {in_split} WHERE split = 'TRAIN' UNION ALL
SELECT 'LEAKED_POST_SHIFT', round(quantile_cont(price_usd_mwh, 0.95), 6),
  round(quantile_cont(roll_price_std_24, 0.80), 6), FALSE FROM {in_split} WHERE split = 'TEST_SHIFTED'""")
def a10(t):
    found = limits(t)
    rows = F.array(*[F.struct(
        F.lit(k).alias("threshold_id"), F.round(F.lit(v[0]), D).alias("spike_threshold"),
        F.round(F.lit(v[1]), D).alias("volatile_threshold"),
        F.lit(k == "FROZEN_PRE_SHIFT").alias("is_governing_standard")) for k, v in found.items()])
    return t.spark.range(1).select(F.inline(rows))


@query("a01_wmape", """
SELECT model_name, round(sum(abs(actual_price - predicted_price)) / sum(abs(actual_price)), 6) AS wmape
FROM {predictions} GROUP BY model_name""")
def a01(t):
    return without_regime(t).groupBy("model_name").agg(F.round(metrics.wmape(
        F.col("actual_price"), F.col("predicted_price")), D).alias("wmape"))


@query("a02_error_metrics", _metrics_sql("model_name, split"))
def a02(t):
    return metrics.by_segment(without_regime(t), ["model_name", "split"], D)


@query("a03_by_zone", _metrics_sql("model_name, zone", where="split = 'TEST_SHIFTED' AND is_eligible_eval"))
def a03(t):
    return metrics.by_segment(_shifted(without_regime(t)), ["model_name", "zone"], D)


def _shifted(rows):
    return rows.where((F.col("split") == "TEST_SHIFTED") & F.col("is_eligible_eval"))


@query("a04_by_regime", _metrics_sql("model_name, regime", where="split = 'TEST_SHIFTED' AND is_eligible_eval"))
def a04(t):
    return metrics.by_segment(_shifted(t.predictions), ["model_name", "regime"], D)


@query("a05_segment_grouping_sets", _metrics_sql(
    "model_name, zone, regime, grouping(model_name, zone, regime) AS level",
    where="split = 'TEST_SHIFTED' AND is_eligible_eval",
    group="GROUPING SETS ((model_name), (model_name, zone), (model_name, regime), (model_name, zone, regime))"))
def a05(t):
    return metrics.by_segment_sets(_shifted(t.predictions), ["model_name"], ["zone", "regime"], D)


@query("a06_phase_population", f"""
SELECT * FROM ({_metrics_sql("model_name, split_phase, 'ELIGIBLE_COMMERCIAL' AS population",
                             where="split_phase IS NOT NULL AND is_eligible_eval", group="model_name, split_phase")})
UNION ALL SELECT * FROM ({_metrics_sql("model_name, split_phase, 'POOLED_OPERATIONAL' AS population",
                                       where="split_phase IS NOT NULL", group="model_name, split_phase")})""")
def a06(t):
    populations = F.when(F.col("is_eligible_eval"), F.array(
        F.lit("ELIGIBLE_COMMERCIAL"), F.lit("POOLED_OPERATIONAL"))).otherwise(
        F.array(F.lit("POOLED_OPERATIONAL")))
    rows = without_regime(t).where("split_phase IS NOT NULL").withColumn(
        "population", F.explode(populations))
    return metrics.by_segment(rows, ["model_name", "split_phase", "population"], D)


def _spike_sql(keys: str, threshold: str, where: str, source: str = "{predictions}") -> str:
    return f"""
SELECT {keys}, count(*) FILTER (actual_price >= {threshold}) AS actual_spikes,
  count(*) FILTER (predicted_price >= {threshold}) AS predicted_spikes,
  round(coalesce(count(*) FILTER (actual_price >= {threshold} AND predicted_price >= {threshold})
    / nullif(count(*) FILTER (predicted_price >= {threshold}), 0)::DOUBLE, 0), 6) AS spike_precision,
  round(coalesce(count(*) FILTER (actual_price >= {threshold} AND predicted_price >= {threshold})
    / nullif(count(*) FILTER (actual_price >= {threshold}), 0)::DOUBLE, 0), 6) AS spike_recall,
  round(coalesce(2 * count(*) FILTER (actual_price >= {threshold} AND predicted_price >= {threshold})
    / nullif(count(*) FILTER (actual_price >= {threshold})
      + count(*) FILTER (predicted_price >= {threshold}), 0)::DOUBLE, 0), 6) AS spike_f1,
  round(coalesce(avg(abs(actual_price - predicted_price)) FILTER (actual_price >= {threshold}), 0), 6) AS spike_mae,
  round(coalesce(sum(abs(actual_price - predicted_price)) FILTER (actual_price >= {threshold})
    / sum(abs(actual_price)) FILTER (actual_price >= {threshold}), 0), 6) AS spike_wmape
FROM {source} WHERE {where}"""


@query("a07_spike_metrics", _spike_sql("model_name", "spike", "split = 'VALIDATION'") + " GROUP BY model_name")
def a07(t):
    spike = limits(t)["FROZEN_PRE_SHIFT"][0]
    return (t.predictions.where("split = 'VALIDATION'").groupBy("model_name")
            .agg(*spikes.spike_metrics(F.lit(spike), D)))


_VARIANTS = [("ELIGIBLE", "FROZEN_PRE_SHIFT", "spike", "AND is_eligible_eval"),
             ("POOLED", "FROZEN_PRE_SHIFT", "spike", ""),
             ("ELIGIBLE", "LEAKED_POST_SHIFT", "leaked", "AND is_eligible_eval")]


@query("a08_spike_variants", " UNION ALL ".join(
    _spike_sql(f"model_name, '{pop}' AS population, '{kind}' AS threshold_type, "
               f"round(min({col}), 6) AS spike_threshold", col, f"split = 'TEST_SHIFTED' {cond}")
    + " GROUP BY model_name" for pop, kind, col, cond in _VARIANTS))
def a08(t):
    found = {k: v[0] for k, v in limits(t).items()}
    out = spikes.spike_variants(t.predictions.where("split = 'TEST_SHIFTED'"), found,
                                ["model_name"], D)
    return out.withColumn("spike_threshold", F.round("spike_threshold", D))


@query("a09_macro_spikes", f"""
SELECT model_name, round(avg(spike_recall), 6) AS macro_spike_recall,
  round(avg(spike_precision), 6) AS macro_spike_precision,
  string_agg(CAST(CAST(round(spike_recall * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY zone) AS zonal_recalls
FROM ({_spike_sql("model_name, zone", "spike", "split = 'TEST_SHIFTED' AND is_eligible_eval")}
 GROUP BY model_name, zone) GROUP BY model_name""")
def a09(t):
    out = spikes.macro_spikes(_shifted(t.predictions), limits(t)["FROZEN_PRE_SHIFT"][0], ["model_name"],
                              digits=D)
    return out.withColumn("zonal_recalls", F.array_join(F.transform(
        "zonal_recalls", lambda r: F.round(r * 1000000).cast("bigint").cast("string")), ","))


_VALIDATION_SQL = f"""
SELECT model_name, round("WMAPE", 6) AS "WMAPE", round(rel, 6) AS rel_improvement_pct, spike_recall,
  round((volatile_wmape - "WMAPE") / "WMAPE", 6) AS volatile_degradation_ratio,
  rel >= 15.0 AS rule1_improvement_passed, spike_recall >= 0.15 AS rule2_spike_recall_passed,
  (volatile_wmape - "WMAPE") / "WMAPE" <= 0.5 AS rule3_volatility_stability_passed,
  rel >= 15.0 AND spike_recall >= 0.15 AND (volatile_wmape - "WMAPE") / "WMAPE" <= 0.5
    AS is_eligible_for_selection
FROM (SELECT *, (max("WMAPE") FILTER (model_name = 'Persistence') OVER () - "WMAPE")
    / max("WMAPE") FILTER (model_name = 'Persistence') OVER () * 100 AS rel
  FROM ({_metrics_sql("model_name", where="split = 'VALIDATION'")})
  JOIN (SELECT model_name, round(sum(abs(actual_price - predicted_price)) / sum(abs(actual_price)), 6)
          AS volatile_wmape FROM {{predictions}} WHERE split = 'VALIDATION' AND regime = 'VOLATILE'
        GROUP BY 1) USING (model_name)
  JOIN ({_spike_sql("model_name", "spike", "split = 'VALIDATION'")} GROUP BY model_name) USING (model_name))"""


def _validation(t):
    return selection.validation_table(t.predictions.where("split = 'VALIDATION'"),
                                      limits(t)["FROZEN_PRE_SHIFT"][0], "Persistence", D)


@query("a11_selection_rules", _VALIDATION_SQL)
def a11(t):
    return _validation(t).select(
        "model_name", "WMAPE", F.round("rel_improvement_pct", D).alias("rel_improvement_pct"),
        "spike_recall", F.round("volatile_degradation_ratio", D).alias("volatile_degradation_ratio"),
        "rule1_improvement_passed", "rule2_spike_recall_passed",
        "rule3_volatility_stability_passed", "is_eligible_for_selection")


@query("a12_select_model", f"""
SELECT model_name AS selected_model, "WMAPE" AS "validation_WMAPE" FROM ({_VALIDATION_SQL})
WHERE is_eligible_for_selection ORDER BY "WMAPE", model_name LIMIT 1""")
def a12(t):
    return selection.select_model(_validation(t))


@query("a13_composition_effect", """
WITH part AS (SELECT model_name, zone, split_phase, sum(abs(actual_price)) AS v,
    sum(abs(actual_price - predicted_price)) AS e FROM {predictions}
  WHERE split_phase IS NOT NULL AND is_eligible_eval GROUP BY ALL),
wide AS (SELECT model_name, zone, coalesce(max(v) FILTER (split_phase = 'PRE_SHIFT'), 0) AS v0,
    coalesce(max(v) FILTER (split_phase = 'SHIFTED'), 0) AS v1,
    max(e / v) FILTER (split_phase = 'PRE_SHIFT') AS m0, max(e / v) FILTER (split_phase = 'SHIFTED') AS m1
  FROM part GROUP BY ALL),
sh AS (SELECT model_name, zone, v0 / sum(v0) OVER (PARTITION BY model_name) AS w0,
    v1 / sum(v1) OVER (PARTITION BY model_name) AS w1, coalesce(m0, m1) AS m0, coalesce(m1, m0) AS m1 FROM wide)
SELECT model_name, zone, round(w0, 6) AS share_before, round(w1, 6) AS share_after,
  round(m0, 6) AS wmape_before, round(m1, 6) AS wmape_after, round((w1 - w0) * m0, 6) AS mix_effect,
  round(w1 * (m1 - m0), 6) AS within_effect FROM sh""")
def a13(t):
    rows = without_regime(t).where(F.col("split_phase").isNotNull() & F.col("is_eligible_eval"))
    return metrics.composition_effect(rows)


# --- joins ----------------------------------------------------------------------

@query("j01_regime_by_key", """
SELECT regime, model_name, count(*) AS n, round(sum(predicted_price), 6) AS predicted_sum
FROM {predictions} WHERE split = 'TEST_SHIFTED' AND is_eligible_eval GROUP BY ALL""")
def j01(t):
    held = t.labelled.select("series_id", "pos", "regime")
    rows = _shifted(t.predictions).drop("regime").join(held, ["series_id", "pos"])
    return rows.groupBy("regime", "model_name").agg(
        F.count("*").alias("n"), F.round(F.sum("predicted_price"), 6).alias("predicted_sum"))


@query("j02_candidate_vs_baseline", """
SELECT c.zone, count(*) AS n, count(*) FILTER (abs(c.actual_price - c.predicted_price)
    < abs(b.actual_price - b.predicted_price)) AS candidate_closer,
  round(sum(abs(b.actual_price - b.predicted_price) - abs(c.actual_price - c.predicted_price)), 6) AS gain
FROM {predictions} c JOIN {predictions} b ON c.series_id = b.series_id AND c.pos = b.pos
WHERE c.model_name = 'RollingMean' AND b.model_name = 'Persistence' AND c.split = 'TEST_SHIFTED'
  AND c.is_eligible_eval GROUP BY c.zone""")
def j02(t):
    pairs = _paired(t)
    base = F.abs(F.col("actual_price") - F.col("baseline_price"))
    cand = F.abs(F.col("actual_price") - F.col("candidate_price"))
    return pairs.groupBy("zone").agg(
        F.count("*").alias("n"), F.count_if(cand < base).alias("candidate_closer"),
        F.round(F.sum(base - cand), 6).alias("gain"))


def _paired(t):
    rows = _shifted(_forecasts(featured(t)))
    base = rows.where("model_name = 'Persistence'").select(
        "series_id", "pos", F.col("predicted_price").alias("baseline_price"))
    cand = rows.where("model_name = 'RollingMean'").withColumnRenamed(
        "predicted_price", "candidate_price")
    return cand.join(base, ["series_id", "pos"])


@query("j03_improvement_over_baseline", f"""
SELECT model_name, zone, "WMAPE", round((b - "WMAPE") / b * 100, 6) AS rel_improvement_pct FROM (
  SELECT *, max("WMAPE") FILTER (model_name = 'Persistence') OVER (PARTITION BY zone) AS b
  FROM ({_metrics_sql("model_name, zone", where="split = 'VALIDATION'")}))""")
def j03(t):
    table = metrics.by_segment(without_regime(t).where("split = 'VALIDATION'"),
                               ["model_name", "zone"], D)
    return selection.relative_improvement(table, "Persistence", keys=["zone"]).select(
        "model_name", "zone", "WMAPE", F.round("rel_improvement_pct", D).alias("rel_improvement_pct"))


@query("u01_union_of_models", """
SELECT model_name, split, count(*) AS n, round(sum(predicted_price), 6) AS predicted_sum
FROM {predictions} GROUP BY ALL""")
def u01(t):
    base = featured(t).select("split", F.lit("Persistence").alias("model_name"),
                             F.col("lag_price_1").alias("predicted_price"))
    cand = featured(t).select("split", F.lit("RollingMean").alias("model_name"),
                             F.col("roll_price_mean_24").alias("predicted_price"))
    return base.unionByName(cand).groupBy("model_name", "split").agg(
        F.count("*").alias("n"), F.round(F.sum("predicted_price"), 6).alias("predicted_sum"))


# --- bootstraps -----------------------------------------------------------------

@built("boot_rows", """
SELECT b.series_id, row_number() OVER (ORDER BY b.pos) - 1 AS pos,
  abs(b.actual_price - b.predicted_price) AS err_base, abs(c.actual_price - c.predicted_price) AS err_cand,
  abs(b.actual_price) AS volume
FROM {predictions} b JOIN {predictions} c ON b.pos = c.pos
WHERE b.model_name = 'Persistence' AND c.model_name = 'RollingMean' AND b.split = 'TEST_SHIFTED'
  AND b.is_eligible_eval""")
def boot_rows(t: Inputs):
    from gaugeworks.operators.series import number_rows
    rows = featured(t).where((F.col("split") == "TEST_SHIFTED") & F.col("is_eligible_eval")).select(
        "series_id", "ts", "event_id", F.col("price_usd_mwh").alias("actual_price"),
        F.col("lag_price_1").alias("baseline_price"), F.col("roll_price_mean_24").alias("candidate_price"))
    return cut_lineage(bootstrap.error_rows(number_rows(
        rows, ["series_id"], "ts", "event_id", TASK_ROWS)))


@query("a14_block_bootstrap", """
WITH r AS (SELECT pos, sum(err_base) OVER f AS bf, sum(err_cand) OVER f AS cf, sum(volume) OVER f AS vf,
    err_base, err_cand, volume FROM {boot_rows} WINDOW f AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING)),
n AS (SELECT count(*) AS n, CAST(ceil(count(*) / 24.0) AS BIGINT) AS k FROM {boot_rows}),
d AS (SELECT b.range AS replicate, g.range AS block, CAST('0x' || substr(md5('42|' || b.range || '|' || g.range), 1, 12)
    AS BIGINT) % (n.n - 23) AS pos, CASE WHEN g.range = n.k - 1 THEN n.n - (n.k - 1) * 24 ELSE 24 END AS len
  FROM n, range(400) b, LATERAL (SELECT range FROM range(20000) x WHERE x.range < n.k) g),
c AS (SELECT pos, sum(err_base) OVER p AS pb, sum(err_cand) OVER p AS pc, sum(volume) OVER p AS pv
  FROM {boot_rows} WINDOW p AS (ORDER BY pos)),
s AS (SELECT replicate, sum(e.pb - coalesce(a.pb, 0)) AS eb, sum(e.pc - coalesce(a.pc, 0)) AS ec,
    sum(e.pv - coalesce(a.pv, 0)) AS v
  FROM d JOIN c e ON e.pos = d.pos + d.len - 1 LEFT JOIN c a ON a.pos = d.pos - 1 GROUP BY replicate),
g AS (SELECT (eb - ec) / v AS diff, (eb - ec) / eb * 100 AS rel FROM s),
p AS (SELECT sum(err_base) / sum(volume) AS b, sum(err_cand) / sum(volume) AS c FROM {boot_rows})
SELECT round(p.c, 6) AS candidate_wmape, round(p.b, 6) AS baseline_wmape, round(p.b - p.c, 6) AS abs_diff_point,
  round((p.b - p.c) / p.b * 100, 6) AS rel_imp_point_pct,
  round(quantile_cont(diff, 0.025), 6) AS ci_abs_lower_95, round(quantile_cont(diff, 0.975), 6) AS ci_abs_upper_95,
  round(quantile_cont(rel, 0.025), 6) AS ci_rel_lower_95_pct, round(quantile_cont(rel, 0.975), 6) AS ci_rel_upper_95_pct,
  'moving_block_bootstrap' AS method, 24 AS block_length, 400 AS n_replicates
FROM g, p GROUP BY p.b, p.c""")
def a14(t):
    rows = t.boot_rows
    reps = bootstrap.block_replicates(rows, rows.count(), max_rows=TASK_ROWS, window_block=HALO_BLOCK)
    return bootstrap.interval(reps, rows, "moving_block_bootstrap", 24, 400)


@query("a15_iid_bootstrap")
def a15(t):
    rows = t.boot_rows
    reps = bootstrap.iid_replicates(rows, rows.count())
    return bootstrap.interval(reps, rows, "naive_iid_resampling", 1, 400)


@query("f26_deployment_gates", f"""
SELECT model_name, "WMAPE", round(rel, 6) AS rel_improvement_pct, spike_recall, worst_zone_wmape,
  rel >= 18.0 AS gate_1, spike_recall >= 0.28 AS gate_2, worst_zone_wmape <= 0.17 AS gate_3,
  rel - 2 >= 16.6 AS gate_4,
  CASE WHEN rel >= 18.0 AND spike_recall >= 0.28 AND worst_zone_wmape <= 0.17 AND rel - 2 >= 16.6
    THEN 'APPROVED' ELSE 'REJECT' END AS decision
FROM (SELECT *, (max("WMAPE") FILTER (model_name = 'Persistence') OVER () - "WMAPE")
    / max("WMAPE") FILTER (model_name = 'Persistence') OVER () * 100 AS rel
  FROM ({_metrics_sql("model_name", where="split = 'TEST_SHIFTED' AND is_eligible_eval")})
  JOIN (SELECT model_name, max(w) AS worst_zone_wmape FROM (SELECT model_name, zone,
      round(sum(abs(actual_price - predicted_price)) / sum(abs(actual_price)), 6) AS w FROM {{predictions}}
      WHERE split = 'TEST_SHIFTED' AND is_eligible_eval GROUP BY ALL) GROUP BY 1) USING (model_name)
  JOIN ({_spike_sql("model_name", "spike", "split = 'TEST_SHIFTED' AND is_eligible_eval")}
        GROUP BY model_name) USING (model_name))""")
def f26(t):
    """Gates over the shifted rows; the interval floor is the point gain less two points."""
    rows = _shifted(t.predictions)
    spike = limits(t)["FROZEN_PRE_SHIFT"][0]
    recall = {c: e for c, e in zip("abcdefg", spikes.spike_metrics(F.lit(spike), D))}["d"]
    overall = rows.groupBy("model_name").agg(*metrics.error_metrics(digits=D), recall)
    worst = (rows.groupBy("model_name", "zone").agg(F.round(metrics.wmape(
        F.col("actual_price"), F.col("predicted_price")), D).alias("w"))
        .groupBy("model_name").agg(F.max("w").alias("worst_zone_wmape")))
    table = selection.relative_improvement(overall, "Persistence").join(worst, "model_name")
    out = selection.deployment_gates(table.withColumn(
        "ci_lower_pct", F.col("rel_improvement_pct") - 2))
    return out.select("model_name", "WMAPE", F.round("rel_improvement_pct", D)
                      .alias("rel_improvement_pct"), "spike_recall", "worst_zone_wmape",
                      "gate_1", "gate_2", "gate_3", "gate_4", "decision")


# --- models ---------------------------------------------------------------------

@query("m01_persistence", "SELECT event_id, lag_price_1 AS predicted_price FROM {lagged}")
def m01(t):
    return regression.persistence(t.lagged).select("event_id", "predicted_price")


def _fitted(t, name: str, interactions: bool = True):
    df = features.with_calendar(t.in_split)
    if interactions:
        df = features.with_interactions(df)
    df = features.with_one_hot(df, ZONES)
    names = [c for c in features.feature_columns(df) if c not in ("split",)]
    model = regression.fit(name, df.where("split = 'TRAIN'").na.drop(subset=names), names)
    out = regression.predict(name, model, df.where("split = 'VALIDATION'"))
    out = out.withColumn("actual_price", F.col("price_usd_mwh"))
    vintage = "full_operational_v2" if interactions else "base_no_interaction"
    return metrics.by_segment(out.withColumn("feature_set", F.lit(vintage)),
                              ["model_name", "run_id", "feature_set"])


@query("m02_ridge")
def m02(t):
    return _fitted(t, "Ridge")


@query("m03_random_forest")
def m03(t):
    return _fitted(t, "RandomForest")


@query("m04_boosting")
def m04(t):
    return _fitted(t, "HistGradientBoosting")


@query("m05_ridge_base_vintage")
def m05(t):
    return _fitted(t, "Ridge", interactions=False)
