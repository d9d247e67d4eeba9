import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import bootstrap, features, metrics, regression, selection, spikes
from gaugeworks.operators.series import exact_quantiles, number_rows, running_sum
from gaugeworks.plans import forecast


@pytest.fixture(scope="module")
def observations(spark):
    rng = random.Random(5)
    start, rows = dt.datetime(2024, 1, 1), []
    for i in range(1200):
        series = "hot" if i % 3 else f"s{i % 5}"
        rows.append((series, i, start + dt.timedelta(minutes=rng.randrange(40_000)), rng.choice("ABC"),
                     "FIRM_DAY_AHEAD" if i % 7 else "STANDBY_RESERVE", "NORMAL" if i % 9 else "OVERRIDE",
                     500.0 + i % 50, float(i % 30), float(i % 35), 3.0 + i % 4, i % 24, i % 7, 0,
                     round(rng.gauss(60, 20) + (80 if i % 29 == 0 else 0), 2)))
    return spark.createDataFrame(rows, "series_id string, event_id bigint, ts timestamp, zone string, product_type string, "
                                 "telemetry_status string, demand_mw double, renewable_generation_mw double, temperature_c double, "
                                 "fuel_index_usd_mmbtu double, hour int, day_of_week int, weekend_flag int, price_usd_mwh double")


def _pandas_features(pdf):
    out = []
    for _, g in pdf.sort_values(["ts", "event_id"]).groupby("series_id"):
        p = g["price_usd_mwh"]
        g = g.assign(**{f"lag_price_{k}": p.shift(k).bfill() for k in features.LAGS})
        back = p.shift(1).rolling(24, min_periods=1)
        out.append(g.assign(roll_price_mean_24=back.mean().bfill(), roll_price_std_24=back.std().fillna(0.0)))
    return pd.concat(out).set_index("event_id").sort_index()


@pytest.mark.parametrize("max_rows,block", [(10_000, 65_536), (60, 200)])
def test_lags_and_rolls_match_pandas_on_either_path(observations, max_rows, block):
    got = features.lag_and_roll(observations, max_rows=max_rows, block=block).toPandas().set_index("event_id").sort_index()
    want = _pandas_features(observations.toPandas())
    for c in [f"lag_price_{k}" for k in features.LAGS] + ["roll_price_mean_24", "roll_price_std_24"]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9)


def test_positions_of_a_hot_series_are_dense(observations):
    got = number_rows(observations, ["series_id"], "ts", "event_id", 50).toPandas()
    for _, g in got.groupby("series_id"):
        assert sorted(g["pos"]) == list(range(len(g)))
        assert list(g.sort_values(["ts", "event_id"])["pos"]) == list(range(len(g)))
    plain = running_sum(observations, ["series_id"], "ts", "event_id", F.col("hour"), "t", 10_000)
    cut = running_sum(observations, ["series_id"], "ts", "event_id", F.col("hour"), "t", 50)
    assert plain.select("event_id", "t").exceptAll(cut.select("event_id", "t")).isEmpty()


def test_exact_quantiles_with_and_without_brackets(observations):
    values = observations.toPandas()["price_usd_mwh"]
    for limit in (1_000_000, 200):
        got = exact_quantiles(observations, "price_usd_mwh", [0.0, 0.5, 0.8, 0.95, 1.0], limit)
        np.testing.assert_allclose(got, np.percentile(values, [0, 50, 80, 95, 100]), rtol=1e-12)


def test_published_arithmetic(spark):
    table = spark.createDataFrame([("Persistence", 0.1596), ("Ridge", 0.1306)], "model_name string, WMAPE double")
    got = {r.model_name: r.rel_improvement_pct for r in selection.relative_improvement(table, "Persistence").collect()}
    assert round(got["Ridge"], 2) == 18.17 and got["Persistence"] == 0.0
    gates = spark.createDataFrame([(18.91, 0.2957, 0.174, 16.88)], "rel_improvement_pct double, spike_recall double, "
                                  "worst_zone_wmape double, ci_lower_pct double")
    row = selection.deployment_gates(gates).first()
    assert (row.gate_1, row.gate_2, row.gate_3, row.gate_4, row.decision) == (True, True, False, True, "REJECT")


def test_metrics_of_edge_segments(spark):
    df = spark.createDataFrame([("one", 5.0, 4.0), ("flat", 2.0, 2.0), ("flat", 2.0, 2.0), ("off", 2.0, 1.0), ("off", 2.0, 2.0),
                                ("zero", 0.0, 1.0), ("zero", 0.0, 0.0)], "k string, actual_price double, predicted_price double")
    got = {r.k: r for r in metrics.by_segment(df, ["k"]).collect()}
    assert got["one"].R2 is None and got["flat"].R2 == 1.0 and got["off"].R2 == 0.0 and got["zero"].WMAPE == 0.0
    none = df.groupBy("k").agg(*spikes.spike_metrics(F.lit(100.0))).first()
    assert (none.spike_precision, none.spike_recall, none.spike_f1, none.spike_mae) == (0.0, 0.0, 0.0, 0.0)


def test_bootstraps(spark):
    rng = np.random.default_rng(3)
    n = 500
    y = rng.uniform(20, 90, n)
    base, cand = y + rng.normal(0, 12, n), y + rng.normal(0, 9, n)
    pdf = pd.DataFrame({"series_id": "s", "pos": np.arange(n), "err_base": abs(y - base), "err_cand": abs(y - cand), "volume": y})
    rows = spark.createDataFrame(pdf)
    a = bootstrap.block_replicates(rows, n, n_boot=50).orderBy("replicate").toPandas()
    b = bootstrap.block_replicates(rows, n, n_boot=50, max_rows=60, window_block=100).orderBy("replicate").toPandas()
    np.testing.assert_allclose(a.to_numpy(), b.to_numpy(), rtol=1e-9)
    iid = bootstrap.iid_replicates(rows, n, n_boot=80, block=128).toPandas()
    assert set(iid["draws"]) == {n} and len(iid) == 80
    again = bootstrap.iid_replicates(rows, n, n_boot=80, block=128).toPandas()
    np.testing.assert_allclose(iid.sort_values("replicate").to_numpy(), again.sort_values("replicate").to_numpy())
    row = bootstrap.interval(bootstrap.iid_replicates(rows, n, block=128), rows, "iid", 1, 400).first()
    assert row.ci_rel_lower_95_pct < row.rel_imp_point_pct < row.ci_rel_upper_95_pct
    assert abs(row.rel_imp_point_pct - (1 - pdf.err_cand.sum() / pdf.err_base.sum()) * 100) < 1e-4


def test_ridge_is_the_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 5, 20]
    y = x @ [2.0, -1.0, 0.3] + rng.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "price_usd_mwh": y}))
    model = regression.fit("Ridge", df, ["a", "b", "c"])
    got = regression.predict("Ridge", model, df).toPandas()["predicted_price"]
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean()))
    np.testing.assert_allclose(got, z @ w + y.mean(), rtol=1e-6)


def test_whole_evaluation(observations):
    rows = observations.withColumn("series_id", F.lit("market"))
    out = forecast.evaluate(rows, ["A", "B", "C"], models=("Persistence", "Ridge"), max_rows=300)
    assert out.tables["validation"].count() == 2
    cells = out.tables["shifted_segments"].toPandas()
    whole = cells[cells["zone"].isna() & cells["regime"].isna()].set_index("model_name")["count"]
    assert (cells[cells["zone"].notna() & cells["regime"].isna()].groupby("model_name")["count"].sum() == whole).all()
    assert out.tables["block_bootstrap"].count() == 1 and out.tables["spikes"].count() == 6


def test_no_row_is_lost_or_moved_by_size(spark):
    """Null, tied and hot time stamps number alike on either path."""
    rows = [("a", None if i % 10 == 0 else 100 + (i % 7 if i < 60 else 3), i) for i in range(200)] + [("b", i, 1000 + i) for i in range(40)]
    df = spark.createDataFrame(rows, "series_id string, ts int, event_id int").withColumn("ts", F.timestamp_seconds("ts"))
    plain, cut = (sorted(map(tuple, number_rows(df, ["series_id"], "ts", "event_id", n).select("event_id", "pos").collect()))
                  for n in (10_000, 20))
    assert plain == cut and len(cut) == 240


def test_lags_back_fill_with_the_next_known_price(spark):
    from gaugeworks.operators.features import LAGS, lag_and_roll

    prices = [None, 3.0, None, None, 7.0, *map(float, range(300)), None]
    df = spark.createDataFrame([("a", i, i, p) for i, p in enumerate(prices)],
                               "series_id string, ts int, event_id int, price_usd_mwh double")
    for most in (10_000, 50):
        got = lag_and_roll(df, max_rows=most, block=200).orderBy("pos").toPandas()
        for k in LAGS:
            want = pd.Series(prices, dtype=float).shift(k).bfill()
            assert got[f"lag_price_{k}"].equals(want.rename(f"lag_price_{k}")), (most, k)


def test_lags_back_fill_over_a_long_outage(spark):
    prices = [None, 2.0, *[None] * 700, 5.0, *map(float, range(40)), *[None] * 250]
    df = spark.createDataFrame([(s, i, i, p) for s in "ab" for i, p in enumerate(prices)],
                               "series_id string, ts int, event_id int, price_usd_mwh double")
    want = pd.DataFrame({f"lag_price_{k}": pd.Series(prices, dtype=float).shift(k).bfill() for k in features.LAGS})
    want["roll_price_mean_24"] = pd.Series(prices, dtype=float).shift(1).rolling(24, min_periods=1).mean().bfill()
    for most in (10_000, 50):
        got = features.lag_and_roll(df, max_rows=most, block=200).orderBy("series_id", "pos").toPandas()
        for _, one in got.groupby("series_id"):
            for c in want:
                np.testing.assert_allclose(one[c].astype(float), want[c], err_msg=f"{most} {c}")


def test_bootstrap_draws_every_series_to_its_length(spark):
    rows = [(s, i, 1.0, 0.5, 1.0) for s, n in (("a", 480), ("b", 100), ("c", 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "series_id string, pos long, err_base double, err_cand double, volume double")
    for got in (bootstrap.block_replicates(df, 587, n_boot=20), bootstrap.iid_replicates(df, 587, n_boot=20, block=64)):
        assert [r.volume for r in got.collect()] == [587.0] * 20


def test_ranges_of_a_long_series_are_bounded(spark):
    from gaugeworks.operators import series

    df = spark.range(5000).select(F.lit("s").alias("s"), F.col("id").alias("ts"), F.lit(0).alias("tie"))
    cut = series._chunked(df, ["s", "ts", "tie"], 10)
    assert cut.agg(F.countDistinct("_chunk")).first()[0] <= series.MAX_CHUNKS < 500
    got = series.number_rows(df, ["s"], "ts", "tie", 10)
    assert got.where("pos = ts").count() == 5000


def test_what_asks_no_regime_looks_for_no_threshold(spark, monkeypatch):
    import __spark_entry__ as entry
    from gaugeworks.operators import splits

    def none(*args, **kwargs):
        raise AssertionError("a threshold is looked for")
    monkeypatch.setattr(splits, "thresholds", none)
    for name in ("a01_wmape", "j02_candidate_vs_baseline", "j03_improvement_over_baseline"):
        assert entry.queries()[name](spark, "/root/testdata/sf0.001").count()


def test_a_lag_is_looked_up_and_not_framed(observations):
    df = features.lag_and_roll(observations, max_rows=50, block=256).select("pos", "lag_price_168")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "currentrow$())" in plan and "-168" in plan and "specifiedwindowframe(RowFrame, -168, currentrow$())" not in plan


def test_a_fit_has_no_more_tasks_than_its_rows_need(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(regression.Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()))
    train = spark.range(4000).repartition(64).selectExpr("double(id) AS x", "double(id % 7) AS price_usd_mwh")
    regression.fit("RandomForest", train, ["x"])
    assert seen == [spark.sparkContext.defaultParallelism]


def test_rows_are_read_once_for_their_forecast(spark):
    df = spark.createDataFrame([(float(i), float(i % 5), 2.0 * i) for i in range(50)] + [(None, 1.0, 3.0), (4.0, None, None)],
                               "x double, y double, price_usd_mwh double")
    out = regression.predict("Ridge", regression.fit("Ridge", df, ["x", "y"]), df)
    assert [r.predicted_price is None for r in out.orderBy(F.col("x").isNull() | F.col("y").isNull()).collect()] == [False] * 50 + [True] * 2
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_draws_are_not_taken_for_as_small_as_their_replicates(spark):
    n, kept = 12_000, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.range(n).select(F.lit("m").alias("series_id"), F.col("id").alias("pos"), *(
        (F.col("id") % k + 1).cast("double").alias(c) for k, c in ((7, "err_base"), (5, "err_cand"), (3, "volume")))).localCheckpoint()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        found = bootstrap.block_replicates(rows, n)
        assert len(found.collect()) == 400
        # 200,000 draws, of which a plan made in advance knows 400 replicates.
        assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
