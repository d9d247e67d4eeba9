"""Causal forecast features of an observation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.operators.series import (MAX_ROWS, longest_series, number_rows,
                                         over_positions)

LAGS = (1, 2, 24, 168)
ROLL = 24
EXCLUDED = ("timestamp", "ts", "zone", "product_type", "telemetry_status", "price_usd_mwh",
            "regime", "split_phase", "is_eligible_eval", "series_id", "event_id", "pos")


def _with_next(df: DataFrame, by: list[str], known: Column, block: int, max_rows: int,
               longest: int) -> DataFrame:
    """Add `_next`, the first known (pos, price) at a row of its series or after it."""
    upto = Window.unboundedPreceding, Window.currentRow

    def nearest(*group: str) -> Column:
        back = Window.partitionBy(*group).orderBy(F.desc("pos")).rowsBetween(*upto)
        return F.last(known, ignorenulls=True).over(back)

    if longest <= max_rows:
        return df.withColumn("_next", nearest(*by))
    placed = df.withColumn("_home", F.floor(F.col("pos") / block))
    # One row a block: the first known price of the blocks after it.
    later = Window.partitionBy(*by).orderBy(F.desc("_home")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = (placed.groupBy(*by, "_home").agg(F.min(known).alias("_known"))
             .select(*by, "_home", F.min("_known").over(later).alias("_ahead")))
    return (placed.withColumn("_next", nearest(*by, "_home")).join(ahead, [*by, "_home"])
            .withColumn("_next", F.coalesce("_next", "_ahead")).drop("_home", "_ahead"))


def lag_and_roll(df: DataFrame, series: str = "series_id", ts: str = "ts",
                 tie: str = "event_id", price: str = "price_usd_mwh",
                 max_rows: int = MAX_ROWS, block: int = 65_536,
                 drop_warmup: bool = False) -> DataFrame:
    """Lags 1, 2, 24 and 168 and the mean and sample deviation of the 24 rows before.

    A lag that is not there, at the head of a series or where the price is null,
    takes the next known price, however far on, as a back-fill of the shifted column
    does; a series too short for a lag has none. The mean is filled like lag 1. The
    deviation is 0 where it is not defined. `drop_warmup` leaves the head rows out.
    """
    by = [series]
    longest = longest_series(df, by)
    numbered = number_rows(df, by, ts, tie, max_rows, longest)
    known = F.when(F.col(price).isNotNull(), F.struct("pos", F.col(price).alias("price")))
    numbered = _with_next(numbered, by, known, block, max_rows, longest)
    # The first known price from k rows back on; a lag is right there, a fill comes later.
    # A row is looked up k rows back: a frame of k rows would be read anew for every row.
    head = Window.unboundedPreceding, Window.currentRow
    frames = {f"_lag_{k}": (lambda w, k=k: F.when(F.col("pos") < k, F.first("_next").over(w.rowsBetween(*head)))
                            .otherwise(F.lag("_next", k).over(w))) for k in LAGS}
    frames["_mean"] = lambda w: F.avg(price).over(w.rowsBetween(-ROLL, -1))
    frames["_std"] = lambda w: F.stddev_samp(price).over(w.rowsBetween(-ROLL, -1))
    out = over_positions(numbered, by, frames, before=max(LAGS), block=block,
                         max_rows=max_rows, longest=longest)
    out = out.join(df.groupBy(*by).agg(F.count("*").alias("_rows")), by)

    def filled(k: int) -> Column:
        # The shifted column ends with the price of the row k before the last.
        return F.when(F.col(f"_lag_{k}.pos") + k < F.col("_rows"), F.col(f"_lag_{k}.price"))

    out = out.select(
        *[c for c in df.columns], "pos",
        *[filled(k).alias(f"lag_price_{k}") for k in LAGS],
        F.coalesce("_mean", filled(1)).alias("roll_price_mean_24"),
        F.coalesce("_std", F.lit(0.0)).alias("roll_price_std_24"))
    return out.where(F.col("pos") >= max(LAGS)) if drop_warmup else out


def net_load() -> Column:
    return F.col("demand_mw") - F.col("renewable_generation_mw")


def cyclic(column: Column, period: float) -> tuple[Column, Column]:
    angle = 2 * F.pi() * column / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def with_calendar(df: DataFrame) -> DataFrame:
    hour_sin, hour_cos = cyclic(F.col("hour"), 24)
    dow_sin, dow_cos = cyclic(F.col("day_of_week"), 7)
    return df.select("*", net_load().alias("net_load_mw"),
                     hour_sin.alias("hour_sin"), hour_cos.alias("hour_cos"),
                     dow_sin.alias("dow_sin"), dow_cos.alias("dow_cos"))


def with_interactions(df: DataFrame) -> DataFrame:
    """Squared net load, fuel times load, heating and cooling degrees."""
    load = F.col("net_load_mw")
    scaled = load / 100.0
    return df.select(
        "*", (scaled * scaled).alias("net_load_squared"),
        (F.col("fuel_index_usd_mmbtu") * load / 100.0).alias("fuel_heat_interaction"),
        F.greatest(F.lit(0.0), 18.0 - F.col("temperature_c")).alias("temp_heating_deg"),
        F.greatest(F.lit(0.0), F.col("temperature_c") - 22.0).alias("temp_cooling_deg"))


def with_one_hot(df: DataFrame, zones: list[str], column: str = "zone") -> DataFrame:
    """One 0/1 column per named category, so that the schema does not hang on the data."""
    return df.select("*", *[F.when(F.col(column) == z, 1.0).otherwise(0.0).alias(f"zone_{z}")
                            for z in zones])


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in EXCLUDED]


def feature_matrix(df: DataFrame, zones: list[str], interactions: bool = True,
                   **windows) -> DataFrame:
    out = with_calendar(lag_and_roll(df, **windows))
    if interactions:
        out = with_interactions(out)
    return with_one_hot(out, zones)
