"""The four forecasters, on Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

RUN_IDS = {"Persistence": "persistence_v1", "Ridge": "ridge_reg_v1",
           "RandomForest": "random_forest_v1",
           "HistGradientBoosting": "hist_gradient_boosting_v1"}
SEED = 42
# Training rows of one task: each task sends its statistics of every node of a tree, so there are no more tasks than needed.
TASK_ROWS = 2_000_000


def persistence(df: DataFrame) -> DataFrame:
    return df.withColumn("predicted_price", F.col("lag_price_1"))


def ridge(rows: int, spread: float, alpha: float = 10.0) -> list:
    """Standardised inputs and an L2 penalty of `alpha` on the summed squared error.

    Spark scales inputs by the sample deviation, where the population one is meant
    (a factor of (n - 1) / n on the penalty), averages the squared error (1 / n),
    and divides the penalty by the label's population deviation, `spread`.
    """
    return [
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LinearRegression(featuresCol="features", labelCol="price_usd_mwh",
                         predictionCol="predicted_price", elasticNetParam=0.0,
                         regParam=spread * alpha * (rows - 1) / rows ** 2, standardization=False,
                         solver="normal"),
    ]


def forest() -> list:
    return [RandomForestRegressor(featuresCol="raw_features", labelCol="price_usd_mwh",
                                  predictionCol="predicted_price", numTrees=80, maxDepth=10,
                                  minInstancesPerNode=5, seed=SEED)]


def boosting() -> list:
    return [GBTRegressor(featuresCol="raw_features", labelCol="price_usd_mwh",
                         predictionCol="predicted_price", maxIter=100, maxDepth=6,
                         stepSize=0.08, minInstancesPerNode=20, maxBins=255, seed=SEED)]


def fit(name: str, train: DataFrame, features: list[str]) -> PipelineModel | None:
    """A fitted pipeline; persistence needs none."""
    if name == "Persistence":
        return None
    # Every stage and iteration reads the rows again. A row without a feature or price teaches nothing.
    train = train.select(*features, "price_usd_mwh").dropna().persist()
    try:
        size = train.agg(F.count("*"), F.stddev_pop("price_usd_mwh")).first()
        stages = {"Ridge": lambda: ridge(*size), "RandomForest": forest,
                  "HistGradientBoosting": boosting}[name]()
        gather = VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="keep")
        tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-size[0] // TASK_ROWS))
        return Pipeline(stages=[gather, *stages]).fit(train.coalesce(tasks))
    finally:
        train.unpersist()


def predict(name: str, model: PipelineModel | None, df: DataFrame) -> DataFrame:
    """Every row of `df` with its forecast, null where a feature is."""
    if model is None:
        out = persistence(df)
    else:
        whole = ~F.expr(" OR ".join(f"`{c}` IS NULL" for c in model.stages[0].getInputCols()))
        out = model.transform(df).drop("raw_features", "features").withColumn(
            "predicted_price", F.when(whole, F.col("predicted_price")))
    return out.withColumn("model_name", F.lit(name)).withColumn("run_id", F.lit(RUN_IDS[name]))
