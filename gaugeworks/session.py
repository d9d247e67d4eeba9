"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def build_session(app: str = "gaugeworks", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC time.

    On a cluster `master` and `shuffle_partitions` are left to the submitter;
    locally both are given. Anything in `conf` is set as written, with `__`
    standing for a dot.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut lineage: the cluster's own, else a local one in local mode.

    Off local mode a folder of one machine would not do, so none is made up.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all machines share")
        context = spark.sparkContext.applicationId
        if context not in _local:
            _local[context] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        folder = _local[context]
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
