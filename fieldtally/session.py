"""Session setup and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
LOCAL_DEFAULTS = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_session(app: str = "fieldtally", master: str | None = None, **conf: str) -> SparkSession:
    """A session; on a cluster, leave ``master`` unset and let spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = LOCAL_DEFAULTS if master and master.startswith("local") else {}
    for key, value in {**DEFAULTS, **local, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and pins values that a recomputation could change. Survives the loss of
    executors, which cached or locally checkpointed blocks do not.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
