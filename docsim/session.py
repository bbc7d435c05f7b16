"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "docsim", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library expects; on a cluster pass no ``master``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="docsim-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder that goes when Python ends; a
    cluster session gets an error, because a folder of one machine is lost with that machine.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    return _local_folder(spark.sparkContext.applicationId).name


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/docsim/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, later stages read
    only the columns they use, and the optimizer sees the real size.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
