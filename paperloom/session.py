"""Session settings and table access."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; on a cluster, leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName("paperloom")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": os.environ.get("PAPERLOOM_SHUFFLE_PARTITIONS", "200"),
    }
    return builder.config(map=settings | conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; its zone-less timestamps become instants in UTC, as watermarks need them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = {c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"}
    return df.withColumns(zoneless) if zoneless else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores if it has fewer splits than these: for rows that cost more than their shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df


def scratch(spark: SparkSession, name: str) -> str:
    """A path that no other run uses, in the folder that executors and driver share."""
    folder = with_checkpoints(spark).sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{re.sub('^file:/(?!/)', 'file:///', folder)}/{name}-{uuid.uuid4().hex}"


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """The session, with its checkpoint folder set: the one that the cluster names.

    Where none is named, a session in local mode gets a temporary one; on a cluster that is an error, as each
    executor would write to a disk of its own.
    """
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors and the driver share")
        spark.sparkContext.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="paperloom-"))
    return spark
