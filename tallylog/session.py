"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Minutes are UTC minutes, so every plan runs under a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else a folder of the warehouse."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tallylog-tables"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Stores a small derived table, so later steps never rescan the logs.

    The table lies in the shared folder, so losing an executor loses nothing. As
    Parquet it is read by column, and its size is known to the join planning; the
    row files of ``checkpoint()`` offer neither.
    """
    spark = df.sparkSession
    path = shared_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
