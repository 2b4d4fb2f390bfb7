"""Sessions with the settings that the engine is laid out for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "docloom", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """This application's part of the folder in spark.checkpoint.dir; a folder of this machine only where none is set."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="docloom-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same, as a table of which nothing but its size is known to the planner.

    A checkpoint keeps the planner's estimates. In a loop of joins each turn multiplies them, and after some turns planning
    multiplies numbers of millions of digits; a table's size is what its files have.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
