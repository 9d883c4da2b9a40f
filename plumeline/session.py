"""Session helpers: recommended settings and shared scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster should start with.  AQE picks join strategies, merges
# small shuffle partitions and splits skewed ones at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as ``spark.checkpoint.dir`` names it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return configured


def _application_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/plumeline-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_application_root(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; results that read them end with it."""
    _delete(spark, _application_root(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    The result survives the loss of any executor and carries no lineage.  The
    files stay until :func:`clear_scratch`, because the result reads them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`materialize`, with the files dropped when the block ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)
