"""Readers for supplied tables and writers for results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.missing import nan_to_null, no_nan

CROSSWALK_SCHEMA = T.StructType([
    T.StructField("zip", T.StringType()),
    T.StructField("tract", T.StringType()),
    T.StructField("res_ratio", T.DoubleType()),
])


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite a partitioned Parquet data set; partitions left over go too.

    Rows are first gathered by partition value, with enough tasks per value
    that adaptive execution can split a large one, so that the number of files
    follows the data and not tasks x values.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_crosswalk(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Zip-to-tract records with fixed types, whatever the file format."""
    if fmt == "parquet":
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CROSSWALK_SCHEMA]
        return spark.read.parquet(path).select(*columns)
    reader = spark.read.schema(CROSSWALK_SCHEMA)
    return reader.csv(path, header=True) if fmt == "csv" else reader.json(path)


def read_monthly_exposures(spark: SparkSession, path: str) -> DataFrame:
    """Long monthly exposures; the year stays text because not all are years."""
    return spark.read.option("recursiveFileLookup", True).parquet(path).select(
        F.col("geoid").cast("string").alias("geoid"), F.col("year").cast("string").alias("year"),
        F.col("month").cast("int").alias("month"), "variable",
        no_nan(F.col("value").cast("double")).alias("value"))


def read_daily_covariates(spark: SparkSession, path: str) -> DataFrame:
    """Wide daily covariates: date, geo_id, geo_type and one column each."""
    wide = spark.read.parquet(path)
    missing = {"date", "geo_id", "geo_type"} - set(wide.columns)
    if missing:
        raise ValueError(f"daily covariates lack {sorted(missing)}")
    return nan_to_null(wide)
