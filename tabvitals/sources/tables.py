"""Reading the tables to be checked."""

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, one file or a folder of files, partitioned or not."""
    return spark.read.parquet(path)
