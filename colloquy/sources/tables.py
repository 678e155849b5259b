"""Readers for the driver tables (one parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table. Column pruning and filter pushdown
    happen in the scan because every consumer selects/filters afterwards."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` of a scan, dealt evenly over the cluster where one task would
    read more than twice its share: a file of one row group is one task,
    whatever its size, and so would be all that is done with its rows. Files of
    many row groups stay as they are. Rows are counted from the files' footers."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    held = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if held["all"] is None or held["most"] * cores <= 2 * held["all"]:
        return rows
    return rows.repartition(max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


class Tables:
    """Attribute access to the driver tables: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)
