"""What must be there before the first run: databases for the layers, and the landing folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .model import TABLES

CONTROL = "control"


def set_up(spark: SparkSession, landing: str, prefix: str = "") -> list[str]:
    """Creates a database for each layer of the registry and the landing folder, where they aren't there yet; returns the databases."""
    names = [f"{prefix}{layer}" for layer in sorted({t.layer for t in TABLES.values()} | {CONTROL})]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return names
