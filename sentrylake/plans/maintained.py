"""Aggregates that are kept up to date by what changes, without reading what they were made of again.

The state is counted: for each group, how often each combination of values occurs. A change is rows that come (+1) and rows that go (-1). Counts add
up, so inserts, updates and deletes of rows change a group's count, sum, least, greatest and distinct values, also when the least value goes. States lie in buckets of
their groups; a change reads and rewrites the buckets that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import stored


def difference(gone: DataFrame, come: DataFrame, columns: list[str]) -> DataFrame:
    """columns, n: how much more often (or, below 0, less often) each row is in ``come`` than in ``gone``; rows that cancel out are left out."""
    both = gone.select(*columns, F.lit(-1).alias("n")).unionByName(come.select(*columns, F.lit(1).alias("n")))
    return both.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")


class CountedState:
    """How often each (group, values) occurs, stored under ``root`` in ``buckets`` folders. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, group: list[str], values: list[str], buckets: int = 64):
        self.spark, self.root, self.group, self.values, self.buckets = spark, root, group, values, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.group), F.lit(self.buckets)).cast("int")

    def _there(self) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def _stored(self, like: DataFrame) -> DataFrame:
        if not self._there():
            return like.limit(0)
        return self.spark.read.schema(like.schema).parquet(self.root).where("n > 0")

    def rows(self, like: DataFrame) -> DataFrame:
        """group, values, n of all that occurs. ``like`` has the columns."""
        shape = like.select(*self.group, *self.values, F.lit(0).cast("long").alias("n"), F.lit(0).alias("bucket"))
        return self._stored(shape).drop("bucket")

    def apply(self, change: DataFrame) -> list[int]:
        """Adds a ``difference`` and returns the buckets that were read and written again: none without a change.

        What goes must have been there; more going than there was is an error and changes nothing. Null groups and values are like others.
        """
        columns = [*self.group, *self.values]
        net = change.groupBy(*columns).agg(F.sum("n").cast("long").alias("n")).where("n <> 0")
        net = stored(net.withColumn("bucket", self._bucket()), "counted-change")
        touched = sorted(r[0] for r in net.select("bucket").distinct().collect())
        if not touched:
            return []
        held = self._stored(net).where(F.col("bucket").isin(touched))
        after = held.unionByName(net).groupBy(*columns, "bucket").agg(F.sum("n").alias("n"))
        checked = F.when(F.col("n") < 0, F.raise_error(F.lit("more rows go than there were")).cast("long")).otherwise(F.col("n"))
        # A row whose count has come to 0 is written once more, so that a bucket that empties is written at all.
        after = after.select(*columns, checked.alias("n"), "bucket").repartition("bucket")
        after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.root)
        return touched

    def groups(self, like: DataFrame, buckets: list[int] | None = None, **made: Column) -> DataFrame:
        """group and aggregates over its (values, n): of all groups, or of those in some buckets."""
        shape = like.select(*self.group, *self.values, F.lit(0).cast("long").alias("n"), F.lit(0).alias("bucket"))
        rows = self._stored(shape)
        rows = rows if buckets is None else rows.where(F.col("bucket").isin(buckets))
        return rows.groupBy(*self.group).agg(*[c.alias(n) for n, c in made.items()])
