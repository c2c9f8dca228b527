"""One row per key: the one that sorts last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: str | list[str], order: list[str]) -> DataFrame:
    """The row of each key that is greatest by ``order`` (nulls last). ``order`` must settle all ties for a fixed result."""
    keys = [keys] if isinstance(keys, str) else keys
    by = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return rows.withColumn("_place", F.row_number().over(by)).where("_place = 1").drop("_place")
