"""Sessions of a stream of events that arrive late and more than once.

Events are told apart by their own columns within the watermark, and gathered in session windows by key. A session comes out once, when the
watermark has passed its end; what arrives for it afterwards is dropped. State is kept for no longer than the watermark's delay and the
longest session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def sessions(events: DataFrame, key: str, at: str, same: list[str], gap: str, delay: str) -> DataFrame:
    """key, first, last, n of each session of a stream: events of which each lies ``gap`` behind the one before at most.

    Rows that agree in ``same`` are one event if the second comes within ``delay``. Rows without key or time are left out. Rows that are later than ``delay``
    behind the latest time of the batches before are dropped.
    """
    known = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn(at, F.col(at).cast("timestamp"))
    once = known.withWatermark(at, delay).dropDuplicatesWithinWatermark(same)
    found = once.groupBy(F.session_window(at, gap).alias("window"), key).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n"))
    return found.select(key, "first", "last", "n")


def stream_sessions(spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str, key: str, at: str, same: list[str], gap: str, delay: str, files: int = 1) -> StreamingQuery:
    """Takes the Parquet files under ``folder`` that no run has taken, ``files`` to a batch, oldest first, appends finished sessions to ``out``, and stops.

    The checkpoint knows files, state and watermark: a run that was broken off goes on where it ended, and a run without new files adds nothing."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).parquet(folder)
    found = sessions(events, key, at, same, gap, delay)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
