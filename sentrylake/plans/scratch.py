"""Folders that driver and executors share for as long as the driver runs."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` of the session names.

    Only where the session names none and runs on one machine (tests) a temporary folder is made; on a cluster that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sentrylake-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may have ended; the folder is then the cluster's to clean
        pass


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path inside the shared one; what lies there is deleted when the driver ends."""
    path = f"{shared_folder(spark)}/sentrylake-{name}-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and what was drawn or numbered stays as it is."""
    path, schema = scratch_folder(df.sparkSession, name), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
