"""What the operators of this subpackage share: shared storage, stable hashes of rows, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import delete, scratch_folder, shared_folder  # noqa: F401  one place for what the library writes aside


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back.

    That cuts the lineage (lost executors cost no recomputation beyond this table) and lets later
    readers take only the columns they need. The folder is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes what ``materialize`` wrote, once nothing reads it any more."""
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        delete(df.sparkSession, f)


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame doesn't have yet."""
    have = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in have:
        name = f"_{name}"
    return name


#: Rows of an Arrow batch, where the session doesn't say: two batches of long texts fit a task's memory on either side.
BATCH_ROWS = 1024


def small_batches(df: DataFrame) -> None:
    """Lets Arrow batches hold BATCH_ROWS rows, unless the session has a size of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(name, None) is None:
        df.sparkSession.conf.set(name, BATCH_ROWS)


def give_back() -> None:
    """Returns what a task has freed to the system, as workers stay for the next stages."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(df: DataFrame, keep: list[str], make, schema: str, many: bool = False) -> DataFrame:
    """Runs ``make()(values of the other columns of a row) -> tuple`` over the rows, in Arrow batches.
    With ``many``, the function takes a list of such rows and returns a list of tuples.

    ``df`` holds the columns ``keep``, which are passed on, then those that the function takes;
    ``schema`` names what it returns. ``make`` runs once per task, and prepares models there. Rows are
    taken and handed on a few at a time, so that a batch of very long texts needs little memory.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    given = df.columns[len(keep):]
    out = StructType([*(df.schema[c] for c in keep), *StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        function = make()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                values = [batch.column(len(keep) + i) for i in range(len(given))]
                given_rows = list(zip(*(v.to_pylist() for v in values)))
                rows = function(given_rows) if many else [function(*row) for row in given_rows]
                columns = list(zip(*rows)) or [[]] * (len(arrow) - len(keep))
                made = [pa.array(c, type=arrow.field(len(keep) + i).type) for i, c in enumerate(columns)]
                kept = [c if (c := batch.column(i)).type == arrow.field(i).type else c.cast(arrow.field(i).type) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *made], schema=arrow)
        give_back()

    small_batches(df)
    return df.mapInArrow(run, out)


def filter_texts(df: DataFrame, make, text: str = "text") -> DataFrame:
    """The rows whose text ``make()`` accepts, in all their columns. ``make`` runs once per task; it accepts a list of texts at a time."""
    at = df.columns.index(text)

    def run(batches):
        import pyarrow as pa

        accepts = make()
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                yield batch.filter(pa.array(list(accepts(batch.column(at).to_pylist())), pa.bool_()))
        give_back()

    small_batches(df)
    return df.mapInArrow(run, df.schema)
