"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass 1 scatters the rows uniformly into memory-sized buckets by a seeded hash of all their columns. Pass 2
deals each bucket into a Fisher-Yates order of its own. The buckets in turn are one uniformly
shuffled sequence, which is cut into shards whose row counts differ by at most one.

A bucket's permutation depends on the seed, the bucket and its number of rows alone. So it is built
once per bucket as an array of small integers by the inside-out form of Fisher-Yates, at the bucket's
first row, and the others look up their places; no row payload is ever gathered in an array, and one exchange
moves the rows. What is broadcast is bounded: the starts of SPANS stretches of buckets, and SLOTS hashes.

Rows that repeat too often for one bucket are counted first and dealt out again from their count, so that
their copies spread over the buckets like other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize, scratch_folder, utf8_size

#: Rows and bytes of a bucket on average: whichever comes first. A permutation costs the square of the rows in 4-byte moves.
ROWS_PER_BUCKET, BYTES_PER_BUCKET = 1024, 16 << 20
#: Stretches of buckets whose starts are broadcast at most (16 bytes each), and hashes of repeated rows (4 bytes each).
SPANS, SLOTS = 1 << 20, 1 << 20
#: Bytes of text that a task writes, about.
BYTES_PER_TASK = 16 << 20


def fisher_yates(n: Column, *seed: Column) -> Column:
    """An array with a uniform permutation of 0..n-1, drawn from a hash of the seeds (inside-out form)."""

    def put(done: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*seed, i), (i + 1).cast("long")).cast("int")
        moved = F.concat(F.slice(done, F.lit(1), j), F.array(i), F.slice(done, j + 2, i - j - 1), F.array(F.get(done, j)))
        return F.when(j == i, F.concat(done, F.array(i))).otherwise(moved)

    steps = F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.expr("array()").cast("array<int>"))
    return F.aggregate(steps, F.expr("cast(array() as array<int>)"), put)


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 0, id_col: str = "doc_id", rows_per_bucket: int = ROWS_PER_BUCKET, tasks: int | None = None) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    The order is a uniform shuffle fixed by ``seed`` and the rows. Shards hold row counts that differ
    by one at most. Rows with null ids or texts, empty and very long texts are dealt like others. Rows that share an id are
    dealt each for itself; rows equal in all columns are interchangeable, and spread over the buckets however many they are
    (frames with map columns, which can't be compared, keep them in one bucket).
    With ``tasks``, rows are scattered over so many tasks, each of which holds one stretch of the sequence.
    An empty frame gives no rows. Columns named shard or slot in ``df`` are replaced, other names are free.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    df = df.drop("shard", "slot")
    plain = [c for c, kind in df.dtypes if "map" not in kind and "variant" not in kind]
    own, times, bucket, span, rank, perm, start = (free_name(df, x) for x in ("row_hash", "times", "bucket", "span", "rank", "permutation", "start"))
    few = max(1, rows_per_bucket // 4)  # copies of a row that stay together
    row_hash = F.xxhash64(F.lit(seed), F.col(id_col), *[F.col(c) for c in plain])
    size = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) if kind in ("string", "binary") else F.lit(8) for c, kind in df.dtypes), F.lit(0))
    known = materialize(df.groupBy(row_hash.alias(own)).agg(F.count(F.lit(1)).alias(times), F.sum(size.cast("long")).alias("bytes")), "shard-rows")
    total, n_bytes = known.agg(F.sum(times), F.sum("bytes")).first()
    total = total or 0
    n_buckets = max(1, -(-total // rows_per_bucket), -(-(n_bytes or 0) // BYTES_PER_BUCKET))
    in_bucket = lambda part: F.pmod(F.xxhash64(F.lit(seed), F.col(own), part), F.lit(n_buckets)).cast("long")
    in_span = F.floor(F.col(bucket) / -(-n_buckets // SPANS))
    parts = F.sequence(F.lit(0), F.floor((F.col(times) - 1) / few).cast("long"))

    spread = known.where(F.col(times) > few) if len(plain) == len(df.columns) else known.limit(0)
    slot = F.pmod(F.col(own), F.lit(SLOTS)).cast("int")
    hot = F.broadcast(spread.select(slot.alias(perm)).distinct())
    keyed = df.withColumn(own, row_hash).withColumn(perm, slot)
    once = keyed.join(hot, perm, "left_anti").drop(perm).withColumn(bucket, in_bucket(F.lit(0).cast("long")))
    again = keyed.join(hot, perm, "left_semi").groupBy(*plain, own).agg(F.count(F.lit(1)).alias(times)).withColumn(rank, F.explode(parts)).repartition(own, rank)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(few).cast("long"), F.col(times) - F.col(rank) * few)))
    again = again.withColumn(bucket, in_bucket(F.col(rank))).withColumn(rank, copies).drop(rank, times)
    scattered = (once.unionByName(again) if len(plain) == len(df.columns) else once).withColumn(span, in_span)

    of_part = F.when(F.col(rank) < F.floor((F.col(times) - 1) / few), F.lit(few)).otherwise(F.col(times) - F.col(rank) * few)
    dealt = known.withColumn(rank, F.explode(parts)) if len(plain) == len(df.columns) else known.withColumn(rank, F.lit(0).cast("long"))
    counts = dealt.select(in_bucket(F.col(rank)).alias(bucket), (of_part if len(plain) == len(df.columns) else F.col(times)).alias(times)).groupBy(in_span.alias(span)).agg(F.sum(times).alias(times))
    starts = counts.select(span, (F.sum(times).over(Window.orderBy(span)) - F.col(times)).alias(start))

    dealt = scattered.repartitionByRange(tasks, span) if tasks else scattered.repartitionByRange(span)
    inside = Window.partitionBy(span, bucket).orderBy(F.xxhash64(F.lit(seed + 1), F.col(own)), *plain)
    whole = Window.partitionBy(span, bucket)
    upto = Window.partitionBy(span).orderBy(bucket).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = dealt.withColumn(rank, F.row_number().over(inside)).withColumn(times, F.count(F.lit(1)).over(whole))
    ranked = ranked.withColumn(perm, F.when(F.col(rank) == 1, fisher_yates(F.col(times), F.lit(seed), F.col(bucket)))).withColumn(perm, F.first(perm, True).over(whole))
    ranked = ranked.withColumn(rank, F.element_at(F.col(perm), F.col(rank))).drop(perm).withColumn(times, F.count(F.lit(1)).over(upto) - F.col(times))
    placed = ranked.join(F.broadcast(starts), span).withColumn(rank, F.col(start) + F.col(times) + F.col(rank))
    small, larger = divmod(total, n_shards)
    edge = larger * (small + 1)
    place = F.col(rank)
    shard = F.when(place < edge, F.floor(place / (small + 1))).otherwise(larger + F.floor((place - edge) / max(small, 1))).cast("int")
    first = F.col("shard") * F.lit(small).cast("long") + F.least(F.col("shard"), F.lit(larger))
    return placed.withColumn("shard", shard).withColumn("slot", (place - first).cast("long")).select(*df.columns, "shard", "slot")


def _text_bytes(df: DataFrame) -> int:
    texts = [F.sum(utf8_size(F.col(c))) for c, kind in df.dtypes if kind in ("string", "binary")]
    return sum(n or 0 for n in df.agg(*texts).first()) if texts else 0


def write_shards(sharded: DataFrame, path: str, tasks_per_shard: int | None = None) -> None:
    """Writes each shard to its own folder, each of its files in slot order; by default in files of about BYTES_PER_TASK."""
    shards = 1 + (sharded.agg(F.max("shard")).first()[0] or 0)
    tasks = max(shards, tasks_per_shard * shards if tasks_per_shard else -(-_text_bytes(sharded) // BYTES_PER_TASK))
    dealt = sharded.repartitionByRange(tasks, "shard", "slot")
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def stored_shards(docs: DataFrame, n_shards: int) -> DataFrame:
    """``docs``, whole, shuffled into shards that are written to the shared folder, as read back from there.

    ``shard`` is that of the folder in which a row lies. The folder is deleted when the driver ends.
    """
    spark = docs.sparkSession
    path = scratch_folder(spark, "shards")
    # A task's buckets are one stretch of the shuffled sequence, so it writes its part of a shard without another exchange.
    sharded = shuffle_into_shards(docs, n_shards, tasks=max(n_shards, -(-_text_bytes(docs) // BYTES_PER_TASK)))
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(sharded.schema).parquet(path)
