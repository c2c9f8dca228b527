"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations.

Each source's documents stand in a shuffled order fixed by a seed. A document's virtual finish time
is the source's cumulative size up to and with it, divided by the source's target; a second pass over
the source goes on where the first ended. All copies together are ordered by finish time and cut
where the total budget is spent. Sources so advance side by side, each at the rate of its target.

Nothing is ordered in one task: a source is cut into hash prefixes whose sums give each its start,
and the global order is cut by summing ranges of finish time first and ordering only the one range
in which the budget ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, free_name, materialize

#: Rows of one source that share a hash prefix, and copies that share a range of finish times, on average.
ROWS_PER_PIECE = 4096
#: Sources whose last places are broadcast at most: some 150 bytes each.
SOURCES = 100_000
#: Ranges of finish times that are summed together first.
RANGES_PER_STRETCH = 4096


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_repeat: int) -> DataFrame:
    """A row per source: ``source``, ``source_size``, ``target``.

    Sources in code-point order, null last, take the weights in turn. Together they get ``share`` times
    all sizes, each in proportion to its weight but ``max_repeat`` times its own size at most; what
    that cuts off goes to the others by weight. The level of the water is found in closed form: in
    order of cap by weight, a source is capped as long as the level over the rest lies above its own.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights)) + 1)
    every = Window.partitionBy()
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeat)
    ranked = ranked.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share))).withColumn("fill", F.col("cap") / F.col("weight"))
    below = Window.orderBy("fill").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("fill")
    ranked = ranked.withColumn("caps", F.sum("cap").over(below) - F.sum("cap").over(same)).withColumn("rest", F.sum("weight").over(every) - F.sum("weight").over(below) + F.sum("weight").over(same))
    ranked = ranked.withColumn("level", (F.col("budget") - F.col("caps")) / F.col("rest")).withColumn("capped", F.col("fill") <= F.col("level"))
    level = F.min(F.when(~F.col("capped"), F.struct("fill", "level"))).over(every)["level"]
    return ranked.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level).alias("target"))


def _spot(seed: int) -> Column:
    """Where a document stands in the shuffled order of its source; documents of one spot follow by id and size."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix_sources(rows: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2, seed: int = 0) -> DataFrame:
    """Decides how often the mix takes each row of ``rows`` (``doc_id``, ``source``, ``size``).

    Returns doc_id, source, size, source_size, target and ``copies`` (0 to max_repeat). Null sizes count
    as 0, a null source is a source of its own, null ids are ordered like any other; a source without
    words has target 0 and none is taken. Repeated rows are taken each for itself. Texts aren't looked at, only sizes, however large. No rows in, no rows out; other columns are dropped, whatever their names.
    """
    at = _spot(seed)
    sized = rows = materialize(rows.select("doc_id", "source", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"), at.alias("at")), "mix-sizes")
    total = rows.count()
    digits = max(0, math.ceil(math.log(max(1, total / ROWS_PER_PIECE), 16)))
    piece = F.substring("at", 1, digits) if digits else F.lit("")

    targets = source_targets(rows, weights, share, max_repeat)
    rows = rows.withColumn("piece", piece)
    sums = rows.groupBy("source", "piece").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("piece")) - F.col("n")
    starts = sums.select(F.col("source").alias("s"), F.col("piece").alias("p"), before.alias("before"))
    within = F.sum("size").over(Window.partitionBy("source", "piece").orderBy("at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    timed = rows.withColumn("within", within).join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")))
    timed = timed.select("doc_id", "source", "size", "at", (F.col("before") + F.col("within")).alias("upto"))
    targets = targets.withColumnRenamed("source", "t")
    timed = materialize(timed.join(targets, F.col("source").eqNullSafe(F.col("t"))).drop("t"), "mix-times")
    discard(sized)

    def finish(epoch: Column) -> Column:
        return F.try_divide(F.col("upto") + F.col("source_size") * epoch, F.col("target"))

    edge = _edge(timed, finish, max_repeat, total)
    copies = F.lit(0)
    for epoch in range(max_repeat):
        place = _place(finish(F.lit(epoch)), F.lit(epoch))
        copies = copies + F.when(finish(F.lit(epoch)).isNotNull() & (place <= edge), 1).otherwise(0) if edge is not None else copies
    return timed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def _place(finish: Column, epoch: Column) -> Column:
    return F.struct(finish.alias("finish"), F.col("at").alias("at"), F.col("doc_id").alias("doc_id"), F.col("size").alias("size"), epoch.alias("epoch"))


def _cut(sums: DataFrame, before: int, budget: float) -> tuple[int, int]:
    """(what is spent before it, the range in which the budget ends, or the last one) of a bounded number of ranges."""
    last = before, 0
    for r in sorted(sums.collect(), key=lambda r: r["range"]):
        last = before, r["range"]
        before += r["n"]
        if before > budget:
            break
    return last


def _edge(timed: DataFrame, finish, max_repeat: int, total: int) -> Column | None:
    """The last place in the global order that the budget still covers; None if it covers no copy."""
    budget = timed.select("source", "target").groupBy("source").agg(F.max("target").alias("target")).agg(F.sum("target")).first()[0]
    if not budget:
        return None
    pieces = max(256, math.ceil(total / ROWS_PER_PIECE))
    epochs = F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1)))
    copies = timed.select("*", epochs.alias("epoch")).withColumn("finish", finish(F.col("epoch"))).where(F.col("finish").isNotNull())
    copies = copies.withColumn("range", F.least(F.floor(F.col("finish") * pieces), F.lit(2 * pieces)))
    # The range in which the budget ends is found in stretches of ranges first, so that neither step has many rows.
    sums = materialize(copies.groupBy("range").agg(F.sum("size").alias("n")), "mix-ranges")
    stretch = F.floor(F.col("range") / RANGES_PER_STRETCH)
    before, inside = _cut(sums.groupBy(stretch.alias("range")).agg(F.sum("n").alias("n")), 0, budget)
    spent, cut = _cut(sums.where(stretch == inside), before, budget)
    discard(sums)
    last = copies.where(F.col("range") == cut).withColumn("place", _place(F.col("finish"), F.col("epoch")))
    last = last.withColumn("spent", spent + F.sum("size").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    found = last.where(F.col("spent") <= budget).agg(F.max("place").alias("place")).first()["place"]
    if found is None:  # the budget ends before this range's first copy
        found = copies.where(F.col("range") < cut).agg(F.max(_place(F.col("finish"), F.col("epoch"))).alias("place")).first()["place"]
    if found is None:
        return None
    kinds = {f.name: f.dataType for f in timed.schema}
    return F.struct(F.lit(found["finish"]).alias("finish"), F.lit(found["at"]).alias("at"), F.lit(found["doc_id"]).cast(kinds["doc_id"]).alias("doc_id"), F.lit(found["size"]).cast("long").alias("size"), F.lit(found["epoch"]).alias("epoch"))


def take_mix(docs: DataFrame, decided: DataFrame, size: Column, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` as the mix holds them: each row ``copies`` times, in its own columns, whatever their names.

    What the mix takes of a source, once or again, is the beginning of its shuffled order. So a row per source with the last
    places taken is enough to decide, and no text is moved. Rows that share place, id and size with the last one taken and aren't all
    taken are numbered within the tasks that read them, and the first ones are.
    """
    row, key, of, task, nth = (free_name(docs, x) for x in ("row", "key", "of", "task", "nth"))
    times = range(1, 1 + (decided.agg(F.max("copies")).first()[0] or 0))
    place = F.struct(_spot(seed).alias("at"), F.col("doc_id"), F.col("size").cast("long").alias("size"))
    each = decided.select(F.col("source").alias("s"), "copies", place.alias("place"))
    cuts = each.groupBy("s").agg(*[F.max(F.when(F.col("copies") >= k, F.col("place"))).alias(f"cut{k}") for k in times], F.count(F.lit(1)).alias("n"))
    cuts = materialize(cuts, "mix-cuts")
    few = cuts.count() <= SOURCES
    small = F.broadcast(cuts) if few else cuts
    tied = [F.count_if(F.col("place") == F.col(f"cut{k}")).alias(f"all{k}") for k in times] + [F.count_if((F.col("place") == F.col(f"cut{k}")) & (F.col("copies") >= k)).alias(f"taken{k}") for k in times]
    ties = each.join(small.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t"))).groupBy("s", *[f"cut{k}" for k in times]).agg(*tied, F.count(F.lit(1)).alias("n"))
    ties = materialize(ties, "mix-ties")
    discard(cuts)
    partial = sum(((F.col(f"taken{k}") < F.col(f"all{k}")).cast("int") for k in times), F.lit(0)) > 0

    mine = F.struct(_spot(seed).alias("at"), F.col("doc_id"), F.coalesce(size, F.lit(0)).cast("long").alias("size"))
    left = docs.select(mine.alias(key), F.col("source").alias(of), F.struct(*[docs[c] for c in docs.columns]).alias(row))
    left = left.join(F.broadcast(ties) if few else ties, F.col(of).eqNullSafe(F.col("s")))
    at_edge = lambda k: (F.col(key) == F.col(f"cut{k}")) & (F.col(f"taken{k}") < F.col(f"all{k}"))
    number = sum((F.when(F.col(key) <= F.col(f"cut{k}"), F.when(at_edge(k), F.coalesce(F.col(nth) <= F.col(f"taken{k}"), F.lit(False)).cast("int")).otherwise(1)).otherwise(0) for k in times), F.lit(0))
    on_edge = F.coalesce(sum((at_edge(k).cast("int") for k in times), F.lit(0)) > 0, F.lit(False))
    if ties.where(partial).isEmpty():
        taken = left.withColumn(nth, F.lit(None).cast("long"))
    else:
        held = left.where(on_edge).withColumn(task, F.spark_partition_id())
        held = held.withColumn(nth, F.row_number().over(Window.partitionBy(of, key, task).orderBy(F.xxhash64(*[F.col(row)[c] for c, kind in docs.dtypes if "map" not in kind]))))
        counts = held.groupBy(F.col(of).alias("a"), F.col(key).alias("b"), F.col(task).alias("c")).agg(F.count(F.lit(1)).alias("in_task"))
        starts = counts.withColumn("start", F.sum("in_task").over(Window.partitionBy("a", "b").orderBy("c")) - F.col("in_task"))
        held = held.join(starts, F.col(of).eqNullSafe(F.col("a")) & (F.col(key) == F.col("b")) & (F.col(task) == F.col("c"))).withColumn(nth, (F.col(nth) + F.col("start")).cast("long"))
        taken = left.where(~on_edge).withColumn(nth, F.lit(None).cast("long")).unionByName(held.select(*left.columns, nth))
    taken = taken.select(row, number.alias(of)).where(F.col(of) > 0).select(row, F.explode(F.sequence(F.lit(1), F.col(of))))
    return taken.select(*[F.col(row)[c].alias(c) for c in docs.columns])
