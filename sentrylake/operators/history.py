"""Type-2 history: from what was said of a key at each moment to the intervals in which a state was valid.

Each moment of a key is a point with a state. A run of equal states is one interval, from the run's first point to the next run's. Points lie in
range partitions by key and time, and an edge carries the last state before it and the next start behind it, so that a
key with very many points is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranges import _PART, cut


def points(changes: DataFrame, keys: list[str], at: str, values: list[str], order: list[str] = [], ordered: bool = False) -> DataFrame:  # noqa: B006
    """keys, at, values: one row per key and moment, of several rows the greatest by ``order`` (nulls first). Null keys and times take no part.

    ``ordered``: with the columns of ``order`` behind them, as ``with_late`` needs where what comes late may be older.
    """
    known = changes.dropna(subset=[*keys, at])
    shown = [*values, *(c for c in order if c not in values)] if ordered else values
    last = F.max_by(F.struct(*shown), F.struct(*[F.col(c) for c in order], F.lit(0)))
    return known.groupBy(*keys, at).agg(last.alias("_state")).select(*keys, at, *[F.col("_state")[c].alias(c) for c in shown])


def _carried(line: DataFrame, keys: list[str], what, name: str, forward: bool) -> DataFrame:
    """keys, part and what the nearest ranges before (or behind) hold of the key; only keys in several ranges have any."""
    ends = line.groupBy(*keys, _PART).agg(what.alias("_end"))
    key = Window.partitionBy(*keys)
    order = key.orderBy(F.col(_PART).asc() if forward else F.col(_PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = ends.withColumn("_spans", F.count(F.lit(1)).over(key)).withColumn(name, F.last("_end", True).over(order))
    return F.broadcast(found.where((F.col("_spans") > 1) & F.col(name).isNotNull()).select(*keys, _PART, name))


def intervals(states: DataFrame, keys: list[str], at: str, values: list[str], gone=None, parts: int | None = None) -> DataFrame:
    """keys, values, valid_from, valid_to, is_current of the runs of equal states of ``points``; nulls equal nulls.

    ``valid_to`` is the start of the next run, null for the last. States for which ``gone`` holds end an interval and are none themselves.
    """
    line = cut(states, [*keys, at], parts).withColumn("_state", F.struct(*values))
    inside = Window.partitionBy(_PART, *keys).orderBy(at)
    before = _carried(line, keys, F.max_by("_state", at), "_before", forward=True)
    marked = line.join(before, [*keys, _PART], "left").withColumn("_nth", F.row_number().over(inside))
    last = F.when(F.col("_nth") > 1, F.lag("_state").over(inside)).otherwise(F.col("_before"))
    marked = marked.withColumn("_last", last)
    starts = marked.where(F.col("_last").isNull() | ~F.col("_state").eqNullSafe(F.col("_last")))
    behind = _carried(starts, keys, F.min(at), "_behind", forward=False)
    ended = starts.join(behind, [*keys, _PART], "left").withColumn("valid_to", F.coalesce(F.lead(at).over(inside), F.col("_behind")))
    if gone is not None:
        ended = ended.where(~F.coalesce(gone, F.lit(False)))
    return ended.select(*keys, *values, F.col(at).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def with_late(known: DataFrame, late: DataFrame, keys: list[str], at: str, order: list[str] = []) -> tuple[DataFrame, DataFrame]:  # noqa: B006
    """(points once the ``late`` ones are among them, those of the keys that they touch): a late point replaces one of its key and moment, unless that is greater by ``order``.

    Whatever order points arrive in, the points are the same, and so are the intervals; only keys that were touched need be made anew. That takes
    ``order``, of points made with it and ``ordered``: without it what comes last wins.
    """
    if order:
        both = known.withColumn("_late", F.lit(0)).unionByName(late.withColumn("_late", F.lit(1)))
        every = points(both, keys, at, [c for c in known.columns if c not in (*keys, at)], [*order, "_late"])
    else:
        every = known.join(late.select(*keys, at), [*keys, at], "left_anti").unionByName(late)
    return every, every.join(late.select(*keys).distinct(), keys, "left_semi")
