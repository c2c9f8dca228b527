"""Sweeps over lines that are cut into ranges: what one range needs of those before it is carried over, whatever the keys' sizes.

``as_of`` gives rows the last known state of their key at their time. ``holding`` finds which points lie in which intervals of
their key, ``counted`` how many of whose. The first two lay two sides in one line, sorted by key and place and dealt over range partitions, so that a key with very many rows lies in
many of them. Only keys that reach over an edge carry anything, and each edge has one such key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import stored

_PART = "_part"


def cut(line: DataFrame, by: list[str], parts: int | None = None) -> DataFrame:
    """The rows in ranges of ``by``, with the number of their range. Stored, as another run of the sampling might cut elsewhere."""
    n = parts or int(line.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(line.repartitionByRange(n, *by).withColumn(_PART, F.spark_partition_id()), "ranges")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, values: list[str], order: list[str] = [], parts: int | None = None) -> DataFrame:  # noqa: B006
    """``left`` with the ``values`` of the last row of ``right`` with equal ``keys`` whose ``since`` is not after the row's ``at``.

    Of rows with one ``since`` the greatest by ``order`` counts (nulls first). Null keys and null times match nothing; such rows of
    ``left`` and those before all of their key stay, with null values. Every row of ``left`` comes out once, repeated ones too.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    known = lambda df, time: [F.col(k).isNotNull() for k in [*keys, time]]

    def both(conditions: list[Column]) -> Column:
        out = conditions[0]
        for c in conditions[1:]:
            out = out & c
        return out

    own, found = F.struct(*[left[c] for c in left.columns]), F.struct(*[right[c].alias(c) for c in values])
    kind = left.select(own.alias("r")).schema["r"].dataType, right.select(found.alias("v")).schema["v"].dataType
    place = [F.col(k).alias(n) for k, n in zip(keys, names)]
    tie = right.select(F.struct(F.lit(0).alias("_"), *[F.col(c) for c in order]).alias("t")).schema["t"].dataType
    rows = left.where(both(known(left, at))).select(own.alias("_row"), *place, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.monotonically_increasing_id().alias("_spread"), F.lit(None).cast(kind[1]).alias("_value"), F.lit(None).cast(tie).alias("_tie"))
    states = right.where(both(known(right, since))).select(F.lit(None).cast(kind[0]).alias("_row"), *place, F.col(since).alias("_at"), F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_spread"), found.alias("_value"), F.struct(F.lit(0).alias("_"), *[F.col(c) for c in order]).alias("_tie"))
    line = cut(rows.unionByName(states), [*names, "_at", "_side", "_spread"], parts)

    inside = Window.partitionBy(_PART, *names).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = line.groupBy(*names, _PART).agg(F.max_by("_value", F.when(F.col("_side") == 0, F.struct("_at", "_tie"))).alias("_end"))
    key = Window.partitionBy(*names)
    carried = ends.withColumn("_spans", F.count(F.lit(1)).over(key)).withColumn("_carried", F.last("_end", True).over(key.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)))
    carried = carried.where((F.col("_spans") > 1) & F.col("_carried").isNotNull()).select(*names, _PART, "_carried")
    # Two keys reach over a range's edges at most, so this is as small as the number of ranges.
    met = line.withColumn("_value", F.last("_value", True).over(inside)).where("_side = 1").join(F.broadcast(carried), [*names, _PART], "left")
    met = met.select("_row", F.coalesce("_value", "_carried").alias("_value"))
    lost = left.where(~both(known(left, at))).select(own.alias("_row"), F.lit(None).cast(kind[1]).alias("_value"))
    return met.unionByName(lost).select(*[F.col("_row")[c].alias(c) for c in left.columns], *[F.col("_value")[c].alias(c) for c in values])


#: Below and above every key of a version.
_LEAST, _GREATEST = "", "~"


def holding(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, low: str, high: str, low_open: str, high_open: str, parts: int | None = None) -> DataFrame:
    """keys, point, low, low_open, high, high_open: each distinct point with each distinct interval of its keys that holds it.

    Points and bounds are texts that sort in code-point order, below "~". A null bound is open to that side; an end belongs to the interval unless its
    flag is set. Null keys and null points match nothing. Only distinct points and intervals are swept: rows that repeat join the
    result by their keys. An interval is carried into every range that it reaches into, where it holds whatever lies between.
    """
    bounds = [low, low_open, high, high_open]
    wanted = points.select(*keys, point).dropna().distinct()
    known = intervals.dropna(subset=keys).select(*keys, F.coalesce(low, F.lit(_LEAST)).alias(low), F.coalesce(low_open, F.lit(False)).alias(low_open), F.coalesce(high, F.lit(_GREATEST)).alias(high), F.coalesce(high_open, F.lit(False)).alias(high_open)).distinct()
    known = known.where(F.col(low) <= F.col(high))
    none = [F.lit(None).cast(dict(known.dtypes)[c]).alias(c) for c in bounds]
    ends = [known.select(*keys, F.col(c).alias("_at"), F.lit(side).alias("_side"), *bounds) for c, side in ((low, 0), (high, 2))]
    line = cut(wanted.select(*keys, F.col(point).alias("_at"), F.lit(1).alias("_side"), *none).unionByName(ends[0]).unionByName(ends[1]), [*keys, "_at", "_side"], parts)
    reach = line.where("_side <> 1").groupBy(*keys, *bounds).agg(F.min(_PART).alias("_from"), F.max(_PART).alias("_to"))
    carried = reach.select(*keys, *bounds, F.explode(F.sequence("_from", "_to")).alias(_PART))
    held = line.where("_side = 1").select(*keys, F.col("_at").alias(point), _PART).join(carried, [*keys, _PART])
    above = (F.col(point) > F.col(low)) | ((F.col(point) == F.col(low)) & ~F.col(low_open))
    below = (F.col(point) < F.col(high)) | ((F.col(point) == F.col(high)) & ~F.col(high_open))
    back = [F.nullif(F.col(low), F.lit(_LEAST)).alias(low), low_open, F.nullif(F.col(high), F.lit(_GREATEST)).alias(high), high_open]
    return held.where(above & below).select(*keys, point, *back)


def counted(points: DataFrame, intervals: DataFrame, keys: list[str], owner: str, point: str, low: str, high: str, low_open: str, high_open: str, spread: int = 8) -> DataFrame:
    """owner, keys, the columns of ``points``, rows and intervals: of each owner and point, how many of the owner's interval rows hold it, and how many distinct ones.

    Bounds are as in ``holding``; ``points`` has each point once. What is found is far more than what is given, so it is made where it stays: both sides are dealt by keys
    and a share of the owners (``points`` ``spread`` times), and no hit moves again. Nearly all owners have one interval of a key and need no counting.
    """
    edges, deal = [low, low_open, high, high_open], [*keys, "_share"]
    known = intervals.dropna(subset=keys).select(owner, *keys, F.coalesce(low, F.lit(_LEAST)).alias(low), F.coalesce(low_open, F.lit(False)).alias(low_open), F.coalesce(high, F.lit(_GREATEST)).alias(high), F.coalesce(high_open, F.lit(False)).alias(high_open))
    dealt = known.withColumn("_share", F.pmod(F.xxhash64(owner), F.lit(spread)).cast("int")).repartition(*deal)
    owned = dealt.groupBy(*deal, owner).agg(F.collect_list(F.struct(*edges)).alias("_held"))
    wanted = points.dropna(subset=[*keys, point]).withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    above = (F.col(point) > F.col(low)) | ((F.col(point) == F.col(low)) & ~F.col(low_open))
    below = (F.col(point) < F.col(high)) | ((F.col(point) == F.col(high)) & ~F.col(high_open))
    one = owned.where(F.size("_held") == 1).select(*deal, owner, *[F.col("_held")[0][c].alias(c) for c in edges]).join(wanted, deal).where(above & below)
    many = owned.where(F.size("_held") > 1).select(*deal, owner, F.inline("_held")).join(wanted, deal).where(above & below)
    rest = [c for c in points.columns if c not in keys]
    several = many.groupBy(*deal, owner, *rest).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(*edges)).alias("intervals"))
    out = [owner, *keys, *rest, "rows", "intervals"]
    return one.withColumns({"rows": F.lit(1).cast("long"), "intervals": F.lit(1).cast("long")}).select(*out).unionByName(several.select(*out))
