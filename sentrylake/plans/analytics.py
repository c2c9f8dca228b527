"""Reports over levels, over moving windows, over stored sketches and over samples. Each first sums up what it can, so that a frequent vendor is days, sketches or
a bounded sample, and not its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a sketch's number of registers: the relative standard error of a distinct count is 1.04 / 2**(bits / 2).
SKETCH_BITS = 12


def distinct_by_levels(rows: DataFrame, columns: list[str], levels: list[list[str]], counted: str) -> DataFrame:
    """columns, level, n: how many distinct ``counted`` there are for each combination of each level's columns; the other columns are null.

    ``level`` tells a null that is rolled up from one that is there: its bits, first column highest, are 1 for rolled-up columns. Rows are expanded once,
    with the counted column as a key: the first stage leaves one row per combination and id, the second counts them. Null ids don't count.
    """
    flags = [F.grouping(c).cast("int").alias(f"_g{i}") for i, c in enumerate(columns)]
    once = rows.where(F.col(counted).isNotNull()).groupingSets([[*level, counted] for level in levels], *columns, counted).agg(*flags)
    level = sum((F.col(f"_g{i}") * 2 ** (len(columns) - 1 - i) for i in range(len(columns))), F.lit(0)).alias("level")
    return once.select(*columns, level).groupBy(*columns, "level").agg(F.count(F.lit(1)).alias("n"))


def daily(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """keys, day, n: rows per key and day. Rows without a day don't count."""
    return rows.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n"))


def moving(per_day: DataFrame, keys: list[str], day: str, days: tuple[int, ...] = (30, 90)) -> DataFrame:
    """``per_day`` with the sum of ``n`` over each number of calendar days up to and with the day, the running total, and the days since the key's day before.

    Days without rows have none here, and count as 0 in every frame. Frames are ranges of days, so gaps don't stretch them."""
    order = Window.partitionBy(*keys).orderBy(F.unix_date(day))
    over = {f"last_{d}": F.sum("n").over(order.rangeBetween(-(d - 1), 0)) for d in days}
    return per_day.withColumns({**over, "total": F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, 0)), "days_since": F.unix_date(day) - F.lag(F.unix_date(day)).over(order)})


def sketches(rows: DataFrame, keys: list[str], counted: str, bits: int = SKETCH_BITS) -> DataFrame:
    """keys, sketch: what distinct counts need of each key's ``counted`` values, in a bounded number of bytes. Sketches of several keys merge into that of all."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(counted, F.lit(bits)).alias("sketch"))


def merged_counts(stored: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """keys and the distinct count, about, over all stored sketches of each."""
    return stored.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def error_bound(exact: Column, bits: int = SKETCH_BITS, deviations: float = 4.0) -> Column:
    """How far a merged count may lie from the exact one, in all but about one of 15,000 cases. Small counts are exact but for a few."""
    return F.ceil(exact * (deviations * 1.04 / 2 ** (bits / 2))) + 1


def bottom_k(rows: DataFrame, strata: list[str], row_id: Column, k: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``weight``: of each stratum the k rows whose hashed ids are the smallest, each standing for the stratum's rows over those drawn.

    The sample is the same on every run, and that of a union lies within the samples of its parts, so stored samples merge. Only k rows of a stratum leave a
    task. ``row_id`` settles the draw, so it should tell rows apart; rows that share an id are drawn in an order of all their columns.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    order = Window.partitionBy(*strata).orderBy("_drawn", *[F.col(c) for c, kind in rows.dtypes if c not in strata and "map" not in kind and "variant" not in kind])
    kept = rows.withColumn("_drawn", drawn).withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    sizes = rows.groupBy(*strata).agg(F.count(F.lit(1)).alias("_size")).select(*[F.col(c).alias(f"_of_{c}") for c in strata], "_size")
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return kept.join(sizes, same).select(*rows.columns, (F.col("_size") / F.least(F.col("_size"), F.lit(k))).alias("weight"))
