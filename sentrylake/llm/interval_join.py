"""Overlap join of intervals with sessions of the same key: totals per interval and relation, without a pair ever being made.

Sessions of one key don't cross: in the order of their starts their ends rise too. So the sessions that start before a place are the
first ones, and so are those that end before it. Starts and ends of sessions and both ends of every interval are laid in one line by key and
place; running counts and sums over it say, at each place, how many sessions have started and ended up to there and what their
starts, ends and checksums add up to. The sessions in one relation to an interval are a stretch between two such counts, and their
totals the difference of two such sums. Open sessions have no end and are summed apart from closed ones; an open interval ends
behind every place.

What repeats at a place is summed before it is exchanged, so a key has as many rows in the line as places, however many sessions
or intervals it has. Events are likewise summed in bins as long as the longest pause, within which no session can end,
and bins are ordered day by day, with what a day needs of those before it carried over: a key has a row for a bin of calendar time, in groups of a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

MINUTE, HOUR, DAY = 60_000_000, 3_600_000_000, 86_400_000_000
#: Longest pause inside a session, and length of a slot, in microseconds.
PAUSE, SLOT = 15 * MINUTE, 6 * HOUR
#: Place behind every other.
NEVER = 1 << 60
RELATIONS = ("overlaps", "finished_by", "contains", "starts", "equals", "started_by", "during", "finishes", "overlapped_by")


def micros(df: DataFrame, column: str) -> Column:
    """Whole microseconds since 1970 of a timestamp, with or without a zone, whatever the session's zone."""
    c = F.col(column)
    if dict(df.dtypes)[column] != "timestamp_ntz":
        return F.unix_micros(c)
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    return F.unix_date(c.cast("date")) * F.lit(DAY) + seconds * F.lit(1_000_000).cast("long") + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def sessions(events: DataFrame, pause: int = PAUSE) -> DataFrame:
    """key, first, last, open of each session of ``events`` (``key``, ``t``, ``ends_open``): events of one key of which each follows the one before by ``pause`` at most.

    A session is open if any of its events at its last t has ``ends_open``. Null keys and times take no part, null ``ends_open`` is false;
    repeated events change nothing.
    """
    known = events.where(F.col("key").isNotNull() & F.col("t").isNotNull())
    at_end = F.struct("t", F.coalesce("ends_open", F.lit(False)).alias("ends_open"))
    bins = known.groupBy("key", F.floor(F.col("t") / pause).alias("bin")).agg(F.min("t").alias("first"), F.max(at_end).alias("last"))
    bins = materialize(bins.withColumn("day", F.floor(F.col("bin") * pause / DAY)), "session-bins")
    inside = Window.partitionBy("key", "day").orderBy("bin")
    begun = F.when(F.col("first") - F.lag("last.t").over(inside) > pause, F.col("first"))
    bins = bins.withColumn("begun", begun).withColumn("begun_before", F.last("begun", True).over(inside))
    days = bins.groupBy("key", "day").agg(F.min("first").alias("day_first"), F.max("last.t").alias("day_last"), F.max("begun").alias("day_begun"))
    order = Window.partitionBy("key").orderBy("day")
    before = F.lag("day_last").over(order)
    fresh = F.when(before.isNull() | (F.col("day_first") - before > pause), F.col("day_first"))
    days = days.withColumn("fresh", fresh).withColumn("latest", F.coalesce("day_begun", "fresh"))
    carried = F.last("latest", True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    days = days.select("key", "day", F.coalesce("fresh", carried).alias("day_session"))
    found = bins.join(days, ["key", "day"]).groupBy("key", F.coalesce("begun_before", "day_session").alias("first")).agg(F.max("last").alias("last"))
    return found.select("key", "first", F.col("last.t").alias("last"), F.col("last.ends_open").alias("open"))


def _totals(line: DataFrame, names: list[str]) -> DataFrame:
    """``upto`` and ``before``: the running totals of each name at and before each place, in the order of places of a key."""
    upto = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = line.withColumns({f"{n}_upto": F.sum(n).over(upto) for n in names})
    return summed.withColumns({f"{n}_before": F.col(f"{n}_upto") - F.col(n) for n in names})


def overlap_totals(intervals: DataFrame, found: DataFrame, slot: int = SLOT) -> DataFrame:
    """id, relation, n_pairs, overlap_slots, sessions_crc for every row of ``intervals`` (``id``, ``key``, ``first``, ``last``, ``open``) and relation to sessions ``found``
    (as of ``sessions``) of the same key that share a slot with it.

    Both ends count by their slots, inclusive; an open end lies behind all others and equals another open one. The relation is that of the
    interval to the session. ``overlap_slots``: shared slots, summed; null if both are open. ``sessions_crc``: sum of the CRC-32 of the
    sessions' exact first times as decimal text. Null keys and first times take no part, null ``open`` is false. Rows that share an id are
    intervals each for itself. The sessions of a key must not cross.
    """
    place = lambda c: F.floor(F.col(c) / slot)
    held = found.select("key", place("first").alias("x"), place("last").alias("y"), "open", F.crc32(F.col("first").cast("string").cast("binary")).alias("crc"))
    of = intervals.where(F.col("key").isNotNull() & F.col("first").isNotNull())
    of = of.select("id", "key", place("first").alias("a"), F.when(F.coalesce("open", F.lit(False)), F.lit(NEVER)).otherwise(place("last")).alias("b"))
    of, held = materialize(of, "interval-slots"), materialize(held, "session-slots")

    names = [f"{side}_{what}" for side, whats in (("started", "nxyc"), ("ended", "nxyc"), ("endless", "nxc")) for what in whats]
    value = {"n": F.lit(1).cast("long"), "x": F.col("x"), "y": F.col("y"), "c": F.col("crc")}
    nothing = F.lit(0).cast("long")

    def laid(rows: DataFrame, where: Column, side: str, starts: bool = False, ends: bool = False) -> DataFrame:
        return rows.select("key", where.alias("place"), *[(value[n[-1]] if n.startswith(side + "_") else nothing).alias(n) for n in names], F.lit(starts).alias("starts"), F.lit(ends).alias("ends"))

    closed, endless = held.where(~F.col("open")), held.where("open")
    parts = [laid(closed, F.col("x"), "started"), laid(closed, F.col("y"), "ended"), laid(endless, F.col("x"), "endless"), laid(of, F.col("a"), "none", starts=True), laid(of, F.col("b"), "none", ends=True)]
    line = parts[0]
    for more in parts[1:]:
        line = line.unionByName(more)
    # A row per key and place: the running sums of a key pass through as many rows as it has slots.
    line = line.groupBy("key", "place").agg(*[F.sum(n).alias(n) for n in names], F.max("starts").alias("starts"), F.max("ends").alias("ends"))
    summed = _totals(line, names)
    point = lambda side, when, whats="nxyc": F.struct(*[F.col(f"{side}_{w}_{when}").alias(w) for w in whats])
    at_first = summed.where("starts").select("key", F.col("place").alias("a"), point("started", "before").alias("a1"), point("started", "upto").alias("a2"), point("ended", "before").alias("y0"), point("endless", "before", "nxc").alias("o1"), point("endless", "upto", "nxc").alias("o2"))
    at_last = summed.where("ends").select("key", F.col("place").alias("b"), point("started", "upto").alias("x2"), point("ended", "before").alias("b1"), point("ended", "upto").alias("b2"), point("endless", "upto", "nxc").alias("o3"))
    both = of.join(at_first, ["key", "a"]).join(at_last, ["key", "b"])

    is_open = F.col("b") == NEVER
    a, b = F.col("a"), F.col("b")
    point = {n: F.col(n) for n in ("a1", "a2", "y0", "o1", "o2", "x2", "b1", "b2", "o3")}

    def between(low: list[str], high: list[str], whats: str = "nxyc") -> dict[str, Column]:
        """The totals of the sessions behind all ``low`` counts and within all ``high`` ones."""
        lo = F.greatest(*[point[x] for x in low]) if len(low) > 1 else point[low[0]]
        hi = F.least(*[point[x] for x in high]) if len(high) > 1 else point[high[0]]
        return {w: F.when(hi["n"] > lo["n"], hi[w] - lo[w]).otherwise(nothing) for w in whats}

    closed_stretch = {
        "overlaps": (["a2", "b2"], ["x2"]), "finished_by": (["a2", "b1"], ["b2"]), "contains": (["a2"], ["b1"]),
        "starts": (["a1", "b2"], ["a2"]), "equals": (["a1", "b1"], ["a2", "b2"]), "started_by": (["a1"], ["a2", "b1"]),
        "during": (["y0", "b2"], ["a1"]), "finishes": (["y0", "b1"], ["a1", "b2"]), "overlapped_by": (["y0"], ["a1", "b1"]),
    }
    # An open session outlasts a closed interval and ends with an open one.
    later, same = between(["o2"], ["o3"], "nxc"), between(["o1"], ["o2"], "nxc")
    earlier = {w: point["o1"][w] for w in "nxc"}
    open_stretch = {"overlaps": (later, False), "starts": (same, False), "during": (earlier, False), "finished_by": (later, True), "equals": (same, True), "finishes": (earlier, True)}
    made = []
    for name in RELATIONS:
        total = between(*closed_stretch[name])
        if name in open_stretch:
            more, wanted = open_stretch[name]
            total |= {w: total[w] + F.when(is_open == F.lit(wanted), more[w]).otherwise(nothing) for w in "nxc"}
        n, x, y = total["n"], total["x"], total["y"]
        shared = {"overlaps": n * (b + 1) - x, "finished_by": n * (b + 1) - x, "contains": y - x + n, "started_by": y - n * (a - 1), "overlapped_by": y - n * (a - 1)}.get(name, n * (b - a + 1))
        if name in ("finished_by", "equals", "finishes"):  # to what an open interval has here are open sessions alone
            shared = F.when(~is_open, shared)
        made.append(F.struct(F.lit(name).alias("relation"), n.alias("n_pairs"), shared.alias("overlap_slots"), total["c"].alias("sessions_crc")))
    each = both.select("id", F.explode(F.array(*made)).alias("r")).select("id", "r.*")
    return each.where("n_pairs > 0")


def sale_intervals(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """id, key, first, last, open of each sale: from sold_at through the latest of it and its lines' shipped_at."""
    shipped = lines.where(F.col("sale_id").isNotNull()).select("sale_id", micros(lines, "shipped_at").alias("t")).groupBy("sale_id").agg(F.max("t").alias("shipped"))
    of = sales.where(F.col("client_id").isNotNull() & F.col("sold_at").isNotNull())
    of = of.select("sale_id", F.col("client_id").alias("key"), micros(sales, "sold_at").alias("first"), F.coalesce(F.col("status") == "open", F.lit(False)).alias("open"))
    joined = of.join(shipped, "sale_id", "left")
    return joined.select(F.col("sale_id").alias("id"), "key", "first", F.greatest("first", "shipped").alias("last"), "open")


def click_events(clicks: DataFrame) -> DataFrame:
    """key, t, ends_open of each click: an error leaves a session open."""
    return clicks.select(F.col("client_id").alias("key"), micros(clicks, "ts").alias("t"), (F.col("kind") == "error").alias("ends_open"))
