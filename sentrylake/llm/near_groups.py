"""Links inside very large groups of near copies, without every text meeting every other.

1. A class's home is the smallest class with which it shares CLOSE buckets or more as their smallest one, followed on: near copies of one text
   share a home, what met by chance does not. A home's reference is the set of shingles that most of a few of its members hold.
2. Every member is sent once, to its home's reference, and from then on it is what it lacks of the reference and what it has besides.
   Two such differences give the exact similarity of their members.
3. How much two members lack and have besides bounds their similarity from both sides. Members with equal numbers are one row, and
   pairs of such rows are settled as a whole wherever the bounds lie on one side of the threshold. Only members with a pair in doubt
   send their differences to blocks of pairs.
4. Members of different homes that share a bucket are verified by their texts: in each such bucket those outside its largest home
   against all, so that the members of that home are sent once for each block of the others.

A text is sent once for its difference and at most once for each of its buckets and block of strangers there.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, give_back, materialize, small_batches

#: Members that a reference is made of; members that share a copy of it; members and elements of a block of differences.
SAMPLED, SHARING, DIFFERENCES, ELEMENTS = 9, 4096, 2048, 1 << 20
#: Buckets that classes of one home share, as a rule.
CLOSE = 3


def homes(members: DataFrame) -> DataFrame:
    """node, home of the members (key, low, node) of buckets. Four steps lead from any near copy of a text to the first one; who isn't led there is a stranger."""
    lows = members.groupBy("node", "low").agg(F.count(F.lit(1)).alias("n"))
    now = materialize(lows.groupBy("node").agg(F.coalesce(F.min(F.when(F.col("n") >= CLOSE, F.col("low"))), F.max_by("low", F.struct("n", -F.col("low")))).alias("home")), "homes-first")
    for _ in range(2):
        further = now.select(F.col("node").alias("home"), F.col("home").alias("further"))
        now = now.join(further, "home").select("node", F.col("further").alias("home"))
    return materialize(now, "homes")


def _stream(df: DataFrame, columns: list[str], schema: str, start, take, end) -> DataFrame:
    """Runs over sorted rows: ``take(state, row)`` and, where the first column changes, ``end(state)``, both of which give lists of output rows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        now, state, out, seen = None, None, [], 0

        def made():
            batch = pa.RecordBatch.from_arrays([pa.array(c, arrow.field(i).type) for i, c in enumerate(zip(*out))], schema=arrow)
            out.clear()
            return batch

        for batch in batches:
            values, seen = [batch.column(c) for c in columns], seen + batch.num_rows
            for i in range(batch.num_rows):
                row = [v[i].as_py() for v in values]
                if state is None or row[0] != now:
                    if state is not None:
                        out.extend(end(state))
                    now, state = row[0], start()
                out.extend(take(state, row))
                if len(out) >= 1024:
                    yield made()
        if state is not None:
            out.extend(end(state))
        if out:
            yield made()
        if seen > 256:
            give_back()

    small_batches(df)
    return df.select(*columns).mapInArrow(run, schema)


def references(placed: DataFrame, texts: DataFrame, shingle_set) -> DataFrame:
    """home, reference. ``texts``: node, text."""
    slot = F.pmod(F.xxhash64(F.lit(5), F.col("node")), F.lit(SAMPLED))
    sampled = placed.groupBy("home", slot.alias("slot")).agg(F.min("node").alias("node")).drop("slot")
    rows = sampled.join(texts, "node").repartition("home").sortWithinPartitions("home", "node")

    def take(state, row):
        if state.get("node") != row[1]:
            state["home"], state["node"] = row[0], row[1]
            state.setdefault("sets", []).append(shingle_set(row[2]))
        return ()

    def end(state):
        sets = state["sets"]
        known, times = np.unique(np.concatenate(sets), return_counts=True)
        most = known[2 * times > len(sets)]
        return [(state["home"], (most if len(most) else sets[0]).view(np.int64).tolist())]

    return _stream(rows, ["home", "node", "text"], "home long, reference array<long>", dict, take, end)


def differences(placed: DataFrame, refs: DataFrame, texts: DataFrame, copies: DataFrame, shingle_set) -> DataFrame:
    """home, node, copies, n_ref, lacks, has: each member against its home's reference. ``copies``: node, copies."""
    n = placed.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / SHARING).cast("int").alias("shares"))
    none = F.lit(None)
    heads = refs.join(n, "home").select("home", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(-1).cast("long").alias("node"), F.lit(0).cast("long").alias("copies"), none.cast("string").alias("text"), "reference")
    mine = F.pmod(F.xxhash64(F.lit(6), F.col("node")), F.col("shares")).cast("int")
    rows = placed.join(n, "home").withColumn("share", mine).join(copies, "node").join(texts, "node").select("home", "share", "node", "copies", "text", none.cast("array<long>").alias("reference"))
    line = heads.unionByName(rows).repartition("home", "share").sortWithinPartitions("home", "share", "node").withColumn("of", F.struct("home", "share"))

    def take(state, row):
        _, home, node, count, text, reference = row
        if node < 0:
            state["reference"] = np.array(reference, np.int64).view(np.uint64)
            return ()
        if state.get("node") == node:  # repeated rows of a class's first document count once
            return ()
        state["node"] = node
        ref, own = state["reference"], shingle_set(text)
        minus = lambda a, b: a[~np.isin(a, b, assume_unique=True)].view(np.int64).tolist()
        return [(home, node, count, len(ref), minus(ref, own), minus(own, ref))]

    return _stream(line, ["of", "home", "node", "copies", "text", "reference"], "home long, node long, copies long, n_ref long, lacks array<long>, has array<long>", dict, take, lambda state: ())


def _bounds(n_ref: int, r1, d1, r2, d2, threshold: float):
    """(surely links, may be links) by how much both sides lack (r) and have besides (d)."""
    both = 2 * n_ref - r1 + d1 - r2 + d2
    least = np.maximum(0, n_ref - r1 - r2)
    most = n_ref - np.maximum(r1, r2) + np.minimum(d1, d2)
    return least >= threshold * (both - least) - 1e-9, most >= threshold * (both - most) - 1e-9


def _settled(deltas: DataFrame, threshold: float) -> DataFrame:
    """home, r, d, sure (copies that all members with these numbers are surely linked to, their own among them), own (whether those are), root, doubt."""
    tally = deltas.groupBy("home", "n_ref", F.size("lacks").alias("r"), F.size("has").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"), F.min("node").alias("low"))
    rows = tally.repartition("home").sortWithinPartitions("home")

    def take(state, row):
        state.setdefault("rows", []).append(row)
        return ()

    def end(state):
        home, n_ref = state["rows"][0][:2]
        r, d, n, copies, low = np.array([row[2:] for row in state["rows"]], np.int64).T
        k = len(r)
        sure_copies, own, doubt, label, linked = np.zeros(k, np.int64), np.zeros(k, bool), np.zeros(k, bool), np.arange(k), np.zeros(k, bool)
        for i in range(k):
            sure, may = _bounds(n_ref, r[i], d[i], r, d, threshold)
            own[i] = sure[i]
            sure_copies[i] = copies[sure].sum()
            unsure = may & ~sure
            unsure[i] &= n[i] > 1
            doubt[i] = unsure.any()
            if sure[i] and n[i] == 1:
                sure[i] = False
            others = np.flatnonzero(sure)
            if len(others):
                linked[i] = True
                met = np.unique(label[np.append(others, i)])
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
        roots = {int(x): int(low[(label == x) & linked].min()) for x in np.unique(label[linked])}
        return [(home, int(r[i]), int(d[i]), int(sure_copies[i]), bool(own[i]), roots.get(int(label[i])) if linked[i] else None, bool(doubt[i])) for i in range(k)]

    return _stream(rows, ["home", "n_ref", "r", "d", "n", "copies", "low"], "home long, r int, d int, sure long, own boolean, root long, doubt boolean", dict, take, end)


def verify_differences(n_ref: int, apart: bool, node: np.ndarray, side: np.ndarray, copies: np.ndarray, lacks: list, has: list, threshold: float) -> Iterable[tuple[int, int, int]]:
    """(node, neighbour, links) over the pairs in doubt of a unit, whose rows are in the order of node."""
    n = len(node)
    r, d = (np.array([len(x) for x in xs], np.int64) for xs in (lacks, has))
    pairs = np.triu(np.ones((n, n), bool), 1)
    if apart:
        pairs &= side[:, None] != side[None]
    shared = np.zeros((n, n), np.int32)
    elements = np.array([e for x, y in zip(lacks, has) for e in (*x, *y)], np.int64)
    owner = np.repeat(np.arange(n), r + d)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    edges = np.flatnonzero(np.diff(elements, prepend=elements[:1] - 1 if len(elements) else 0)) if len(elements) else np.zeros(0, np.int64)
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(elements)]):
        if b - a > 1:
            who = owner[a:b]
            shared[np.ix_(who, who)] += 1
    for i in range(n):
        sure, may = _bounds(n_ref, r[i], d[i], r, d, threshold)
        inter = n_ref - r[i] - r + shared[i]
        pairs[i] &= may & ~sure & (inter >= threshold * (2 * n_ref - r[i] + d[i] - r + d - inter) - 1e-9)
    links = pairs | pairs.T
    total = links @ copies
    seen = np.zeros(n, bool)
    for first in np.flatnonzero(total):
        if seen[first]:
            continue
        group = np.zeros(n, bool)
        edge = np.array([first])
        while len(edge):
            group[edge] = True
            edge = np.flatnonzero(links[edge].any(0) & ~group)
        seen |= group
        for i in np.flatnonzero(group):
            yield int(node[i]), int(node[first]), int(total[i])


def _verified(dealt: DataFrame, threshold: float) -> DataFrame:
    def take(state, row):
        state.setdefault("rows", []).append(row)
        return ()

    def end(state):
        rows = state["rows"]
        if len(rows) < 2:
            return ()
        unit, n_ref, node, side, copies, lacks, has = rows[0][0], rows[0][1], *zip(*(row[2:] for row in rows))
        return verify_differences(n_ref, unit["i"] != unit["j"], np.array(node), np.array(side), np.array(copies), lacks, has, threshold)

    line = dealt.withColumn("unit", F.struct("key", "i", "j")).repartition("unit").sortWithinPartitions("unit", "node")
    return _stream(line, ["unit", "n_ref", "node", "side", "copies", "lacks", "has"], "node long, neighbour long, links long", dict, take, end)


def inside(placed: DataFrame, texts: DataFrame, copies: DataFrame, units, shingle_set, threshold: float) -> list[DataFrame]:
    """Stored tables of node, neighbour, links: the pairs of members of one home."""
    refs = materialize(references(placed, texts, shingle_set), "references")
    deltas = materialize(differences(placed, refs, texts, copies, shingle_set), "differences")
    classes = materialize(_settled(deltas, threshold), "settled")
    numbered = deltas.withColumns({"r": F.size("lacks"), "d": F.size("has")}).join(classes, ["home", "r", "d"])
    sure = numbered.select("node", F.col("root").alias("neighbour"), (F.col("sure") - F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("links")).where("neighbour IS NOT NULL AND links > 0")
    open_ = numbered.where("doubt").select(F.col("home").alias("key"), "node", "copies", "n_ref", "lacks", "has")
    sizes = open_.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / DIFFERENCES), F.ceil(F.sum(F.size("lacks") + F.size("has")) / ELEMENTS)).cast("int").alias("blocks"))
    dealt = units(open_.join(sizes, "key"))
    found = [materialize(sure, "sure-links"), materialize(_verified(dealt, threshold), "doubtful-links")]
    for used in (refs, deltas, classes):
        discard(used)
    return found


def across(members: DataFrame, placed: DataFrame, blocks_of) -> DataFrame:
    """key, i, j, side, node, home: units of the buckets (key, node, n_shingles) in which several homes meet; pairs of one home don't count there.

    Blocks of the strangers to a bucket's largest home come first, and meet all blocks; those of that home meet the strangers' alone."""
    rows = members.join(placed, "node")
    each = rows.groupBy("key", "home").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    met = each.groupBy("key").agg(F.count(F.lit(1)).alias("homes"), F.max_by(F.struct("home", "n", "s"), F.struct("n", "home")).alias("most"), F.sum("n").alias("n"), F.sum("s").alias("s")).where("homes > 1")
    strangers, largest = blocks_of(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.s")), blocks_of(F.col("most.n"), F.col("most.s"))
    met = met.select("key", F.col("most.home").alias("largest"), strangers.alias("few"), largest.alias("many"))
    place = lambda of: F.pmod(F.xxhash64(F.lit(3), F.col("node")), F.col(of)).cast("int")
    rows = rows.join(met, "key").withColumn("stranger", F.col("home") != F.col("largest"))
    mine: Column = F.when(F.col("stranger"), place("few")).otherwise(F.col("few") + place("many"))
    last = F.when(F.col("stranger"), F.col("few") + F.col("many") - 1).otherwise(F.col("few") - 1)
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "node", "home")
