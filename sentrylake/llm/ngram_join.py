"""N-gram Jaccard self-join by MinHash banding, and the groups of near copies that it links.

1. Each text becomes its set of word 5-grams (64-bit hashes). Texts of one set are one class, and from
   then on a class is one row, however many copies it has. Classes get numbers in the order of their
   smallest doc_id, so that equal ids on different texts stay apart.
2. Band and row counts are chosen for the target recall at the threshold; classes meet in the buckets
   of their band hashes. A pair is a link if it shares a bucket and its similarity, on the full sets,
   reaches the threshold. In groups of more than BLOCKS blocks pairs with one home count as well without a bucket.
3. What a pair of classes needs to meet only settles what travels: classes that buckets chain together
   are one group, cut into blocks bounded by classes and by shingles, and every pair of blocks is a unit of work of its own. A unit
   gets its classes' texts, which travel smaller than their sets, and returns one row per class, with its links and one neighbour, and
   never a row per pair. Groups of more than BLOCKS blocks go by ``near_groups`` instead, where a text is sent once to a reference and
   pairs are settled by their differences from it.
4. The groups are the connected components over these neighbours, found by alternating star
   operations on distributed edges.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import near_groups
from .common import discard, give_back, map_texts, materialize, small_batches

#: Words of a shingle, least similarity, and the least chance that a pair of that similarity shares a band.
WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Hash functions at most; classes and shingles of one block, about; blocks of a group whose texts meet each other: each is sent so often at most.
HASHES, BLOCK, SHINGLES, BLOCKS = 128, 256, 1 << 20, 4
#: Rows of the broadcast table of hashes at most: 4 bytes each.
FILTER = 1 << 20
#: Edges from which on a node counts as a hub, at least; hubs at most, which are broadcast: 16 bytes each.
HUB, HUBS = 256, 100_000
#: Edges of a file, about: a round's result is written by so few tasks.
EDGES = 1_000_000
#: Characters of a text whose words are looked up at once.
PIECE = 1 << 20
_WORD = re.compile(r"\w+")
_GAP = re.compile(r"\W")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest chance meetings, with which ``hashes`` functions reach the recall."""
    best = None
    for rows in range(1, hashes + 1):
        bands = 1 if threshold >= 1 else int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if bands * rows > hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("the recall can't be reached with so few hash functions")
    return best


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Of every word in its order. Very long texts are read in pieces that end at a gap, so that their words needn't be held at once."""
    parts, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = gap.start() if gap else len(text)
        words = _WORD.findall(text, at, end)
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` lower-cased words; of all words, if there are fewer; empty without words."""
    h = word_hashes((text or "").lower())
    if not len(h):
        return np.zeros(0, np.uint64)
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mixed(out * _MIX + h[k : len(h) - size + 1 + k])
    return np.unique(out)


class Banding:
    """Band hashes of a shingle set. Equal sets have equal hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 0):
        r = np.random.RandomState(seed)
        self.bands, self.rows = bands, rows
        self.odd = (r.randint(0, 2**62, bands * rows).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
        self.add = r.randint(0, 2**62, bands * rows).astype(np.uint64)
        self.base = np.arange(1, bands + 1, dtype=np.uint64) * _MIX

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        lowest = np.full(self.bands * self.rows, ~np.uint64(0))
        for at in range(0, len(shingles), 2048):  # a few at a time: bounded memory for very long texts
            np.minimum(lowest, (shingles[at : at + 2048, None] * self.odd + self.add).min(0), out=lowest)
        key = self.base.copy()
        for row in lowest.reshape(self.bands, self.rows).T:
            key = _mixed(key * _MIX + row)
        return key.view(np.int64)


def signatures(docs: DataFrame, kept: list[str], bands: int, rows: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, row (a struct of the columns ``kept``), class_key (128-bit hash of the whole set), n_shingles, bands (null without words)."""

    def make():
        banding = Banding(bands, rows)

        def run(text):
            s = shingle_set(text)
            return xxhash.xxh3_128_digest(s.tobytes()), len(s), banding.keys(s).tolist() if len(s) else None

        return run

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.struct(*[docs[c] for c in kept]).alias("row"), F.col(text).alias("text"))
    return map_texts(plain, ["doc_id", "row"], make, "class_key binary, n_shingles long, bands array<long>")


def numbered_classes(known: DataFrame) -> DataFrame:
    """class_key, rep (its smallest doc_id), times (rows with that id), copies, n_shingles, bands, and node: a number in the order of rep."""
    rows = known.groupBy("class_key", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("n_shingles", "bands")).alias("set"))
    classes = rows.groupBy("class_key").agg(F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("copies"), F.first("set").alias("set"))
    classes = classes.select("class_key", F.col("first.doc_id").alias("rep"), F.col("first.n").alias("times"), "copies", "set.n_shingles", "set.bands")
    dealt = classes.repartitionByRange("rep", "class_key").sortWithinPartitions("rep", "class_key")
    return materialize(dealt.withColumn("node", F.monotonically_increasing_id()), "classes")


def buckets(classes: DataFrame) -> DataFrame:
    """key, n, low, node: the members of every bucket that holds two classes or more; ``low`` is its smallest. One exchange serves both uses."""
    spread = classes.select("node", F.explode("bands").alias("key")).repartition("key")
    sizes = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low")).where("n > 1")
    return spread.join(sizes, "key")


def blocks_of(n: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / SHINGLES)).cast("int")


def gathered(members: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, blocks, node: the classes that meet in any bucket, directly or through others, each in one group; key, low, node, n_shingles:
    the buckets of those in groups of more than BLOCKS blocks)."""
    chains = connected_components(members.select(F.col("node").alias("a"), F.col("low").alias("b")).where("a <> b"))
    chained = materialize(chains.join(classes.select("node", "n_shingles"), "node"), "chains")
    discard(chains)
    sizes = chained.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    sized = materialize(chained.join(sizes.select("component", blocks_of(F.col("n"), F.col("shingles")).alias("blocks")), "component"), "groups")
    discard(chained)
    whole = sized.where(F.col("blocks") <= BLOCKS).select(F.col("component").alias("key"), "blocks", "node")
    return whole, members.join(sized.where(F.col("blocks") > BLOCKS).select("node", "n_shingles"), "node").select("key", "low", "node", "n_shingles")


def units(members: DataFrame) -> DataFrame:
    """Deals the members to pairs of blocks: key, i, j (i <= j), side, and their other columns. One block is one unit."""
    mine = F.pmod(F.xxhash64(F.lit(3), F.col("node")), F.col("blocks")).cast("int")
    m = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).withColumn("side", (F.col("mine") > F.col("other")).cast("int"))
    return m.drop("blocks", "mine", "other")


def verify_unit(band: int, apart: bool, node: np.ndarray, side: np.ndarray, copies: np.ndarray, keys: list[list[int]], sets: list[np.ndarray], homes: np.ndarray | None = None, threshold: float = THRESHOLD) -> Iterable[tuple[int, int, int]]:
    """(node, neighbour, links) of each class with a link in the unit: the copies of all classes that it is linked to,
    and the smallest class that these links reach. ``apart``: only pairs across the two sides count.

    keys: in a group (band -1) the hashes of all bands, of which a pair that counts shares one or more; in a bucket those of the
    earlier bands, of which it shares none, and only classes of different ``homes`` count."""
    n, rep = len(node), node
    shared_band = np.zeros((n, n), bool)
    for column in np.array(keys, np.int64).reshape(n, -1).T:
        shared_band |= column[:, None] == column[None]
    wanted = shared_band if band < 0 else ~shared_band
    wanted &= np.triu(np.ones((n, n), bool), 1)
    if apart:
        wanted &= side[:, None] != side[None]
    if band >= 0 and homes is not None:
        wanted &= homes[:, None] != homes[None]
    links, parent = np.zeros(n, np.int64), np.arange(n)

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    sizes = np.array([len(s) for s in sets])
    where = starts = members = None
    for a in np.flatnonzero(wanted.any(1)):
        others = np.flatnonzero(wanted[a])
        lo, hi = np.minimum(sizes[a], sizes[others]), np.maximum(sizes[a], sizes[others])
        others = others[lo >= threshold * hi - 1e-9]
        if not len(others):
            continue
        if len(others) <= 4:
            shared = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in others])
        else:
            if where is None:
                flat = np.concatenate(sets)
                order = np.argsort(flat, kind="stable")
                members = np.repeat(np.arange(n), sizes)[order]
                distinct, first = np.unique(flat[order], return_index=True)
                starts = np.append(first, len(flat))
                where = distinct
            at = np.searchsorted(where, sets[a])
            count = starts[at + 1] - starts[at]
            shift = np.repeat(starts[at] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
            shared = np.bincount(members[shift + np.arange(count.sum())], minlength=n)[others]
        near = others[shared >= threshold * (sizes[a] + sizes[others] - shared) - 1e-9]
        if len(near):
            links[a] += copies[near].sum()
            links[near] += copies[a]
            for b in near:
                x, y = root(a), root(b)
                if x != y:
                    low, high = (x, y) if rep[x] < rep[y] else (y, x)
                    parent[high] = low
    for a in np.flatnonzero(links):
        yield int(rep[a]), int(rep[root(a)]), int(links[a])


def _verified(dealt: DataFrame) -> DataFrame:
    """node, neighbour, links over all units. Rows of a unit stand together in one partition, those of one class side by side."""
    import pyarrow as pa

    schema = pa.schema([("node", pa.int64()), ("neighbour", pa.int64()), ("links", pa.int64())])

    def run(batches):
        unit, rows, out, seen = None, [], [], 0

        def done():
            if len(rows) > 1:
                node, side, copies, keys, home, sets = zip(*rows)
                out.extend(verify_unit(unit[1], unit[2] != unit[3], np.array(node), np.array(side), np.array(copies), keys, sets, np.array(home)))

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "band", "i", "j", "node", "side", "copies", "keys", "home", "text")]
            seen += batch.num_rows
            for at in range(batch.num_rows):
                v = [c[at].as_py() for c in columns]
                if tuple(v[:4]) != unit:
                    done()
                    unit, rows = tuple(v[:4]), []
                if not rows or rows[-1][0] != v[4]:  # repeated rows of a class's first document count once
                    rows.append((*v[4:9], shingle_set(v[9])))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
                out.clear()
        done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
        rows.clear()
        if seen > 256:
            give_back()

    small_batches(dealt)
    return dealt.mapInArrow(run, "node long, neighbour long, links long")


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b).

    Large-star and small-star operations alternate until every node but the roots has one edge, to its root. Each is an aggregation of the
    smallest neighbour and a join back. Nodes with very many edges, of which there can't be more than HUBS,
    meet their smallest neighbour by a broadcast, so that their edges stay where they are.
    """

    def smallest(pairs: DataFrame, hub: int = 0) -> DataFrame:
        """u, v, m: each pair with the smallest of u and its v. Nodes of more than ``hub`` pairs are hubs, if that is set."""
        low = pairs.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n"))
        if hub:
            hubs = F.broadcast(low.where(F.col("n") > hub).select("u", "low"))
            rest = pairs.join(hubs.select("u"), "u", "left_anti").join(low.where(F.col("n") <= hub).select("u", "low"), "u")
            return pairs.join(hubs, "u").unionByName(rest).select("u", "v", F.least("u", "low").alias("m"))
        return pairs.join(low.select("u", "low"), "u").select("u", "v", F.least("u", "low").alias("m"))

    def mark(e: DataFrame) -> tuple[int, int, int]:
        """Number of edges, of nodes that aren't settled (larger end of several edges, or of one and smaller end of another), and the most
        edges whose smaller end is one node; of larger ends few ever meet."""
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        found = nodes.agg(F.sum("up"), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))), F.max("down")).first()
        return tuple(x or 0 for x in found)

    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    n, unsettled, most = mark(now)
    for _ in range(max_rounds):
        if not unsettled:
            break
        hub = max(HUB, 3 * n // HUBS)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = smallest(both, hub if most > hub else 0).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = smallest(large)
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = materialize(small.where("u > v").distinct().coalesce(1 + n // EDGES), "edges")
        discard(now)
        now = after
        n, unsettled, most = mark(now)
    else:
        raise RuntimeError("the components have not settled")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def linked_classes(signed: DataFrame, texts: Column) -> DataFrame:
    """The classes of the rows of ``signatures``: class_key, rep, times, copies, links and whether it is the ``leader`` of its group,
    and class_id, the leader's rep. ``texts`` picks the text of a row."""
    known = signed.where(F.col("doc_id").isNotNull())
    classes = numbered_classes(known)
    met = materialize(buckets(classes.where(F.col("bands").isNotNull())), "buckets")
    whole, large = gathered(met, classes)
    large = materialize(large, "large-buckets")
    columns = ["key", "band", "i", "j", "side", "node", "home"]
    small = units(whole).withColumns({"band": F.lit(-1), "home": F.lit(-1).cast("long")}).select(*columns)
    # Most texts are in no group; a table of hashes that can't outgrow FILTER rows keeps them out of the exchange.
    slot = F.pmod(F.xxhash64("class_key"), F.lit(FILTER)).cast("int").alias("slot")
    wanted = met.select("node").distinct().join(classes.select("node", "class_key"), "node").select(slot).distinct()
    texts = known.select("class_key", F.col("doc_id").alias("rep"), texts.alias("text"), slot).join(F.broadcast(wanted), "slot", "left_semi").drop("slot")
    found = []
    if not large.isEmpty():
        placed = near_groups.homes(large)
        of_node = classes.select("node", "class_key", "rep").join(placed.select("node"), "node", "left_semi").join(texts, ["class_key", "rep"]).select("node", "text")
        found = near_groups.inside(placed, of_node, classes.select("node", "copies"), units, shingle_set, THRESHOLD)
        strange = near_groups.across(large, placed, blocks_of)
        small = small.unionByName(strange.withColumn("band", F.lit(None).cast("int")).select(*columns))
    # The band of a bucket is where its key stands among the class's bands; a class brings those once, in the join that it needs anyway.
    dealt = small.join(classes.select("node", "class_key", "rep", "copies", "bands"), "node").withColumn("band", F.coalesce("band", (F.array_position("bands", F.col("key")) - 1).cast("int")))
    keys = F.when(F.col("band") < 0, F.col("bands")).otherwise(F.slice("bands", F.lit(1), F.greatest("band", F.lit(0))))
    dealt = dealt.withColumn("keys", keys).drop("bands")
    dealt = dealt.join(texts, ["class_key", "rep"]).drop("class_key", "rep").repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j", "node")
    verified = materialize(_verified(dealt), "links")
    for more in found:
        verified = verified.unionByName(more)
    discard(met)
    discard(large)

    linked = verified.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(verified.select(F.col("node").alias("a"), F.col("neighbour").alias("b")).where("a <> b"))
    leaders = groups.select("component").distinct().join(classes.select(F.col("node").alias("component"), F.col("rep").alias("class_id")), "component")
    grouped = groups.join(leaders, "component")
    found = classes.drop("bands", "n_shingles").join(linked, "node", "left").join(grouped, "node", "left")
    leads = (F.col("component").isNull() | (F.col("component") == F.col("node"))).alias("leader")
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    done = materialize(found.select("class_key", "rep", "times", "copies", links, leads, F.coalesce("class_id", "rep").alias("class_id")), "linked-classes")
    for used in (classes, verified, groups):
        discard(used)
    return done


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, text_class, copies, n_links.

    ``n_links``: other documents whose set of word 5-grams has a Jaccard similarity of 0.8 or more with
    this one's, those with an equal set among them. ``class_id``: the smallest doc_id that such links
    reach. ``text_class`` and ``copies``: the smallest doc_id with an equal set, and how many rows have
    it. Texts of fewer than five words are one shingle; texts without words, null or not, are equal to
    each other. Very long texts are read whole. Rows with a null doc_id take no part: they get null
    classes and 0 links. Repeated rows count each for itself, and so do different texts with one
    doc_id. No rows in, no rows out. ``doc_id`` must be an integer; other columns are dropped, whatever their names.
    """
    signed = materialize(signatures(docs, [text], *choose_bands(THRESHOLD, recall), text, doc_id), "signatures")
    per_class = linked_classes(signed, F.col("row")[text])
    known = signed.where(F.col("doc_id").isNotNull())
    found = known.select("doc_id", "class_key").join(per_class, "class_key").select("doc_id", "class_id", F.col("rep").alias("text_class"), "copies", F.col("links").alias("n_links"))
    none = F.lit(None).cast("long")
    lost = signed.where(F.col("doc_id").isNull()).select("doc_id", none.alias("class_id"), none.alias("text_class"), F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(lost)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest doc_id stays, once.

    Rows with a null doc_id stay. Where a text repeats under its smallest doc_id, the row that comes first by its
    source, language and text stays. Different texts with one doc_id are documents of their own. All columns stay, whatever their names.
    """
    signed = materialize(signatures(docs, docs.columns, *choose_bands()), "signed-rows")
    leaders = linked_classes(signed, F.col("row")["text"]).where("leader").select("class_key", F.col("rep").alias("doc_id"), "times")
    known = signed.where(F.col("doc_id").isNotNull()).select("class_key", "doc_id", "row")
    one = known.join(leaders.where("times = 1"), ["class_key", "doc_id"]).select("row")
    order = [F.col("row")[c] for c in ("source", "lang", "text") if c in docs.columns]
    again = known.join(leaders.where("times > 1"), ["class_key", "doc_id"]).groupBy("class_key", "doc_id").agg(F.min_by("row", F.struct(*order)).alias("row")).select("row")
    return one.unionByName(again).unionByName(signed.where(F.col("doc_id").isNull()).select("row")).select(*[F.col("row")[c].alias(c) for c in docs.columns])
