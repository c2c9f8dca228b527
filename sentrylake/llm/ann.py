"""Approximate nearest neighbours by largest inner product: inverted lists scanned by adaptive dimensions.

Vectors get one more dimension that makes all norms equal, so that the largest inner product is the
smallest distance, and are rotated at random. A bounded sample fixes the lists' centres and how many
lists a query probes: as many as the sample needs for the target recall. Every vector is indexed.

In each probed list a query's partial distances over blocks of rotated columns are tested against its
k-th best distance so far: if the whole distance, estimated from the columns seen, would exceed that
with the test's confidence, the candidate is abandoned. Survivors are scored exactly on the original
vectors. Small lists are bundled, so that a query travels once for a bundle; large lists and the queries of a bundle are cut into
blocks of bounded size, so a hot list is many units of work. A query whose lists hold too few candidates probes further ones.

Equal vectors are one candidate, with the smallest of their ids; equal queries are searched once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, materialize, small_batches

#: Rows and bytes that the centres and the number of probes are fitted to, at most; sampled vectors of a list on average.
SAMPLE, SAMPLE_BYTES, PER_LIST = 65_536, 64 << 20, 32
#: The share of the sample's own neighbours that the probed lists must hold.
TARGET_RECALL = 0.97
#: Rotated columns of a block, and the test's width: the chance of a false abandonment falls as exp(-c * WIDTH^2).
COLUMNS, TEST_WIDTH = 16, 2.1
#: Vectors that meet all centres at once.
NEAREST = 2048
#: Vectors and queries of one unit of work, candidates taken at a time, queries whose best are held at once.
UNIT, CHUNK, HELD = 4096, 512, 50_000


@dataclass
class Lists:
    """The fitted index: a rotation of the lengthened vectors, the centres of the lists, and how many are probed."""

    dims: int
    norm: float
    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, norm: float, k: int, seed: int = 0) -> Lists:
        d = sample.shape[1]
        r = np.random.RandomState(seed)
        q, upper = np.linalg.qr(r.standard_normal((d + 1, d + 1)))
        made = cls(d, norm, q * np.sign(np.diag(upper)), np.zeros((1, d + 1)), 1)
        x = made.rotate(sample)
        n_lists = int(max(1, min(np.sqrt(rows), len(x) // PER_LIST)))
        centres = x[r.choice(len(x), n_lists, replace=False)]
        for _ in range(8):
            near = made.nearest(x, centres)
            total = np.zeros_like(centres)
            np.add.at(total, near, x)
            count = np.bincount(near, minlength=n_lists)
            centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
        made.centres = centres
        made.probes = made.probes_for(x, sample, max(1, round(k * len(x) / max(rows, 1))))
        return made

    def probes_for(self, x: np.ndarray, sample: np.ndarray, k: int) -> int:
        """The fewest probes that reach the target on the sample; k: neighbours in the sample that stand for all rows'."""
        asked = np.arange(0, len(x), max(1, len(x) // 400))
        k = min(k, len(x) - 1)
        if k < 1:
            return len(self.centres)
        top = np.empty((len(asked), k), np.int64)
        for at in range(0, len(asked), 32):  # a few at a time, as each meets the whole sample
            some = asked[at : at + 32]
            score = sample[some] @ sample.T
            score[np.arange(len(some)), some] = -np.inf
            top[at : at + 32] = np.argpartition(-score, k - 1, axis=1)[:, :k]
        near = self.nearest(x, self.centres)
        order = self.ranked(self.lengthen_queries(sample[asked]))
        place = np.argsort(order, axis=1)  # list -> its rank for the query
        rank = np.take_along_axis(place, near[top], axis=1)
        share = np.cumsum(np.bincount(rank.ravel(), minlength=len(self.centres))) / rank.size
        return int(min(len(self.centres), np.searchsorted(share, TARGET_RECALL) + 1))

    @staticmethod
    def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        length = (centres**2).sum(1)
        parts = [np.argmin(length - 2 * x[at : at + NEAREST] @ centres.T, axis=1) for at in range(0, len(x), NEAREST)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def rotate(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))
        return np.column_stack((x, rest)) @ self.rotation

    def lengthen_queries(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack((q, np.zeros(len(q)))) @ self.rotation

    def ranked(self, rotated: np.ndarray) -> np.ndarray:
        return np.argsort((self.centres**2).sum(1) - 2 * rotated @ self.centres.T, axis=1, kind="stable")


class Best:
    """The k best (score, id) of each query so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.row = k, {}
        self.owner = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.kth = np.zeros(0)  # the k-th best score of each row; -inf while there are fewer

    def rows(self, queries: list[int]) -> np.ndarray:
        rows = np.array([self.row.setdefault(q, len(self.row)) for q in queries], np.int64)
        if len(self.kth) < len(self.row):
            self.kth = np.concatenate((self.kth, np.full(len(self.row) - len(self.kth), -np.inf)))
        return rows

    def add(self, owner: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Only the rows that get something new are sorted again."""
        touched = np.zeros(len(self.kth), bool)
        touched[owner] = True
        mine = touched[self.owner]
        o = np.concatenate((self.owner[mine], owner))
        i = np.concatenate((self.id[mine], ids))
        s = np.concatenate((self.score[mine], score))
        by = np.lexsort((i, -s, o))
        o, i, s = o[by], i[by], s[by]
        place = np.arange(len(o)) - np.searchsorted(o, o)
        kept = place < self.k
        full = place == self.k - 1
        self.kth[o[full]] = s[full]
        self.owner = np.concatenate((self.owner[~mine], o[kept]))
        self.id = np.concatenate((self.id[~mine], i[kept]))
        self.score = np.concatenate((self.score[~mine], s[kept]))

    def drain(self):
        names = np.array(list(self.row), np.int64)
        out = names[self.owner] if len(names) else self.owner, self.id, self.score
        self.__init__(self.k)
        return out


def scan(lists: Lists, best: Best, ids: np.ndarray, x: np.ndarray, query_ids: list[int], q: np.ndarray, rx: np.ndarray | None = None, rq: np.ndarray | None = None) -> int:
    """Scans one block of a list for a block of queries; returns how many candidates were scored in full. rx, rq: both rotated, if they are known."""
    rows = best.rows(query_ids)
    rx = lists.rotate(x).astype(np.float32) if rx is None else rx
    rq = lists.lengthen_queries(q).astype(np.float32) if rq is None else rq
    width, total = rx.shape[1], 0
    edges = list(range(0, width, COLUMNS))[: max(1, width // COLUMNS)] + [width]
    ends = np.array(edges[1:])
    factor = ends / width * (1 + TEST_WIDTH / np.sqrt(ends)) ** 2
    whole = (q * q).sum(1) + lists.norm**2
    for at in range(0, len(x), CHUNK):
        part = rx[at : at + CHUNK]
        limit = np.maximum(whole - 2 * best.kth[rows], 0)  # the k-th best squared distance
        first = rq[:, : ends[0]], part[:, : ends[0]]
        partial = (first[0] ** 2).sum(1)[:, None] + (first[1] ** 2).sum(1) - 2 * first[0] @ first[1].T
        a, b = np.nonzero(partial <= limit[:, None] * factor[0] + 1e-5)
        seen = partial[a, b]
        for k in range(1, len(ends) - 1):
            lo, hi = ends[k - 1], ends[k]
            gap = rq[a, lo:hi] - part[b, lo:hi]
            seen = seen + np.einsum("ij,ij->i", gap, gap)
            on = seen <= limit[a] * factor[k] + 1e-5
            a, b, seen = a[on], b[on], seen[on]
        total += len(a)
        if len(a):
            score = np.einsum("ij,ij->i", q[a], x[at + b])
            ahead = score >= best.kth[rows[a]]
            best.add(rows[a[ahead]], ids[at + b[ahead]], score[ahead])
    return total


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows that take part: a set id, and a vector of the table's usual
    length without null or non-finite components, not zero."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine & F.exists("embedding", lambda x: x != 0))
    usual = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return v.where(F.size("embedding") == (usual[0]["n"] if usual else 0))


def search(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row with ``is_query(vec_id)`` the k rows of largest inner product.

    The query's own row is no candidate; ties go to the smaller id; with fewer than k candidates in all those found
    are returned. Rows with null ids and vectors that ``usable`` leaves out take no part. Repeated rows
    count once. No usable rows, no rows out. Other columns are dropped, whatever their names.
    """
    known = materialize(usable(vectors, vec_id, embedding), "vectors")
    near = Window.partitionBy("embedding").orderBy("vec_id")
    # k + 1 ids of equal vectors are enough: k beside the query's own.
    few = known.withColumn("nth", F.dense_rank().over(near)).where(F.col("nth") <= k + 1)
    classes = materialize(few.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).withColumn("rep", F.element_at("ids", 1)), "vector-classes")
    asking = known.where(is_query(F.col("vec_id"))).distinct()
    asked = asking.join(classes.select("embedding", F.col("rep").alias("asked")), "embedding").select("asked", F.col("vec_id").alias("query_id"))
    asked = materialize(asked, "queries")

    norm_of = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max(norm_of).alias("norm")).first()
    empty = known.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not stats["n"]:
        return empty
    dims = classes.select(F.size("embedding")).first()[0]
    rows = int(min(SAMPLE, max(1, SAMPLE_BYTES // (8 * dims))))
    sample = classes.select("rep", "embedding").orderBy(F.xxhash64("rep"), "rep").limit(rows).toArrow()
    lists = Lists.fit(_matrix(sample.column("embedding").combine_chunks()), stats["n"], stats["norm"], k)

    found = materialize(_search_lists(classes, asked.select("asked").distinct(), lists, k + 1), "found")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "rep")
    top = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    rows = top.join(classes.select("rep", "ids"), "rep").select("asked", "score", F.explode("ids").alias("vec_id"))
    of_class = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    rows = rows.withColumn("nth", F.row_number().over(of_class)).where(F.col("nth") <= k + 1).drop("nth")
    each = rows.join(asked, "asked").where(F.col("vec_id") != F.col("query_id"))
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(column) -> np.ndarray:
    """An Arrow column of arrays of one length, as rows of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def bundles(sizes: dict[int, int], n_lists: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Each list's bundle, and (bundle, blocks of vectors) of each: neighbours by number share one as long as it holds no more than UNIT vectors."""
    of, held = np.zeros(n_lists, np.int32), [0]
    for k in range(n_lists):
        if held[-1] and held[-1] + sizes.get(k, 0) > UNIT:
            held.append(0)
        of[k] = len(held) - 1
        held[-1] += sizes.get(k, 0)
    return of, [(b, max(1, -(-n // UNIT))) for b, n in enumerate(held)]


def _search_lists(classes: DataFrame, queries: DataFrame, lists: Lists, k: int) -> DataFrame:
    """asked, rep, score: the k best of each query in each partition of the units, a superset of its best in all."""
    import pyarrow as pa

    def homes(batches):
        for batch in batches:
            x = lists.rotate(_matrix(batch.column("embedding")))
            near = lists.nearest(x, lists.centres).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("embedding"), pa.array(near)], names=["rep", "embedding", "list"])

    plain = classes.select("rep", "embedding")
    small_batches(plain)
    held = materialize(plain.mapInArrow(homes, "rep long, embedding array<double>, list int"), "lists")
    n_lists = len(lists.centres)
    sizes = {r["list"]: r["count"] for r in held.groupBy("list").count().collect()}  # as many as there are centres
    of_list, blocks = bundles(sizes, n_lists)
    size = np.array([sizes.get(i, 0) for i in range(n_lists)])

    def probes(batches):
        """A row for each bundle that holds a list to probe: as many lists as the sample needs, and on until they hold k vectors."""
        kind = pa.list_(pa.int32())
        for batch in batches:
            ranked = lists.ranked(lists.lengthen_queries(_matrix(batch.column("embedding"))))
            enough = (np.cumsum(size[ranked], axis=1) < k).sum(1) + 1
            row, bundle, wanted = [], [], []
            for i, (order, n) in enumerate(zip(ranked, np.minimum(np.maximum(enough, lists.probes), n_lists))):
                mine = order[:n]
                for b in np.unique(of_list[mine]):
                    row.append(i)
                    bundle.append(b)
                    wanted.append(mine[of_list[mine] == b].astype(np.int32))
            taken = batch.select(["rep", "embedding"]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(bundle, pa.int32()), pa.array(wanted, kind)], names=["rep", "embedding", "bundle", "lists"])

    asking = plain.join(queries, plain["rep"] == queries["asked"], "left_semi").mapInArrow(probes, "rep long, embedding array<double>, bundle int, lists array<int>")
    asking = materialize(asking, "probes")

    # A bundle is cut into blocks of vectors and its queries into blocks of queries; a unit is one of each.
    known = held.sparkSession.createDataFrame(blocks, "bundle int, of_vectors int")
    bundle_of = held.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(of_list)], "list int, bundle int")
    cut = asking.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / UNIT).cast("int").alias("of_queries")).join(F.broadcast(known), "bundle")

    def dealt(rows: DataFrame, kind: int, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(F.lit(5), F.col("rep")), F.col(own)).cast("int")
        all_of = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        d = rows.join(F.broadcast(cut), "bundle").withColumn(own[3], mine).withColumn(other[3], all_of)  # no more rows than centres
        return d.select("bundle", "v", "q", F.lit(kind).alias("kind"), "rep", "embedding", "lists")

    vectors = held.join(F.broadcast(bundle_of), "list").withColumn("lists", F.array("list"))
    both = dealt(vectors, 0, "of_vectors", "of_queries").unionByName(dealt(asking, 1, "of_queries", "of_vectors"))
    both = both.repartition("bundle", "v", "q").sortWithinPartitions("bundle", "v", "q", "kind", "rep")
    schema = pa.schema([("asked", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])

    def run(batches):
        best, unit, sides = Best(k), None, ([], [])

        def done():
            if unit is None or not sides[0] or not sides[1]:
                return
            ids, x, home, _ = (np.concatenate(c) for c in zip(*sides[0]))
            asked, q, wanted, number = (np.concatenate(c) for c in zip(*sides[1]))
            rx, rq = lists.rotate(x).astype(np.float32), lists.lengthen_queries(q).astype(np.float32)
            of = np.repeat(np.arange(len(asked)), number)
            for one in np.unique(home):
                mine, its = home == one, of[wanted == one]
                if len(its):
                    scan(lists, best, ids[mine], x[mine], asked[its].tolist(), q[its], rx[mine], rq[its])

        def drained():
            asked, ids, score = best.drain()
            for at in range(0, len(asked), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 20_000]) for c in (asked, ids, score)], schema=schema)

        for batch in batches:
            x, rep = _matrix(batch.column("embedding")), batch.column("rep").to_numpy()
            key = np.stack([batch.column(c).to_numpy() for c in ("bundle", "v", "q", "kind")], 1)
            named = batch.column("lists")
            number = named.value_lengths().to_numpy(zero_copy_only=False)
            upto = np.concatenate(([0], np.cumsum(number)))
            named = named.flatten().to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(key)]):
                if hi <= lo:
                    continue
                now = tuple(key[lo, :3].tolist())
                if now != unit:
                    done()
                    unit, sides = now, ([], [])
                    if len(best.row) > HELD:
                        yield from drained()
                sides[key[lo, 3]].append((rep[lo:hi], x[lo:hi], named[upto[lo] : upto[hi]], number[lo:hi]))
        done()
        yield from drained()
        give_back()

    return both.mapInArrow(run, "asked long, rep long, score double")
