"""Target-distribution importance resampling over hashed n-grams.

Two bags of hashed word n-grams are counted: that of all raw texts and that of the target's. A bucket's gain is the logarithm of how
much more often the target has it; a text's weight is the sum of gains over its n-grams, and texts are drawn
without replacement by the highest weights with Gumbel noise that is fixed by their ids.

A task numbers the words of a stretch of texts and sorts their suffixes by the first words. Neighbours in that order that
agree in n words or more are a run, and a run is all occurrences of one n-gram: it is hashed once, and its bucket is
scattered back to the places where it occurs. Counts are summed in tasks before they are exchanged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, give_back, materialize, small_batches

#: Buckets, shortest and longest n-gram in words, least words of a text that can be drawn, percent of those that are, seed.
BUCKETS, SHORTEST, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 1, 20, 10, 2024
#: Bytes of text whose suffixes are sorted together, about.
STRETCH = 4 << 20

_IN_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def suffix_runs(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, agree): the places in the order of their suffixes' first ``depth`` words, and in how many of these words each
    place agrees with the one before it in that order. Below 0 are ends of texts, which agree with nothing."""
    columns = [words if k == 0 else np.concatenate((words[k:], np.full(min(k, len(words)), -1, words.dtype))) for k in range(depth)]
    order = np.argsort(words, kind="stable") if depth == 1 else np.lexsort(columns[::-1])
    agree, same = np.zeros(len(words), np.int32), np.ones(max(0, len(words) - 1), bool)
    for column in columns:
        sorted_words = column[order]
        same = same & (sorted_words[1:] == sorted_words[:-1]) & (sorted_words[1:] >= 0)
        agree[1:] += same
    return order, agree


class Stretch:
    """The words of some texts: ``of`` tells whose each is, ``owned`` whether an n-gram that starts there is counted here."""

    def __init__(self, raw: bytes, ends: np.ndarray, owned_upto: int | None = None):
        """raw: lower-cased texts one behind the other, ends: where each ends."""
        import pyarrow as pa

        flat = np.frombuffer(raw, np.uint8)
        inside = _IN_WORD[flat]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        begins = np.concatenate(([0], ends[:-1]))
        begins = begins[begins < len(flat)]
        start[begins] = inside[begins]
        at = np.flatnonzero(start)
        kept = flat[inside]
        offsets = np.append(np.cumsum(inside)[at] - 1, len(kept)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode()
        self.number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.spelled = coded.dictionary
        self.of = np.searchsorted(ends, at, side="right")
        self.owned = np.ones(len(at), bool) if owned_upto is None else at < owned_upto

    def buckets(self, shortest: int, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place of its first word, bucket) of the n-grams counted here, for each length."""
        if not len(self.number):
            return
        # An end of text stands between texts, so that no n-gram spans two.
        breaks = np.flatnonzero(self.of[1:] != self.of[:-1]) + 1
        words = np.append(np.insert(self.number, breaks, -1), -1)
        place = np.append(np.insert(np.arange(len(self.number)), breaks, -1), -1)
        order, agree = suffix_runs(words, longest)
        spelled = self.spelled.to_pylist()
        reach = np.zeros(len(words), np.int64)  # words from here to the end of the text
        ends = np.flatnonzero(words < 0)
        reach[:] = ends[np.searchsorted(ends, np.arange(len(words)))] - np.arange(len(words))
        for n in range(shortest, longest + 1):
            fits = reach[order] >= n
            new = fits & (agree < n)
            firsts = order[new]
            if n == 1:
                hashed = [zlib.crc32(spelled[w]) % buckets for w in words[firsts].tolist()]
            else:
                hashed = [zlib.crc32(b" ".join(spelled[w] for w in words[p : p + n].tolist())) % buckets for p in firsts.tolist()]
            run = np.cumsum(new)[fits] - 1
            at = place[order[fits]]
            bucket = np.array(hashed, np.int64)[run]
            mine = self.owned[at]
            yield at[mine], bucket[mine]


def stretches(texts, longest: int, size: int = STRETCH) -> Iterator[tuple[Stretch, np.ndarray]]:
    """The texts (bytes or None) in stretches of about ``size`` bytes, with the numbers of their texts. A longer text is cut between
    words, and each cut sees the words that n-grams over it need."""
    ahead = re.compile(rb"(?:" + _GAP + rb"*" + _WORD + rb"){0,%d}" % (longest - 1)) if longest > 1 else None
    gap = re.compile(_GAP)
    held, rows, n = [], [], 0

    def made():
        return Stretch(b"".join(held), np.cumsum([len(x) for x in held])), np.array(rows)

    for row, text in enumerate(texts):
        raw = (text or b"").lower()
        if len(raw) > size:
            at = 0
            while at < len(raw):
                edge = gap.search(raw, at + size) if len(raw) - at > size else None
                end = edge.start() if edge else len(raw)
                more = ahead.match(raw, end).end() if ahead else end
                yield Stretch(raw[at:more], np.array([more - at]), end - at), np.array([row])
                at = end
            continue
        if n + len(raw) > size and rows:
            yield made()
            held, rows, n = [], [], 0
        held.append(raw)
        rows.append(row)
        n += len(raw)
    if rows:
        yield made()


def _bytes_of(column) -> list[bytes | None]:
    return column.to_pylist()


def bucket_counts(texts: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: over all rows of ``texts`` (one column of text). A task hands on a row per bucket at most."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for stretch, _ in stretches(_bytes_of(batch.column(0)), longest):
                for _, bucket in stretch.buckets(shortest, longest, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])
        give_back()

    small_batches(texts)
    return texts.select(F.col(texts.columns[0]).cast("binary")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def fitted_gains(raw: DataFrame, target: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths, with one added to each count. Only the ``buckets`` sums reach the driver."""
    sides = []
    for texts in (raw, target):
        count = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, shortest, longest, buckets).collect():
            count[r["bucket"]] = r["n"]
        sides.append(count)
    (s, t), (n_raw, n_target) = sides, (int(x.sum()) for x in sides)
    ratio = (t + 1.0) * float(n_raw + buckets) / ((s + 1.0) * float(n_target + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row of ``docs``."""
    import pyarrow as pa

    kind = docs.schema["doc_id"].dataType
    small_batches(docs)

    def run(batches):
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for stretch, rows in stretches(_bytes_of(batch.column(1)), longest):
                words += np.bincount(rows[stretch.of[stretch.owned]], minlength=batch.num_rows)
                for at, bucket in stretch.buckets(shortest, longest, len(gains)):
                    row = rows[stretch.of[at]]
                    features += np.bincount(row, minlength=batch.num_rows)
                    weight += np.bincount(row, gains[bucket], batch.num_rows).astype(np.int64)  # whole numbers below 2**53
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"])
        give_back()

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise in thousandths, fixed by the seed and the id; a null id counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each row of ``docs`` (``doc_id``, ``text``); rank is null for rows that aren't drawn.

    ``target``: one column of texts. Words are runs of digits, letters and characters beyond ASCII, A to Z in lower case; features are all runs of ``shortest`` to ``longest`` words, repeats counted. Null,
    empty and wordless texts have no features and weight 0, here and in the target, which may be empty. Very long texts are read
    whole. Of the rows with ``least_words`` words the highest ``percent`` percent by score are drawn, rounded down; ties go to the
    smaller doc_id, null ids first. Repeated rows count and are drawn each for itself. No rows in, no rows out; other columns are dropped, whatever their names.
    """
    gains = fitted_gains(docs.select("text"), target, shortest, longest, buckets)
    found = weighed(docs, gains, shortest, longest)
    scored = materialize(found.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id()), "resample-scores")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    # Ranges of the order follow each other; a row's number in it is that in its range behind the rows of the ranges before.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row").asc()]
    line = able.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(line.withColumn("place", F.monotonically_increasing_id()), "resample-order")
    task, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("start"))  # a row per range
    rank = F.col("start") + within + 1
    ranked = placed.withColumn("task", task).join(F.broadcast(starts), "task").withColumn("rank", F.when(rank <= drawn, rank))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    done = materialize(ranked.select(*columns).unionByName(short.select(*columns)), "resampled")
    discard(scored)
    discard(placed)
    return done
