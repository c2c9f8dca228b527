"""Bounded samples of labelled rows for the operators that learn.

A sample takes rows in the order of a hash of their id, so it is the same on every run and drawn alike
from every source. Only as many rows as the documented bound ever reach the driver.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, utf8_size


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % parts


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    return F.coalesce(remainder(doc_id, parts) == rest, F.lit(False))


def sample_labels(labels: DataFrame, label: str, parts: int, rest: int, rows: int) -> DataFrame:
    """``rows`` labelled ids of each class at most (doc_id, label), none of them held out, and each once.

    Null ids and labels are left out; an id with several labels counts with the largest.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), parts, rest))
    each = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")).withColumn("h", F.xxhash64("doc_id"))
    picked = [each.where(F.col("label") == y).orderBy("h", "doc_id").limit(rows) for y in (0, 1)]
    return picked[0].unionByName(picked[1]).drop("h")


def class_counts(labels: DataFrame, label: str, parts: int, rest: int) -> dict[int, int]:
    """How many usable labels each class has in all of ``labels``."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), parts, rest))
    found = usable.groupBy(F.col(label).cast("int").alias("y")).count().where("y in (0, 1)").collect()
    return {0: 0, 1: 0} | {r["y"]: r["count"] for r in found}


def with_texts(sample: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, label, text of the sample, a row per id: of several texts with one id the first in code-point order.

    The sample is bounded, so it is what gets broadcast, and what comes back is bounded, however often ids repeat.
    """
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def bounded_texts(sample: DataFrame, docs: DataFrame, most_bytes: int) -> DataFrame:
    """As ``with_texts``, of ``most_bytes`` of text at most: each class takes its rows in the order of a hash of their ids while they
    fit into its half. Only sizes of the sample's rows reach the driver. A row whose text alone is larger is left out."""
    held = materialize(with_texts(sample, docs).withColumn("h", F.xxhash64("doc_id")), "labelled-texts")
    sizes = held.select("doc_id", "label", "h", utf8_size(F.col("text")).alias("n")).collect()
    if 2 * sum(r["n"] for r in sizes) <= most_bytes:
        return held.drop("h")
    fit, full = [], {0: 0, 1: 0}
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if full[r["label"]] + r["n"] <= most_bytes // 2:
            full[r["label"]] += r["n"]
            fit.append((r["doc_id"],))
    ids = held.sparkSession.createDataFrame(fit, held.select("doc_id").schema)
    return held.join(F.broadcast(ids), "doc_id", "left_semi").drop("h")


_BANDS, _ROWS = 4, 3
_COPY_WORD = re.compile(r"\w+")


def copy_bands(text: str | None) -> list[int]:
    """Band keys of a MinHash over pairs of words; copies of a text share one of them as a rule, other texts don't."""
    words = _COPY_WORD.findall((text or "").lower())
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:])} or {" ".join(words)}
    h = np.array([xxhash.xxh3_64_intdigest(p) for p in pairs], np.uint64)
    odd = np.random.RandomState(7).randint(0, 2**62, _BANDS * _ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    lowest = np.array([(h * a).min() for a in odd])
    return [xxhash.xxh3_64_intdigest(bytes([b]) + lowest[b * _ROWS : (b + 1) * _ROWS].tobytes()) - 2**63 for b in range(_BANDS)]


def without_copies(rows: list[tuple[int, int, list[int]]]) -> set[int]:
    """The ids that stay when each text with an earlier one's band key goes. rows: (id, label, band keys) of a bounded sample."""
    seen: set[int] = set()
    kept = set()
    for doc_id, _, bands in sorted(rows, key=lambda r: r[:2]):
        if seen.isdisjoint(bands):
            kept.add(doc_id)
        seen.update(bands)
    return kept
