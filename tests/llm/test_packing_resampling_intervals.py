"""Packing, importance resampling and the interval overlap join against plain versions."""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentrylake.llm import interval_join, packing, queries, resampling
from sentrylake.llm.byte_tokens import ByteTokenizer


# Tokens.
@pytest.fixture(scope="module")
def vocabulary():
    return queries.byte_vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary[0])


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    return ByteTokenizer(*vocabulary)


ODD = ["", " ", "  a", "a  b", "a \n b", "\n\n", " a b ", "don't  stop'll x", "x y", "é è́ ñ", "日本 語 text", "a <|endoftext|> b", "a\x1c b", "tab\t\tx  z w", "١٢ ٣ x", "🎉 🎉🎉 ok", "a b c\n", "'s 's", "² ½ x", "\x85 a", "“it’s” – so"]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library_on_edge_cases(tokenizer, library, text):
    assert tokenizer.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'sz .,\n\t  é“’1²語") | st.characters(codec="utf-8"), max_size=40))
def test_ids_equal_the_library(tokenizer, library, text):
    assert tokenizer.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


# Packing.
def is_packed(rows, capacity):
    """Every sequence is gapless from 0 and within capacity; returns how many there are."""
    by = defaultdict(list)
    for size, sequence, offset in rows:
        by[sequence].append((offset, size))
    for held in by.values():
        upto = 0
        for offset, size in sorted(held):
            assert offset == upto
            upto += size
        assert upto <= capacity
    return len(by)


def best_fit_decreasing(sizes, capacity):
    gaps, n = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, s)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        n += gap == capacity
        bisect.insort(gaps, gap - s)
    return n


SIZES = {
    "spread": [random.Random(1).randint(1, 2047) for _ in range(1500)],
    "short": [random.Random(2).randint(1, 40) for _ in range(3000)],
    "tiny": [3] * 2500,
    "one size": [600] * 700,
    "halves": [1024] * 301 + [1025] * 100 + [1023] * 100,
    "long tail": [min(2047, int(random.Random(i).lognormvariate(6, 1.2)) + 1) for i in range(1500)],
    "single": [5],
}


@pytest.mark.parametrize("kind", SIZES)
@pytest.mark.parametrize("last, per_task", [(50_000, 250_000), (400, 300)])
def test_packing_is_nearly_as_tight_as_one_sequential_best_fit(spark, monkeypatch, kind, last, per_task):
    """In one task, and in rounds of several tasks down to the last few rows."""
    monkeypatch.setattr(packing, "ROWS_PER_TASK", per_task)
    monkeypatch.setattr(packing, "LAST_ROWS", last)
    sizes = SIZES[kind]
    items = spark.createDataFrame(list(enumerate(sizes)), "id long, size long").repartition(3)
    rows = packing.best_fit(items).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(sizes)))
    used = is_packed([(sizes[r["id"]], r["sequence_id"], r["offset"]) for r in rows], 2048)
    assert used <= math.ceil(best_fit_decreasing(sizes, 2048) * 1.01)


def test_a_round_pairs_every_gap_with_the_largest_document_that_is_left(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_TASK", 40)
    r = random.Random(4)
    docs, gaps = ([(i, r.randint(1, 30)) for i in range(k)] for k in (150, 90))
    spread = lambda rows: spark.createDataFrame(rows, "id long, size int")
    swept, rest = packing._matched(spread(docs), spread(gaps), 240)
    found = {x["id"]: (x["value"], x["mate_value"]) for f in (swept, rest) for x in f.where("kind = 1 AND mate IS NOT NULL").collect()}
    stack, wanted = [], Counter()
    for value, kind in sorted([(s, 0) for _, s in docs] + [(s, 1) for _, s in gaps]):
        if kind == 0:
            stack.append(value)
        elif stack:
            wanted[value, stack.pop()] += 1
    assert Counter(found.values()) == wanted
    mates = [x["mate"] for f in (swept, rest) for x in f.where("kind = 1 AND mate IS NOT NULL").collect()]
    assert len(mates) == len(set(mates))


def plain_pieces(ids, capacity):
    n, start, out = len(ids), 0, []
    end = n % capacity or capacity
    while start < n:
        out.append((len(out), start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
        start, end = end, end + capacity
    return out


def test_packed_documents_are_cut_and_summed_like_plain_ones(spark, vocabulary, library):
    texts = [(1, "one two  three"), (2, None), (3, ""), (3, "x " * 700), (None, "y"), (5, "word " * 130), (5, "word " * 130), (6, "z" * 40_000)]
    docs = spark.createDataFrame([(i, t, i, "c") for i, t in texts], "doc_id long, text string, sequence_id long, id string")
    rows = packing.pack(docs, *vocabulary, capacity=64).collect()
    wanted = Counter()
    for doc_id, text in texts:
        for piece in plain_pieces([*library.encode(text or "", add_special_tokens=False).ids, 0], 64):
            wanted[(doc_id, *piece)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    is_packed([(r["length"], r["sequence_id"], r["offset"]) for r in rows], 64)
    assert packing.pack(docs.limit(0), *vocabulary).collect() == []


def test_packing_query(spark, sf_dir, library):
    rows = queries.op11_packing(spark, sf_dir).collect()
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in queries.table(spark, sf_dir, "documents").collect()}
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == Counter((d, *p) for d, x in ids.items() for p in plain_pieces(x, 2048))
    used = is_packed([(r["length"], r["sequence_id"], r["offset"]) for r in rows], 2048)
    assert used <= best_fit_decreasing([r["length"] for r in rows], 2048) + 1


# Resampling.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_features(text, lo, hi, buckets):
    words = WORD.findall(lowered(text))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, lo, hi, buckets, least, percent):
    per = [plain_features(t, lo, hi, buckets) for _, t in docs]
    s, t = Counter(b for _, f in per for b in f), Counter(b for x in target for b in plain_features(x, lo, hi, buckets)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    rows = []
    for (doc_id, _), (words, features) in zip(docs, per):
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, features))
        rows.append((doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = len(able) * percent // 100
    return Counter([(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)] + [(*r[:4], None) for r in rows if not r[4]])


@pytest.mark.parametrize("lo, hi, stretch", [(1, 1, 4 << 20), (1, 3, 4 << 20), (2, 3, 50), (1, 2, 7)])
def test_resampling_equals_a_plain_version(spark, monkeypatch, lo, hi, stretch):
    r = random.Random(3)
    vocabulary = ["alpha", "Beta", "été", "x1", "語", "the", "of", "a"]
    text = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "--", "\n"]) for _ in range(n))
    docs = [(i, text(r.randint(0, 60))) for i in range(60)] + [(7, None), (None, text(30)), (None, text(30)), (90, ""), (91, "¡!"), (92, "..."), (93, text(900)), (8, "the the of the the of" * 9), (8, "the the of the the of" * 9)]
    target = [text(12), None, "", "the of the of", "Alpha beta ALPHA"]
    stretches = resampling.stretches
    monkeypatch.setattr(resampling, "stretches", lambda texts, longest: stretches(texts, longest, stretch))
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, rank int, row string").repartition(3)
    found = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), lo, hi, 50, 20, 40)
    assert Counter(map(tuple, found.collect())) == plain_resample(docs, target, lo, hi, 50, 20, 40)


def test_runs_hold_all_occurrences_once(monkeypatch):
    hashed = []
    monkeypatch.setattr(resampling.zlib, "crc32", lambda b: hashed.append(b) or zlib_crc32(b))
    texts = [b"a b a b a", b"b a b"]
    (stretch, rows), = resampling.stretches(texts, 2)
    found = {n: sorted(zip(rows[stretch.of[at]].tolist(), bucket.tolist())) for n, (at, bucket) in enumerate(stretch.buckets(1, 2, 1000), 1)}
    assert sorted(hashed) == [b"a", b"a b", b"b", b"b a"]
    c = lambda s: zlib_crc32(s) % 1000
    assert found[1] == sorted([(0, c(b"a"))] * 3 + [(0, c(b"b"))] * 2 + [(1, c(b"b"))] * 2 + [(1, c(b"a"))])
    assert found[2] == sorted([(0, c(b"a b"))] * 2 + [(0, c(b"b a"))] * 2 + [(1, c(b"b a")), (1, c(b"a b"))])


zlib_crc32 = zlib.crc32


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(docs, none).count() == 0
    assert resampling.resample(some, none, percent=100).first()["rank"] == 1


# Intervals.
def plain_sessions(events, pause):
    by, out = defaultdict(list), []
    for key, t, bad in events:
        if key is not None and t is not None:
            by[key].append((t, bool(bad)))
    for key, rows in by.items():
        rows.sort()
        group = []
        for row in rows:
            if group and row[0] - group[-1][0] > pause:
                out.append((key, group[0][0], group[-1][0], any(b for t, b in group if t == group[-1][0])))
                group = []
            group.append(row)
        out.append((key, group[0][0], group[-1][0], any(b for t, b in group if t == group[-1][0])))
    return out


def plain_totals(intervals, found, slot):
    out = Counter()
    for number, (i, key, first, last, is_open) in enumerate(intervals):
        if key is None or first is None:
            continue
        a, b = first // slot, math.inf if is_open else last // slot
        held = defaultdict(lambda: [0, 0, 0])
        for k, f, l, o in found:
            x, y = f // slot, math.inf if o else l // slot
            if k == key and x <= b and y >= a:
                start, end = (a > x) - (a < x), (b > y) - (b < y)
                name = {(-1, -1): "overlaps", (-1, 0): "finished_by", (-1, 1): "contains", (0, -1): "starts", (0, 0): "equals", (0, 1): "started_by", (1, -1): "during", (1, 0): "finishes", (1, 1): "overlapped_by"}[start, end]
                h = held[name]
                h[0] += 1
                h[1] = None if b == y == math.inf else h[1] + min(b, y) - max(a, x) + 1
                h[2] += zlib.crc32(str(f).encode())
        for name, h in held.items():
            out[(i, name, h[0], h[1], h[2])] += 1
    return out


@pytest.mark.parametrize("seed, span, step", [(1, 40_000, 1), (2, 4_000, 1), (3, 400_000, 97), (4, 600, 1)])
def test_overlaps_equal_all_pairs(spark, seed, span, step):
    r = random.Random(seed)
    pause, slot, shift = 50, 120, 10 * interval_join.DAY
    moment = lambda: shift + r.randrange(0, span, step)
    key = lambda: r.choice([7, 7, 7, 1, 2, 3, None])
    events = [(key(), moment() if r.random() > 0.02 else None, r.choice([True, False, False, None])) for _ in range(700)]
    events += events[:40]
    intervals = []
    for i in range(300):
        first = moment() if r.random() > 0.02 else None
        intervals.append((r.choice([i, 0]), key(), first, (first or 0) + r.choice([0, 1, slot, r.randrange(span)]), r.choice([True, False, False, None])))
    spread = spark.createDataFrame(events, "key long, t long, ends_open boolean")
    found = interval_join.sessions(spread, pause)
    wanted = plain_sessions(events, pause)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    frame = spark.createDataFrame([(*i, 1, "x") for i in intervals], "id long, key long, first long, last long, open boolean, place long, relation string")
    totals = interval_join.overlap_totals(frame, found, slot)
    assert totals.columns == ["id", "relation", "n_pairs", "overlap_slots", "sessions_crc"]
    assert Counter(map(tuple, totals.collect())) == plain_totals(intervals, wanted, slot)


def test_sessions_go_on_over_midnight_and_days_without_a_start(spark):
    day, pause = interval_join.DAY, interval_join.PAUSE
    times = list(range(day - 10 * pause, 3 * day + 5, pause)) + [4 * day, 4 * day + pause, 4 * day + 2 * pause + 1]
    events = [(1, t, False) for t in times]
    found = interval_join.sessions(spark.createDataFrame(events, "key long, t long, ends_open boolean"))
    assert sorted(map(tuple, found.collect())) == sorted(plain_sessions(events, pause))


def test_times_before_1970_with_and_without_a_zone(spark):
    from pyspark.sql import functions as F

    moments = [dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), dt.datetime(2024, 3, 10, 2, 30, 0, 1), None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    frame = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    micros = [None if m is None else (m - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for m in moments]
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert [r[0] for r in frame.select(interval_join.micros(frame, "t")).collect()] == micros
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    zoned = frame.select(F.col("t").cast("timestamp").alias("t"))
    assert [r[0] for r in zoned.select(interval_join.micros(zoned, "t")).collect()] == micros


def test_sale_intervals_and_empty_tables(spark):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    us = lambda h: 1704067200000000 + h * 3_600_000_000
    sales = spark.createDataFrame([(1, 5, "open", at(1)), (2, 5, None, at(2)), (3, None, "done", at(3)), (4, 6, "done", None), (5, 6, "done", at(5))], "sale_id long, client_id long, status string, sold_at timestamp_ntz")
    lines = spark.createDataFrame([(1, at(9)), (1, at(8)), (2, None), (5, at(4)), (None, at(99))], "sale_id long, shipped_at timestamp_ntz")
    of = interval_join.sale_intervals(sales, lines)
    assert sorted(map(tuple, of.collect())) == [(1, 5, us(1), us(9), True), (2, 5, us(2), us(2), False), (5, 6, us(5), us(5), False)]
    none = interval_join.sessions(spark.createDataFrame([], "key long, t long, ends_open boolean"))
    assert interval_join.overlap_totals(of, none).count() == 0
    assert interval_join.overlap_totals(of.limit(0), none).count() == 0


def test_no_pairs_are_made(spark, sf_dir):
    plan = queries.op13_interval_overlap(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
