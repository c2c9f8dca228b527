"""Sweeps over ranges, versions, histories and maintained aggregates against plain versions."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sentrylake.functions.versions import version_key
from sentrylake.operators import history, ranges
from sentrylake.plans.maintained import CountedState, difference


# Versions.
def test_versions_sort_as_they_should(spark):
    rising = ["0.1alpha", "0.1beta2", "0.1beta10", "0.1", "0.1.1", "0.9", "0.10", "1.0-rc1", "1", "1.0.1a", "1.0.1", "2", "10", "10.0.0.3", "99999999999999999999.1", "100000000000000000000"]
    keys = [r[0] for r in spark.createDataFrame(list(enumerate(rising)), "i int, v string").orderBy("i").select(version_key(F.col("v"))).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    same = spark.createDataFrame([("1.0", "1"), ("V1.0.0", "v1"), ("01.002-RC1", "1.2rc1"), ("1.0rc", "1rc"), ("1_0_3", "1.0.3")], "a string, b string")
    assert same.where(version_key(F.col("a")) != version_key(F.col("b"))).count() == 0
    none = spark.createDataFrame([("*",), ("-",), ("",), (None,)], "v string")
    assert none.where(version_key(F.col("v")).isNotNull()).count() == 0


# Intervals that hold a point.
def plain_holding(points, intervals):
    out = set()
    for k, at in set(points):
        for j, low, low_open, high, high_open in set(intervals):
            if None not in (k, at, j) and k == j and (low is None or at > low or at == low and not low_open) and (high is None or at < high or at == high and not high_open):
                out.add((k, at, low, bool(low_open), high, bool(high_open)))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_points_in_intervals_equal_all_pairs(spark, parts):
    r = random.Random(parts)
    key = lambda: r.choice(["hot"] * 6 + ["a", "b", None])
    text = lambda: r.choice([None, "M", f"N{r.randint(10, 60)}"] + [f"N{r.randint(10, 60)}M"] * 6)
    points = [(key(), text()) for _ in range(250)] * 2
    intervals = [(key(), text(), r.choice([True, False, None]), text(), r.choice([True, False, None])) for _ in range(120)] + [("hot", None, None, None, None)] * 2
    p = spark.createDataFrame([(*x, 1) for x in points], "k string, v string, low int").drop("low")
    i = spark.createDataFrame(intervals, "k string, low string, low_open boolean, high string, high_open boolean")
    held = ranges.holding(p, i, ["k"], "v", "low", "high", "low_open", "high_open", parts)
    rows = [tuple(x) for x in held.select("k", "v", "low", "low_open", "high", "high_open").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_holding(points, intervals)
    assert ranges.holding(p.limit(0), i, ["k"], "v", "low", "high", "low_open", "high_open", 3).count() == 0


def test_a_hot_key_lies_in_several_ranges(spark):
    p = spark.createDataFrame([("hot", f"N{i:05d}M") for i in range(4000)] + [("a", "N1M")], "k string, v string")
    line = ranges.cut(p, ["k", "v"], 8)
    sizes = [r["count"] for r in line.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


# As of.
def plain_as_of(left, right):
    by = defaultdict(list)
    for k, since, value, order in right:
        if k is not None and since is not None:
            by[k].append((since, order is not None, order or 0, value))
    out = Counter()
    for i, k, at in left:
        held = sorted(x for x in by.get(k, ()) if at is not None and x[0] <= at)
        out[(i, k, at, held[-1][3] if held else None)] += 1
    return out


@pytest.mark.parametrize("parts", [1, 9])
def test_as_of_equals_a_plain_search(spark, parts):
    r = random.Random(parts)
    key = lambda: r.choice([7, 7, 7, 7, 1, 2, 3, None])
    time = lambda: r.choice([None] + [r.randint(0, 300)] * 30)
    left = [(r.randint(0, 150), key(), time()) for _ in range(400)] + [(1, 7, 50)] * 3 + [(2, 9, 5)]
    right = [(key(), time(), r.choice([None, f"s{n}"]), n) for n in range(60)] + [(7, 40, "last", 999), (7, 40, "null first", None)]
    frames = spark.createDataFrame(left, "i int, k int, at int"), spark.createDataFrame(right, "k int, since int, value string, n int")
    found = ranges.as_of(*frames, ["k"], "at", "since", ["value"], ["n"], parts)
    assert found.columns == ["i", "k", "at", "value"]
    assert Counter(map(tuple, found.collect())) == plain_as_of(left, right)
    assert ranges.as_of(frames[0], frames[1].limit(0), ["k"], "at", "since", ["value"], [], 3).where("value IS NULL").count() == len(left)
    assert ranges.as_of(frames[0].limit(0), frames[1], ["k"], "at", "since", ["value"], [], 3).count() == 0


# History.
def plain_intervals(states):
    by, out = defaultdict(dict), Counter()
    for k, at, value in states:
        by[k][at] = value
    for k, held in by.items():
        runs = []
        for at in sorted(held):
            if not runs or runs[-1][1] != held[at]:
                runs.append((at, held[at]))
        for (at, value), after in zip(runs, [*runs[1:], None]):
            if value != "gone":
                out[(k, value, at, after and after[0], after is None)] += 1
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_history_is_the_same_whatever_order_changes_come_in(spark, parts):
    r = random.Random(parts)
    rows = [(r.choice([7, 7, 7, 1, 2]), r.randint(0, 500), r.choice(["a", "b", None, "gone"]), n) for n in range(350)] + [(None, 3, "a", 1), (1, None, "a", 1)]
    rows += [(3, n, "a", n) for n in range(5, 40)]
    final = {}
    for k, at, value, n in sorted((x for x in rows if None not in x[:2]), key=lambda x: x[3]):
        final[k, at] = value
    wanted = plain_intervals([(k, at, v) for (k, at), v in final.items()])
    frame = lambda some: spark.createDataFrame(some, "k int, at int, value string, n int")
    make = lambda states: history.intervals(states, ["k"], "at", ["value"], F.col("value") == "gone", parts)
    points = lambda some: history.points(frame(some), ["k"], "at", ["value"], ["n"])
    assert Counter(map(tuple, make(points(rows)).collect())) == wanted
    # The same in two batches; what comes late of one moment replaces what was there.
    rows.sort(key=lambda x: x[3])
    first, late = rows[:250], rows[250:]
    every, touched = history.with_late(points(first), points(late), ["k"], "at")
    assert Counter(map(tuple, make(every).collect())) == wanted
    keys = {x[0] for x in touched.select("k").distinct().collect()}
    assert Counter(map(tuple, make(touched).collect())) == Counter({k: n for k, n in wanted.items() if k[0] in keys})


# Maintained aggregates.
def aggregates(rows):
    by = defaultdict(list)
    for g, v, w in rows:
        by[g].append((v, w))
    return {(g, len(x), min((v for v, _ in x if v is not None), default=None), len({w for _, w in x if w is not None})) for g, x in by.items()}


def test_three_rounds_of_changes_equal_a_rebuild_and_read_what_they_touch(spark, tmp_path):
    r = random.Random(5)
    row = lambda: (r.choice([None, *range(40)]), r.choice([None, 1, 2, 3]), r.choice([None, "x", "y", "z"]))
    schema, columns = "g int, v int, w string", ["g", "v", "w"]
    state = CountedState(spark, f"{tmp_path}/state", ["g"], ["v", "w"], 16)
    now, frame = [], lambda some: spark.createDataFrame(some, schema)
    shown = lambda: {tuple(x) for x in state.groups(frame([]), n=F.sum("n"), least=F.min("v"), distinct=F.count_distinct("w")).collect()}
    for n_gone, n_come in ((0, 400), (150, 60), (200, 10)):
        gone = r.sample(now, n_gone)
        come = [row() for _ in range(n_come)]
        now = list((Counter(now) - Counter(gone)).elements()) + come
        state.apply(difference(frame(gone), frame(come), columns))
        assert shown() == aggregates(now)
    one = now[0]
    touched = state.apply(difference(frame([one]), frame([]), columns))
    assert len(touched) == 1 and shown() == aggregates(now[1:])
    # All rows of a group go, and of the only group of a bucket.
    last = [x for x in now[1:] if x[0] == now[-1][0]]
    state.apply(difference(frame(last), frame([]), columns))
    assert shown() == aggregates([x for x in now[1:] if x[0] != now[-1][0]])
    before = shown()
    assert state.apply(difference(frame([one]), frame([one]), columns)) == []
    with pytest.raises(Exception, match="more rows go"):
        state.apply(difference(frame([(-5, 1, "x")]), frame([]), columns))
    assert shown() == before


def test_the_least_value_comes_back_when_it_goes(spark, tmp_path):
    state = CountedState(spark, f"{tmp_path}/least", ["g"], ["v"])
    f = lambda *v: spark.createDataFrame([(1, x) for x in v], "g int, v int")
    state.apply(difference(f(), f(3, 1, 1), ["g", "v"]))
    for gone, least in ((1, 1), (1, 3)):
        state.apply(difference(f(gone), f(), ["g", "v"]))
        assert state.groups(f(), least=F.min("v")).first()["least"] == least
    assert {tuple(x) for x in state.rows(f()).collect()} == {(1, 3, 1)}


# Streams.
def test_a_stream_of_sessions_goes_on_from_its_checkpoint_and_drops_what_is_too_late(spark, tmp_path):
    import datetime as dt

    from sentrylake.streaming.sessions import stream_sessions

    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    schema = spark.createDataFrame([], "id long, key long, at timestamp").schema
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def take(number, *rows):
        if rows:
            spark.createDataFrame([(i, k, None if m is None else at(m)) for i, k, m in rows], schema).coalesce(1).write.parquet(f"{folder}/{number}")
        stream_sessions(spark, folder, schema, out, checkpoint, "key", "at", ["id"], "10 minutes", "30 minutes").awaitTermination()
        return sorted((r["key"], r["first"], r["last"], r["n"]) for r in spark.read.schema("key long, first timestamp, last timestamp, n long").parquet(out).collect())

    assert take(0, (1, 7, 0), (2, 7, 10), (2, 7, 10), (3, 8, 5), (4, None, 5), (5, 7, None)) == []
    assert take(1, (6, 7, 5), (7, 7, 100)) == [(7, at(0), at(10), 3), (8, at(5), at(5), 1)]
    assert take(2) == [(7, at(0), at(10), 3), (8, at(5), at(5), 1)]
    # 55 is beyond the watermark (70) and dropped; 95 is late, but not too late.
    assert take(3, (8, 7, 55), (9, 7, 95), (10, 9, 200)) == [(7, at(0), at(10), 3), (7, at(95), at(100), 2), (8, at(5), at(5), 1)]
    assert take(4) == take(5)


# Levels, frames and samples.
def test_levels_tell_nulls_from_totals(spark):
    rows = [(2001, None, 1), (2001, "a", 1), (2001, "a", 2), (None, "a", 2), (2002, "b", None)]
    from sentrylake.plans import analytics

    found = analytics.distinct_by_levels(spark.createDataFrame(rows, "y int, v string, id int"), ["y", "v"], [["y", "v"], ["v"], []], "id")
    assert Counter(map(tuple, found.collect())) == Counter([(2001, None, 0, 1), (2001, "a", 0, 2), (None, "a", 0, 1), (None, None, 2, 1), (None, "a", 2, 2), (None, None, 3, 2)])


def test_samples_of_parts_hold_the_sample_of_all(spark):
    from sentrylake.plans import analytics

    rows = spark.range(600).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 3).alias("s"))
    draw = lambda df: analytics.bottom_k(df, ["s"], F.col("id"), 20)
    whole = draw(rows).collect()
    parts = draw(rows.where("id % 2 = 0")).unionByName(draw(rows.where("id % 2 = 1"))).drop("weight")
    assert {r["id"] for r in draw(parts).collect()} == {r["id"] for r in whole}
    assert len(whole) == 80 and sum(r["weight"] for r in whole) == pytest.approx(600)
    assert draw(rows.where("id < 5")).agg(F.max("weight")).first()[0] == 1


def test_frames_are_ranges_of_days(spark):
    import datetime as dt

    from sentrylake.plans import analytics

    day = lambda n: dt.date(2024, 2, 1) + dt.timedelta(days=n)
    rows = spark.createDataFrame([("a", day(0)), ("a", day(0)), ("a", day(29)), ("a", day(30)), ("b", day(5)), ("a", None)], "k string, d date")
    found = analytics.moving(analytics.daily(rows, ["k"], "d"), ["k"], "d")
    assert sorted(map(tuple, found.collect())) == [("a", day(0), 2, 2, 2, 2, None), ("a", day(29), 1, 3, 3, 3, 29), ("a", day(30), 1, 2, 4, 4, 1), ("b", day(5), 1, 1, 1, 1, None)]


# Variants.
def test_variants_find_drift_at_any_depth_and_survive_broken_fields(spark):
    import datetime as dt

    from sentrylake.operators import variants

    texts = [
        '{"id": "a", "published": "2024-01-01T00:00:00.000", "vulnStatus": 7, "descriptions": [{"lang": "en", "value": "x", "tone": 1}], "references": [{"anything": 1}]}',
        '{"id": "b", "published": [1], "metrics": {"cvssMetricV31": [{"type": "Primary", "cvssData": {"baseScore": "7.5", "vectorString": "V", "scope": "C"}, "extra": {"deep": 1}}]}, "newKey": {"deeper": 2}, "odd, <`key>": {"x": 1.5}}',
        '{"id": "c", "metrics": {"cvssMetricV30": [{"cvssData": {"baseScore": 9.1, "baseSeverity": "critical"}}], "cvssMetricV40": []}}', "broken", None,
    ]
    rows = spark.createDataFrame([(t, "h", "b") for t in texts], "raw_json string, payload_sha256 string, batch_id string").withColumn("cve_id", F.get_json_object("raw_json", "$.id"))
    parsed = variants.parsed(rows)
    assert variants.drift(parsed) == ["descriptions.tone", "metrics.cvssMetricV31.cvssData.scope", "metrics.cvssMetricV31.extra", "metrics.cvssMetricV40", "newKey", "odd, <`key>"]
    assert variants.drift(parsed.limit(0)) == []
    odd = rows.limit(1).withColumn("raw_json", F.lit('{"id": "d", "descriptions": "none", "metrics": [1], "published": "2024-01-01T00:00:00"}')).withColumn("cve_id", F.lit("d"))
    broken = variants.shaped_cves(variants.parsed(odd), dt.datetime(2024, 1, 1, tzinfo=dt.UTC)).first()
    assert (broken["description_en"], broken["cvss_v3_score"], str(broken["published_at"])) == (None, None, "2024-01-01 00:00:00")
    got = {r["cve_id"]: r for r in variants.shaped_cves(parsed, dt.datetime(2024, 1, 1, tzinfo=dt.UTC)).collect() if r["cve_id"]}
    assert (got["a"]["vuln_status"], got["a"]["description_en"], got["a"]["cvss_v3_score"]) == ("7", "x", None)
    assert (got["b"]["published_at"], got["b"]["cvss_v3_score"], got["b"]["description_en"]) == (None, 7.5, None)
    assert (got["c"]["cvss_v3_score"], got["c"]["cvss_v3_severity"]) == (9.1, "CRITICAL")
