"""What a reviewer found in round 3, on small tables that hold the case."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

from oracle import same

from sentrylake import queries as Q
from sentrylake import run_queries, time_queries  # noqa: F401  register their queries beside the others


def tables(spark, tmp_path, sf_dir, **made):
    """A folder with the tables of ``sf_dir``, but for those given."""
    folder = tmp_path / "tables"
    folder.mkdir()
    for p in Path(sf_dir).glob("*.parquet"):
        if p.stem not in made:
            (folder / p.name).symlink_to(p)
    for name, rows in made.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_late_change_that_is_older_replaces_nothing(spark, tmp_path, sf_dir):
    day = lambda n: datetime(2024, 1, n)
    rows = [(1, 7, 2, "U", day(1), "retail", "A"), (2, 7, 1, "U", day(1), "public", "B"), (3, 7, 5, "U", day(3), "public", "C"), (4, 7, 4, "D", day(3), None, None), (5, 7, 3, "U", day(5), "retail", "D"), (6, 7, None, "I", day(5), "retail", "E"), (7, 8, 4, "I", day(2), "retail", "F"), (8, 8, 4, "I", day(2), "retail", "G")]
    changes = spark.createDataFrame(rows, "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, segment string, city string")
    folder = tables(spark, tmp_path, sf_dir, client_changes=changes)
    same(Q.QUERIES["client_history_late"](spark, folder), Q.ORACLE_SQL["client_history_late"], folder)


def test_rejected_records_that_differ_in_their_key_alone_all_stay(spark, tmp_path, sf_dir):
    orders = spark.createDataFrame([(k, 3, "F", 10.5, datetime(1999, 5, 2), "5-LOW") for k in (21210, 42420, 5)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    folder = tables(spark, tmp_path, sf_dir, orders=orders)
    assert Q.QUERIES["quarantine_insert_only"](spark, folder).count() == 2
    same(Q.QUERIES["quarantine_insert_only"](spark, folder), Q.ORACLE_SQL["quarantine_insert_only"], folder)


def test_a_catalog_is_cut_into_files_that_any_task_can_read(spark, tmp_path, sf_dir, monkeypatch):
    from sentrylake import run_queries as R
    from sentrylake.sources import synthetic

    monkeypatch.setattr(R, "PAGE", 20)
    R._write_catalogs(synthetic.kev_feed(spark, sf_dir), str(tmp_path / "c"))
    files = [p for p in (tmp_path / "c" / "catalog_1.json").glob("part-*.txt") if p.stat().st_size]
    assert len(files) > 5 and all(p.read_text().count('"catalogVersion"') == 1 for p in files)
    same(R.catalog_files(spark, sf_dir), Q.ORACLE_SQL["catalog_files"], sf_dir)


def rendered_feeds(monkeypatch):
    """How often a feed of records is asked for."""
    asked, real = [], Q.synthetic.cve_feed
    monkeypatch.setattr(Q.synthetic, "cve_feed", lambda *a, **k: asked.append(a) or real(*a, **k))
    return asked


def test_queries_of_several_tables_render_and_parse_the_feed_once(spark, sf_dir, monkeypatch):
    asked = rendered_feeds(monkeypatch)
    for name in ("quarantine_by_reason", "report_top_exploited_cwes", "fk_check", "fact_cve_counts"):
        asked.clear()
        plan = Q.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert len(asked) == 1 and "from_json" not in plan, name


def test_scalars_of_a_record_are_read_in_one_pass(spark, sf_dir):
    plan = Q.cves(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and plan.count("json_tuple(") == 2  # capture and typing


def test_maintained_months_parse_the_feed_once(spark, sf_dir, monkeypatch):
    made, real = [], Q.parsed_records
    monkeypatch.setattr(Q, "parsed_records", lambda *a, **k: made.append(a) or real(*a, **k))
    same(Q.QUERIES["maintained_months"](spark, sf_dir), Q.ORACLE_SQL["maintained_months"], sf_dir)
    assert len(made) == 1


def test_intervals_are_counted_per_owner_without_moving_hits(spark):
    from sentrylake.operators import ranges

    points = spark.createDataFrame([("a", "1", 2), ("a", "3", 1), ("a", "5", 7), ("b", "3", 4), (None, "3", 1), ("b", None, 1)], "p string, v string, n long")
    rows = [("x", "a", "1", "3", False, True), ("x", "a", "1", "3", False, True), ("x", "a", None, None, None, None), ("y", "a", "3", "5", True, False), ("y", "b", "3", "3", False, False), ("z", "a", "5", "1", False, False), ("z", None, None, None, False, False)]
    intervals = spark.createDataFrame(rows, "id string, p string, low string, high string, lo boolean, ho boolean")
    found = ranges.counted(points, intervals, ["p"], "id", "v", "low", "high", "lo", "ho")
    dealt = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and all("_share" in line for line in dealt)  # nothing is dealt by owner or point
    assert sorted(tuple(r) for r in found.collect()) == [("x", "a", "1", 2, 3, 2), ("x", "a", "3", 1, 1, 1), ("x", "a", "5", 7, 1, 1), ("y", "a", "5", 7, 1, 1), ("y", "b", "3", 4, 1, 1)]


def test_a_feed_that_is_landed_in_batches_is_rendered_once(spark, sf_dir, monkeypatch):
    from sentrylake import run_queries as R

    texts, real = [], R._write_pages
    monkeypatch.setattr(R, "_write_pages", lambda feed, folder: texts.append(feed._jdf.queryExecution().optimizedPlan().toString()) or real(feed, folder))
    same(R.landed_batches(spark, sf_dir), Q.ORACLE_SQL["landed_batches"], sf_dir)
    assert len(texts) == 2 and not any("to_json" in t for t in texts)


def test_a_table_types_no_part_of_a_record_that_it_is_not_made_of(spark, sf_dir):
    typed = lambda df: next(line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "from_json" in line)
    assert "criteria" in typed(Q.products(spark, sf_dir)) and "descriptions" not in typed(Q.products(spark, sf_dir))
    assert "weaknesses" in typed(Q.weaknesses(spark, sf_dir)) and "criteria" not in typed(Q.weaknesses(spark, sf_dir))


def test_odd_names_and_scores_come_through_the_feed(spark, tmp_path, sf_dir):
    orders = spark.createDataFrame([(k, 3, "F", price, datetime(1999, 5, 2), "5-LOW") for k, price in ((1, 10.5), (2, None), (11, 10.5), (22, 99.0))], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    names = ['a "quoted" name', "back\\slash", "tab\there", "\u00e9t\u00e9"]
    parts = spark.createDataFrame([(n, name) for n, name in enumerate(names, 1)], "p_partkey long, p_name string")
    lines = spark.createDataFrame([(1, n, n, 7, "N" if n != 2 else "R") for n in range(1, 5)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string")
    folder = tables(spark, tmp_path, sf_dir, orders=orders, part=parts, lineitem=lines)
    found = {r["product"] for r in Q.products(spark, folder).collect()}
    assert found == {'a_"quoted"_name', "backslash", "tab\there", "\u00e9t\u00e9"}  # a backslash escapes in a criterion
    assert {r["cvss_v3_score"] for r in Q.cves(spark, folder).collect()} == {1.0, None, 9.9}


def test_rows_of_a_bridge_are_dealt_once(spark, sf_dir):
    b = Q.star.bridge(spark.range(100).selectExpr("cast(id % 9 as string) AS cve_id", "id % 7 AS n"), ["n"], spark.range(9).selectExpr("cast(id as string) AS cve_id").repartition("cve_id").hint("merge"))
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert b.count() == 63 and plan.count("Exchange hashpartitioning(cve_id") == 2 and "cve_id, n" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_pages_are_written_packed_and_none_is_held_as_a_whole(spark, tmp_path, sf_dir, monkeypatch):
    import gzip
    import json

    from sentrylake import run_queries as R
    from sentrylake.sources import feeds, synthetic

    monkeypatch.setattr(R, "PAGE", 20)
    feed = synthetic.cve_feed(spark, sf_dir, children=False)
    R._write_pages(feed, str(tmp_path / "p"))
    R._write_pages(feed.limit(0), str(tmp_path / "none"))
    pages = [json.loads(gzip.open(f).read())["vulnerabilities"] for f in (tmp_path / "p").glob("page_n=*/*.txt.gz")]
    assert len(pages) > 5 and sorted(json.dumps(r["cve"], sort_keys=True) for p in pages for r in p) == sorted(json.dumps(json.loads(r[1]), sort_keys=True) for r in feed.collect())
    read = feeds.cve_texts(feeds.cve_pages(spark, f"{tmp_path}/p/page_*.json"))
    assert sorted(r[0] for r in read.collect()) == sorted(r[1] for r in feed.collect())
