"""Queries that write files and tables into the shared folder and work on those: feed files, landing folders, marks, runs and the store.

They register themselves beside those of ``queries``.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas as S
from .functions.clock import as_utc, parse_utc
from .operators import capture, quality
from .operators import upsert as U
from .plans import drills, reports, watermark
from .plans import setup as plans_setup
from .plans.params import BronzeRun
from .plans.run import Warehouse
from .plans.scratch import scratch_folder, stored
from .plans.store import TableStore
from .queries import _event_log, facts, query, shown, table
from .sources import acquire, feeds, landing, synthetic

NOW = datetime(2024, 3, 1, 12, tzinfo=UTC)
#: Records of a page of the service.
PAGE = 2000


def _text(moment: datetime | None) -> str | None:
    return None if moment is None else f"{as_utc(moment):%Y-%m-%d %H:%M:%S}"


def _write_pages(feed: DataFrame, folder: str) -> None:
    """The records as pages of some PAGE records, each a folder page_<n>.json that holds one JSON document, packed."""
    n = max(1, -(-feed.count() // PAGE))
    place = F.xxhash64("raw_json")
    rows = feed.select(F.format_string("%05d.json", F.pmod(place, F.lit(n))).alias("page_n"), place.alias("place"), "raw_json")
    # A page is written line by line as its records come; none is held as a whole.
    by = Window.partitionBy("page_n").orderBy("place")
    head, tail = F.when(F.row_number().over(by) == 1, '{"resultsPerPage":2000,"vulnerabilities":[').otherwise(","), F.when(F.lead(F.lit(1)).over(by).isNull(), "]}").otherwise("")
    pages = rows.select("page_n", F.concat(head, F.lit('{"cve":'), "raw_json", F.lit("}"), tail).alias("value"))
    pages.write.partitionBy("page_n").option("compression", "gzip").text(folder)


def _write_catalogs(feed: DataFrame, folder: str) -> None:
    """A catalog for each of the two sendings: a folder of files with some PAGE entries, each a JSON document with the catalog's head."""
    for v in (1, 2):
        sent = feed.where(F.col("v") == v)
        n = max(1, -(-sent.count() // PAGE))
        part = F.pmod(F.xxhash64("raw_json"), F.lit(n)).alias("part")
        entries = sent.groupBy("catalog_version", "date_released", part).agg(F.array_join(F.collect_list("raw_json"), ",").alias("entries"))
        head = [F.lit('{"catalogVersion":"'), "catalog_version", F.lit('","dateReleased":"'), "date_released", F.lit('","vulnerabilities":['), "entries", F.lit("]}")]
        entries.select(F.concat(*head).alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/catalog_{v}.json")


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# Files.
@query("SELECT cve_id, count(*) AS n FROM r GROUP BY 1")
def page_files(spark, sf_dir):
    folder = scratch_folder(spark, "pages")
    _write_pages(synthetic.cve_feed(spark, sf_dir, children=False), folder)
    texts = feeds.cve_texts(feeds.cve_pages(spark, f"{folder}/page_*.json"))
    return texts.groupBy(F.get_json_object("raw_json", "$.id").alias("cve_id")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT cve_id, CASE v WHEN 1 THEN '2024.01.01' ELSE '2024.02.01' END AS catalog_version, '2024-02-01T00:00:00Z' AS date_released, count(*) AS n FROM r WHERE o_orderpriority = '1-URGENT' GROUP BY ALL")
def catalog_files(spark, sf_dir):
    folder = scratch_folder(spark, "catalogs")
    _write_catalogs(synthetic.kev_feed(spark, sf_dir), folder)
    rows = capture.bronze_kev(feeds.kev_texts(feeds.kev_catalog(spark, f"{folder}/catalog_*.json")), source_uri=folder, load_type="FULL", batch_id="b", loaded=NOW)
    return rows.groupBy("cve_id", "catalog_version", "date_released").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 0::BIGINT AS rows, 8 AS columns", prelude=False)
def empty_window(spark, sf_dir):
    """What a batch without a record captures: no rows, in all of bronze's columns."""
    texts = feeds.no_rows(spark, feeds.cve_texts(feeds.no_rows(spark, feeds.CVE_PAGE)).schema)
    rows = capture.bronze_cves(texts, source_uri="none", load_type="INCREMENTAL", batch_id="b", loaded=NOW)
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(rows.columns)))


@query("SELECT 4500::BIGINT AS records, 4500::BIGINT AS ids, 4 AS pages, 5 AS requests, 4500 AS announced", prelude=False)
def fetched_pages(spark, sf_dir):
    """4,500 records of a service that fails at first, over two windows of which the second is empty, as files that are read back."""
    asked: list[str] = []

    def service(url: str, key: str | None) -> dict:
        asked.append(url)
        if len(asked) == 1:
            raise TimeoutError("try again")
        at = int(url.split("startIndex=")[1])
        held = range(at, min(at + 1200, 4500)) if "lastModStartDate=2024-01-01" in url else ()
        return {"totalResults": 4500 if held else 0, "vulnerabilities": [{"cve": {"id": f"CVE-2024-{n:05d}"}} for n in held]}

    folder = scratch_folder(spark, "fetched")
    start = datetime(2024, 1, 1, tzinfo=UTC)
    got = acquire.fetch_pages(start, start + timedelta(days=150), folder.removeprefix("file:"), fetch=service, sleep=lambda _: None, size=1200)
    texts = feeds.cve_texts(feeds.cve_pages(spark, f"{folder}/page_*.json"))
    rows = texts.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("raw_json").alias("ids"))
    return rows.withColumns({"pages": F.lit(got.pages), "requests": F.lit(got.requests), "announced": F.lit(got.total_results)})


# Windows and marks.
@query("""SELECT k::INT AS window_number, strftime(s, '%Y-%m-%dT%H:%M:%S.000') AS first_second, strftime(least(s + INTERVAL 120 DAY, TIMESTAMP '2024-12-31 18:00:00'), '%Y-%m-%dT%H:%M:%S.000') AS last_second,
  'https://services.nvd.nist.gov/rest/json/cves/2.0?lastModStartDate=' || replace(strftime(s, '%Y-%m-%dT%H:%M:%S.000'), ':', '%3A') || '&lastModEndDate=' || replace(strftime(least(s + INTERVAL 120 DAY, TIMESTAMP '2024-12-31 18:00:00'), '%Y-%m-%dT%H:%M:%S.000'), ':', '%3A')
  || '&resultsPerPage=2000&startIndex=' || 2000 * k AS page_url FROM (SELECT k, TIMESTAMP '2023-06-01 06:30:00' + k * INTERVAL 120 DAY AS s FROM range(5) AS t(k))""", prelude=False)
def service_windows(spark, sf_dir):
    found = list(acquire.windows(parse_utc("2023-06-01T06:30:00Z"), parse_utc("2024-12-31T18:00:00")))
    rows = [(k, acquire.service_time(a), acquire.service_time(b), acquire.page_url(a, b, 2000 * k)) for k, (a, b) in enumerate(found)]
    return _values(spark, rows, "window_number int, first_second string, last_second string, page_url string")


@query("""SELECT * FROM (VALUES ('neither', 'INCREMENTAL', '2024-02-29 12:00:00', '2024-03-01 12:00:00'), ('hours', 'INCREMENTAL', '2024-03-01 06:00:00', '2024-03-01 12:00:00'), ('start', 'INCREMENTAL', '2024-02-01 00:00:00', '2024-03-01 12:00:00'),
  ('both', 'BACKFILL', '2024-02-01 00:00:00', '2024-02-03 00:00:00'), ('end', 'ERROR', NULL, NULL), ('empty', 'ERROR', NULL, NULL), ('marked', 'MARK', '2024-03-01 08:50:00', '2024-03-01 12:00:00'), ('seeded', 'MARK', '2024-01-01 00:00:00', '2024-03-01 12:00:00'),
  ('first', 'MARK', '2024-02-29 12:00:00', '2024-03-01 12:00:00')) AS t(given, load_type, first_second, last_second)""", prelude=False)
def resolved_windows(spark, sf_dir):
    rows = []
    for name, start, end, hours in (("neither", None, None, None), ("hours", None, None, 6), ("start", "2024-02-01", None, None), ("both", "2024-02-01", "2024-02-03", None), ("end", None, "2024-02-03", None), ("empty", "2024-02-03", "2024-02-03", None)):
        try:
            kind, first, last = landing.resolve_window(start, end, hours, NOW)
            rows.append((name, kind, _text(first), _text(last)))
        except ValueError:
            rows.append((name, "ERROR", None, None))
    for name, mark, seed in (("marked", NOW - timedelta(hours=3), None), ("seeded", None, datetime(2024, 1, 1, tzinfo=UTC)), ("first", None, None)):
        rows.append((name, "MARK", *map(_text, watermark.next_window(mark, NOW, seed))))
    return _values(spark, rows, "given string, load_type string, first_second string, last_second string")


@query("SELECT event_type AS source, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS mark FROM events GROUP BY 1 UNION ALL SELECT 'none', NULL", prelude=False)
def current_marks(spark, sf_dir):
    """The mark of each source in a history of marks, read as a run reads it."""
    history = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("watermark_ts"))
    none = spark.range(1).select(F.lit("none").alias("source"), F.lit(None).cast("timestamp").alias("watermark_ts"))
    return watermark.all_current(history.unionByName(none)).select("source", F.date_format("watermark_ts", "yyyy-MM-dd HH:mm:ss").alias("mark"))


@query("""SELECT 'FULL' AS load, count(*) FILTER (WHERE v = 1) AS rows, NULL AS mark, NULL AS gap_hours FROM r WHERE modified IS NOT NULL
  UNION ALL SELECT 'INCREMENTAL', count(*), strftime(max(modified), '%Y-%m-%d 06:30:00'), NULL FROM r WHERE v = 2 AND modified IS NOT NULL
  UNION ALL SELECT 'EMPTY', 0, '2031-01-01 02:00:00', date_diff('second', max(modified) + INTERVAL '6 hours 30 minutes', TIMESTAMP '2031-01-01 01:00:00') / 3600.0::DOUBLE FROM r WHERE v = 2 AND modified IS NOT NULL
  UNION ALL SELECT 'BACKFILL', count(*) FILTER (WHERE v = 1), '2031-01-01 02:00:00', NULL FROM r WHERE modified IS NOT NULL""")
def landed_batches(spark, sf_dir):
    """A full load, an incremental one, an empty one behind a gap and a backfill, from landing folders with manifests: rows, and the mark after each."""
    folder = scratch_folder(spark, "landing")
    w = Warehouse(spark, f"{folder}/w", clock=lambda: NOW)
    feed = stored(synthetic.cve_feed(spark, sf_dir, children=False).where(~F.contains("raw_json", F.lit('"soon"'))), "feed")
    for v in (1, 2):
        _write_pages(feed.where(F.col("v") == v), f"{folder}/{v}")
    span = {"window_start": "2031-01-01T01:00:00Z", "window_end": "2031-01-01T02:00:00Z"}
    rows = []
    for load, source, manifest in (("FULL", "1", None), ("INCREMENTAL", "2", {"window_start": "1990-01-01", "window_end": "2000-01-01"}), ("EMPTY", "3", {"records": 0, **span}), ("BACKFILL", "1", span)):
        path = f"{folder}/{source}"
        if manifest is not None:
            landing.write_manifest(path, spark, batch_id=f"b-{load}", **manifest)
        got = w.load_cves(BronzeRun(load if load != "EMPTY" else "INCREMENTAL", path if manifest is not None else f"{path}/page_*.json"))
        gap = got["gap"].total_seconds() / 3600 if got["gap"] else None
        rows.append((load, got["rows"], _text(w.mark("nvd")), gap))
    return _values(spark, rows, "load string, rows long, mark string, gap_hours double")


@query("""SELECT 'silver_cve' AS table_name, (SELECT count(*) FROM cve) AS rows, 0::BIGINT AS changed_again UNION ALL SELECT 'silver_kev', (SELECT count(*) FROM kev), 0 UNION ALL SELECT 'silver_affected_product', (SELECT count(*) FROM prod), 0
  UNION ALL SELECT 'silver_cwe', (SELECT count(*) FROM cwe), 0 UNION ALL SELECT 'dim_cve', (SELECT count(*) FROM cve), 0 UNION ALL SELECT 'fact_cve', (SELECT count(*) FROM fact), 0
  UNION ALL SELECT 'dim_vendor_product', (SELECT count(*) FROM (SELECT DISTINCT fv, fp FROM prod WHERE vulnerable)), 0 UNION ALL SELECT 'fact_cve_product', (SELECT count(*) FROM bp), 0
  UNION ALL SELECT 'dim_cwe', (SELECT count(DISTINCT cwe_key) FROM cwe), 0 UNION ALL SELECT 'fact_cve_cwe', (SELECT count(*) FROM bc), 0 UNION ALL SELECT 'gold_mark_moved', 1, 0""")
def warehouse_runs(spark, sf_dir):
    """Feeds to gold in a store: the first sending in full, the second as an increment, then everything once more. Rows of each table, and what the last run changed."""
    folder = scratch_folder(spark, "warehouse")
    ticks = iter(range(10_000))
    w = Warehouse(spark, f"{folder}/w", clock=lambda: NOW + timedelta(seconds=next(ticks)))
    feed, kev = stored(synthetic.cve_feed(spark, sf_dir), "feed"), synthetic.kev_feed(spark, sf_dir)
    _write_catalogs(kev, folder)
    for v, batch in ((1, synthetic.FIRST), (2, synthetic.SECOND)):
        _write_pages(feed.where(F.col("v") == v), f"{folder}/{v}")
        w.load_cves(BronzeRun("FULL", f"{folder}/{v}/page_*.json", batch_id=batch))
        w.load_kev(BronzeRun("FULL", f"{folder}/catalog_{v}.json", batch_id=batch))
        w.refine()
        w.build()
    mark = w.mark(watermark.GOLD)
    again = w.refine() | w.build("full")
    names = ("silver_cve", "silver_kev", "silver_affected_product", "silver_cwe", "dim_cve", "fact_cve", "dim_vendor_product", "fact_cve_product", "dim_cwe", "fact_cve_cwe")
    rows = [(n, w.table(n).count(), again[n]["inserted"] + again[n]["updated"]) for n in names]
    return _values(spark, [*rows, ("gold_mark_moved", int(mark is not None), 0)], "table_name string, rows long, changed_again long")


@query("""SELECT * FROM (VALUES ('inserted', '1'), ('updated', '1'), ('quarantined', '2'), ('unknown_keys', 'unheardOf'), ('drill-dateless', 'unparseable_published'), ('drill-nameless', 'missing_cve_id'), ('drill-later', 'CVE'), ('drill-drifted', 'score'), ('real tables changed', '0')) AS t(step, outcome)""", prelude=False)
def failure_drills(spark, sf_dir):
    """One record sent again in four altered forms, on copies of the silver tables."""
    folder = scratch_folder(spark, "drills")
    ticks = iter(range(10_000))
    w = Warehouse(spark, f"{folder}/w", clock=lambda: NOW + timedelta(seconds=next(ticks)))
    _write_pages(synthetic.cve_feed(spark, sf_dir, children=False).where("v = 1 and raw_json not like '%brandNewField%'"), f"{folder}/pages")
    w.load_cves(BronzeRun("FULL", f"{folder}/pages/page_*.json"))
    w.refine()
    before = {n: w.store.version(n) for n in drills.COPIES}
    done = drills.run(spark, w, NOW)
    rows = [(k, ",".join(v) if isinstance(v, list) else str(v)) for k, v in done.items()]
    rows += [(r["batch_id"], r["reason"]) for r in w.table("drill_silver_quarantine").where(F.col("batch_id").startswith("drill")).collect()]
    for r in w.table("drill_silver_cve").where(F.col("batch_id").startswith("drill")).collect():
        rows.append((r["batch_id"], r["cve_id"][:3] if r["batch_id"] == drills.LATER else "score" if r["cvss_v3_score"] is not None else "none"))
    return _values(spark, [*rows, ("real tables changed", str(sum(w.store.version(n) != v for n, v in before.items())))], "step string, outcome string")


@query("SELECT * FROM (VALUES ('trial_bronze', true), ('trial_control', true), ('trial_gold', true), ('trial_silver', true)) AS t(database_name, there)", prelude=False)
def layers_set_up(spark, sf_dir):
    folder = scratch_folder(spark, "setup")
    names = plans_setup.set_up(spark, f"{folder}/landing", "trial_")
    again = plans_setup.set_up(spark, f"{folder}/landing", "trial_")
    found = [(n, n in again and spark.catalog.databaseExists(n)) for n in names]
    for n in names:
        spark.sql(f"DROP DATABASE `{n}`")
    return _values(spark, found, "database_name string, there boolean")


# The store.
@query("""WITH a AS (SELECT o_orderkey AS k, 1 AS last_modified_at, o_custkey AS x FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS last_modified_at, -1 AS x FROM orders WHERE o_orderkey % 5 = 0),
  u AS (SELECT b.*, a.k IS NULL AS fresh FROM b LEFT JOIN a ON a.k = b.k WHERE a.k IS NULL OR b.last_modified_at > 1)
  SELECT 'inserted' AS step, count(*) FILTER (WHERE fresh) AS n FROM u UNION ALL SELECT 'updated', count(*) FILTER (WHERE NOT fresh) FROM u UNION ALL SELECT 'written', count(*) FROM u
  UNION ALL SELECT 'rows', (SELECT count(*) FROM a) + (SELECT count(*) FROM u WHERE fresh) UNION ALL SELECT 'sum', (SELECT sum(x) FROM a WHERE k NOT IN (SELECT k FROM u)) + (SELECT sum(x) FROM u)
  UNION ALL SELECT 'trial', (SELECT count(*) FROM a) UNION ALL SELECT 'folded', 3 UNION ALL SELECT 'vacuumed', 2 UNION ALL SELECT 'after', (SELECT sum(x) FROM a WHERE k NOT IN (SELECT k FROM u)) + (SELECT sum(x) FROM u)""", prelude=False)
def store_lifecycle(spark, sf_dir):
    """A keyed table through swap, trial copy, upsert, compaction and vacuum."""
    store = TableStore(spark, scratch_folder(spark, "store"))
    o = table(spark, sf_dir, "orders")
    schema = S.ddl("k bigint!, last_modified_at int, x bigint")
    key, x = F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("long").alias("x")
    store.create("t", schema, ["k"], ["x"])
    store.swap(o.where("o_orderkey % 3 <> 0").select(key, F.lit(1).alias("last_modified_at"), x), "t")
    store.copy("t", "trial")
    whole = store.parts("t")
    change = o.where("o_orderkey % 5 = 0").select(key, F.when(F.col("o_orderkey") % 2 == 0, 2).otherwise(1).alias("last_modified_at"), F.lit(-1).cast("long").alias("x"))
    done = store.upsert(change, "t", U.newer)
    written = sum(spark.read.parquet(p).count() for p in store.parts("t") if p not in whole)
    sums = lambda: tuple(store.read("t").agg(F.count(F.lit(1)), F.sum("x")).first())
    rows, total = sums()
    folded = store.compact("t")
    out = [("inserted", done["inserted"]), ("updated", done["updated"]), ("written", written), ("rows", rows), ("sum", total), ("trial", store.read("trial").count()), ("folded", folded["before"]), ("vacuumed", store.vacuum("t")), ("after", sums()[1])]
    return _values(spark, out, "step string, n long")


# Single operators that no other query shows.
@query("SELECT sha256(sha256(event_id::VARCHAR) || '|' || event_type) AS payload_sha256, event_id FROM events", prelude=False)
def child_hashes(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.sha2(F.col("event_id").cast("string"), 256).alias("payload_sha256"), F.col("event_type").alias("raw_json"))
    return quality.child_hash(e).select("payload_sha256", "event_id")


@query("SELECT count(DISTINCT user_id) AS runs, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS failed_runs, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_finished, strftime(max(ts) FILTER (WHERE event_type = 'click'), '%Y-%m-%d %H:%M:%S') AS last_watermark, count(*) FILTER (WHERE event_id % 7 = 0) AS quarantined FROM events", prelude=False)
def report_operations(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    marks = e.where("event_type = 'click'").select(F.col("ts").cast("timestamp").alias("watermark_ts"))
    return reports.operations(_event_log(spark, sf_dir), marks, e.where("event_id % 7 = 0")).withColumns({"last_finished": F.date_format("last_finished", "yyyy-MM-dd HH:mm:ss"), "last_watermark": F.date_format("last_watermark", "yyyy-MM-dd HH:mm:ss")})


@query("SELECT true AS within_a_day, count(days) > 0 AS known FROM fact")
def median_tolerance(spark, sf_dir):
    """The approximate median of days against the exact one."""
    f = facts(spark, sf_dir)
    exact, near = F.median("days_to_kev"), F.percentile_approx("days_to_kev", 0.5)
    return f.agg((F.abs(exact - near) <= 1).alias("within_a_day"), (F.count("days_to_kev") > 0).alias("known"))


@query("SELECT a.k AS o_orderkey, a.v AS first_sent, b.v AS later_sent FROM s AS a JOIN s AS b ON a.k = b.k WHERE a.v < b.v AND a.tenths <> b.tenths")
def resent_changes(spark, sf_dir):
    """A self-join under two names with an inequality: records whose score changed from one sending to the next."""
    o = synthetic.orders(spark, sf_dir).select("k", "v", "tenths")
    a, b = o.alias("a"), o.alias("b")
    both = a.join(b, F.col("a.k") == F.col("b.k")).where((F.col("a.v") < F.col("b.v")) & (F.col("a.tenths") != F.col("b.tenths")))
    return both.select(F.col("a.k").alias("o_orderkey"), F.col("a.v").alias("first_sent"), F.col("b.v").alias("later_sent"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') OR starts_with(o_orderpriority, '3') GROUP BY 1", prelude=False)
def named_or_prefixed(spark, sf_dir):
    p = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").where(p.isin("1-URGENT", "5-LOW") | p.startswith("3")).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_load FROM events WHERE event_type IN ('click', 'view')", prelude=False)
def last_load(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("load_timestamp", F.col("ts").cast("timestamp"))
    found = watermark.latest_load([e.where("event_type = 'click'"), e.where("event_type = 'view'")])
    return _values(spark, [(_text(found),)], "last_load string")
