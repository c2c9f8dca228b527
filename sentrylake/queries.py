"""The engine's queries over the test tables, each with the SQL that computes the same from the tables directly.

The tables are rendered into feed texts (sources.synthetic); the engine reads those texts. The SQL never sees them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import UTC, date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import keys as K
from .functions.clock import feed_instant, instant
from .operators import capture, dedup, quality, shape, star
from .operators import upsert as U
from .plans import audit, model, reports, watermark
from .plans.params import SilverRun
from .plans.scratch import stored
from .schemas import CVE_RECORD
from .sources import feeds, synthetic

LOADED = datetime(2024, 3, 1, tzinfo=UTC)
AS_OF = date(2001, 6, 1)
RUN = "20240301T000000Z-00000003"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# CTEs that the SQL below builds on: s (sendings), r (records), cve and kev (silver), newest, prod and cwe (children).
PRELUDE = r"""
WITH s AS (SELECT o_orderkey AS k, v, o_orderdate::DATE AS day, o_custkey, o_orderstatus, o_orderpriority,
             ((floor(o_totalprice)::BIGINT + v - 1) % 101)::INT AS tenths
           FROM orders, (VALUES (1), (2)) AS t(v) WHERE v = 1 OR o_orderkey % 5 = 0),
r AS (SELECT *, CASE WHEN k % 101 = 0 THEN NULL WHEN k % 97 = 0 THEN 'CVE-BAD-' || k
                ELSE 'CVE-' || year(day) || '-' || lpad(k::VARCHAR, 7, '0') END AS cve_id,
        k % 101 <> 0 AND k % 97 <> 0 AS good_id,
        CASE WHEN k % 89 <> 0 THEN day END AS published,
        CASE WHEN NOT (k % 79 = 0 AND v = 2) THEN day + (k % 30 + (v - 1) * 60)::INT END AS modified,
        CASE WHEN k % 7 <> 0 THEN tenths / 10.0::DOUBLE END AS score,
        CASE WHEN k % 7 <> 0 AND k % 3 <> 0 THEN CASE WHEN tenths >= 90 THEN 'CRITICAL' WHEN tenths >= 70 THEN 'HIGH'
             WHEN tenths >= 40 THEN 'MEDIUM' WHEN tenths > 0 THEN 'LOW' ELSE 'NONE' END END AS severity,
        CASE WHEN k % 7 = 0 THEN 6 WHEN tenths >= 90 THEN 1 WHEN tenths >= 70 THEN 2 WHEN tenths >= 40 THEN 3 WHEN tenths > 0 THEN 4 ELSE 5 END AS severity_key,
        CASE WHEN k % 83 <> 0 THEN day + (o_custkey % 400)::INT END AS added,
        CASE WHEN k % 23 <> 0 THEN day + (o_custkey % 400)::INT + 21 END AS due,
        CASE WHEN k % 19 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Known' ELSE 'Unknown' END AS ransom
      FROM s),
cve AS (SELECT * FROM r WHERE good_id AND published IS NOT NULL AND modified IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY modified DESC, v DESC) = 1),
newest AS (SELECT * FROM r WHERE good_id QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY modified DESC NULLS LAST, v DESC) = 1),
kev AS (SELECT * FROM r WHERE o_orderpriority = '1-URGENT' AND good_id AND added IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY v DESC) = 1),
item AS (SELECT cve_id, modified, substr('aoh', (l_partkey % 3 + 1)::INT, 1) AS part, CASE WHEN l_partkey % 83 = 0 THEN '*' ELSE 'Supplier_' || (l_suppkey % 40) END AS vendor,
           CASE WHEN l_partkey % 71 = 0 THEN 'foo:' ELSE '' END || replace(p_name, ' ', '_') AS product, l_linenumber::VARCHAR AS version, l_returnflag <> 'R' AS vulnerable,
           CASE WHEN l_partkey % 2 = 0 THEN l_suppkey::VARCHAR END AS bound, l_partkey % 83 <> 0 AS good_item, l_suppkey % 5 = 1 AS foreign_text, l_partkey, l_suppkey, l_linenumber
         FROM newest JOIN lineitem ON l_orderkey = k JOIN part ON l_partkey = p_partkey),
prod AS (SELECT *, lower(trim(vendor)) AS fv, lower(trim(product)) AS fp FROM item WHERE good_item
         QUALIFY row_number() OVER (PARTITION BY cve_id, part, vendor, product, version ORDER BY vulnerable DESC, bound DESC NULLS LAST) = 1),
named AS (SELECT cve_id, modified, CASE WHEN l_partkey % 29 = 0 THEN 'NVD-CWE-noinfo' WHEN l_partkey % 31 = 0 THEN 'NVD-CWE-Other' WHEN l_partkey % 37 = 0 THEN 'Use after free'
           ELSE 'CWE-' || (l_partkey % 50 + 1) END AS cwe_id FROM item WHERE NOT foreign_text),
cwe AS (SELECT DISTINCT cve_id, modified, cwe_id, CASE cwe_id WHEN 'NVD-CWE-noinfo' THEN -1 WHEN 'NVD-CWE-Other' THEN -2 ELSE substr(cwe_id, 5)::INT END AS cwe_key
        FROM named WHERE cwe_id <> 'Use after free'),
pcount AS (SELECT p.cve_id, count(*)::INT AS n FROM (SELECT DISTINCT cve_id, fv, fp FROM prod WHERE vulnerable) AS p JOIN cve ON p.cve_id = cve.cve_id GROUP BY 1),
ccount AS (SELECT c.cve_id, count(*)::INT AS n FROM cwe AS c JOIN cve ON c.cve_id = cve.cve_id GROUP BY 1),
fact AS (SELECT c.*, k.cve_id IS NOT NULL AS listed, k.added AS k_added, k.due AS k_due, k.ransom AS k_ransom, k.v AS k_v, k.o_custkey AS k_cust, k.k AS k_k,
           strftime(c.published, '%Y%m%d')::INT AS published_key, (k.added - c.published)::INT AS days, p.n AS products, w.n AS cwes
         FROM cve AS c LEFT JOIN kev AS k ON c.cve_id = k.cve_id LEFT JOIN pcount AS p ON c.cve_id = p.cve_id LEFT JOIN ccount AS w ON c.cve_id = w.cve_id),
bp AS (SELECT DISTINCT p.cve_id, p.fv AS vendor, p.fp AS product, f.published_key, f.severity_key, f.listed, f.score FROM prod AS p JOIN fact AS f ON p.cve_id = f.cve_id WHERE p.vulnerable),
bc AS (SELECT DISTINCT w.cve_id, w.cwe_id, w.cwe_key, f.published_key, f.severity_key, f.listed, f.score FROM cwe AS w JOIN fact AS f ON w.cve_id = f.cve_id)
"""


def query(sql: str | None, prelude: bool = True):
    """Registers a query under its function's name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = (PRELUDE if prelude else "") + sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shown(column: str):
    """An instant as text."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# The engine's tables, over the rendered feeds.
def _of_sending(first, second) -> Column:
    return F.when(F.col("v") == 1, first).otherwise(second)


def _sent_as() -> dict:
    """Batch and load time of each sending."""
    return {"batch_id": _of_sending(synthetic.FIRST, synthetic.SECOND), "loaded": _of_sending(*(instant(LOADED + timedelta(days=v)) for v in (1, 2)))}


def bronze(spark: SparkSession, sf_dir: str, children: bool = True) -> DataFrame:
    """Both sendings in one pass over the feed."""
    return capture.bronze_cves(synthetic.cve_feed(spark, sf_dir, children), source_uri="feed", load_type=_of_sending("FULL", "INCREMENTAL"), **_sent_as())


def bronze_kev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.bronze_kev(synthetic.kev_feed(spark, sf_dir), source_uri="feed", load_type="FULL", **_sent_as())


#: The nested fields of a record that each silver table is made of.
PARTS = {"cves": ("descriptions", "metrics"), "products": ("configurations",), "weaknesses": ("weaknesses",)}


def cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.silver_cves(shape.parsed(bronze(spark, sf_dir, children=False), PARTS["cves"]), LOADED)[0]


def kev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.silver_kev(bronze_kev(spark, sf_dir), LOADED)[0]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.silver_products(shape.parsed(bronze(spark, sf_dir), PARTS["products"]), LOADED)[0]


def weaknesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.silver_cwes(shape.parsed(bronze(spark, sf_dir), PARTS["weaknesses"]), LOADED)[0]


def silver(spark: SparkSession, sf_dir: str, *names: str, once: Iterable[str] = ()) -> dict[str, DataFrame]:
    """The named tables (cves, kev, products, weaknesses) for a query that reads several, or one more than once.

    The feed is rendered and parsed once for all of them, and each table is made once and stored, without its hashes. once: tables that the query
    reads a single time, which need not be stored.
    """
    made = parsed_records(spark, sf_dir, parts=[p for n in names for p in PARTS.get(n, ())])
    build = {"cves": lambda: shape.silver_cves(made, LOADED)[0], "kev": lambda: kev(spark, sf_dir), "products": lambda: shape.silver_products(made, LOADED)[0], "weaknesses": lambda: shape.silver_cwes(made, LOADED)[0]}
    tables = {n: build[n]().drop("payload_sha256") for n in names}
    return {n: t if n in once else stored(t, n) for n, t in tables.items()}


def parsed_records(spark: SparkSession, sf_dir: str, children: bool = True, parts: Iterable[str] = CVE_RECORD.names) -> DataFrame:
    """The parsed records of both sendings, stored. Their texts are not kept: what is made of these rows doesn't read them."""
    rows = shape.parsed(bronze(spark, sf_dir, children), parts).drop("raw_json", "source_last_modified", "source_uri", "load_type")
    return stored(rows, "records").withColumn("raw_json", F.lit(None).cast("string"))


def facts(spark: SparkSession, sf_dir: str, counted: bool = False) -> DataFrame:
    if not counted:
        return star.fact_cve(cves(spark, sf_dir), kev(spark, sf_dir), RUN, LOADED)
    t = silver(spark, sf_dir, "cves", "kev", "products", "weaknesses")
    return star.fact_cve(t["cves"], t["kev"], RUN, LOADED, star.count_children(bridge_products(t)), star.count_children(bridge_cwes(t)))


def bridge_products(t: dict[str, DataFrame]) -> DataFrame:
    """Of ``silver`` tables."""
    return star.fact_cve_product(t["products"], star.shared_attributes(t["cves"], t["kev"]), RUN, LOADED)


def bridge_cwes(t: dict[str, DataFrame]) -> DataFrame:
    return star.fact_cve_cwe(t["weaknesses"], star.shared_attributes(t["cves"], t["kev"]), RUN, LOADED)


def severities(spark: SparkSession) -> DataFrame:
    return star.dim_severity(spark, RUN, LOADED)


# Capture.
@query("SELECT cve_id, CASE WHEN modified IS NULL THEN 'soon' ELSE strftime(modified, '%Y-%m-%dT06:30:00.000') END AS source_last_modified, CASE v WHEN 1 THEN '20240101T000000Z-00000001' ELSE '20240201T000000Z-00000002' END AS batch_id, true AS hashed FROM r")
def bronze_capture(spark, sf_dir):
    return bronze(spark, sf_dir).select("cve_id", "source_last_modified", "batch_id", (F.col("payload_sha256") == F.sha2("raw_json", 256)).alias("hashed"))


@query("SELECT sha256(o_orderkey || '|' || o_orderpriority) AS payload_sha256, o_orderkey FROM orders", prelude=False)
def payload_hash(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    texts = o.select("o_orderkey", F.concat_ws("|", "o_orderkey", "o_orderpriority").alias("raw_json"))
    return texts.select(F.sha2("raw_json", 256).alias("payload_sha256"), "o_orderkey")


@query("SELECT cve_id, CASE v WHEN 1 THEN '2024.01.01' ELSE '2024.02.01' END AS catalog_version, '2024-02-01T00:00:00Z' AS date_released, count(*) AS n FROM r WHERE o_orderpriority = '1-URGENT' GROUP BY ALL")
def kev_capture(spark, sf_dir):
    return bronze_kev(spark, sf_dir).groupBy("cve_id", "catalog_version", "date_released").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS records, count(DISTINCT cve_id) AS ids FROM r")
def page_explode(spark, sf_dir):
    """Records through a page envelope: rendered as pages, read by the envelope's schema, unnested."""
    feed = synthetic.cve_feed(spark, sf_dir, children=False)
    n_pages = 1 + table(spark, sf_dir, "orders").count() // 1000  # a page holds about as much at any size
    pages = feed.groupBy(F.pmod(F.xxhash64("raw_json"), F.lit(n_pages)).alias("page")).agg(F.concat(F.lit('{"resultsPerPage":2000,"vulnerabilities":['), F.array_join(F.transform(F.collect_list("raw_json"), lambda t: F.concat(F.lit('{"cve":'), t, F.lit("}"))), ","), F.lit("]}")).alias("text"))
    read = pages.select(F.from_json("text", feeds.CVE_PAGE).alias("p")).select("p.*")
    rows = feeds.cve_texts(read).select(F.get_json_object("raw_json", "$.id").alias("id"))
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("id").alias("ids"))


# Silver.
@query("""SELECT cve_id, strftime(published, '%Y-%m-%d 00:00:00') AS published_at, strftime(modified, '%Y-%m-%d 06:30:00') AS last_modified_at, 'S-' || o_orderstatus AS vuln_status,
  CASE WHEN k % 13 <> 0 THEN 'order ' || o_orderpriority END AS description_en, score AS cvss_v3_score, severity AS cvss_v3_severity, CASE WHEN k % 7 <> 0 THEN 'V:' || k END AS cvss_vector,
  k % 2 = 0 AS has_source_identifier FROM cve""")
def silver_cve(spark, sf_dir):
    return cves(spark, sf_dir).select("cve_id", shown("published_at"), shown("last_modified_at"), "vuln_status", "description_en", "cvss_v3_score", "cvss_v3_severity", "cvss_vector", "has_source_identifier")


@query("""SELECT cve_id, 'Vendor ' || (o_custkey % 25) AS vendor_project, 'Product ' || (k % 9) || ' ' AS product, 'Name v' || v AS vulnerability_name, strftime(added, '%Y-%m-%d') AS date_added,
  strftime(due, '%Y-%m-%d') AS due_date, ransom AS known_ransomware_campaign_use, 'Apply updates.' AS required_action, CASE v WHEN 1 THEN '2024.01.01' ELSE '2024.02.01' END AS catalog_version FROM kev""")
def silver_kev(spark, sf_dir):
    return kev(spark, sf_dir).select("cve_id", "vendor_project", "product", "vulnerability_name", F.col("date_added").cast("string"), F.col("due_date").cast("string"), "known_ransomware_campaign_use", "required_action", "catalog_version")


@query("SELECT cve_id, part, vendor, product, version, vulnerable, bound AS version_end_excluding FROM prod")
def cpe_products(spark, sf_dir):
    return products(spark, sf_dir).select("cve_id", "part", "vendor", "product", "version", "vulnerable", "version_end_excluding")


@query("SELECT cve_id, cwe_id, strftime(modified, '%Y-%m-%d 06:30:00') AS last_modified_at FROM cwe")
def cwe_rows(spark, sf_dir):
    return weaknesses(spark, sf_dir).select("cve_id", "cwe_id", shown("last_modified_at"))


@query("""SELECT source_table, reason, count(*) AS rows FROM (
  SELECT 'bronze_nvd_raw' AS source_table, CASE WHEN cve_id IS NULL THEN 'missing_cve_id' WHEN NOT good_id THEN 'invalid_cve_id_format' WHEN published IS NULL THEN 'unparseable_published'
    WHEN modified IS NULL THEN 'unparseable_last_modified' END AS reason FROM r
  UNION ALL SELECT 'bronze_cisa_raw', CASE WHEN cve_id IS NULL THEN 'missing_cve_id' WHEN NOT good_id THEN 'invalid_cve_id_format' WHEN added IS NULL THEN 'unparseable_date_added' END FROM r WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'bronze_nvd_raw', CASE WHEN NOT good_item THEN 'invalid_cpe_criteria' END FROM item
  UNION ALL SELECT 'bronze_nvd_raw', CASE WHEN cwe_id = 'Use after free' THEN 'invalid_cwe_id' END FROM named) WHERE reason IS NOT NULL GROUP BY ALL""")
def quarantine_by_reason(spark, sf_dir):
    records = parsed_records(spark, sf_dir)
    rejected = [shape.silver_cves(records, LOADED)[1], shape.silver_kev(bronze_kev(spark, sf_dir), LOADED)[1], shape.silver_products(records, LOADED)[1], shape.silver_cwes(records, LOADED)[1]]
    return reports.quarantine_by_reason(reduce(DataFrame.unionByName, rejected))


@query("SELECT k AS o_orderkey, v, CASE WHEN cve_id IS NULL THEN 'missing_cve_id' WHEN NOT good_id THEN 'invalid_cve_id_format' WHEN published IS NULL THEN 'unparseable_published' WHEN modified IS NULL THEN 'unparseable_last_modified' END AS reason FROM r")
def quality_split(spark, sf_dir):
    o = synthetic.orders(spark, sf_dir)
    rows = o.select("o_orderkey", "v", synthetic.cve_id().alias("cve_id"), F.when(F.col("k") % 89 != 0, F.col("day")).alias("published_at"), F.when(~((F.col("k") % 79 == 0) & (F.col("v") == 2)), F.col("day")).alias("last_modified_at"))
    return quality.tagged(rows, quality.cve_rules()).select("o_orderkey", "v", "reason")


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1", prelude=False)
def dedup_latest(spark, sf_dir):
    return dedup.latest(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST) = 1", prelude=False)
def dedup_composite(spark, sf_dir):
    return dedup.latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("SELECT event_type, count(*) AS n, min(event_id) AS first_id FROM events WHERE event_type = 'click' AND ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY ALL", prelude=False)
def filter_window(spark, sf_dir):
    run = SilverRun(batch_id="click", from_date="2024-01-05", to_date="2024-01-12")
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("batch_id"), F.col("ts").cast("timestamp").alias("load_timestamp"))
    return shape.filter_bronze(e, run.batch_id, run.from_date, run.to_date).groupBy(F.col("batch_id").alias("event_type")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT CASE WHEN count(*) FILTER (WHERE k % 17 = 0) > 0 THEN 'brandNewField' ELSE '' END AS cve_keys, (SELECT CASE WHEN count(*) FILTER (WHERE k % 14 = 0) > 0 THEN 'newKey' ELSE '' END FROM r WHERE o_orderpriority = '1-URGENT') AS kev_keys FROM r")
def drift_keys(spark, sf_dir):
    c = shape.drift(shape.shaped_cves(shape.parsed(bronze(spark, sf_dir, children=False)), LOADED)).select(F.array_join("unknown_keys", ",").alias("cve_keys"))
    k = shape.drift(shape.shaped_kev(bronze_kev(spark, sf_dir), LOADED)).select(F.array_join("unknown_keys", ",").alias("kev_keys"))
    return c.withColumn("one", F.lit(1)).join(k.withColumn("one", F.lit(1)), "one").drop("one")


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props::JSON)) AS key FROM events) GROUP BY key", prelude=False)
def event_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.explode(F.json_object_keys("props")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


# Keys and static dimensions.
@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INT AS date_key FROM orders", prelude=False)
def date_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", K.date_key(F.col("o_orderdate")).alias("date_key"))


@query("SELECT k, v, severity_key FROM r")
def severity_key(spark, sf_dir):
    o = synthetic.orders(spark, sf_dir)
    score = F.when(F.col("k") % 7 != 0, F.col("tenths") / 10)
    label = F.when((F.col("k") % 7 != 0) & (F.col("k") % 3 != 0), F.when(score >= 9, "critical").when(score >= 7, "High").when(score >= 4, "MEDIUM").when(score > 0, "low").otherwise("None"))
    return o.select("k", "v", K.severity_key(label, score).alias("severity_key"))


@query("SELECT l_partkey, CASE WHEN l_partkey % 29 = 0 THEN -1 WHEN l_partkey % 31 = 0 THEN -2 WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN NULL ELSE (l_partkey % 50 + 1)::INT END AS cwe_key, CASE WHEN l_partkey % 29 = 0 THEN 'NVD-CWE-noinfo' WHEN l_partkey % 31 = 0 THEN 'NVD-CWE-Other' ELSE 'CWE' END AS cwe_category FROM lineitem", prelude=False)
def cwe_key(spark, sf_dir):
    p = F.col("l_partkey")
    name = F.when(p % 29 == 0, "NVD-CWE-noinfo").when(p % 31 == 0, "NVD-CWE-Other").when(p % 37 == 0, "garbage").when(p % 41 == 0, "CWE-99999999999").otherwise(F.concat(F.lit("CWE-"), p % 50 + 1))
    return table(spark, sf_dir, "lineitem").select("l_partkey", K.cwe_key(name).alias("cwe_key"), K.cwe_category(name).alias("cwe_category"))


@query("SELECT count(DISTINCT lower(trim(p_brand)) || '|' || lower(trim(p_name))) AS pairs, 0::BIGINT AS collisions FROM part", prelude=False)
def vendor_product_key(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(K.folded(F.col("p_brand")).alias("a"), K.folded(F.col("p_name")).alias("b"), K.vendor_product_key(F.concat(F.lit(" "), F.upper("p_brand")), F.col("p_name")).alias("key"))
    pairs = p.select("a", "b", "key").distinct()
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), (F.count(F.lit(1)) - F.count_distinct("key")).alias("collisions"))


@query("""SELECT strftime(d, '%Y%m%d')::INT AS date_key, strftime(d, '%Y-%m-%d') AS full_date, year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month, strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
  day(d)::INT AS day, isodow(d)::INT AS day_of_week, strftime(d, '%A') AS day_name, weekofyear(d)::INT AS week_of_year, isodow(d) >= 6 AS is_weekend FROM range(DATE '1988-01-01', DATE '2031-01-01', INTERVAL 1 DAY) AS t(d)""", prelude=False)
def dim_date(spark, sf_dir):
    return star.dim_date(spark, RUN, LOADED).drop("batch_id", "load_timestamp").withColumn("full_date", F.col("full_date").cast("string"))


@query("SELECT * FROM (VALUES (1, 'CRITICAL', 9.0::DOUBLE, 10.0::DOUBLE, 1), (2, 'HIGH', 7.0, 8.9, 2), (3, 'MEDIUM', 4.0, 6.9, 3), (4, 'LOW', 0.1, 3.9, 4), (5, 'NONE', 0.0, 0.0, 5), (6, 'UNKNOWN', NULL, NULL, 6)) AS t(severity_key, severity, score_min, score_max, sort_order)", prelude=False)
def dim_severity(spark, sf_dir):
    return severities(spark).select("severity_key", "severity", "score_min", "score_max", "sort_order")


# The star.
@query("""SELECT cve_id, CASE WHEN k % 13 <> 0 THEN 'order ' || o_orderpriority END AS description_en, 'S-' || o_orderstatus AS vuln_status, k % 2 = 0 AS has_source_identifier, listed AS is_in_kev,
  CASE WHEN listed THEN 'Vendor ' || (k_cust % 25) END AS kev_vendor_project, CASE WHEN listed THEN 'Name v' || k_v END AS kev_vulnerability_name, k_ransom AS known_ransomware_campaign_use, strftime(k_due, '%Y-%m-%d') AS kev_due_date FROM fact""")
def dim_cve(spark, sf_dir):
    d = star.dim_cve(cves(spark, sf_dir), kev(spark, sf_dir), RUN, LOADED)
    return d.select("cve_id", "description_en", "vuln_status", "has_source_identifier", "is_in_kev", "kev_vendor_project", "kev_vulnerability_name", "known_ransomware_campaign_use", F.col("kev_due_date").cast("string"))


_FACT = """SELECT cve_id, published_key AS published_date_key, strftime(modified, '%Y%m%d')::INT AS last_modified_date_key, strftime(k_added, '%Y%m%d')::INT AS kev_added_date_key, strftime(k_due, '%Y%m%d')::INT AS kev_due_date_key,
  severity_key, score AS cvss_v3_score, listed::INT AS is_exploited, coalesce(k_ransom = 'Known', false)::INT AS is_ransomware, days AS days_to_kev, {0} AS product_count, {1} AS cwe_count, 1 AS cve_count FROM fact"""


@query(_FACT.format("NULL::INT", "NULL::INT"))
def fact_cve(spark, sf_dir):
    return facts(spark, sf_dir).drop("batch_id", "load_timestamp")


@query(_FACT.format("products", "cwes"))
def fact_cve_counts(spark, sf_dir):
    return facts(spark, sf_dir, counted=True).drop("batch_id", "load_timestamp")


@query("SELECT fv AS vendor, fp AS product, min(part) AS part FROM prod WHERE vulnerable GROUP BY ALL")
def dim_vendor_product(spark, sf_dir):
    return star.dim_vendor_product(products(spark, sf_dir), RUN, LOADED).select("vendor", "product", "part")


@query("SELECT cve_id, vendor, product, published_key AS published_date_key, severity_key, listed::INT AS is_exploited, score AS cvss_v3_score FROM bp")
def fact_cve_product(spark, sf_dir):
    t = silver(spark, sf_dir, "cves", "kev", "products", once=("cves", "kev", "products"))
    p = star.vulnerable_products(t["products"]).withColumns({c: K.folded(F.col(c)) for c in ("vendor", "product")})
    attributes = star.shared_attributes(t["cves"], t["kev"])
    return star.bridge(p, ["vendor_product_key", "vendor", "product"], attributes).select("cve_id", "vendor", "product", "published_date_key", "severity_key", "is_exploited", "cvss_v3_score")


@query("SELECT DISTINCT cwe_key, cwe_id, CASE WHEN cwe_key < 0 THEN cwe_id ELSE 'CWE' END AS cwe_category FROM cwe")
def dim_cwe(spark, sf_dir):
    return star.dim_cwe(weaknesses(spark, sf_dir), RUN, LOADED).drop("batch_id", "load_timestamp")


@query("SELECT cve_id, cwe_key, published_key AS published_date_key, severity_key, listed::INT AS is_exploited, score AS cvss_v3_score FROM bc")
def fact_cve_cwe(spark, sf_dir):
    return bridge_cwes(silver(spark, sf_dir, "cves", "kev", "weaknesses", once=("cves", "kev", "weaknesses"))).drop("batch_id", "load_timestamp")


# Upserts: the first sending is the target, the second the source.
def _sent(spark: SparkSession, sf_dir: str, v: int) -> DataFrame:
    batch = synthetic.FIRST if v == 1 else synthetic.SECOND
    return shape.silver_cves(shape.parsed(bronze(spark, sf_dir, children=False).where(F.col("batch_id") == batch)), LOADED)[0]


@query("""SELECT a.cve_id, CASE WHEN b.modified > a.modified THEN b.score ELSE a.score END AS cvss_v3_score, CASE WHEN b.modified > a.modified THEN 'update' ELSE 'keep' END AS _action
  FROM (SELECT * FROM r WHERE v = 1 AND good_id AND published IS NOT NULL AND k % 3 <> 1) AS a LEFT JOIN (SELECT * FROM r WHERE v = 2 AND good_id AND published IS NOT NULL AND modified IS NOT NULL) AS b ON a.cve_id = b.cve_id
  UNION ALL SELECT cve_id, score, 'insert' FROM r WHERE v = 2 AND good_id AND published IS NOT NULL AND modified IS NOT NULL AND k % 3 = 1""")
def upsert_newer(spark, sf_dir):
    target = _sent(spark, sf_dir, 1).where(F.substring("cve_id", 10, 20).cast("bigint") % 3 != 1)
    return U.plan(target, _sent(spark, sf_dir, 2), ["cve_id"], U.newer).select("cve_id", "cvss_v3_score", "_action")


@query("""SELECT a.cve_id, CASE WHEN b.cve_id IS NULL THEN 'Name v1' ELSE 'Name v2' END AS vulnerability_name, CASE WHEN b.cve_id IS NULL THEN 'keep' ELSE 'update' END AS _action
  FROM (SELECT * FROM r WHERE v = 1 AND o_orderpriority = '1-URGENT' AND good_id AND added IS NOT NULL) AS a LEFT JOIN (SELECT * FROM r WHERE v = 2) AS b ON a.cve_id = b.cve_id""")
def upsert_kev(spark, sf_dir):
    each = [shape.silver_kev(bronze_kev(spark, sf_dir).where(F.col("batch_id") == b), LOADED)[0] for b in (synthetic.FIRST, synthetic.SECOND)]
    return U.plan(each[0], each[1], ["cve_id"], U.newer_catalog).select("cve_id", "vulnerability_name", "_action")


@query("""SELECT a.user_id, CASE WHEN b.user_id IS NULL OR (a.event_type IS NOT DISTINCT FROM b.event_type) THEN 'keep' ELSE 'update' END AS _action
  FROM (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events WHERE event_id % 2 = 0 GROUP BY 1) AS a LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events WHERE event_id % 2 = 1 GROUP BY 1) AS b ON a.user_id = b.user_id
  UNION ALL SELECT DISTINCT user_id, 'insert' FROM events WHERE event_id % 2 = 1 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 0)""", prelude=False)
def upsert_changed(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    half = [e.where(F.col("event_id") % 2 == n).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type")).withColumns({"batch_id": F.lit(str(n)), "load_timestamp": instant(LOADED + timedelta(days=n))}) for n in (0, 1)]
    return U.plan(half[0], half[1], ["user_id"], U.changed(half[0].columns)).select("user_id", "_action")


@query("SELECT 0::BIGINT AS changed, count(*) AS kept FROM cve")
def upsert_rerun_noop(spark, sf_dir):
    c = cves(spark, sf_dir)
    return U.plan(c, c, ["cve_id"], U.newer).agg(F.count_if(F.col("_action") != U.KEEP).alias("changed"), F.count_if(F.col("_action") == U.KEEP).alias("kept"))


@query("SELECT cve_id, CASE WHEN cve_id IS NULL THEN 'missing_cve_id' WHEN NOT good_id THEN 'invalid_cve_id_format' WHEN published IS NULL THEN 'unparseable_published' ELSE 'unparseable_last_modified' END AS reason FROM r WHERE v = 2 AND (NOT good_id OR published IS NULL OR modified IS NULL)")
def quarantine_insert_only(spark, sf_dir):
    """Of all rejected rows, those that a store which holds the first batch's lacks."""
    rejected = shape.silver_cves(shape.parsed(bronze(spark, sf_dir, children=False)), LOADED)[1]
    return U.insert_only(rejected.where(F.col("batch_id") == synthetic.FIRST), rejected).select("cve_id", "reason")


# Scope and marks.
@query("SELECT DISTINCT cve_id FROM (SELECT cve_id FROM cve WHERE v = 2 UNION ALL SELECT cve_id FROM kev WHERE v = 2)")
def changed_ids(spark, sf_dir):
    frames = [f.withColumn("load_timestamp", F.when(F.col("batch_id") == synthetic.SECOND, instant(LOADED + timedelta(days=2))).otherwise(instant(LOADED))) for f in (cves(spark, sf_dir), kev(spark, sf_dir))]
    return watermark.changed_ids(frames, LOADED)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')", prelude=False)
def scope_semi(spark, sf_dir):
    ids = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("cve_id")).distinct()
    o = table(spark, sf_dir, "orders").withColumn("cve_id", F.col("o_custkey"))
    return watermark.scoped(o, ids).select("o_orderkey", "o_orderpriority")


@query("SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS watermark_ts FROM events GROUP BY 1", prelude=False)
def max_watermark(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.date_format(F.max(F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("watermark_ts"))


@query("SELECT 0::BIGINT AS differences, count(*) AS rows FROM cve")
def incremental_equals_full(spark, sf_dir):
    """A fact built of the first sending and brought up to date by the changed ids alone, against one built of all."""
    k, content = kev(spark, sf_dir), [c for c in star.S.FACT_CVE.names if c not in star.S.AUDIT_COLUMNS]
    first = _sent(spark, sf_dir, 1)
    both = cves(spark, sf_dir)
    moved = both.where(F.col("batch_id") == synthetic.SECOND).select("cve_id").distinct()
    step = U.plan(star.fact_cve(first, k, RUN, LOADED), star.fact_cve(watermark.scoped(both, moved), k, RUN, LOADED), ["cve_id"], U.changed(content)).select(*content).withColumn("side", F.lit(1))
    full = star.fact_cve(both, k, RUN, LOADED).select(*content).withColumn("side", F.lit(-1))
    per = step.unionByName(full).groupBy(*content).agg(F.sum("side").alias("d"), F.count_if(F.col("side") == -1).alias("n"))
    return per.agg(F.count_if(F.col("d") != 0).alias("differences"), F.sum("n").alias("rows"))


# Constraints.
@query("""SELECT t AS table_name, count(*) FILTER (WHERE bad) AS violations FROM (
  SELECT 'dim_cve' AS t, cve_id IS NULL OR count(*) > 1 AS bad FROM cve GROUP BY cve_id UNION ALL SELECT 'dim_cwe', cwe_key IS NULL OR count(*) > 1 FROM (SELECT DISTINCT cwe_key, cwe_id FROM cwe) GROUP BY cwe_key
  UNION ALL SELECT 'dim_vendor_product', fv IS NULL OR fp IS NULL OR count(*) > 1 FROM (SELECT fv, fp, min(part) FROM prod WHERE vulnerable GROUP BY 1, 2) GROUP BY fv, fp UNION ALL SELECT 'fact_cve', cve_id IS NULL OR count(*) > 1 FROM fact GROUP BY cve_id
  UNION ALL SELECT 'fact_cve_cwe', cve_id IS NULL OR cwe_key IS NULL OR count(*) > 1 FROM bc GROUP BY cve_id, cwe_key UNION ALL SELECT 'fact_cve_product', cve_id IS NULL OR vendor IS NULL OR product IS NULL OR count(*) > 1 FROM bp GROUP BY cve_id, vendor, product) GROUP BY t""")
def pk_check(spark, sf_dir):
    c, k, p, w = silver(spark, sf_dir, "cves", "kev", "products", "weaknesses").values()
    a = star.shared_attributes(c, k)
    made = {"dim_cve": star.dim_cve(c, k, RUN, LOADED), "dim_cwe": star.dim_cwe(w, RUN, LOADED), "dim_vendor_product": star.dim_vendor_product(p, RUN, LOADED), "fact_cve": star.fact_cve(c, k, RUN, LOADED), "fact_cve_cwe": star.fact_cve_cwe(w, a, RUN, LOADED), "fact_cve_product": star.fact_cve_product(p, a, RUN, LOADED)}
    return reduce(DataFrame.unionAll, [model.key_violations(f, model.TABLES[n].keys).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(n).alias("table_name"), "violations") for n, f in made.items()])


@query("""SELECT t AS table_name, c AS column_name, count(*) FILTER (WHERE bad) AS orphans FROM (
  SELECT 'fact_cve' AS t, 'cve_id' AS c, cve_id NOT IN (SELECT cve_id FROM cve) AS bad FROM fact
  UNION ALL SELECT 'fact_cve', 'published_date_key', published_key NOT IN (SELECT strftime(d, '%Y%m%d')::INT FROM range(DATE '1988-01-01', DATE '2031-01-01', INTERVAL 1 DAY) AS x(d)) FROM fact WHERE published_key IS NOT NULL
  UNION ALL SELECT 'fact_cve', 'severity_key', severity_key NOT BETWEEN 1 AND 6 FROM fact
  UNION ALL SELECT 'fact_cve_cwe', 'cwe_key', cwe_key NOT IN (SELECT cwe_key FROM cwe) FROM bc UNION ALL SELECT 'fact_cve_product', 'cve_id', cve_id NOT IN (SELECT cve_id FROM cve) FROM bp) GROUP BY ALL""")
def fk_check(spark, sf_dir):
    c, k, p, w = silver(spark, sf_dir, "cves", "kev", "products", "weaknesses", once=("products",)).values()
    a, d = star.shared_attributes(c, k), star.dim_cve(c, k, RUN, LOADED)
    f, dates = star.fact_cve(c, k, RUN, LOADED), star.dim_date(spark, RUN, LOADED)
    pairs = [("fact_cve", "cve_id", f, d, "cve_id"), ("fact_cve", "published_date_key", f, dates, "date_key"), ("fact_cve", "severity_key", f, severities(spark), "severity_key"), ("fact_cve_cwe", "cwe_key", star.fact_cve_cwe(w, a, RUN, LOADED), star.dim_cwe(w, RUN, LOADED), "cwe_key"), ("fact_cve_product", "cve_id", star.fact_cve_product(p, a, RUN, LOADED), d, "cve_id")]
    return reduce(DataFrame.unionAll, [model.orphans(rows, column, to, key).agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(n).alias("table_name"), F.lit(column).alias("column_name"), "orphans") for n, column, rows, to, key in pairs])


# Reports.
@query("""SELECT cve_id, strftime(published, '%Y-%m-%d') AS published_at, (['CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'NONE', 'UNKNOWN'])[severity_key] AS severity, score AS cvss_v3_score, listed AS is_exploited, strftime(k_due, '%Y-%m-%d') AS kev_due_date,
  k_ransom AS known_ransomware_campaign_use, CASE WHEN listed THEN 'KEV listed' ELSE 'Critical, recent' END AS watch_reason FROM fact WHERE listed OR (score >= 9 AND published >= DATE '2001-06-01' - 90)""")
def watchlist(spark, sf_dir):
    c, k = cves(spark, sf_dir), kev(spark, sf_dir)
    w = star.watchlist(star.fact_cve(c, k, RUN, LOADED), star.dim_date(spark, RUN, LOADED), severities(spark), star.dim_cve(c, k, RUN, LOADED), F.lit(AS_OF))
    return w.select("cve_id", F.col("published_at").cast("string"), "severity", "cvss_v3_score", "is_exploited", F.col("kev_due_date").cast("string"), "known_ransomware_campaign_use", "watch_reason")


_SEVERITY = "(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'NONE', 'UNKNOWN'])[severity_key]"


@query(f"SELECT {_SEVERITY} AS severity, count(*) AS cves, sum(listed::INT)::BIGINT AS exploited, round(avg(score), 2) AS avg_score FROM fact GROUP BY severity_key")
def report_severity(spark, sf_dir):
    return reports.by_severity(facts(spark, sf_dir), severities(spark))


@query("SELECT count(*) AS rows, count(DISTINCT cve_id) AS distinct_cves, count(*) FILTER (WHERE severity_key = 1) AS critical, sum(listed::INT)::BIGINT AS in_kev, sum(coalesce(k_ransom = 'Known', false)::INT)::BIGINT AS ransomware, median(days)::DOUBLE AS median_days, min(days) AS min_days, max(days) AS max_days FROM fact")
def report_kpis(spark, sf_dir):
    return reports.kpis(facts(spark, sf_dir))


@query("SELECT median(days)::DOUBLE AS median_days FROM fact")
def median_days(spark, sf_dir):
    return reports.kpis(facts(spark, sf_dir)).select("median_days")


@query(None)
def median_days_approx(spark, sf_dir):
    return reports.kpis(facts(spark, sf_dir), approximate=True).select("median_days")


@query("SELECT vendor, count(DISTINCT cve_id) AS cves, count(DISTINCT CASE WHEN listed THEN cve_id END) AS exploited_cves FROM bp GROUP BY 1 ORDER BY cves DESC, vendor LIMIT 10")
def report_top_vendors(spark, sf_dir):
    t = silver(spark, sf_dir, "cves", "kev", "products", once=("cves", "kev"))
    return reports.top_vendors(bridge_products(t), star.dim_vendor_product(t["products"], RUN, LOADED))


@query("SELECT cwe_id, count(*) AS cves, sum(listed::INT)::BIGINT AS exploited_cves FROM bc GROUP BY 1 ORDER BY cves DESC, cwe_id LIMIT 10")
def report_top_cwes(spark, sf_dir):
    t = silver(spark, sf_dir, "cves", "kev", "weaknesses", once=("cves", "kev"))
    return reports.top_cwes(bridge_cwes(t), star.dim_cwe(t["weaknesses"], RUN, LOADED))


@query("SELECT cwe_id, count(*) AS cves, count(*) AS exploited_cves FROM bc WHERE listed GROUP BY 1 ORDER BY cves DESC, cwe_id LIMIT 10")
def report_top_exploited_cwes(spark, sf_dir):
    t = silver(spark, sf_dir, "cves", "kev", "weaknesses", once=("cves", "kev"))
    return reports.top_cwes(bridge_cwes(t), star.dim_cwe(t["weaknesses"], RUN, LOADED), exploited_only=True)


@query(f"SELECT year(published)::INT AS year, {_SEVERITY} AS severity, count(*) AS cves FROM fact GROUP BY ALL")
def report_trend_year_severity(spark, sf_dir):
    return reports.year_by_severity(facts(spark, sf_dir), severities(spark))


@query("SELECT (floor(days / 30.0) * 30)::INT AS bin_start, count(*) AS cves FROM fact WHERE days IS NOT NULL GROUP BY 1")
def report_kev_histogram(spark, sf_dir):
    return reports.kev_histogram(facts(spark, sf_dir))


@query("SELECT year(d)::INT AS year, count(*) AS days, count(*) FILTER (WHERE isodow(d) >= 6) AS weekend_days FROM range(DATE '1988-01-01', DATE '2031-01-01', INTERVAL 1 DAY) AS t(d) GROUP BY 1", prelude=False)
def report_calendar(spark, sf_dir):
    return reports.calendar_check(star.dim_date(spark, RUN, LOADED))


@query("SELECT 'fact_cve' AS table_name, count(*) AS rows FROM fact UNION ALL SELECT 'fact_cve_product', count(*) FROM bp UNION ALL SELECT 'fact_cve_cwe', count(*) FROM bc UNION ALL SELECT 'dim_cwe', count(DISTINCT cwe_key) FROM cwe")
def report_row_counts(spark, sf_dir):
    t = silver(spark, sf_dir, "cves", "kev", "products", "weaknesses", once=("products",))
    return reports.row_counts({"fact_cve": star.fact_cve(t["cves"], t["kev"], RUN, LOADED), "fact_cve_product": bridge_products(t), "fact_cve_cwe": bridge_cwes(t), "dim_cwe": star.dim_cwe(t["weaknesses"], RUN, LOADED)})


@query("SELECT CASE v WHEN 1 THEN '20240101T000000Z-00000001' ELSE '20240201T000000Z-00000002' END AS batch_id, CASE v WHEN 1 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_type, count(*) AS rows, CASE v WHEN 1 THEN '2024-03-02 00:00:00' ELSE '2024-03-03 00:00:00' END AS first_loaded FROM r GROUP BY v")
def report_batches(spark, sf_dir):
    return reports.batch_history(bronze(spark, sf_dir, children=False), "load_type").withColumn("first_loaded", shown("first_loaded"))


@query("""SELECT 'silver_cve' AS table_name, count(*) AS rows, count(DISTINCT cve_id) AS ids, count(score) AS flagged FROM cve UNION ALL SELECT 'silver_kev', count(*), count(DISTINCT cve_id), count(*) FILTER (WHERE ransom = 'Known') FROM kev
  UNION ALL SELECT 'silver_affected_product', count(*), count(DISTINCT cve_id), count(*) FILTER (WHERE vulnerable) FROM prod UNION ALL SELECT 'silver_cwe', count(*), count(DISTINCT cve_id), NULL FROM cwe""")
def report_silver_summary(spark, sf_dir):
    return reports.silver_summary(*silver(spark, sf_dir, "cves", "kev", "products", "weaknesses").values())


@query("SELECT strftime(published, '%Y%m')::INT AS month, count(*) AS cves, count(*) FILTER (WHERE severity_key = 1) AS critical, sum(listed::INT)::BIGINT AS exploited FROM fact GROUP BY 1")
def report_monthly_trend(spark, sf_dir):
    return reports.monthly_trend(facts(spark, sf_dir))


@query("SELECT vendor, count(DISTINCT cve_id) AS cves, count(DISTINCT CASE WHEN listed THEN cve_id END) AS exploited_cves, round(count(DISTINCT CASE WHEN listed THEN cve_id END) / count(DISTINCT cve_id)::DOUBLE, 4) AS exploit_ratio, max(score) AS max_score FROM bp GROUP BY 1")
def report_vendor_risk(spark, sf_dir):
    t = silver(spark, sf_dir, "cves", "kev", "products", once=("cves", "kev"))
    return reports.vendor_risk(bridge_products(t), star.dim_vendor_product(t["products"], RUN, LOADED))


@query("SELECT year(k_added)::INT AS listed_year, count(*) AS listed, round(avg(days), 2) AS avg_days, count(*) FILTER (WHERE days <= 30) AS within_30 FROM fact WHERE k_added IS NOT NULL GROUP BY 1")
def report_kev_response(spark, sf_dir):
    return reports.kev_response(facts(spark, sf_dir))


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of runs: purchases count as failures."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(F.col("user_id").cast("string").alias("batch_id"), F.col("event_type").alias("layer"), F.col("ts").alias("started_at"), F.col("ts").alias("finished_at"), F.when(F.col("event_type") == "purchase", audit.FAILURE).otherwise(audit.SUCCESS).alias("status"), F.lit(1).alias("rows_inserted"), (F.col("event_id") % 3).alias("rows_updated"), F.lit(0).alias("rows_quarantined"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type = 'purchase' THEN 'FAILURE' ELSE 'SUCCESS' END AS status, count(DISTINCT user_id) AS runs FROM events GROUP BY ALL", prelude=False)
def report_runs_by_day(spark, sf_dir):
    return reports.runs_by_day(_event_log(spark, sf_dir)).withColumn("day", F.col("day").cast("string"))


@query("SELECT event_type AS layer, count(*) AS writes, count(*) FILTER (WHERE event_type = 'purchase') AS failed, count(*) AS rows_inserted, sum(event_id % 3)::BIGINT AS rows_updated, 0::BIGINT AS rows_quarantined, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_finished FROM events GROUP BY 1", prelude=False)
def report_rows_by_layer(spark, sf_dir):
    return reports.rows_by_layer(_event_log(spark, sf_dir)).withColumn("last_finished", shown("last_finished"))


@query("SELECT 'b' AS batch_id, 'Silver-to-Gold' AS layer, 'fact_cve' AS source, 'FULL' AS load_type, '{\"mode\": \"full\"}' AS parameters, '2024-03-01 00:00:00' AS started_at, '2024-03-01 00:01:00' AS finished_at, 'SUCCESS' AS status, 5::BIGINT AS rows_read", prelude=False)
def audit_log(spark, sf_dir):
    row = audit.log_row(spark, audit.Step("b", audit.SILVER_TO_GOLD, "fact_cve", "FULL", {"mode": "full"}, rows_read=5), LOADED, LOADED + timedelta(minutes=1), audit.SUCCESS)
    return row.select("batch_id", "layer", "source", "load_type", "parameters", shown("started_at"), shown("finished_at"), "status", "rows_read")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 06:30:00') AS with_ms, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS without_ms, NULL::VARCHAR AS broken FROM orders", prelude=False)
def timestamp_parse(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'06:30:00.000").alias("with_ms"), F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00").alias("without_ms"), F.lit("not-a-date").alias("broken"))
    return o.select("o_orderkey", *(F.date_format(feed_instant(F.col(c)), "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("with_ms", "without_ms", "broken")))
