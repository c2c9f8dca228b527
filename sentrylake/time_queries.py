"""Queries over versions and over time: ranges that hold a version, states as of a moment, histories, and aggregates kept up to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import queries as Q
from .functions import keys as K
from .functions.versions import version_key
from .operators import history, ranges, shape, star, variants
from .plans import analytics
from .plans.maintained import CountedState, difference
from .plans.scratch import scratch_folder, stored
from .queries import LOADED, bronze, kev, query, shown, table
from .sources import synthetic
from .streaming.sessions import stream_sessions

# The key of a version, as functions.versions spells it.
_KEY = """CASE WHEN regexp_matches({0}, '[0-9a-zA-Z]') THEN regexp_replace(array_to_string(list_transform(regexp_extract_all(lower({0}), '([0-9]+|[a-z]+)'),
    lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN 'N' || lpad(length(regexp_replace(x, '^0+([0-9])', '\\1'))::VARCHAR, 3, '0') || regexp_replace(x, '^0+([0-9])', '\\1') ELSE 'A' || x || ' ' END), '') || 'M', '(N0010)+([AM])', '\\2', 'g') END"""


def assets(spark, sf_dir):
    """An inventory: vendor, product and version of each line, in the spelling of its owner."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    each = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    version = F.concat_ws(".", F.col("l_linenumber"), (F.col("l_quantity") % 12).cast("int"), F.when(F.col("l_partkey") % 7 == 0, F.lit("0")).when(F.col("l_partkey") % 7 == 1, F.lit("rc2")))
    return each.select(K.folded(F.concat(F.lit(" SUPPLIER_"), F.col("l_suppkey") % 40)).alias("vendor"), K.folded(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("product"), F.when(F.col("l_partkey") % 53 == 0, "-").otherwise(version).alias("version"))


def bounded_criteria(spark, sf_dir):
    """Criteria of the products with the keys of their bounds. Without bounds a criterion holds its own version alone."""
    p = Q.products(spark, sf_dir).where("vulnerable")
    low, high = F.coalesce("version_start_including", "version_start_excluding"), F.coalesce("version_end_excluding", "version_end_including")
    free = low.isNull() & high.isNull()
    made = {
        "vendor": K.folded(F.col("vendor")), "product": K.folded(F.col("product")), "low": version_key(F.when(free, F.col("version")).otherwise(low)), "high": version_key(F.when(free, F.col("version")).otherwise(high)),
        "low_open": F.col("version_start_including").isNull() & F.col("version_start_excluding").isNotNull(), "high_open": F.col("version_end_excluding").isNotNull(),
    }
    return p.select("cve_id", "criteria", *[c.alias(n) for n, c in made.items()])


@query(f"""
, asset AS (SELECT 'supplier_' || (l_suppkey % 40) AS vendor, lower(replace(p_name, ' ', '_')) AS product, CASE WHEN l_partkey % 53 = 0 THEN '-' ELSE l_linenumber || '.' || (l_quantity % 12)::INT || CASE l_partkey % 7 WHEN 0 THEN '.0' WHEN 1 THEN '.rc2' ELSE '' END END AS version
  FROM lineitem JOIN part ON l_partkey = p_partkey),
owned AS (SELECT vendor, product, {_KEY.format('version')} AS vkey, count(*) AS n FROM asset GROUP BY ALL),
texts AS (SELECT cve_id, fv, fp, version, CASE WHEN l_partkey % 3 = 0 THEN (l_linenumber % 4) || '.' || (l_suppkey % 15) END AS si, CASE WHEN l_partkey % 15 = 1 THEN (l_linenumber % 4) || '.0rc' END AS se,
    CASE WHEN l_partkey % 2 = 1 AND l_partkey % 5 <> 0 THEN (l_linenumber + 1) || '.' || (l_suppkey % 12) END AS ei, bound AS ee FROM prod WHERE vulnerable),
range AS (SELECT cve_id, fv, fp, si IS NULL AND se IS NOT NULL AS low_open, ee IS NOT NULL AS high_open, coalesce(si, se) AS l, coalesce(ee, ei) AS h, version FROM texts),
spelled AS (SELECT *, {_KEY.format('(CASE WHEN l IS NULL AND h IS NULL THEN version ELSE l END)')} AS low, {_KEY.format('(CASE WHEN l IS NULL AND h IS NULL THEN version ELSE h END)')} AS high FROM range)
SELECT cve_id, fv AS vendor, fp AS product, vkey AS version_key, sum(n)::BIGINT AS assets, count(DISTINCT (low, low_open, high, high_open)) AS criteria FROM spelled JOIN owned ON fv = owned.vendor AND fp = owned.product
  AND (low IS NULL OR vkey > low OR (vkey = low AND NOT low_open)) AND (high IS NULL OR vkey < high OR (vkey = high AND NOT high_open)) GROUP BY ALL""")
def vulnerable_assets(spark, sf_dir):
    """Which installed versions lie in the version ranges of which records' criteria."""
    owned = assets(spark, sf_dir).withColumn("version_key", version_key(F.col("version"))).groupBy("vendor", "product", "version_key").agg(F.count(F.lit(1)).alias("n"))
    found = ranges.counted(owned, bounded_criteria(spark, sf_dir), ["vendor", "product"], "cve_id", "version_key", "low", "high", "low_open", "high_open")
    return found.select("cve_id", "vendor", "product", "version_key", (F.col("n") * F.col("rows")).alias("assets"), F.col("intervals").alias("criteria"))


@query(f"""SELECT l_orderkey, l_linenumber, {_KEY.format("(CASE l_partkey % 5 WHEN 0 THEN '*' WHEN 1 THEN '1.' || l_suppkey || '.0' WHEN 2 THEN '0' || l_linenumber || '.00' || l_suppkey || 'RC1' WHEN 3 THEN 'v' || l_suppkey || '-beta.' || l_linenumber ELSE l_linenumber || '.' || l_partkey END)")} AS version_key FROM lineitem""", prelude=False)
def version_keys(spark, sf_dir):
    p, s, n = F.col("l_partkey"), F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")
    v = F.when(p % 5 == 0, "*").when(p % 5 == 1, F.concat(F.lit("1."), s, F.lit(".0"))).when(p % 5 == 2, F.concat(F.lit("0"), n, F.lit(".00"), s, F.lit("RC1"))).when(p % 5 == 3, F.concat(F.lit("v"), s, F.lit("-beta."), n)).otherwise(F.concat(n, F.lit("."), p.cast("string")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", version_key(v).alias("version_key"))


@query("""SELECT k.cve_id, strftime(k.added, '%Y-%m-%d') AS date_added, strftime(a.modified, '%Y-%m-%d 06:30:00') AS last_modified_at, a.score AS cvss_v3_score
  FROM kev AS k ASOF LEFT JOIN (SELECT cve_id, modified, score FROM r WHERE good_id AND published IS NOT NULL AND modified IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cve_id, modified ORDER BY v DESC) = 1) AS a ON k.cve_id = a.cve_id AND k.added >= a.modified + INTERVAL '6 hours 30 minutes'""")
def listed_as_of(spark, sf_dir):
    """The version of its record that was valid when an exploited one was listed."""
    versions = shape.quality.split(shape.shaped_cves(shape.parsed(bronze(spark, sf_dir, children=False)), LOADED), shape.quality.cve_rules(), "bronze_nvd_raw")[0]
    entries = kev(spark, sf_dir).select("cve_id", "date_added", F.col("date_added").cast("timestamp").alias("at"))
    found = ranges.as_of(entries, versions, ["cve_id"], "at", "last_modified_at", ["last_modified_at", "cvss_v3_score"], ["batch_id"])
    return found.select("cve_id", F.col("date_added").cast("string"), shown("last_modified_at"), "cvss_v3_score")


@query("""SELECT sale_id, c.change_id, c.op, c.segment, c.city FROM sales AS s ASOF LEFT JOIN (SELECT * FROM client_changes WHERE client_id IS NOT NULL AND valid_at IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY client_id, valid_at ORDER BY seq DESC NULLS LAST, change_id DESC NULLS LAST) = 1) AS c ON s.client_id = c.client_id AND s.sold_at >= c.valid_at""", prelude=False)
def sale_client_as_of(spark, sf_dir):
    """What was known of a sale's client when it was made. A few clients have most of the sales and changes."""
    sales = table(spark, sf_dir, "sales").select("sale_id", "client_id", "sold_at")
    found = ranges.as_of(sales, table(spark, sf_dir, "client_changes"), ["client_id"], "sold_at", "valid_at", ["change_id", "op", "segment", "city"], ["seq", "change_id"])
    return found.drop("client_id", "sold_at")


_POINTS = """p AS (SELECT client_id, valid_at, op IS NOT DISTINCT FROM 'D' AS gone, CASE WHEN op IS DISTINCT FROM 'D' THEN segment END AS segment, CASE WHEN op IS DISTINCT FROM 'D' THEN city END AS city FROM client_changes WHERE client_id IS NOT NULL AND valid_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY client_id, valid_at ORDER BY seq DESC NULLS LAST, change_id DESC NULLS LAST) = 1)"""
_HISTORY = f"""WITH {_POINTS},
l AS (SELECT *, lag((gone, segment, city)) OVER w AS last, row_number() OVER w AS nth FROM p WINDOW w AS (PARTITION BY client_id ORDER BY valid_at)),
s AS (SELECT *, lead(valid_at) OVER (PARTITION BY client_id ORDER BY valid_at) AS valid_to FROM l WHERE nth = 1 OR (gone, segment, city) IS DISTINCT FROM last)
SELECT client_id, segment, city, strftime(valid_at, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, valid_to IS NULL AS is_current FROM s WHERE NOT gone"""


def client_points(changes, ordered=False):
    """What each change says of its client; one that goes has neither segment nor city. ``ordered``: with the columns that settle which of one moment counts."""
    gone = F.coalesce(F.col("op") == "D", F.lit(False))
    said = changes.select("client_id", "valid_at", "seq", "change_id", gone.alias("gone"), *[F.when(~gone, F.col(c)).alias(c) for c in ("segment", "city")])
    return history.points(said, ["client_id"], "valid_at", ["gone", "segment", "city"], ["seq", "change_id"], ordered)


def _shown_history(found):
    return found.drop("gone").withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("valid_from", "valid_to")})


@query(_HISTORY, prelude=False)
def client_history(spark, sf_dir):
    states = client_points(table(spark, sf_dir, "client_changes"))
    return _shown_history(history.intervals(states, ["client_id"], "valid_at", ["gone", "segment", "city"], F.col("gone")))


@query(_HISTORY, prelude=False)
def client_history_late(spark, sf_dir):
    """A third of the changes comes after all others: it splits what was closed. Intervals of clients that it doesn't touch stay as they were."""
    changes = table(spark, sf_dir, "client_changes")
    nth = F.coalesce(F.col("seq"), F.lit(0)) % 3
    now, late = (client_points(changes.where(c), ordered=True) for c in (nth != 1, nth == 1))
    key, states = ["client_id"], ["gone", "segment", "city"]
    first = history.intervals(now, key, "valid_at", states, F.col("gone"))
    _, touched = history.with_late(now, late, key, "valid_at", ["seq", "change_id"])
    again = history.intervals(touched, key, "valid_at", states, F.col("gone"))
    return _shown_history(first.join(touched.select("client_id").distinct(), key, "left_anti").unionByName(again))


@query("""SELECT cve_id, score AS cvss_v3_score, severity AS cvss_v3_severity, strftime(modified, '%Y-%m-%d 06:30:00') AS valid_from, strftime(lead(modified) OVER w, '%Y-%m-%d 06:30:00') AS valid_to, lead(modified) OVER w IS NULL AS is_current FROM
  (SELECT *, lag((score, severity)) OVER v AS last, row_number() OVER v AS nth FROM (SELECT * FROM r WHERE good_id AND published IS NOT NULL AND modified IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cve_id, modified ORDER BY v DESC) = 1)
    WINDOW v AS (PARTITION BY cve_id ORDER BY modified)) WHERE nth = 1 OR (score, severity) IS DISTINCT FROM last WINDOW w AS (PARTITION BY cve_id ORDER BY modified)""")
def record_history(spark, sf_dir):
    """From when to when each record had which score."""
    sent = shape.quality.split(shape.shaped_cves(shape.parsed(bronze(spark, sf_dir, children=False)), LOADED), shape.quality.cve_rules(), "bronze_nvd_raw")[0]
    values = ["cvss_v3_score", "cvss_v3_severity"]
    found = history.intervals(history.points(sent, ["cve_id"], "last_modified_at", values, ["batch_id"]), ["cve_id"], "last_modified_at", values)
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("valid_from", "valid_to")})


@query("""SELECT strftime(published, '%Y-%m') AS month, count(*) AS cves, min(score) AS least_score, max(score) AS greatest_score, count(DISTINCT severity_key) AS severities FROM cve GROUP BY 1""")
def maintained_months(spark, sf_dir):
    """Months of publication, made of the first sending and brought up to date by the second in two rounds: only records that are sent again are read for them."""
    records = Q.parsed_records(spark, sf_dir, children=False)
    first, second = (records.where(F.col("batch_id") == b) for b in (synthetic.FIRST, synthetic.SECOND))
    columns = ["month", "severity_key", "score"]

    def rows(sent):
        c = shape.silver_cves(sent, LOADED)[0]
        return c.select(F.date_format("published_at", "yyyy-MM").alias("month"), K.severity_key(F.col("cvss_v3_severity"), F.col("cvss_v3_score")).alias("severity_key"), F.col("cvss_v3_score").alias("score"))

    state = CountedState(spark, scratch_folder(spark, "maintained-months"), ["month"], ["severity_key", "score"])
    made = rows(first)
    state.apply(difference(made.limit(0), made, columns))
    number = F.substring("cve_id", 10, 20).try_cast("bigint")
    before = first
    for half in (second.where(number % 2 == 0), second.where(F.coalesce(number % 2 != 0, F.lit(True)))):
        sent = half.select("cve_id").distinct()
        old = before.join(sent, "cve_id", "left_semi")
        state.apply(difference(rows(old), rows(old.unionByName(half)), columns))
    return state.groups(made, cves=F.sum("n"), least_score=F.min("score"), greatest_score=F.max("score"), severities=F.count_distinct("severity_key"))


# Levels, frames, sketches and samples.
@query("""SELECT year(published)::INT AS year, severity_key, vendor, GROUPING(year(published)::INT, severity_key, vendor)::INT AS level, count(DISTINCT bp.cve_id) AS n
  FROM bp JOIN (SELECT cve_id, published FROM fact) AS f ON bp.cve_id = f.cve_id
  GROUP BY GROUPING SETS ((year(published)::INT, severity_key, vendor), (year(published)::INT, severity_key), (year(published)::INT, vendor), (vendor), (year(published)::INT), ())""")
def report_levels(spark, sf_dir):
    """Records by year, severity and vendor with subtotals; a record of several vendors counts once in each total."""
    t = Q.silver(spark, sf_dir, "cves", "kev", "products")
    b = Q.bridge_products(t).join(star.dim_vendor_product(t["products"], Q.RUN, LOADED), "vendor_product_key")
    rows = b.select(F.floor(F.col("published_date_key") / 10000).cast("int").alias("year"), "severity_key", "vendor", "cve_id")
    levels = [["year", "severity_key", "vendor"], ["year", "severity_key"], ["year", "vendor"], ["vendor"], ["year"], []]
    return analytics.distinct_by_levels(rows, ["year", "severity_key", "vendor"], levels, "cve_id")


@query("""SELECT vendor, strftime(day, '%Y-%m-%d') AS day, n, (sum(n) OVER (w RANGE BETWEEN 29 PRECEDING AND CURRENT ROW))::BIGINT AS last_30, (sum(n) OVER (w RANGE BETWEEN 89 PRECEDING AND CURRENT ROW))::BIGINT AS last_90,
    (sum(n) OVER (w RANGE UNBOUNDED PRECEDING))::BIGINT AS total, (day - lag(day) OVER w)::INT AS days_since
  FROM (SELECT bp.vendor, f.published AS day, count(*) AS n, (f.published - DATE '1970-01-01')::INT AS d FROM bp JOIN fact AS f ON bp.cve_id = f.cve_id GROUP BY ALL) WINDOW w AS (PARTITION BY vendor ORDER BY d)""")
def report_moving(spark, sf_dir):
    """How many products of each vendor were named in the last 30 and 90 days, day by day."""
    t = Q.silver(spark, sf_dir, "cves", "kev", "products")
    b = Q.bridge_products(t).join(star.dim_vendor_product(t["products"], Q.RUN, LOADED), "vendor_product_key")
    rows = b.select("vendor", F.to_date(F.col("published_date_key").cast("string"), "yyyyMMdd").alias("day"))
    return analytics.moving(analytics.daily(rows, ["vendor"], "day"), ["vendor"], "day").withColumn("day", F.col("day").cast("string"))


@query("SELECT kind, strftime(ts, '%Y-%m') AS month, count(DISTINCT client_id) AS clients, true AS within FROM clicks WHERE ts IS NOT NULL AND client_id IS NOT NULL GROUP BY ALL", prelude=False)
def sketched_clients(spark, sf_dir):
    """Clients per kind and month from stored sketches per kind and day, held against the exact number."""
    known = table(spark, sf_dir, "clicks").where("ts IS NOT NULL AND client_id IS NOT NULL")
    rows = known.select("kind", F.to_date("ts").alias("day"), "client_id")
    held = stored(analytics.sketches(rows, ["kind", "day"], "client_id"), "click-sketches")
    month = F.date_format("day", "yyyy-MM").alias("month")
    near = analytics.merged_counts(held.select("kind", month, "sketch"), ["kind", "month"], "near").withColumnsRenamed({"kind": "k", "month": "m"})
    exact = rows.select("kind", month, "client_id").groupBy("kind", "month").agg(F.count_distinct("client_id").alias("clients"))
    both = exact.join(near, F.col("kind").eqNullSafe(F.col("k")) & (F.col("month") == F.col("m")))
    return both.select("kind", "month", "clients", (F.abs(F.col("near") - F.col("clients")) <= analytics.error_bound(F.col("clients"))).alias("within"))


@query("""SELECT sale_id, status, priority, weight FROM (SELECT sale_id, status, priority, count(*) OVER w / least(count(*) OVER w, 50)::DOUBLE AS weight,
  row_number() OVER (PARTITION BY status, priority ORDER BY sha256('0:' || sale_id)) AS place FROM sales WINDOW w AS (PARTITION BY status, priority)) WHERE place <= 50""", prelude=False)
def sampled_sales(spark, sf_dir):
    """Fifty sales of each status and priority, with what each stands for."""
    return analytics.bottom_k(table(spark, sf_dir, "sales").select("sale_id", "status", "priority"), ["status", "priority"], F.col("sale_id"), 50)


@query("""WITH e AS (SELECT DISTINCT click_id, client_id, ts FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
f AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 15 MINUTE THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY client_id ORDER BY ts)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY client_id ORDER BY ts) AS session FROM f)
SELECT client_id, epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last, count(*) AS n FROM g GROUP BY client_id, session""", prelude=False)
def streamed_sessions(spark, sf_dir):
    """Sessions of the clicks, replayed in the order of their arrival in five files and two runs on one checkpoint. The watermark waits as long as the latest click was late."""
    clicks = table(spark, sf_dir, "clicks").select("click_id", "client_id", "ts", F.coalesce("arrived_at", "ts").alias("arrived")).where("ts IS NOT NULL AND client_id IS NOT NULL")
    seconds = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    late, ends = clicks.agg(F.max(seconds("arrived") - seconds("ts")).alias("late"), F.max("ts").alias("ends")).first()
    delay = f"{max(0, late or 0) + 2} seconds"
    cuts = clicks.select(F.percentile_approx(seconds("arrived"), [0.2, 0.4, 0.6, 0.8])).first()[0] or []
    folder, out, checkpoint = (scratch_folder(spark, f"sessions-{x}") for x in ("events", "out", "checkpoint"))
    part = sum((F.when(seconds("arrived") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    events = clicks.withColumn("part", part).drop("arrived")
    run = lambda: stream_sessions(spark, folder, events.drop("part").schema, out, checkpoint, "client_id", "ts", ["click_id", "client_id", "ts"], "15 minutes", delay, 64).awaitTermination()
    for number in range(len(cuts) + 1):
        events.where(F.col("part") == number).drop("part").write.parquet(f"{folder}/{number}")
        if number == 2:
            run()
    # One event long after all others lets the watermark pass every session; it is none itself.
    if ends is not None:
        after = (F.lit(ends) + F.make_dt_interval(F.lit(3), F.lit(0), F.lit(0), F.lit(2.0 * (late or 0)))).cast(events.schema["ts"].dataType)
        spark.range(1).select(F.lit(-1).cast("long").alias("click_id"), F.lit(-1).cast("long").alias("client_id"), after.alias("ts")).write.parquet(f"{folder}/end")
    run()
    run()
    found = spark.read.schema("client_id long, first timestamp, last timestamp, n long").parquet(out)
    return found.where("client_id <> -1").select("client_id", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"), "n")


@query("""SELECT strftime(ts, '%Y-%m') AS month, count(DISTINCT CASE WHEN kind = 'purchase' THEN client_id END) AS buyers,
  (SELECT count(*) FROM (SELECT client_id FROM clicks AS a WHERE kind = 'purchase' AND strftime(a.ts, '%Y-%m') = strftime(c.ts, '%Y-%m') AND client_id IS NOT NULL INTERSECT SELECT client_id FROM clicks AS b WHERE kind = 'error' AND strftime(b.ts, '%Y-%m') = strftime(c.ts, '%Y-%m'))) AS troubled, true AS within
  FROM clicks AS c WHERE ts IS NOT NULL AND client_id IS NOT NULL GROUP BY ALL""", prelude=False)
def sketched_overlaps(spark, sf_dir):
    """Clients who bought and met an error in one month, from stored theta sketches per day, held against the exact number."""
    known = table(spark, sf_dir, "clicks").where("ts IS NOT NULL AND client_id IS NOT NULL AND kind IN ('purchase', 'error')").select("kind", F.to_date("ts").alias("day"), "client_id")
    held = stored(known.groupBy("kind", "day").agg(F.theta_sketch_agg("client_id").alias("sketch")), "theta-sketches")
    month = F.date_format("day", "yyyy-MM").alias("month")
    one = lambda kind: F.theta_union_agg(F.when(F.col("kind") == kind, F.col("sketch")))
    merged = held.groupBy(month).agg(one("purchase").alias("p"), one("error").alias("e")).select(F.col("month").alias("m"), F.theta_sketch_estimate(F.theta_intersection("p", "e")).alias("near"), F.theta_sketch_estimate(F.theta_union("p", "e")).alias("all"))
    per = known.groupBy(month, "client_id").agg(F.max(F.col("kind") == "purchase").alias("p"), F.max(F.col("kind") == "error").alias("e"))
    exact = per.groupBy("month").agg(F.count_if("p").alias("buyers"), F.count_if(F.col("p") & F.col("e")).alias("troubled"))
    return exact.join(merged, F.col("month") == F.col("m")).select("month", "buyers", "troubled", (F.abs(F.col("near") - F.col("troubled")) <= 4 * F.col("all") / 64 + 1).alias("within"))


# Records by way of VARIANT.
@query(Q.ORACLE_SQL["silver_cve"], prelude=False)
def silver_cve_variant(spark, sf_dir):
    """The same rows as silver_cve, from texts that are parsed once."""
    shaped = variants.shaped_cves(variants.parsed(bronze(spark, sf_dir, children=False)), LOADED)
    valid, _ = shape.quality.split(shaped, shape.quality.cve_rules(), "bronze_nvd_raw")
    rows = shape.latest(valid, "cve_id", shape.CVE_ORDER)
    return rows.select("cve_id", shown("published_at"), shown("last_modified_at"), "vuln_status", "description_en", "cvss_v3_score", "cvss_v3_severity", "cvss_vector", "has_source_identifier")
