"""The analytic surface: queries over the star, the silver tables and the control tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _rows() -> Column:
    return F.count(F.lit(1))



def _total(flag: str) -> Column:
    return F.coalesce(F.sum(flag), F.lit(0)).cast("bigint")


def by_severity(facts: DataFrame, severities: DataFrame) -> DataFrame:
    """severity, cves, exploited, avg_score; in order of severity."""
    sums = facts.groupBy("severity_key").agg(_rows().alias("cves"), _total("is_exploited").alias("exploited"), F.round(F.avg("cvss_v3_score"), 2).alias("avg_score"))
    return sums.join(F.broadcast(severities.select("severity_key", "severity", "sort_order")), "severity_key").orderBy("sort_order").select("severity", "cves", "exploited", "avg_score")


def kpis(facts: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: records, distinct ones, critical, exploited, ransomware, and median (exact unless ``approximate``), least and most days to listing."""
    middle = F.percentile_approx("days_to_kev", 0.5) if approximate else F.median("days_to_kev")
    return facts.agg(
        _rows().alias("rows"), F.count_distinct("cve_id").alias("distinct_cves"), F.count_if(F.col("severity_key") == 1).alias("critical"), _total("is_exploited").alias("in_kev"), _total("is_ransomware").alias("ransomware"),
        middle.cast("double").alias("median_days"), F.min("days_to_kev").alias("min_days"), F.max("days_to_kev").alias("max_days"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, rows."""
    return reduce(DataFrame.unionAll, [t.agg(_rows().alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, t in tables.items()])


def top_vendors(bridge: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """vendor, cves, exploited_cves: records count once for a vendor, however many of its products they touch."""
    per = bridge.join(products.select("vendor_product_key", "vendor"), "vendor_product_key")
    once = per.groupBy("vendor", "cve_id").agg(F.max("is_exploited").alias("hit"))
    return once.groupBy("vendor").agg(_rows().alias("cves"), _total("hit").alias("exploited_cves")).orderBy(F.desc("cves"), "vendor").limit(n)


def top_cwes(bridge: DataFrame, cwes: DataFrame, n: int = 10, exploited_only: bool = False) -> DataFrame:
    """cwe_id, cves, exploited_cves."""
    rows = bridge.where("is_exploited = 1") if exploited_only else bridge
    sums = rows.groupBy("cwe_key").agg(_rows().alias("cves"), _total("is_exploited").alias("exploited_cves"))
    return sums.join(cwes.select("cwe_key", "cwe_id"), "cwe_key").select("cwe_id", "cves", "exploited_cves").orderBy(F.desc("cves"), "cwe_id").limit(n)


def calendar_check(dates: DataFrame) -> DataFrame:
    """year, days, weekend_days."""
    return dates.groupBy("year").agg(_rows().alias("days"), F.count_if("is_weekend").alias("weekend_days")).orderBy("year")


def year_by_severity(facts: DataFrame, severities: DataFrame) -> DataFrame:
    """year, severity, cves."""
    sums = facts.groupBy(F.floor(F.col("published_date_key") / 10000).cast("int").alias("year"), "severity_key").agg(_rows().alias("cves"))
    return sums.join(F.broadcast(severities.select("severity_key", "severity")), "severity_key").select("year", "severity", "cves").orderBy("year", "severity")


def kev_histogram(facts: DataFrame, width: int = 30) -> DataFrame:
    """bin_start, cves: days from publication to listing in bins of ``width`` days."""
    bin_ = (F.floor(F.col("days_to_kev") / width) * width).cast("int")
    return facts.where(F.col("days_to_kev").isNotNull()).groupBy(bin_.alias("bin_start")).agg(_rows().alias("cves")).orderBy("bin_start")


def batch_history(bronze: DataFrame, by: str) -> DataFrame:
    """batch_id, the column ``by``, rows, first_loaded."""
    return bronze.groupBy("batch_id", by).agg(_rows().alias("rows"), F.min("load_timestamp").alias("first_loaded")).orderBy("first_loaded", "batch_id")


def quarantine_by_reason(rejected: DataFrame) -> DataFrame:
    """source_table, reason, rows."""
    return rejected.groupBy("source_table", "reason").agg(_rows().alias("rows")).orderBy("source_table", "reason")


def silver_summary(cves: DataFrame, kev: DataFrame, products: DataFrame, cwes: DataFrame) -> DataFrame:
    """table_name, rows, ids, flagged: scored records, ransomware entries, vulnerable products; null for weaknesses."""
    flags = (("silver_cve", cves, F.col("cvss_v3_score").isNotNull()), ("silver_kev", kev, F.col("known_ransomware_campaign_use") == "Known"), ("silver_affected_product", products, F.col("vulnerable")), ("silver_cwe", cwes, None))
    lines = [t.agg(_rows().alias("rows"), F.count_distinct("cve_id").alias("ids"), (F.lit(None).cast("bigint") if flag is None else F.count_if(flag)).alias("flagged")).select(F.lit(name).alias("table_name"), "*") for name, t, flag in flags]
    return reduce(DataFrame.unionAll, lines)


def monthly_trend(facts: DataFrame) -> DataFrame:
    """month (yyyymm), cves, critical, exploited."""
    return facts.groupBy(F.floor(F.col("published_date_key") / 100).cast("int").alias("month")).agg(_rows().alias("cves"), F.count_if(F.col("severity_key") == 1).alias("critical"), _total("is_exploited").alias("exploited")).orderBy("month")


def vendor_risk(bridge: DataFrame, products: DataFrame) -> DataFrame:
    """vendor, cves, exploited_cves, exploit_ratio, max_score."""
    per = bridge.join(products.select("vendor_product_key", "vendor"), "vendor_product_key")
    once = per.groupBy("vendor", "cve_id").agg(F.max("is_exploited").alias("hit"), F.max("cvss_v3_score").alias("score"))
    sums = once.groupBy("vendor").agg(_rows().alias("cves"), _total("hit").alias("exploited_cves"), F.max("score").alias("max_score"))
    return sums.withColumn("exploit_ratio", F.round(F.col("exploited_cves") / F.col("cves"), 4)).select("vendor", "cves", "exploited_cves", "exploit_ratio", "max_score")


def kev_response(facts: DataFrame) -> DataFrame:
    """listed_year, listed, avg_days, within_30: how soon after publication records are listed."""
    rows = facts.where(F.col("kev_added_date_key").isNotNull()).withColumn("listed_year", F.floor(F.col("kev_added_date_key") / 10000).cast("int"))
    return rows.groupBy("listed_year").agg(_rows().alias("listed"), F.round(F.avg("days_to_kev"), 2).alias("avg_days"), F.count_if(F.col("days_to_kev") <= 30).alias("within_30")).orderBy("listed_year")


def runs_by_day(log: DataFrame) -> DataFrame:
    """day, status, runs."""
    return log.groupBy(F.to_date("started_at").alias("day"), "status").agg(F.count_distinct("batch_id").alias("runs")).orderBy("day", "status")


def rows_by_layer(log: DataFrame) -> DataFrame:
    """layer, writes, failed, rows_inserted, rows_updated, rows_quarantined, last_finished."""
    sums = [_total(c).alias(c) for c in ("rows_inserted", "rows_updated", "rows_quarantined")]
    return log.groupBy("layer").agg(_rows().alias("writes"), F.count_if(F.col("status") == "FAILURE").alias("failed"), *sums, F.max("finished_at").alias("last_finished")).orderBy("layer")


def operations(log: DataFrame, marks: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row on the pipeline's health: runs, failed_runs, last_finished, last_watermark, quarantined."""
    runs = log.agg(F.count_distinct("batch_id").alias("runs"), F.count_distinct(F.when(F.col("status") == "FAILURE", F.col("batch_id"))).alias("failed_runs"), F.max("finished_at").alias("last_finished"))
    mark = marks.agg(F.max("watermark_ts").alias("last_watermark"))
    held = rejected.agg(_rows().alias("quarantined"))
    one = F.lit(1).alias("one")
    return runs.select("*", one).join(mark.select("*", one), "one").join(held.select("*", one), "one").drop("one")
