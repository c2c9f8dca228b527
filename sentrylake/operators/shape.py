"""Bronze rows to typed silver rows, and the children inside a record.

A record is parsed once: ``parsed`` adds the typed record, and cves, products and weaknesses are all
projections of that. Scalars are read by path, so that one broken nested field can't blank a row.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.clock import feed_instant, instant
from ..functions.records import cpe_part, cpe_parts, drifted, fields, first, preferred_metric
from ..schemas import CVE_KEYS, CVE_RECORD, KEV_KEYS, QUARANTINE, SILVER_CVE, SILVER_CWE, SILVER_KEV, SILVER_PRODUCT
from . import quality
from .dedup import latest

CVE_ORDER = ["last_modified_at", "batch_id", "payload_sha256"]
KEV_ORDER = ["catalog_version", "batch_id", "payload_sha256"]
#: The vulnerable entry of a criterion wins, then the greatest bounds.
PRODUCT_ORDER = ["vulnerable", "version_end_excluding", "version_end_including", "version_start_including", "version_start_excluding", "last_modified_at", "payload_sha256"]


def parsed(bronze: DataFrame, parts: Iterable[str] = CVE_RECORD.names) -> DataFrame:
    """Bronze rows with ``cve_id`` trimmed, ``last_modified_at``, the other scalars as texts (_published, _status, _source) and the typed ``record``.

    parts: the nested fields of ``record`` that are wanted; others are passed over.
    """
    rows = fields(bronze, {"_modified": "lastModified", "_published": "published", "_status": "vulnStatus", "_source": "sourceIdentifier"})
    wanted = StructType([f for f in CVE_RECORD if f.name in set(parts)])
    return rows.withColumns({"cve_id": F.trim("cve_id"), "last_modified_at": feed_instant(F.col("_modified")), "record": F.from_json("raw_json", wanted)}).drop("_modified")


def shaped_cves(records: DataFrame, loaded: datetime) -> DataFrame:
    """SILVER_CVE with raw_json and unknown_keys, from ``parsed`` rows. Of the source's contact only whether there is one is kept."""
    records = records.withColumn("metric", preferred_metric(F.col("record.metrics"))["cvssData"])
    metric = F.col("metric")
    made = {
        "published_at": feed_instant(F.col("_published")),
        "vuln_status": F.col("_status"),
        "description_en": first(F.col("record.descriptions"), lambda d: d["lang"] == "en")["value"],
        "cvss_v3_score": metric["baseScore"].try_cast("double"),
        "cvss_v3_severity": F.upper(metric["baseSeverity"]),
        "cvss_vector": metric["vectorString"],
        "has_source_identifier": F.col("_source").isNotNull(),
        "unknown_keys": drifted(CVE_KEYS),
    }
    return records.select("*", *(c.alias(n) for n, c in made.items())).withColumn("load_timestamp", instant(loaded)).select(*SILVER_CVE.names, "raw_json", "unknown_keys")


def shaped_kev(bronze: DataFrame, loaded: datetime) -> DataFrame:
    """SILVER_KEV with raw_json and unknown_keys. Only the id is trimmed."""

    def day(text: str) -> Column:
        return F.try_to_date(F.col(text), "yyyy-MM-dd")

    texts = {"vendor_project": "vendorProject", "product": "product", "vulnerability_name": "vulnerabilityName", "_added": "dateAdded", "_due": "dueDate", "known_ransomware_campaign_use": "knownRansomwareCampaignUse", "required_action": "requiredAction"}
    made = {"cve_id": F.trim("cve_id"), "date_added": day("_added"), "due_date": day("_due"), "load_timestamp": instant(loaded), "unknown_keys": drifted(KEV_KEYS)}
    return fields(bronze, texts).withColumns(made).select(*SILVER_KEV.names, "raw_json", "unknown_keys")


def latest_records(records: DataFrame, *parts: str) -> DataFrame:
    """The newest version of each record with a valid id, whether or not its other fields are valid: children are taken of no other. parts: the only ones of ``record`` that are kept, if any are named."""
    if parts:
        records = records.withColumn("record", F.struct(*(F.col(f"record.{p}").alias(p) for p in parts)))
    return latest(records.where(quality.valid_id()), "cve_id", CVE_ORDER)


def shaped_products(newest: DataFrame, loaded: datetime) -> DataFrame:
    """SILVER_PRODUCT with raw_json (the criterion) and cpe_fields: a row per match of each node of each configuration."""
    nodes = newest.select("*", F.explode(F.flatten("record.configurations.nodes")).alias("node"))
    # Cut before the explosion, so that rules on the fields, which move up to it, don't cut each criterion again.
    cut = F.transform("node.cpeMatch", lambda m: F.struct(m.alias("match"), cpe_parts(m["criteria"]).alias("parts")))
    match = nodes.select("*", F.explode(cut).alias("cut")).select("*", "cut.match", "cut.parts")
    parts = F.col("parts")
    bounds = {"version_start_including": "versionStartIncluding", "version_start_excluding": "versionStartExcluding", "version_end_including": "versionEndIncluding", "version_end_excluding": "versionEndExcluding"}
    made = {
        "criteria": F.trim("match.criteria"), **{name: cpe_part(parts, n) for n, name in enumerate(("part", "vendor", "product", "version"), 3)}, "vulnerable": F.col("match.vulnerable"),
        **{name: F.col(f"match.{own}") for name, own in bounds.items()}, "load_timestamp": instant(loaded), "raw_json": F.col("match.criteria"), "cpe_fields": F.size(parts),
    }
    return match.withColumns(made).select(*SILVER_PRODUCT.names, "raw_json", "cpe_fields")


def shaped_cwes(newest: DataFrame, loaded: datetime) -> DataFrame:
    """SILVER_CWE with raw_json (the identifier): a row per English description of each weakness."""
    each = newest.select("*", F.explode(F.flatten("record.weaknesses.description")).alias("named")).where("named.lang = 'en'")
    made = {"cwe_id": F.trim("named.value"), "load_timestamp": instant(loaded), "raw_json": F.col("named.value")}
    return each.withColumns(made).select(*SILVER_CWE.names, "raw_json")


def silver_cves(records: DataFrame, loaded: datetime) -> tuple[DataFrame, DataFrame]:
    """(one valid row per id, rejected rows)."""
    valid, rejected = quality.split(shaped_cves(records, loaded), quality.cve_rules(), "bronze_nvd_raw")
    return latest(valid, "cve_id", CVE_ORDER).select(*SILVER_CVE.names), rejected


def silver_kev(bronze: DataFrame, loaded: datetime) -> tuple[DataFrame, DataFrame]:
    valid, rejected = quality.split(shaped_kev(bronze, loaded), quality.kev_rules(), "bronze_cisa_raw")
    return latest(valid, "cve_id", KEV_ORDER).select(*SILVER_KEV.names), rejected


def silver_products(records: DataFrame, loaded: datetime) -> tuple[DataFrame, DataFrame]:
    valid, rejected = quality.split(shaped_products(latest_records(records, "configurations"), loaded), quality.product_rules(), "bronze_nvd_raw")
    return latest(valid, ["cve_id", "criteria"], PRODUCT_ORDER).select(*SILVER_PRODUCT.names), quality.child_hash(rejected)


def silver_cwes(records: DataFrame, loaded: datetime) -> tuple[DataFrame, DataFrame]:
    valid, rejected = quality.split(shaped_cwes(latest_records(records, "weaknesses"), loaded), quality.cwe_rules(), "bronze_nvd_raw")
    return latest(valid, ["cve_id", "cwe_id"], ["last_modified_at", "payload_sha256"]).select(*SILVER_CWE.names), quality.child_hash(rejected)


def settled(shaped: DataFrame, rules: quality.Rules, keys: list[str], order: list[str]) -> DataFrame:
    """Both outcomes of typed rows in one pass: rejected rows with their reason, and of the others the newest of each key, without a reason and its text."""
    reason, raw = F.col("reason"), F.col("raw_json")
    tagged = quality.tagged(shaped, rules).withColumn("raw_json", F.when(reason.isNotNull(), raw))
    # Rejected rows are told apart by their hash, so that those without an id don't all meet in one task.
    by = Window.partitionBy(*keys, F.when(reason.isNotNull(), F.col("payload_sha256"))).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return tagged.withColumn("_place", F.row_number().over(by)).where(reason.isNotNull() | (F.col("_place") == 1)).drop("_place")


def settled_cves(bronze: DataFrame, loaded: datetime) -> DataFrame:
    """What ``silver_cves`` parts, in one frame with ``reason``; types only its own part of a record, as do those of the children."""
    return settled(shaped_cves(parsed(bronze, ("descriptions", "metrics")), loaded).drop("unknown_keys"), quality.cve_rules(), ["cve_id"], CVE_ORDER)


def settled_kev(bronze: DataFrame, loaded: datetime) -> DataFrame:
    return settled(shaped_kev(bronze, loaded).drop("unknown_keys"), quality.kev_rules(), ["cve_id"], KEV_ORDER)


def settled_products(bronze: DataFrame, loaded: datetime) -> DataFrame:
    newest = latest_records(parsed(bronze, ("configurations",)), "configurations")
    return settled(shaped_products(newest, loaded), quality.product_rules(), ["cve_id", "criteria"], PRODUCT_ORDER).drop("cpe_fields")


def settled_cwes(bronze: DataFrame, loaded: datetime) -> DataFrame:
    newest = latest_records(parsed(bronze, ("weaknesses",)), "weaknesses")
    return settled(shaped_cwes(newest, loaded), quality.cwe_rules(), ["cve_id", "cwe_id"], ["last_modified_at", "payload_sha256"])


def parted(both: DataFrame, schema: StructType, source_table: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows as QUARANTINE) of a ``settled`` frame."""
    rejected = both.where(F.col("reason").isNotNull()).withColumn("source_table", F.lit(source_table))
    return both.where(F.col("reason").isNull()).select(*schema.names), rejected.select(*QUARANTINE.names)


def unknown_keys(bronze: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """unknown_keys of each row, with nothing else of it read."""
    return bronze.select(drifted(known).alias("unknown_keys"))


def drift(shaped: DataFrame) -> DataFrame:
    """unknown_keys: one row with the sorted keys that no contract knows."""
    return shaped.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("unknown_keys")))).alias("unknown_keys"))


def filter_bronze(bronze: DataFrame, batch_id: str | None = None, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """Rows of a batch and of days of loading, both ends included. The bounds are on the raw column, so they reach the scan."""
    if batch_id:
        bronze = bronze.where(F.col("batch_id") == batch_id)
    if from_date:
        bronze = bronze.where(F.col("load_timestamp") >= F.lit(from_date).cast("timestamp"))
    if to_date:
        bronze = bronze.where(F.col("load_timestamp") < F.date_add(F.lit(to_date).cast("date"), 1).cast("timestamp"))
    return bronze
