"""Schemas of feeds, tables and control records, each from one line of DDL per column group.

A feed is read in two steps: its envelope is typed, its records stay text; a record is typed later, field
by field. Scores are read as text, so that 7.5 and "7.5" come out alike and one cast settles both.
"""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructType

_SIMPLE = {"string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "timestamp": T.TimestampType, "date": T.DateType}


def _split(text: str) -> list[str]:
    """Cuts at commas outside angle brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[start:i].strip())
            start = i + 1
    return [*out, text[start:].strip()]


def _kind(text: str) -> T.DataType:
    low = text.lower()
    if low.startswith("array<"):
        return T.ArrayType(_kind(text[6:-1].strip()))
    if low.startswith("struct<"):
        return StructType([T.StructField(n.strip(), _kind(k.strip())) for n, k in (f.split(":", 1) for f in _split(text[7:-1]))])
    return _SIMPLE[low]()


def ddl(*columns: str) -> StructType:
    """Column names with types; a trailing ``!`` forbids nulls. Needs no session, so that importing this doesn't."""
    fields = []
    for line in columns:
        for part in _split(line):
            name, kind = part.split(" ", 1)
            fields.append(T.StructField(name, _kind(kind.rstrip("!").strip()), not kind.endswith("!")))
    return StructType(fields)


# Feeds. The records of either envelope stay verbatim text.
CVE_PAGE = ddl("resultsPerPage INT, startIndex INT, totalResults INT, format STRING, version STRING, timestamp STRING, vulnerabilities ARRAY<STRUCT<cve: STRING>>")
KEV_CATALOG = ddl("title STRING, catalogVersion STRING, dateReleased STRING, count INT, vulnerabilities ARRAY<STRING>")

_METRIC = "ARRAY<STRUCT<source: STRING, type: STRING, cvssData: STRUCT<version: STRING, vectorString: STRING, baseScore: STRING, baseSeverity: STRING>>>"
_MATCH = "STRUCT<vulnerable: BOOLEAN, criteria: STRING, matchCriteriaId: STRING, versionStartIncluding: STRING, versionStartExcluding: STRING, versionEndIncluding: STRING, versionEndExcluding: STRING>"
CVE_RECORD = ddl(
    f"descriptions ARRAY<STRUCT<lang: STRING, value: STRING>>, metrics STRUCT<cvssMetricV31: {_METRIC}, cvssMetricV30: {_METRIC}>, "
    "weaknesses ARRAY<STRUCT<source: STRING, type: STRING, description: ARRAY<STRUCT<lang: STRING, value: STRING>>>>, "
    f"configurations ARRAY<STRUCT<operator: STRING, negate: BOOLEAN, nodes: ARRAY<STRUCT<operator: STRING, negate: BOOLEAN, cpeMatch: ARRAY<{_MATCH}>>>>>"
)

#: Fixed values of the feeds: the top-level keys of their records. Others are drift.
CVE_KEYS = ("id", "sourceIdentifier", "published", "lastModified", "vulnStatus", "cveTags", "descriptions", "metrics", "weaknesses", "configurations", "references", "cisaExploitAdd", "cisaActionDue", "cisaRequiredAction", "cisaVulnerabilityName", "affected", "evaluatorComment", "evaluatorSolution", "evaluatorImpact")
KEV_KEYS = ("cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded", "shortDescription", "requiredAction", "dueDate", "knownRansomwareCampaignUse", "notes", "cwes", "forensicTriage")

_LOADED = "batch_id string!, load_timestamp timestamp!"
_RAW = "raw_json string!, payload_sha256 string!, source_uri string, load_type string!"
_PAYLOAD = "payload_sha256 string!"

# Tables. Bronze keeps null ids: they are rejected later, with a reason.
BRONZE_CVE = ddl("cve_id string, source_last_modified string", _RAW, _LOADED)
BRONZE_KEV = ddl("cve_id string, catalog_version string, date_released string", _RAW, _LOADED)
SILVER_CVE = ddl("cve_id string!, published_at timestamp!, last_modified_at timestamp!, vuln_status string, description_en string, cvss_v3_score double, cvss_v3_severity string, cvss_vector string, has_source_identifier boolean", _PAYLOAD, _LOADED)
SILVER_KEV = ddl("cve_id string!, vendor_project string, product string, vulnerability_name string, date_added date!, due_date date, known_ransomware_campaign_use string, required_action string, catalog_version string", _PAYLOAD, _LOADED)
SILVER_PRODUCT = ddl("cve_id string!, criteria string!, part string, vendor string, product string, version string, vulnerable boolean, version_start_including string, version_start_excluding string, version_end_including string, version_end_excluding string, last_modified_at timestamp", _PAYLOAD, _LOADED)
SILVER_CWE = ddl("cve_id string!, cwe_id string!, last_modified_at timestamp", _PAYLOAD, _LOADED)
QUARANTINE = ddl("source_table string!, cve_id string, reason string!, raw_json string", _PAYLOAD, _LOADED)

DIM_DATE = ddl("date_key int!, full_date date!, year int!, quarter int!, month int!, month_name string!, year_month string!, day int!, day_of_week int!, day_name string!, week_of_year int!, is_weekend boolean!", _LOADED)
DIM_SEVERITY = ddl("severity_key int!, severity string!, score_min double, score_max double, sort_order int!, description string", _LOADED)
DIM_CVE = ddl("cve_id string!, description_en string, vuln_status string, cvss_vector string, has_source_identifier boolean, is_in_kev boolean!, kev_vendor_project string, kev_product string, kev_vulnerability_name string, known_ransomware_campaign_use string, kev_required_action string, kev_due_date date", _LOADED)
DIM_PRODUCT = ddl("vendor_product_key bigint!, vendor string!, product string!, part string", _LOADED)
DIM_CWE = ddl("cwe_key int!, cwe_id string!, cwe_category string!", _LOADED)
FACT_CVE = ddl("cve_id string!, published_date_key int!, last_modified_date_key int, kev_added_date_key int, kev_due_date_key int, severity_key int!, cvss_v3_score double, is_exploited int!, is_ransomware int!, days_to_kev int, product_count int, cwe_count int, cve_count int!", _LOADED)
_SHARED = "published_date_key int!, severity_key int!, is_exploited int!, cvss_v3_score double"
FACT_PRODUCT = ddl("cve_id string!, vendor_product_key bigint!", _SHARED, _LOADED)
FACT_CWE = ddl("cve_id string!, cwe_key int!", _SHARED, _LOADED)

AUDIT_LOG = ddl("batch_id string!, layer string!, source string!, load_type string!, parameters string, started_at timestamp!, finished_at timestamp!, status string!, rows_read bigint, rows_inserted bigint, rows_updated bigint, rows_quarantined bigint, error_message string, load_timestamp timestamp!")
WATERMARKS = ddl("source string!, watermark_ts timestamp!", _LOADED)

#: Columns that say when and by which run a row was written; they never make a row count as changed.
AUDIT_COLUMNS = ("batch_id", "load_timestamp")
