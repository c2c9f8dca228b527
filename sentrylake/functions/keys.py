"""Surrogate keys of the star: one expression each, used by every builder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Key, label, lowest and highest score, description. Order of severity.
SEVERITIES = (
    (1, "CRITICAL", 9.0, 10.0, "CVSS v3 base score 9.0-10.0"),
    (2, "HIGH", 7.0, 8.9, "CVSS v3 base score 7.0-8.9"),
    (3, "MEDIUM", 4.0, 6.9, "CVSS v3 base score 4.0-6.9"),
    (4, "LOW", 0.1, 3.9, "CVSS v3 base score 0.1-3.9"),
    (5, "NONE", 0.0, 0.0, "CVSS v3 base score 0.0"),
    (6, "UNKNOWN", None, None, "No CVSS v3 metric published (v2-only or awaiting analysis)"),
)
UNKNOWN_SEVERITY = 6
#: Identifiers of weaknesses that have no number.
UNNUMBERED_CWES = {"NVD-CWE-noinfo": -1, "NVD-CWE-Other": -2}


def date_key(moment: Column) -> Column:
    """yyyymmdd as a whole number; null for null."""
    day = F.to_date(moment)
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def severity_key(label: Column, score: Column) -> Column:
    """By the published label, whatever its case; without a known label by the score's band; else unknown."""
    named = F.create_map(*(F.lit(x) for key, name, *_ in SEVERITIES if key != UNKNOWN_SEVERITY for x in (name, key)))
    band = F.when(score == 0, 5).when(score > 0, F.when(score < 4, 4).when(score < 7, 3).when(score < 9, 2).otherwise(1))
    return F.coalesce(F.try_element_at(named, F.upper(label)), band, F.lit(UNKNOWN_SEVERITY)).cast("int")


def folded(name: Column) -> Column:
    return F.lower(F.trim(name))


def vendor_product_key(vendor: Column, product: Column) -> Column:
    """64-bit hash of the pair, blind to case and outer blanks."""
    return F.xxhash64(folded(vendor), F.lit("|"), folded(product))


def cwe_key(cwe_id: Column) -> Column:
    """The number of CWE-<number>, a negative one for the two unnumbered identifiers, null for all else and for numbers beyond an int."""
    unnumbered = F.create_map(*(F.lit(x) for pair in UNNUMBERED_CWES.items() for x in pair))
    number = F.nullif(F.regexp_extract(cwe_id, r"^CWE-(\d+)$", 1), F.lit("")).try_cast("int")
    return F.coalesce(F.try_element_at(unnumbered, cwe_id), number)


def cwe_category(cwe_id: Column) -> Column:
    """The unnumbered identifiers are categories of their own."""
    return F.when(cwe_id.isin(*UNNUMBERED_CWES), cwe_id).otherwise("CWE")
