"""Rules that a silver row must keep, and the split into valid rows and rejected ones.

A rule is a condition under which a row is bad, with a reason. A row's reason is that of the first rule
that it breaks, in the order of the rules; an unknown condition breaks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import QUARANTINE

Rules = list[tuple[Column, str]]

#: What ids look like, and the reasons.
CVE_ID = r"^CVE-\d{4}-\d{4,}$"
CWE_ID = r"^(CWE-\d+|NVD-CWE-noinfo|NVD-CWE-Other)$"
MISSING_ID, BAD_ID = "missing_cve_id", "invalid_cve_id_format"
BAD_PUBLISHED, BAD_LAST_MODIFIED, BAD_DATE_ADDED = "unparseable_published", "unparseable_last_modified", "unparseable_date_added"
BAD_CPE, BAD_CWE = "invalid_cpe_criteria", "invalid_cwe_id"


def valid_id() -> Column:
    return F.col("cve_id").rlike(CVE_ID)


def id_rules() -> Rules:
    return [(F.coalesce(F.trim("cve_id"), F.lit("")) == "", MISSING_ID), (~valid_id(), BAD_ID)]


def cve_rules() -> Rules:
    return [*id_rules(), (F.isnull("published_at"), BAD_PUBLISHED), (F.isnull("last_modified_at"), BAD_LAST_MODIFIED)]


def kev_rules() -> Rules:
    """A due date may be unreadable; the date added may not."""
    return [*id_rules(), (F.isnull("date_added"), BAD_DATE_ADDED)]


def _must(hold: Column, reason: str) -> Rules:
    """Unknown counts as broken."""
    return [(~F.coalesce(hold, F.lit(False)), reason)]


def product_rules() -> Rules:
    """cpe:2.3 with 13 fields, a known part, and a vendor and product that name something."""
    named = [~F.col(c).isin("", "*", "-") for c in ("vendor", "product")]
    return _must(F.startswith("criteria", F.lit("cpe:2.3:")) & (F.col("cpe_fields") == 13) & F.col("part").isin("a", "o", "h") & named[0] & named[1], BAD_CPE)


def cwe_rules() -> Rules:
    return _must(F.col("cwe_id").rlike(CWE_ID), BAD_CWE)


def first_broken(rules: Rules) -> Column:
    """The reason of the first rule that is broken; null if none is."""
    return F.coalesce(*(F.when(bad, reason) for bad, reason in rules))


def tagged(rows: DataFrame, rules: Rules) -> DataFrame:
    return rows.withColumn("reason", first_broken(rules))


def split(rows: DataFrame, rules: Rules, source_table: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows as they were, rejected rows as QUARANTINE)."""
    t = tagged(rows, rules)
    rejected = t.where(F.col("reason").isNotNull()).withColumn("source_table", F.lit(source_table))
    return t.where(F.col("reason").isNull()).drop("reason"), rejected.select(*QUARANTINE.names)


def child_hash(rejected: DataFrame) -> DataFrame:
    """Rejected children of one record get a hash each, of the record's and their own text."""
    return rejected.withColumn("payload_sha256", F.sha2(F.concat_ws("|", "payload_sha256", "raw_json"), 256))
