"""Records by way of VARIANT: a text is parsed once, fields are taken by path, and drift is found at any depth.

``shape`` reads the same rows by a typed record beside scalars by path; here one parsed value serves both.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import feed_instant, instant
from ..functions.records import first, preferred_metric
from ..schemas import CVE_KEYS, CVE_RECORD, SILVER_CVE

_TYPED = {f.name: f.dataType for f in CVE_RECORD}


def parsed(bronze: DataFrame) -> DataFrame:
    """Bronze rows with ``record``, the parsed text; null for text that isn't JSON. What stands for a key twice is no JSON here."""
    return bronze.withColumns({"cve_id": F.trim("cve_id"), "record": F.try_parse_json("raw_json")})


def _at(path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("record"), f"$.{path}", kind)


def shaped_cves(records: DataFrame, loaded: datetime) -> DataFrame:
    """SILVER_CVE with raw_json, from ``parsed`` rows. A field of another kind than expected is null and leaves its neighbours alone."""
    entries = _TYPED["metrics"]["cvssMetricV31"].dataType.simpleString()
    taken = records.withColumns({"metrics": F.struct(_at("metrics.cvssMetricV31", entries).alias("cvssMetricV31"), _at("metrics.cvssMetricV30", entries).alias("cvssMetricV30")), "descriptions": _at("descriptions", _TYPED["descriptions"].simpleString())})
    taken = taken.withColumn("metric", preferred_metric(F.col("metrics"))["cvssData"])
    made = {
        "published_at": feed_instant(_at("published")), "last_modified_at": feed_instant(_at("lastModified")), "vuln_status": _at("vulnStatus"), "description_en": first(F.col("descriptions"), lambda d: d["lang"] == "en")["value"],
        "cvss_v3_score": F.col("metric.baseScore").try_cast("double"), "cvss_v3_severity": F.upper("metric.baseSeverity"), "cvss_vector": F.col("metric.vectorString"),
        "has_source_identifier": _at("sourceIdentifier").isNotNull(), "load_timestamp": instant(loaded),
    }
    return taken.withColumns(made).select(*SILVER_CVE.names, "raw_json")


_NAME = re.compile(r"(`(?:[^`]|``)*`|[^:]*): (.*)", re.DOTALL)


def _fields(text: str) -> list[str]:
    """Cuts at commas outside brackets and quoted names."""
    out, depth, quoted, start = [], 0, False, 0
    for i, c in enumerate(text):
        quoted ^= c == "`"
        depth += 0 if quoted else (c in "<(") - (c in ">)")
        if c == "," and not depth and not quoted:
            out.append(text[start:i].strip())
            start = i + 1
    return [*out, text[start:].strip()]


def _paths(shape: str, prefix: str = "") -> set[str]:
    """Paths of the fields of a merged variant schema, arrays being passed through. What has several kinds in several records has no fields here."""
    if shape.startswith("ARRAY<"):
        return _paths(shape[6:-1], prefix)
    if not shape.startswith("OBJECT<") or shape == "OBJECT<>":
        return set()
    out: set[str] = set()
    for field in _fields(shape[7:-1]):
        name, kind = _NAME.fullmatch(field).groups()
        path = prefix + (name[1:-1].replace("``", "`") if name.startswith("`") else name)
        out |= {path} | _paths(kind, f"{path}.")
    return out


def _typed_paths(kind: T.DataType, prefix: str) -> set[str]:
    if isinstance(kind, T.ArrayType):
        return _typed_paths(kind.elementType, prefix)
    if not isinstance(kind, T.StructType):
        return set()
    return {p for f in kind for p in ({f"{prefix}{f.name}"} | _typed_paths(f.dataType, f"{prefix}{f.name}."))}


def drift(records: DataFrame) -> list[str]:
    """Paths that no contract knows, at any depth of the fields that are typed and at the top; of others only the top is known. Only the merged
    schema of all records reaches the driver."""
    found = _paths(records.agg(F.schema_of_variant_agg("record")).first()[0])
    known = set(CVE_KEYS) | _typed_paths(CVE_RECORD, "")
    free = tuple(f"{k}." for k in CVE_KEYS if k not in _TYPED)
    strange = {p for p in found if p not in known and not p.startswith(free)}
    return sorted(p for p in strange if not any(p.startswith(f"{q}.") for q in strange))
