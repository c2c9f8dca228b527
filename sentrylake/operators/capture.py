"""Feed records to bronze rows: text as it came, its hash, and where it came from."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import instant
from ..functions.records import fields
from ..schemas import BRONZE_CVE, BRONZE_KEV


def _literal(value) -> Column:
    return value if isinstance(value, Column) else instant(value) if isinstance(value, datetime) else F.lit(value)


def _provenance(source_uri: str | None, load_type: str | Column, batch_id: str | Column, loaded: datetime | Column) -> list[Column]:
    return [
        "raw_json",
        F.sha2("raw_json", 256).alias("payload_sha256"),
        F.lit(source_uri).cast("string").alias("source_uri"),
        _literal(load_type).alias("load_type"),
        _literal(batch_id).alias("batch_id"),
        _literal(loaded).alias("load_timestamp"),
    ]


def bronze_cves(texts: DataFrame, *, source_uri: str | None, load_type: str | Column, batch_id: str | Column, loaded: datetime | Column) -> DataFrame:
    """BRONZE_CVE from raw_json: only the id and the stamp of last change are lifted out. What differs from text to text of several batches is given as columns."""
    lifted = fields(texts, {"cve_id": "id", "source_last_modified": "lastModified"})
    return lifted.select("cve_id", "source_last_modified", *_provenance(source_uri, load_type, batch_id, loaded)).select(*BRONZE_CVE.names)


def bronze_kev(texts: DataFrame, *, source_uri: str | None, load_type: str | Column, batch_id: str | Column, loaded: datetime | Column) -> DataFrame:
    """BRONZE_KEV from catalog_version, date_released and raw_json."""
    lifted = fields(texts, {"cve_id": "cveID"})
    return lifted.select("cve_id", "catalog_version", "date_released", *_provenance(source_uri, load_type, batch_id, loaded)).select(*BRONZE_KEV.names)
