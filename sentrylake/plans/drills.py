"""Drills: what the pipeline does with broken and drifting records, tried on copies of its tables.

One captured record is sent again in altered forms, each with an outcome that is known beforehand.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import shape
from ..operators import upsert as U
from .run import Warehouse

#: The altered forms by their batch: a later version, one without an id, one with a broken date, one with an unknown key and scores as text.
LATER, NAMELESS, DATELESS, DRIFTED = "drill-later", "drill-nameless", "drill-dateless", "drill-drifted"
NEW_IDS = {DATELESS: "CVE-2199-70001", DRIFTED: "CVE-2199-70002"}
COPIES = {"silver_cve": "drill_silver_cve", "silver_quarantine": "drill_silver_quarantine"}


def _with_text(name: str, value: str) -> Column:
    """The record's text with another text as the value of every field of that name."""
    return F.regexp_replace("raw_json", rf'"{name}"(\s*):(\s*)"[^"]*"', f'"{name}"$1:$2"{value}"')


def altered(record: DataFrame) -> DataFrame:
    """The four forms of one bronze row, each as a batch of its own."""
    forms = {
        LATER: {"raw_json": _with_text("lastModified", "2098-06-01T00:00:00.000")},
        NAMELESS: {"cve_id": F.lit(None).cast("string")},
        DATELESS: {"cve_id": F.lit(NEW_IDS[DATELESS]), "raw_json": _with_text("published", "some day")},
        DRIFTED: {"cve_id": F.lit(NEW_IDS[DRIFTED]), "raw_json": F.regexp_replace(F.regexp_replace("raw_json", r"^\s*\{", '{"unheardOf":1,'), r'"baseScore"\s*:\s*([0-9.]+)', '"baseScore":"$1"')},
    }
    return reduce(DataFrame.unionByName, [record.withColumns(changes | {"batch_id": F.lit(batch)}) for batch, changes in forms.items()])


def run(spark: SparkSession, warehouse: Warehouse, loaded: datetime) -> dict:
    """Makes the copies, sends the forms through typing, rules and upserts, and says what became of them. The tables themselves stay as they are.

    The record is the first by id and batch that silver holds with a score.
    """
    for name, copy in COPIES.items():
        warehouse.store.copy(name, copy)
    bronze = warehouse.table("bronze_nvd_raw")
    scored = warehouse.table("silver_cve").where("cvss_v3_score is not null").select("cve_id")
    # Only names travel to find the record; its text is fetched where it lies, once for all forms.
    first = bronze.select("cve_id", "batch_id").join(scored, "cve_id", "left_semi").orderBy("cve_id", "batch_id").limit(1).collect()
    found = bronze.where((F.col("cve_id") == first[0]["cve_id"]) & (F.col("batch_id") == first[0]["batch_id"])) if first else bronze
    with warehouse.store.staging() as staged:
        records = shape.parsed(staged(altered(staged(found.limit(1 if first else 0)))))
        valid, rejected = shape.silver_cves(records, loaded)
        done = warehouse.store.upsert(valid, COPIES["silver_cve"], U.newer)
        done["quarantined"] = warehouse.store.insert_new(rejected, COPIES["silver_quarantine"])
        done["unknown_keys"] = list(shape.drift(shape.shaped_cves(records, loaded)).first()[0] or [])
    return done
