"""The registry of tables: schemas, keys, references, and what is generated from them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas as S


@dataclass(frozen=True)
class Table:
    name: str
    schema: StructType
    comment: str
    keys: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()
    layer: str = "gold"


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    to: str
    to_column: str
    role: str = ""
    active: bool = True


TABLES = {t.name: t for t in (
    Table("bronze_nvd_raw", S.BRONZE_CVE, "Records of the CVE feed as they came, one row per record and batch", layer="bronze"),
    Table("bronze_cisa_raw", S.BRONZE_KEV, "Entries of the exploited catalog as they came, one row per entry and snapshot", layer="bronze"),
    Table("silver_cve", S.SILVER_CVE, "Typed records, the newest valid version of each", ("cve_id",), layer="silver"),
    Table("silver_kev", S.SILVER_KEV, "Typed catalog entries, the newest of each", ("cve_id",), layer="silver"),
    Table("silver_affected_product", S.SILVER_PRODUCT, "Product criteria of each record's newest version", ("cve_id", "criteria"), layer="silver"),
    Table("silver_cwe", S.SILVER_CWE, "Weaknesses of each record's newest version", ("cve_id", "cwe_id"), layer="silver"),
    Table("silver_quarantine", S.QUARANTINE, "Rejected rows with the first rule that each broke", layer="silver"),
    Table("dim_date", S.DIM_DATE, "Calendar", ("date_key",)),
    Table("dim_severity", S.DIM_SEVERITY, "Severities with their score bands", ("severity_key",)),
    Table("dim_cve", S.DIM_CVE, "What describes a record (type 1)", ("cve_id",)),
    Table("dim_vendor_product", S.DIM_PRODUCT, "Vendor and product pairs (type 1)", ("vendor_product_key",)),
    Table("dim_cwe", S.DIM_CWE, "Weakness identifiers (type 1)", ("cwe_key",)),
    Table("fact_cve", S.FACT_CVE, "Dates, severity, exploitation and counts of each record", ("cve_id",), ("published_date_key", "severity_key")),
    Table("fact_cve_product", S.FACT_PRODUCT, "Bridge of records and affected products", ("cve_id", "vendor_product_key"), ("vendor_product_key",)),
    Table("fact_cve_cwe", S.FACT_CWE, "Bridge of records and weaknesses", ("cve_id", "cwe_key"), ("cwe_key",)),
    Table("pipeline_execution_logs", S.AUDIT_LOG, "A row per table write of each run", layer="control"),
    Table("pipeline_watermarks", S.WATERMARKS, "History of high-water marks; the current one is the largest", layer="control"),
)}


def _references() -> tuple[Reference, ...]:
    """Every fact refers to its record, its dimension, its severity and its dates; one date of a fact is the active one."""
    out = []
    for name in ("fact_cve", "fact_cve_product", "fact_cve_cwe"):
        out.append(Reference(name, "cve_id", "dim_cve", "cve_id"))
        for c in TABLES[name].schema.names:
            if c.endswith("_date_key"):
                role = c.removesuffix("_date_key")
                out.append(Reference(name, c, "dim_date", "date_key", role, role == "published"))
        out.append(Reference(name, "severity_key", "dim_severity", "severity_key"))
    out.append(Reference("fact_cve_product", "vendor_product_key", "dim_vendor_product", "vendor_product_key"))
    out.append(Reference("fact_cve_cwe", "cwe_key", "dim_cwe", "cwe_key"))
    return tuple(out)


REFERENCES = _references()


def column_ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema)


def create_sql(table: Table, database: str, using: str = "PARQUET") -> str:
    """CREATE TABLE for a catalog; clustering columns where the format takes them."""
    cluster = f" CLUSTER BY ({', '.join(table.cluster)})" if table.cluster else ""
    return f"CREATE TABLE IF NOT EXISTS {database}.{table.name} ({column_ddl(table.schema)}) USING {using}{cluster} COMMENT '{table.comment}'"


def key_violations(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The key values that are null or occur more than once, with ``n``."""
    null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null)


def orphans(rows: DataFrame, column: str, to: DataFrame, to_column: str) -> DataFrame:
    """The referring rows without a partner; a null refers to nothing."""
    known = to.select(F.col(to_column).alias(column))
    return rows.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def check(read, tables: list[str] | None = None) -> dict[str, int]:
    """Violations by constraint, 0 where it holds. read: name -> DataFrame; only tables that are named (all) are looked at."""
    names = set(tables or TABLES)
    out = {f"pk_{t.name}": key_violations(read(t.name), t.keys).count() for t in TABLES.values() if t.layer == "gold" and t.name in names}
    for r in REFERENCES:
        if {r.table, r.to} <= names:
            out[f"fk_{r.table}_{r.column}"] = orphans(read(r.table), r.column, read(r.to), r.to_column).count()
    return out


def dictionary() -> str:
    """The gold tables in Markdown: an entity diagram and a table of columns each, from the registry alone."""
    gold = [t for t in TABLES.values() if t.layer == "gold"]
    lines = ["# Gold model", "", "```mermaid", "erDiagram"]
    lines += [f"    {r.to} ||--o{{ {r.table} : \"{r.role or r.column}\"" for r in REFERENCES]
    for t in gold:
        lines += [f"    {t.name} {{", *(f"        {f.dataType.simpleString()} {f.name}{' PK' if f.name in t.keys else ''}" for f in t.schema), "    }"]
    lines.append("```")
    for t in gold:
        points = {r.column: f"{r.to}.{r.to_column}" for r in REFERENCES if r.table == t.name}
        lines += ["", f"## {t.name}", "", f"{t.comment}. Key: {', '.join(t.keys)}.", "", "| column | type | null | refers to |", "|-|-|-|-|"]
        lines += [f"| {f.name} | {f.dataType.simpleString()} | {'yes' if f.nullable else 'no'} | {points.get(f.name, '')} |" for f in t.schema]
    return "\n".join(lines) + "\n"
