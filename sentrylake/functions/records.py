"""Expressions over record text and its typed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNESCAPED_COLON = r"(?<!\\):"


def field(path: str, text: str = "raw_json") -> Column:
    """A scalar of the record by path; a broken neighbour doesn't touch it."""
    return F.get_json_object(F.col(text), f"$.{path}")


def fields(rows: DataFrame, names: dict[str, str], text: str = "raw_json") -> DataFrame:
    """``rows`` with top-level scalars of the record as columns (column: key), read as by ``field`` but all in one pass over the text.

    Filters on them stay behind the reading and don't repeat it. Of a key that a record repeats the last counts.
    """
    return rows.select("*", F.json_tuple(F.col(text), *names.values()).alias(*names))


def first(items: Column, wanted) -> Column:
    """The first item that ``wanted`` holds for; null if there is none."""
    return F.try_element_at(F.filter(items, wanted), F.lit(1))


def preferred_metric(metrics: Column) -> Column:
    """Of each version, newest first, the primary entry, else the first one."""
    def best(of: Column) -> Column:
        return F.coalesce(first(of, lambda m: m["type"] == "Primary"), F.try_element_at(of, F.lit(1)))

    return F.coalesce(best(metrics["cvssMetricV31"]), best(metrics["cvssMetricV30"]))


def drifted(known: tuple[str, ...], text: str = "raw_json") -> Column:
    """Top-level keys of the record that the contract doesn't know."""
    return F.array_except(F.json_object_keys(F.col(text)), F.array(*map(F.lit, known)))


def cpe_parts(criteria: Column) -> Column:
    """The colon-separated fields; an escaped colon belongs to its field."""
    return F.when(F.contains(criteria, F.lit("\\")), F.split(criteria, _UNESCAPED_COLON)).otherwise(F.split(criteria, ":"))


def cpe_part(parts: Column, n: int) -> Column:
    """Field n (from 1) without escapes; null where there are fewer."""
    part = F.try_element_at(parts, F.lit(n))
    return F.when(F.contains(part, F.lit("\\")), F.regexp_replace(part, r"\\(.)", "$1")).otherwise(part)
