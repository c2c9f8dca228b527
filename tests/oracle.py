"""Runs a query and its SQL over the same tables and compares rows without regard to order."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(_plain, value))
    return value


def rows_of(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        source = p if p.is_file() else p / "*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{source}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    by = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in by], sorted((tuple(_plain(r[i]) for i in by) for r in found.fetchall()), key=repr)


def same(df, sql: str, sf_dir: str) -> None:
    names, wanted = sql_rows(sql, sf_dir)
    assert sorted(df.columns) == names
    assert rows_of(df) == wanted
